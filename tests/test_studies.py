"""Facts, grounding, passages, claims, sources: small fixtures with hand-derived results."""

import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from lodestone.functions import grounding as gr
from lodestone.operators import claims, constraints, facts, nested, passages, projections, review
from lodestone.sources import files, shared


def value(name, raw, number=None, unit=None):
    return {"name": name, "raw_value": raw, "value_number": number, "unit": unit, "evidence": [{"block_id": "b1", "quote": raw}]}


def study(pce=20.1, unit="%", material="Gold", direction="reverse", steps=("spin coating", "annealing")):
    return {
        "device_families": [{
            "family_id": "f1", "label": "design", "variant": None, "polarity": "n-i-p", "full_stack_raw": "ITO/x/Au",
            "layers": [{"layer_id": "l1", "sequence": 1, "role": "back_electrode", "material": material, "constituents": [{"name": "PbI2", "role": "precursor", "amount": value("ratio", "1 M", 1.0, "M")}], "material_form": "not_reported", "reported_properties": [value("Gold thickness", "80 nm", 80.0, "nm")]}],
            "absorbers": [{"absorber_id": "a1", "layer_id": None, "label": "main", "formula": value("formula", "CH₃NH₃PbI₃"), "properties": [], "constituents": []}],
            "processing_steps": [{"step_id": f"s{i}", "sequence": i, "operation": name, "target_layer_ids": ["l1"], "materials": [], "conditions": [value("annealing temperature", "100 °C", 100.0, "°C")] if name != "spin coating" else []} for i, name in enumerate(steps, 1)],
        }],
        "individual_devices": [{"device_id": "d1", "family_id": "f1", "label": "champion", "champion_status": "yes", "selection_basis": "champion", "subject_context": None, "reported_properties": []}],
        "performance_observations": [{"observation_id": "o1", "device_id": "d1", "measurement_type": "jv_scan", "scan_direction": direction, "measurement_conditions": [value("scan rate", "50 mV/s", 50.0, "mV/s")], "metrics": [value("PCE", f"{pce}", pce, unit), value("Voc (V)", "1.1", 1.1, None), value("note", "not reported")]}],
        "population_statistics": [{"population_id": "p1", "family_id": "f1", "label": "Device A", "statistic_type": "mean", "sample_size": 12, "subjects": [], "error_bar_type": "Standard deviation", "measurement_type": "jv_scan", "scan_direction": "not_reported", "measurement_conditions": [], "metrics": [value("average PCE", "19 %", 19.0, "%")]}],
        "stability_tests": [{"test_id": "t1", "family_id": "f1", "device_id": None, "specimen_label": "cell", "link_status": "linked", "conditions": [value("temperature", "65 °C", 65.0, "°C")], "checkpoints": [{"checkpoint_id": "c1", "time": value("time", "1000 h", 1000.0, "h"), "conditions": [], "outcomes": [value("PCE retention", "90 %", 90.0, "%")]}]}],
    }


PAIRS = [("device_families", "f1"), ("individual_devices", "d1"), ("performance_observations", "o1"), ("population_statistics", "p1"), ("stability_tests", "t1")]


@pytest.fixture(scope="module")
def scored(spark):
    """Facts and compared pairs of four papers at once: alike, different, without pairs of records, and empty."""
    papers = {"alike": (study(), study(pce=0.201, unit="dimensionless", material="Au layer")), "other": (study(), study(pce=18.0, direction="forward", steps=("spin coating",))), "unpaired": (study(), study()), "empty": ({}, {"device_families": []})}
    rows = spark.createDataFrame([(p, side, json.dumps(x)) for p, sides in papers.items() for side, x in zip(("truth", "prediction"), sides)], "paper_id string, side string, document string")
    known = spark.createDataFrame([(p, k, i, i) for p in ("alike", "other") for k, i in PAIRS], "paper_id string, kind string, truth_id string, prediction_id string")
    found = facts.facts(facts.with_identities(facts.read_studies(rows), known))
    found = spark.createDataFrame(found.collect(), found.schema)  # the fixture's facts, read once
    pairs = facts.compared(found)
    pairs = spark.createDataFrame(pairs.collect(), pairs.schema)
    hits = facts.matches(pairs)
    hits = spark.createDataFrame(hits.collect(), hits.schema)
    return found, pairs, hits


def test_facts_of_a_study(scored):
    found, pairs, hits = scored
    truth = {r.path: r for r in found.where("side = 'truth' and paper_id = 'alike'").collect()}
    assert {p: (r.field, r.subfield, r.domain) for p, r in truth.items() if p.endswith(("/metrics/0", "/operation", "/formula", "/outcomes/0", "/name"))} == {
        "/performance_observations/0/metrics/0": ("measurement:pce", "photovoltaic_metrics", "performance"),
        "/population_statistics/0/metrics/0": ("measurement:pce", "photovoltaic_metrics", "performance"),
        "/device_families/0/processing_steps/0/operation": ("processing:operation", "processing_operations", "processing"),
        "/device_families/0/processing_steps/1/operation": ("processing:operation", "processing_operations", "processing"),
        "/device_families/0/absorbers/0/formula": ("material:formula", "material_identity", "material_device_identity"),
        "/stability_tests/0/checkpoints/0/outcomes/0": ("aging_outcome:efficiencyretention", "stability_outcomes", "stability"),
        "/device_families/0/layers/0/constituents/0/name": ("recipe:constituent", "recipe_composition", "processing"),
    }
    assert "/performance_observations/0/metrics/2" not in truth and "/device_families/0/full_stack_raw" not in truth
    voc = truth["/performance_observations/0/metrics/1"]
    assert (voc.name, voc.value.unit) == ("voc", "V") and voc.context["champion_status"] == "yes" and voc.context["family_id"] == "device_families:f1"
    assert truth["/device_families/0/layers/0/reported_properties/0"].name == "thickness" and truth["/device_families/0/layers/0/material"].text == "Au"
    assert truth["/population_statistics/0/error_bar_type"].text == "standard_deviation" and truth["/population_statistics/0/metrics/0"].context["statistic_type"] == "mean"


def test_scores_of_studies(scored):
    found, pairs, hits = scored
    total = {r.paper_id: r for r in facts.view(found, hits).where("by = 'all'").collect()}
    assert total["alike"].truth == total["alike"].predicted == total["alike"].matched >= 20 and total["alike"].f1 == 1.0
    assert "empty" not in total and total["unpaired"].matched == 0
    states = {(r.paper_id, r.side, r.path): r.state for r in facts.blockers(found, pairs, hits).collect()}
    assert {s for (p, *_), s in states.items() if p == "alike"} == {"matched"}
    assert states["other", "truth", "/performance_observations/0/metrics/0"] == "no_equal_value"
    assert states["other", "truth", "/performance_observations/0/metrics/1"] == "conflicting_context"  # the other scan direction
    assert states["other", "truth", "/device_families/0/processing_steps/1/conditions/0"] == "no_candidate"
    recovered = {(r.paper_id, r.truth_path) for r in facts.matches(pairs, "recovery").collect()}
    assert ("other", "/performance_observations/0/metrics/1") in recovered and len([p for p, _ in recovered if p == "unpaired"]) >= 20


QUOTES = [
    ("Efficiency of 20.1 % was found", "efficiency of 20.1%", True), ("values 200–300 nm thick", "200-300 nm", True), ("the IV curve", "I–V curve", True), ("ran at 0.5 V", "-0.5 V", False), ("Superconductor", "CONDUCT", False),
    ("10 士 1 nm", "10 ± 1 nm", True), ("10 士士 1 nm", "10 ± 1 nm", False), ("a b", "", False), ("a \\E(x) b", "\\E(x)", True), ("per cent. IV x, XIV", "I–V", True), ("200300 nm thick", "200-300 nm", True), ("12 3 V", "123 v", True), (None, "x", False), ("x", None, False), ("112 V", "12 v", False),
]
VALUES = [("gave 20.1 %.", "20.1%", True), ("gave 120.1 %", "20.1%", False), ("Fe³⁺ ions", "Fe³", False), ("Fe³⁺ ions", "Fe3+", False), ("1.25 V", "1.2", False), ("at −0.5 V", "-0.5 V", True), ("at -0.5 V", "0.5 V", False), ("10 士 1", "10±1", True), (None, "1", False), ("MAPbI3-x", "MAPbI3", True), ("10-5 A", "10", False), ("1.10 V", "10 V", False), ("x(1)\\Q 2", "(1)\\Q", True), ("10-fold", "10", True), ("m^2", "m", False), ("5 cells", "5c", False), ("20 . 1 %", "20.1%", True)]


def test_grounding(spark):
    for column, cases in ((gr.contains_quote, QUOTES), (gr.contains_value, VALUES)):
        df = spark.createDataFrame(cases, "s string, q string, w boolean")
        assert [(r.s, r.q, r.got) for r in df.select("s", "q", column(df.s, df.q).alias("got")).collect()] == cases
    df = spark.createDataFrame([("0.2 Å s-1", "Å s-1", "0.2 and 0.1", "rates 0.2 and 0.1 Å s-1"), ("0.2 nm", "Å", "0.2", "x")], "v string, u string, q string, c string")
    assert [r[0] for r in df.select(gr.shares_unit(df.v, df.u, df.q, df.c)).collect()] == [True, False]


def _counted(text):
    """What of a text counts, a character at a time."""
    out = []
    for x in unicodedata.normalize("NFKC", text):
        x = "-" if unicodedata.category(x) == "Pd" or x == "−" else x
        out += [y for y in x.casefold() if y.isalnum() or y in "_.%<>~=+/-"]
    return "".join(out)


def test_plain_values_need_no_pattern(spark, monkeypatch):
    """What stands alone in plain text is found without a pattern; all else is judged as before."""
    texts = ["a 1.2 V", "a 1.2 V. b", "1.2 V", "a -1.2 V", "a 1.2 V.5", "a 1.2 V-", "a 1.2 V+ b", "a 1.2 Va", "11.2 V", "a 1.2  V", "a 1.2 V\u0301", "a \u22121.2 V b", "", "b 1.2 V, c", "1.2 V .", None]
    values = ["1.2 V", "1.2", "V", " 1.2 V", "", "1.2 V.", "-1.2 V", "\\Q", None]
    rows = spark.createDataFrame([(t, v) for t in texts for v in values], "t string, v string")
    both = lambda: rows.select("t", "v", gr.contains_value(F.col("t"), F.col("v")).alias("x"), gr.contains_quote(F.col("t"), F.col("v")).alias("y")).collect()
    quick = both()
    assert rows.where(gr._stands_alone(F.col("v"), F.col("t"))).count() > 20
    monkeypatch.setattr(gr, "_stands_alone", lambda v, t: F.lit(False))
    monkeypatch.setattr(gr, "_ascii", lambda t: F.lit(False))
    assert quick == both()


def test_folding(spark):
    rng = random.Random(1)
    points = [chr(x) for x in (*range(0x20, 0x250), *range(0x2010, 0x2060), 0x2212, 0xFF0D, 0xFE63, 0x1E9E, 0xFB01, 0x2126, 0x3C2)]
    texts = ["".join(rng.choice(points) for _ in range(30)) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    assert [r[0] for r in df.select(gr.folded(df.s)).collect()] == [_counted(x) for x in texts]


def test_passages():
    text = "First sentence here. " * 60 + "x" * 3000 + " End. And 5."
    parts = passages.passages_of(text, "text")
    assert all(0 < len(p) <= passages.LONGEST for p in parts) and "".join(parts).replace(" ", "") == text.replace(" ", "") and max(len(p) for p in parts[:2]) <= passages.TARGET
    assert passages.passages_of("a | b\n\n c\n", "Table") == ["a | b", "c"] and passages.passages_of(None, None) == [] and passages.passages_of("one", "text") == ["one"]


def rows_of(sizes, section=lambda i: "s", page=lambda i: i // 2):
    return [{"size": n, "section": section(i), "page": page(i), "id": i} for i, n in enumerate(sizes)]


def test_packing():
    ids = lambda groups: [[r["id"] for r in g] for g in groups]
    assert ids(passages.packed(rows_of([100] * 6), 400)) == [[0, 1, 2, 3], [4, 5]]
    assert ids(passages.packed(rows_of([100] * 6, section=lambda i: i // 3), 400)) == [[0, 1, 2], [3, 4, 5]]
    assert ids(passages.packed(rows_of([50, 800, 50, 50]), 400)) == [[0], [1], [2, 3]]
    assert list(passages.halved("w", [10, 10, 10, 10], 5, 25, lambda n: n)) == [("w-a", 0, 2, False), ("w-b", 2, 4, False)]
    with pytest.raises(ValueError):
        list(passages.halved("w", [30], 0, 25, lambda n: n))


def test_windows_cover_all_blocks(spark):
    rows = [("p", i, "main" if i < 3 else "si", None, i // 2, 100, f"b{i}") for i in range(9)]
    blocks = spark.createDataFrame(rows, "doc string, order int, source string, section string, page int, size int, block_id string")
    plan = passages.plan_windows(blocks, ["doc"], "order", budget=700, context_budget=350)
    got = plan.orderBy("window_id", "position").collect()
    assert [(r.window_id, r.block_id, r.has_context) for r in got][:4] == [("main-0001", "b0", False), ("main-0001", "b1", False), ("main-0001", "b2", False), ("si-0001", "b3", True)]
    assert passages.cover_issues(blocks, plan, ["doc"]).count() == 0
    assert {(r.block_id, r.issue) for r in passages.cover_issues(blocks, plan.where("block_id <> 'b1'").union(plan.where("block_id = 'b2'")), ["doc"]).collect()} == {("b1", "missing"), ("b2", "repeated")}
    sized = plan.join(blocks.select("block_id", "size"), "block_id").withColumn("context_size", F.lit(300))
    fitted = passages.fit_windows(sized, ["doc"], 64 + 70)
    assert fitted.groupBy("window_id").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0] <= 210 and fitted.count() == 9
    spans = passages.number_passages(spark.createDataFrame([("p", 1, "b1", "One. Two.", "text"), ("p", 2, "b2", "x\ny", "table")], "doc string, order int, block_id string, text string, kind string"), ["doc"], "order")
    assert [(r.span_id, r.text) for r in spans.orderBy("span_id").collect()] == [(1, "One. Two."), (2, "x"), (3, "y")]
    assert len(passages.catalog_digest(spans, ["doc"]).first().digest) == 64


def test_ledger(spark):
    blocks = spark.createDataFrame([("p", "b1", "We made cell A with 20.1 % efficiency.", "main", 1, 1), ("p", "b2", "Other text here.", "main", 2, 2), ("p", "b3", "An SI text of 3 V.", "si", 1, 3)], "paper_id string, block_id string, text string, source string, page int, order int")
    objects = spark.createDataFrame([("p", "o1", "A", "individual_device", "target"), ("p", "o2", "B", "population", "target"), ("p", "o3", "C", "other", "context")], "paper_id string, object_id string, label string, role string, scope string")
    noted = spark.createDataFrame([("p", "c1", "20.1 %"), ("p", "c2", "21 %"), ("p", "c3", None)], "paper_id string, claim_id string, raw_value string")
    subjects = spark.createDataFrame([("p", "c1", "o1"), ("p", "c3", "o2")], "paper_id string, claim_id string, object_id string")
    cited = spark.createDataFrame([("p", "o1", "b1", "cell A with 20.1 % efficiency"), ("p", "o2", "b2", "no such text"), ("p", "o3", "b3", "SI text"), ("p", "c1", "b1", "20.1 %"), ("p", "c2", "b1", "20.1 %"), ("p", "c3", "b3", "3 V")], "paper_id string, owner_id string, block_id string, quote string")
    kept, good, lost = claims.ground(objects, noted, subjects, cited, blocks)
    assert {r.object_id for r in kept.collect()} == {"o1", "o3"} and {r.claim_id for r in good.collect()} == {"c1"}
    assert {(r.source_id, r.reason) for r in lost.collect()} == {("o2", "unresolved evidence"), ("c2", "raw value absent from cited evidence"), ("c3", "unresolved evidence or subject")}
    recorded = spark.createDataFrame([("p", "individual_device", "d1"), ("p", "stability_test", "t1")], "paper_id string, kind string, record_id string")
    of_records = spark.createDataFrame([("p", "individual_device", "d1", "b1", "made cell A with 20.1 % efficiency.")], "paper_id string, kind string, record_id string, block_id string, quote string")
    covered = claims.object_coverage(objects, cited, recorded, of_records)
    assert {(r.id, r.status, tuple(r.record_ids)) for r in covered.collect()} == {("o1", "covered", ("d1",)), ("o2", "unmatched", ()), ("o3", "context", ()), ("unclaimed:stability_test:t1", "unclaimed", ("t1",))}
    assert {r.block_id for r in claims.cited_blocks(blocks, cited.where("block_id = 'b3'")).collect()} == {"b1", "b3"}
    wrong = spark.createDataFrame([("p", "x", "b2", "cell A with 20.1 % efficiency"), ("p", "y", "b2", "3 V"), ("p", "z", "b1", "cell A"), ("p", "w", "b1", "never said anywhere at all")], "paper_id string, owner_id string, block_id string, quote string")
    assert {(r.owner_id, r.new_block_id, r.status) for r in claims.relinked(wrong, blocks).collect()} == {("x", "b1", "relinked"), ("y", None, "too_short"), ("z", "b1", "kept"), ("w", None, "unresolved")}
    spans = spark.createDataFrame([("p", 1, "b1", "one two"), ("p", 2, "b1", "two three")], "paper_id string, span_id long, block_id string, text string")
    quotes = spark.createDataFrame([("p", "b1", "one two"), ("p", "b1", "three"), ("p", "b1", "two")], "paper_id string, block_id string, quote string")
    assert {(r.quote, r.span_id) for r in claims.compact_spans(quotes, spans).collect()} == {("one two", 1), ("three", 2), ("two", None)}
    assert {r.span_id for r in claims.cited_spans(spans, blocks.where("block_id = 'b2'"), quotes.where("quote = 'one two'").withColumn("owner_id", F.lit("c"))).collect()} == {1, 2}


def test_reviews_after_a_cutoff(spark):
    catalog = spark.createDataFrame([("p", "a:1", "x"), ("p", "a:2", "x"), ("p", "b:1", "x"), ("q", "a:1", "x")], "paper_id string, record_key string, digest string")
    touches = spark.createDataFrame([("p", 5, "a:1", "a", "e1", "mutation", True), ("p", 6, None, "b", "e2", "mutation", False), ("p", 2, "a:2", "a", "e3", "mutation", True), ("q", 9, None, None, "e4", "mutation", False)], "paper_id string, revision long, record_key string, collection string, event_id string, kind string, removed boolean")
    cutoffs = spark.createDataFrame([("p", 3), ("q", 3)], "paper_id string, cutoff long")
    assert {(r.paper_id, r.record_key) for r in review.untouched(catalog, touches, cutoffs).collect()} == {("p", "a:2")}
    assert {(r.event_id, tuple(r.removed), r.metadata_changed) for r in review.scope_changes(touches, cutoffs).collect()} == {("e1", ("a:1",), False), ("e4", (), True)}
    stages = spark.createDataFrame([("p", "r", "fields"), ("p", "s", "inventory"), ("p", "s", "fields")], "paper_id string, reviewer_id string, stage string")
    made = spark.createDataFrame([("p", "s", k) for k in ("a:1", "a:2", "b:1")], "paper_id string, reviewer_id string, record_key string")
    assert {(r.reviewer_id, r.issue) for r in review.stage_gate(stages, made, catalog, ["inventory", "fields"]).collect()} == {("r", "predecessor not complete"), ("r", "records without a decision")}


def test_documents():
    before, after = nested.edit({"a": [1, {"b~/": 2}]}, "replace", "/a/1/b~0~1", 3)
    assert (before, after) == (2, {"a": [1, {"b~/": 3}]}) and nested.edit({"a": []}, "add", "/a/-", 1)[1] == {"a": [1]}
    for action, pointer in (("remove", "/x"), ("add", "/a"), ("replace", "/a/5")):
        with pytest.raises((KeyError, IndexError)):
            nested.edit({"a": [1]}, action, pointer, 0)


def test_agreement_of_scalars(spark):
    left = spark.createDataFrame([(1, '{"label": "Straße", "n": [1, 2]}'), (2, '{"label": "cell A"}'), (3, None)], "paper int, doc string")
    right = spark.createDataFrame([(1, '{"label": "STRASSE", "n": [2, 3]}'), (1, '{"label": "x"}'), (2, '{"label": "CELL  a"}')], "paper int, doc string")
    assert {tuple(r) for r in nested.scalar_agreement(left, right, ["paper"], "doc").collect()} == {(1, 4, 2), (2, 1, 1)}


def test_legacy_absorbers(spark):
    part = "struct<evidence:array<struct<block_id:string,quote:string>>>"
    schema = f"family_id string, layers array<struct<layer_id:string,role:string,material:string>>, evidence array<struct<block_id:string,quote:string>>, absorber_formula {part}, absorber_properties array<{part}>, absorber_constituents array<{part}>"
    cite = [{"block_id": "b", "quote": "q"}]
    rows = [("f", [("l1", "absorber", "MAPbI3"), ("l2", "other", "x")], cite, {"evidence": cite * 3}, [], []), ("g", [], cite, None, [], None)]
    got = {r.family_id: r.absorbers for r in constraints.scoped_absorbers(spark.createDataFrame(rows, schema)).collect()}
    assert [(a.absorber_id, a.layer_id, a.label, len(a.evidence)) for a in got["f"]] == [("f-absorber-1", "l1", "MAPbI3", 1)] and got["g"] == []


def test_flat_metrics(spark):
    rows = [(1, "PCE", 20.0, "%"), (1, "Jsc", 23.0, "mA/cm²"), (1, "Voc", 1.1, "foo"), (1, "odd", 1.0, None), (2, "PCE", 1.0, "%"), (2, "Efficiency", 2.0, "%"), (3, "FF", None, "%")]
    flat, rest = projections.project_metrics(spark.createDataFrame(rows, "k int, name string, value_number double, unit string"), ["k"])
    assert {(r.k, r.pce, r.jsc, r.jsc_unit, r.voc) for r in flat.collect()} == {(1, 20.0, 23.0, "mA cm^-2", None), (2, None, None, None, None), (3, None, None, None, None)}
    assert {(r.k, r.name, r.issue) for r in rest.collect()} == {(1, "Voc", "incompatible_metric_unit"), (1, "odd", None), (2, "PCE", "ambiguous_metric"), (2, "Efficiency", "ambiguous_metric"), (3, "FF", "incompatible_metric_unit")}


def test_sources(spark, tmp_path):
    (tmp_path / "runs.csv").write_text("paper_id,arm,repeat,run_dir\np,control,1,a\np,treatment,,b\n")
    assert [tuple(r) for r in files.read_roster(spark, str(tmp_path / "runs.csv")).collect()] == [("p", "control", 1, "a", "paired"), ("p", "treatment", None, "b", "paired")]
    (tmp_path / "bad.csv").write_text("paper_id,arm\np,control\n")
    with pytest.raises(ValueError):
        files.read_roster(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "events.jsonl").write_text('{"event_version": 1, "event": "start", "sequence": 1}\n')
    assert files.read_events(spark, str(tmp_path / "e")).count() == 1
    (tmp_path / "e" / "later.jsonl").write_text('{"event_version": 9, "event": "start"}\n')
    with pytest.raises(Exception, match="event version 9"):
        files.read_events(spark, str(tmp_path / "e")).collect()
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.json").write_text('{"version": 1, "papers": {"x": "new"}}')
    documents = files.read_documents(spark, str(tmp_path / "d"))
    assert files.read_state(documents, 1).first().papers == {"x": "new"}
    with pytest.raises(Exception, match="newer version"):
        files.read_state(documents, 0).collect()
    listed = files.file_hashes(spark, str(tmp_path / "d"))
    assert files.verify_manifest(listed.select("path", "sha256"), listed).count() == 0
    assert {r.issue for r in files.verify_manifest(listed.select("path", F.lit("x").alias("sha256")), listed).collect()} == {"changed"}
    for run in ("r1", "r2", "r1"):
        files.append_ledger(spark.range(3), str(tmp_path / "ledger"), run)
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 6


def test_events_of_an_interrupted_writer(spark, tmp_path):
    line = '{"event_version":1,"event":"e","event_id":"%s","sequence":1,"timestamp":"2024-01-01T00:00:00","run_id":"r"}'
    whole = "\n".join(line % i for i in range(5))
    cases = {"ended": (whole + "\n", 5), "open": (whole, 5), "cut": (whole + "\n" + (line % 9)[:40], 5), "only": ("{", 0), "bad": (whole + "\n{\n", None), "middle": ("{\n" + whole, None), "two": ("{\n" + whole + "\n{", None)}
    for name, (text, n) in cases.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "e.jsonl").write_text(text)
        if n is None:
            with pytest.raises(Exception):
                files.read_events(spark, str(tmp_path / name)).collect()
        else:
            assert files.read_events(spark, str(tmp_path / name)).count() == n, name


def test_a_spine_stands_wherever_a_quotation_does(spark):
    texts = ["the gap is 1.5±0.1 eV here", "the gap is 1.5士0.1 eV here", "the gap is 1.50.1 eV here", "well-known spin-coating was used", "wellknown spincoating was used", "ＳＰＩＮ－coating, used", "Straße ﬁlm of TiO2", "STRASSE film of TiO2", "a – b", "±", "", "...", "12.5±", None]
    pairs = [(a, b) for a in texts for b in texts]
    rows = spark.createDataFrame(pairs, "source string, quote string").select("*", gr.contains_quote(F.col("source"), F.col("quote")).alias("held"), F.contains(gr.without_dashes(F.col("source")), gr.spine(F.col("quote"))).alias("may")).collect()
    assert len({(r.source, r.quote) for r in rows if r.held and r.source != r.quote}) >= 6 and not [r for r in rows if r.held and not r.may]
    assert [r for r in rows if not r.may]


def test_a_large_paper_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(claims, "_SHARE", 3)
    turns = [("p", i, f"block number {i // 2 if i < 10 else i} of the paper") for i in range(40)] + [("p", 50, "one word"), ("q", 1, "block number 12 of the paper")]
    blocks = spark.createDataFrame(turns, "paper_id string, block_id long, text string")
    cited = blocks.select("paper_id", (F.col("block_id") + 1).alias("block_id"), F.col("text").alias("quote"))
    got = claims.relinked(cited, blocks)
    assert "_share" in got._jdf.queryExecution().executedPlan().toString()
    rows = {(r.paper_id, r.block_id): (r.new_block_id, r.status) for r in got.collect()}
    kept = lambda i: i < 10 and i % 2 == 0
    assert {k[1] - 1: v for k, v in rows.items() if k[0] == "p" and k[1] < 50} == {i: (i + 1, "kept") if kept(i) else (None, "unresolved") if i < 10 else (i, "relinked") for i in range(40)}
    assert rows["q", 2] == (1, "relinked") and rows["p", 51] == (None, "too_short")
    again = claims.relinked(cited, blocks, shared.folder(spark))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, got.collect()), key=str)
