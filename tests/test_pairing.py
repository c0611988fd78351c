"""Record pairs of small studies, with results read from the rules by hand. All cases are papers of one job."""

import json

import pytest
from pyspark.sql import functions as F

from lodestone.operators import facts, pairing
from lodestone.sources import shared


def value(name, raw, number=None, unit=None):
    return {"name": name, "raw_value": raw, "value_number": number, "unit": unit}


def family(key, variant=None, materials=(), label="Design", sequence=True, stack=None):
    layers = [{"layer_id": f"{key}{i}", "sequence": i if sequence else None, "role": "layer", "material": m} for i, m in enumerate(materials)]
    return {"family_id": key, "label": label, "variant": variant, "layers": layers, "full_stack_raw": stack}


def device(key, label="champion", parent=None, **more):
    return {"device_id": key, "family_id": parent, "label": label, "champion_status": "yes", **more}


def observation(key, parent=None, rate=None, method="jv_scan", direction="reverse", metrics=()):
    return {"observation_id": key, "device_id": parent, "measurement_type": method, "scan_direction": direction, "measurement_conditions": [value("scan rate", *rate)] if rate else [], "metrics": list(metrics)}


def population(key, label, parent=None, subjects=(), statistic="mean"):
    return {"population_id": key, "family_id": parent, "label": label, "statistic_type": statistic, "subjects": list(subjects)}


def treated(*conditions, stage="before_device_completion", material="absorber"):
    return {"treatment_stage": stage, "treated_material": material, "conditions": list(conditions)}


HOT, COLD, WARM = value("annealing temperature", "100 °C", 100.0, "°C"), value("annealing temperature", "60 °C", 60.0, "°C"), value("annealing temperature", "373.15 K", 373.15, "K")
AIR = value("atmosphere", "air")
CASES = {
    # codes: each sample finds its own, whatever the order; different codes are never one
    "codes": ({"individual_devices": [device("a", "Device A"), device("b", "Device B")]}, {"individual_devices": [device("x", "Device B, Table 1"), device("y", "device A")]}),
    "gate": ({"individual_devices": [device("a", "Device A")]}, {"individual_devices": [device("b", "Device B")]}),
    # equal devices of different families are told by the families
    "parents": (
        {"device_families": [family("f", "x", ("Au", "C60")), family("g", "y", ("Ag", "PCBM"))], "individual_devices": [device("a", parent="f"), device("b", parent="g")], "performance_observations": [observation("o", "a"), observation("p", "b")]},
        {"device_families": [family("h", "y", ("silver", "PCBM")), family("i", "x", ("gold", "C60"))], "individual_devices": [device("x", parent="h"), device("y", parent="i")], "performance_observations": [observation("q", "x"), observation("r", "y")]},
    ),
    "ambiguous": ({"individual_devices": [device("a"), device("b")]}, {"individual_devices": [device("x"), device("y")]}),
    # a parent lifts unlike content over the threshold: (0.25 + 1) / 2, then the mean with the uses
    "lifted": ({"device_families": [family("f", stack="s")], "individual_devices": [device("a", "one", "f", variant="arm v")]}, {"device_families": [family("f", stack="s")], "individual_devices": [device("a", "two", "f", variant="arm w")]}),
    "unlifted": ({"individual_devices": [device("a", "one", variant="arm v", selection_basis="q")]}, {"individual_devices": [device("a", "two", variant="arm w", selection_basis="r")]}),
    # conditions: the same within one in a hundred, in any unit; different; on one side only
    "protocol": ({"performance_observations": [observation("o", rate=("50 mV/s", 50.0, "mV/s")), observation("p", rate=("10 mV/s", 10.0, "mV/s"))]}, {"performance_observations": [observation("q", rate=("0.01 V/s", 0.01, "V/s")), observation("r", rate=("50.2 mV/s", 50.2, "mV/s"))]}),
    "half": ({"performance_observations": [observation("o", rate=("50 mV/s", 50.0, "mV/s"))]}, {"performance_observations": [observation("o")]}),
    "apart": ({"performance_observations": [observation("o", rate=("50 mV/s", 50.0, "mV/s"))]}, {"performance_observations": [observation("o", rate=("80 mV/s", 80.0, "mV/s"))]}),
    # a metric that is a condition, said twice, is one condition
    "copied": ({"performance_observations": [observation("o", rate=("50 mV/s", 50.0, "mV/s"), metrics=[value("scan rate", "50 mV/s", 50.0, "mV/s")])]}, {"performance_observations": [observation("o", rate=("50 mV/s", 50.0, "mV/s"))]}),
    # treatments decide where both sides state them
    "treated": ({"individual_devices": [device("a", "one", subject_context=treated(HOT, AIR)), device("b", "one", subject_context=treated(COLD))]}, {"individual_devices": [device("x", "other", subject_context=treated(COLD)), device("y", "other", subject_context=treated(AIR, WARM))]}),
    "twice": ({"individual_devices": [device("a", "one", subject_context=treated(HOT), reported_properties=[HOT])]}, {"individual_devices": [device("a", "two", subject_context=treated(HOT))]}),
    "untreated": ({"individual_devices": [device("a", "one", subject_context=treated(HOT))]}, {"individual_devices": [device("a", "one", subject_context=treated(COLD))]}),
    # cohorts: by label, by code, or by their subjects
    "cohorts": ({"population_statistics": [population("p", "control"), population("q", "Device A"), population("r", "any", subjects=[treated(HOT), treated(COLD)])]}, {"population_statistics": [population("s", "treated"), population("t", "sample A of ten"), population("u", "none", subjects=[treated(COLD), treated(WARM)])]}),
    "tests": ({"stability_tests": [{"test_id": "t", "specimen_label": "cell one", "link_status": "unlinked", "conditions": [HOT]}, {"test_id": "u", "specimen_label": "cell two", "link_status": "unlinked"}]}, {"stability_tests": [{"test_id": "v", "specimen_label": "cell  one", "link_status": "unlinked", "conditions": [WARM]}]}),
    # stacks: two of three layers in order, and equal variants, which are codes here
    "stacks": ({"device_families": [family("f", "v", ("ITO", "C60", "Au"))]}, {"device_families": [family("g", "v", ("ITO", "Au"))]}),
    "loose": ({"device_families": [family("f", "v", ("ITO", "Au"), sequence=False)]}, {"device_families": [family("g", "v", ("Au", "ITO"), sequence=False)]}),
    "parts": ({"device_families": [{"family_id": "f", "layers": [{"material": "ITO", "constituents": None}, {"material": "x", "constituents": [{"name": "gold", "role": "dopant"}, {"name": "PbI2", "role": "precursor"}]}]}]}, {"device_families": [{"family_id": "g", "layers": [{"material": "ITO"}, {"material": "x", "constituents": [{"name": "Au", "role": "dopant"}]}]}]}),
    "empty": ({}, {"individual_devices": [device("a")]}),
    "nothing": ({}, {}),
}
WANT = {
    ("codes", "a", "y", 2 / 4, False), ("codes", "b", "x", 2 / 4, False),
    ("parents", "f", "i", 1.0, False), ("parents", "g", "h", 1.0, False), ("parents", "a", "y", 1.0, False), ("parents", "b", "x", 1.0, False), ("parents", "o", "r", 1.0, False), ("parents", "p", "q", 1.0, False),
    ("lifted", "f", "f", 1.0, False), ("lifted", "a", "a", (2 / 6 + 1) / 4, False),
    ("protocol", "o", "r", 1.0, False), ("protocol", "p", "q", 1.0, False), ("half", "o", "o", 1.0, False), ("apart", "o", "o", 3 / 5, False), ("copied", "o", "o", 1.0, False),
    ("treated", "a", "y", 1.0, False), ("treated", "b", "x", 1.0, False), ("twice", "a", "a", 1.0, False),
    ("cohorts", "q", "t", 2 / 4, False), ("cohorts", "r", "u", 1.0, False),
    ("tests", "t", "v", 1.0, False), ("stacks", "f", "g", (5 / 6 + 1) / 2, False), ("loose", "f", "g", 1.0, False), ("parts", "f", "g", 1.0, False),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(p, side, json.dumps(x)) for p, sides in CASES.items() for side, x in zip(("truth", "prediction"), sides)]
    studies = facts.read_studies(spark.createDataFrame(rows, "paper_id string, side string, document string"))
    own = shared.written(pairing.records(shared.written(studies, f"{shared.folder(spark)}/s")), f"{shared.folder(spark)}/r")
    return own, shared.written(pairing.paired(own, shared.folder(spark)), f"{shared.folder(spark)}/p")


def test_pairs_by_hand(found):
    rows = found[1].collect()
    got = {(r.paper_id, r.truth_id, r.prediction_id, round(r.similarity, 9), r.ambiguous) for r in rows if r.paper_id != "ambiguous"}
    want = {(p, a, b, round(x, 9), y) for p, a, b, x, y in WANT}
    assert got == want, (sorted(got - want), sorted(want - got))
    assert [(r.ambiguous, r.similarity) for r in rows if r.paper_id == "ambiguous"] == [(True, 1.0)] * 2


def test_what_follows_from_pairs(found):
    own, pairs = found
    links = {(r.paper_id, r.kind): (r.compared, r.agreed) for r in pairing.relationships(own, pairs).collect()}
    assert links["parents", "individual_devices"] == links["parents", "performance_observations"] == (2, 2)
    counts = {(r.paper_id, r.kind): (r.predicted, r.truth, r.matched, r.f1) for r in pairing.inventory(own, pairs).collect()}
    assert counts["codes", "individual_devices"] == (2, 2, 2, 1.0) and counts["gate", "individual_devices"][:3] == (1, 1, 0) and counts["empty", "individual_devices"][:3] == (1, 0, 0)
    alone = {(r.paper_id, r.side, r.id) for r in pairing.unpaired(own, pairs).collect()}
    assert {("gate", "truth", "a"), ("gate", "prediction", "b"), ("tests", "truth", "u"), ("cohorts", "truth", "p"), ("untreated", "truth", "a"), ("unlifted", "truth", "a")} <= alone
    told = {r.paper_id: r for r in pairing.family_evidence(own, pairs).collect() if r.paper_id in ("stacks", "loose")}
    assert (told["stacks"].truth_stack, told["stacks"].prediction_stack, told["stacks"].shared) == (["ITO", "C60", "Au"], ["ITO", "Au"], None)
    assert told["loose"].truth_stack is None and told["loose"].truth_only == [] and "material:Au" in told["loose"].shared


def test_repeated_keys_are_refused(spark, found):
    with pytest.raises(Exception, match="repeated record"):
        pairing.paired(found[0].union(found[0].where("paper_id = 'gate' and side = 'truth'")), shared.folder(spark))
    with pytest.raises(Exception, match="repeated record"):
        pairing.paired(found[0].union(found[0].where(F.col("paper_id") == "codes")), shared.folder(spark))


def test_plain_pairs_ask_no_python(spark, monkeypatch):
    """Lists of one entry at most are compared in SQL; longer ones, and what is told by them, as before."""
    from lodestone.functions import quantities as qt

    def one(name, number):
        return F.struct(F.lit(name).alias("name"), qt.claim(F.lit(f"{number} V"), F.lit(float(number)), F.lit("V")).alias("claim"))

    held = {"none": [], "a": [one("n", 10)], "near": [one("n", 10.05)], "far": [one("n", 20)], "other": [one("m", 10)], "both": [one("n", 10), one("m", 10)]}
    empty = F.array().cast("array<struct<name:string,claim:" + spark.range(1).select(one("n", 1)["claim"].alias("c")).schema["c"].dataType.simpleString() + ">>")
    features = F.array(F.lit("x:1"), F.lit("y:2"))

    def side(name):
        entries = held[name]
        none = F.lit(None)
        return F.struct(features.alias("features"), none.cast("array<string>").alias("stack"), none.cast("string").alias("variant"), none.cast("array<struct<head:array<string>,n:int>>").alias("groups"), empty.alias("inputs"), (F.array(*entries) if entries else empty).alias("protocol"))

    def of(x, y):
        return pairing.similarity(spark.range(1).select(side(x).alias("a"), side(y).alias("b"))).first()["content"]

    assert [of("a", x) for x in ("a", "near", "far", "other", "none", "both")] == [1.0, 1.0, 0.5, 1.0, 1.0, 1.0]
    assert (of("both", "both"), of("none", "none"), of("far", "both")) == (1.0, 1.0, 0.5)

    def refuse(edges):
        raise AssertionError("a plain pair was matched in Python")

    monkeypatch.setattr(pairing, "_matched", F.udf(refuse, "boolean").asNondeterministic())
    assert of("a", "far") == 0.5
