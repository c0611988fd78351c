from lodestone.operators import explanation


def tables(spark, facts, pairs, found, asked):
    return (
        spark.createDataFrame(asked, "paper_id string, view string, side string, path string"),
        spark.createDataFrame(facts, "paper_id string, side string, path string, owner string, owner_unmatched boolean, ambiguous boolean"),
        spark.createDataFrame(pairs, "paper_id string, truth_path string, predicted_path string, value_equal boolean, context_equal boolean, ambiguity_blocked boolean"),
        spark.createDataFrame(found, "paper_id string, view string, truth_path string, predicted_path string"),
    )


def test_reasons(spark):
    truth = {"m": "o", "u": "gone", "c": "o", "b1": "o", "b2": "o", "b3": "o", "p": "o", "n": "q", "v": "o", "x": "o", "vc": "o"}
    facts = [("p", "truth", k, o, k == "u", k == "b1" or None) for k, o in truth.items()] + [("p", "prediction", k, "o", False, False) for k in ("1", "2", "3")]
    pairs = [
        ("p", "m", "1", True, True, False), ("p", "m", "2", True, True, False), ("p", "m", "3", False, None, None), ("p", "u", "1", True, True, False), ("p", "c", "1", True, True, False), ("p", "b1", "1", False, True, False),
        ("p", "b2", "1", False, False, True), ("p", "b3", "1", True, True, True), ("p", "b3", "2", False, False, False), ("p", "v", "1", False, True, False), ("p", "v", "2", False, False, False), ("p", "x", "1", True, False, False), ("p", "vc", "1", False, False, False),
    ]
    found = [("p", v, "m", "2") for v in ("attributed", "recovery")]
    asked = [("p", v, "truth", k) for v in ("attributed", "recovery") for k in truth] * 2 + [("p", "attributed", "truth", "no fact"), ("p", "attributed", "prediction", "1")]
    rows = explanation.explanations(*tables(spark, facts, pairs, found, asked), most=2).collect()
    got = {(r.view, r.side, r.path): r for r in rows}
    assert len(rows) == len(got) == 2 * len(truth) + 1
    reasons = lambda view: {k: got[(view, "truth", k)].reason for k in truth}
    assert reasons("attributed") == {"m": "matched", "u": "owner_unmatched", "c": "one_to_one_competition", "b1": "ambiguity", "b2": "ambiguity", "b3": "ambiguity", "p": "property_mismatch", "n": "no_candidate", "v": "value_mismatch", "x": "context_mismatch", "vc": "value_and_context_mismatch"}
    assert reasons("recovery") == {"m": "matched", "u": "one_to_one_competition", "c": "one_to_one_competition", "b1": "value_mismatch", "b2": "value_mismatch", "b3": "one_to_one_competition", "p": "property_mismatch", "n": "no_candidate", "v": "value_mismatch", "x": "one_to_one_competition", "vc": "value_mismatch"}
    m = got[("attributed", "truth", "m")]
    assert (m.n_candidates, m.n_eligible) == (3, 2) and [c.predicted_path for c in m.candidates] == ["2", "1"]
    assert got[("attributed", "truth", "n")].candidates == [] and got[("attributed", "prediction", "1")].n_candidates == 9
    assert [c.truth_path for c in got[("attributed", "prediction", "1")].candidates] == ["c", "m"]


def test_empty(spark):
    assert explanation.explanations(*tables(spark, [], [], [], [])).collect() == []


def test_views_are_not_dealt_out(spark):
    facts = [("p", side, k, "o", False, False) for side in ("truth", "prediction") for k in ("1", "2")]
    asked = [("p", f"view {i}", "truth", k) for i in range(30) for k in ("1", "2")]
    got = explanation.explanations(*tables(spark, facts, [("p", "1", "1", True, True, False)], [("p", "view 7", "1", "1")], asked))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(" in plan and not [x for x in plan.splitlines() if "hashpartitioning(" in x and "view#" in x.split("hashpartitioning(")[1].split(")")[0]]
    assert sorted(r.view for r in got.where("reason = 'matched'").collect()) == ["view 7"] and got.count() == 60
