import json

from lodestone.streaming import logs

SCHEMA = "id long, user string, kind string, value double, undoes long, at timestamp"


def test_folded_log(spark, tmp_path):
    """Undo by id: of the event named, of an earlier one, of a reset, and of two in a row."""
    rows = [(1, "a", "set", 1, None), (2, "a", "set", 2, None), (3, "a", "undo", 0, 2), (4, "b", "set", 5, None), (5, "b", "reset", 0, None), (6, "b", "set", 7, None), (7, "b", "undo", 0, 5), (8, "b", "undo", 0, 6), (9, "c", "set", 1, None), (10, "c", "set", 2, None), (11, "c", "undo", 0, 1), (12, "c", "undo", 0, 9), (13, "c", "undo", 0, 10)]
    lines = [json.dumps({"id": i, "user": u, "kind": k, "value": v, "undoes": w, "at": f"2024-01-01T00:{i:02}:00Z"}) for i, u, k, v, w in rows]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    stream = logs.folded(logs.json_events(spark, str(tmp_path / "in"), SCHEMA), "user", "id", "id", "kind", "value", "undoes", "reset")
    stream.writeStream.format("memory").queryName("folded").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert {(r.user, r.current, r.n_live) for r in spark.table("folded").collect()} == {("a", 1.0, 1), ("b", 5.0, 1), ("c", None, 0)}
