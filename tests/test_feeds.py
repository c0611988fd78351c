"""Runs over paged sources: whole traversals only, failures apart, marks that move with what was read."""

import json
import tracemalloc

import pytest

from lodestone.sources import feeds, revisions


def page(root, source, cursor, entries, following=None, mark=None, text=None):
    folder = root / f"source={source}" / f"page={cursor}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part-0.txt").write_text(json.dumps({"entries": entries, "next": following, "mark": mark}) if text is None else text)


@pytest.fixture
def service(tmp_path):
    root = tmp_path / "service"
    page(root, "good", 0, [{"id": "a", "mark": "1"}, {"id": "b", "mark": "2"}], "x", "2")
    page(root, "good", "x", [{"id": "ü", "mark": "3"}], None, "3")
    page(root, "empty", 0, [])
    page(root, "loop", 0, [{"id": "l"}], "y")
    page(root, "loop", "y", [{"id": "m"}], "y")
    page(root, "again", 0, [{"id": "l"}], "y")
    page(root, "again", "y", [{"id": "l"}])
    page(root, "broken", 0, [{"id": "k"}], "z")
    page(root, "broken", "z", [], text="{")
    page(root, "shape", 0, None)
    return root


def test_a_failure_is_its_source_alone(spark, service, tmp_path):
    names = ["good", "empty", "loop", "again", "broken", "shape", "absent"]
    found, failed = feeds.run(spark, f"folder:{service}", names, str(tmp_path / "state"))
    assert [(r.source, r.position, json.loads(r.entry)["id"]) for r in found.orderBy("position").collect()] == [("good", 0, "a"), ("good", 1, "b"), ("good", 2, "ü")]
    errors = {r.source: r.error for r in failed.collect()}
    assert set(errors) == {"loop", "again", "broken", "shape", "absent"} and "came before" in errors["loop"] and "came before" in errors["again"]


def test_marks_move_with_whole_traversals(spark, service, tmp_path):
    path = str(tmp_path / "state")
    feeds.run(spark, f"folder:{service}", ["good", "broken"], path)
    page(service, "good", "x", [{"id": "ü", "mark": "3"}, {"id": "d", "mark": "4"}], None, "4")
    page(service, "broken", "z", [{"id": "n"}], None, "9")
    found, failed = feeds.run(spark, f"folder:{service}", ["broken"], path)
    assert sorted(json.loads(r.entry)["id"] for r in found.collect()) == ["k", "n"] and failed.count() == 0
    found, _ = feeds.run(spark, f"folder:{service}", ["good", "broken"], path)
    assert [(r.source, json.loads(r.entry)["id"]) for r in found.where("source = 'good'").collect()] == [("good", "d")]
    assert revisions.revisions(spark, path) == [1, 2, 3]
    marks = {r.source: r.mark for r in revisions.read(spark, path).where("entry is null").collect()}
    assert marks == {"good": "4", "broken": "9"}


def test_filters_leave_out_sources(spark, service):
    rows = feeds.read_sources(spark, f"folder:{service}", [("good", None), ("loop", None), ("broken", None)])
    assert {r.source for r in rows.where("source = 'good'").collect()} == {"good"}
    assert rows.where("source in ('good', 'loop') and error is null").count() == 4
    assert feeds.read_sources(spark, f"folder:{service}", []).count() == 0
    with pytest.raises(ValueError):
        feeds.read_sources(spark, "folder:x", [("a", None), ("a", None)])
    lines = spark.createDataFrame([("# feeds",), (" http://a ",), ("",), ("http://b",)], "value string")
    assert feeds.declared(lines) == ["http://a", "http://b"]


def many(source, since, cursor):
    """400 pages of 500 entries; the source named short fails at the last one."""
    k = int(cursor or 0)
    if source == "short" and k == 399:
        raise OSError("gone")
    return {"entries": [{"id": f"{k}-{i}", "text": "x" * 100} for i in range(500)], "next": str(k + 1) if k < 399 else None, "mark": f"{k:03}"}


def test_a_source_is_not_held_in_memory():
    reader = feeds.FeedReader(f"{__name__}:many", [("long", None), ("short", None)])
    tracemalloc.start()
    n, last = 0, None
    for batch in reader.read(feeds._Source("long", None)):
        if batch["position"][0].is_valid:
            assert batch["position"][0].as_py() == n and json.loads(batch["entry"][0].as_py())["id"] == f"{n // 500}-{n % 500}"
            n += batch.num_rows
        last = batch
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 200_000 and last.to_pylist() == [{"source": "long", "position": None, "entry": None, "mark": "399", "pages": 400, "error": None}]
    assert peak < 16_000_000  # the entries are 24 MB of text
    assert [b.to_pylist()[0]["error"] for b in reader.read(feeds._Source("short", None))] == ["OSError: gone"]
