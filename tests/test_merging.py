"""Copies of facts: matched one for one, contradictions told, chains merged to one fact with all its paths."""

import pyarrow as pa
from pyspark.sql import functions as F

from lodestone.functions import quantities as qt
from lodestone.operators import merging
from lodestone.sources import shared

FACTS = [
    ("/l/0/t", "thickness", "100 nm", 100.0, "nm"), ("/a/0/t", "thickness", "0.1 µm", 0.1, "µm"),  # one value in two units
    ("/l/0/g", "gap", "1.5 eV", 1.5, "eV"), ("/a/0/g", "gap", "1.6 eV", 1.6, "eV"),  # a contradiction
    ("/l/0/p/0", "size", "5 nm", 5.0, "nm"), ("/l/0/p/1", "size", "5 nm", 5.0, "nm"), ("/a/0/p/0", "size", "5 nm", 5.0, "nm"),  # two copies here, one there
    ("/l/0/q/0", "rate", "1 s", 1.0, "s"), ("/a/0/q/0", "rate", "2 s", 2.0, "s"), ("/a/0/q/1", "rate", "3 s", 3.0, "s"),  # neither alone
    ("/l/0/n", "note", None, None, None), ("/a/0/n", "note", None, None, None), ("/l/00/t", "thickness", "9 nm", 9.0, "nm"), ("/b/1", "other", "1", 1.0, None), ("/b/2", "other", "1", 1.0, None), ("/b/3", "other", "1", 1.0, None),
]
RELATION = "paper_id string, side string, path string, name string, raw string, number double, unit string"


def rows(spark):
    df = spark.createDataFrame([(p, "truth", *f) for p in ("one", "two") for f in FACTS], RELATION)
    text = F.when(F.col("name") == "note", "as made")
    return df.select("paper_id", "side", "path", "name", F.lit("stack").alias("source"), F.lit("o").alias("owner"), F.create_map(F.lit("k"), F.lit("v")).alias("context"), qt.claim(df.raw, df.number, df.unit).alias("claim"), text.alias("text"))


def test_copies_and_contradictions(spark):
    links = spark.createDataFrame([("one", "truth", "/l/0", "/a/0"), ("one", "truth", "/l/0", "/none")], "paper_id string, side string, left_path string, right_path string")
    found, against = merging.copies(rows(spark), links)
    assert sorted((r.path, r.copy_path) for r in found.collect()) == [("/l/0/n", "/a/0/n"), ("/l/0/p/0", "/a/0/p/0"), ("/l/0/t", "/a/0/t")]
    assert [(r.path, r.other_path) for r in against.collect()] == [("/l/0/g", "/a/0/g")]
    kept = merging.merged(rows(spark), found, shared.folder(spark)).collect()
    assert len(kept) == 2 * len(FACTS) - 3 and {p for r in kept if r.paper_id == "one" for p in r.source_paths} == {f[0] for f in FACTS}
    assert next(r.source_paths for r in kept if r.paper_id == "one" and r.path == "/l/0/t") == ["/l/0/t", "/a/0/t"]


def test_chains_are_one_fact(spark):
    chain = [("one", "truth", "/b/2", "/b/3"), ("one", "truth", "/b/1", "/b/2"), ("one", "truth", "/b/1", "/b/1"), ("one", "truth", "/b/1", "/absent"), ("two", "truth", "/b/1", "/b/3"), ("two", "truth", "/b/3", "/b/1")]
    edges = spark.createDataFrame(chain, "paper_id string, side string, path string, copy_path string")
    kept = {(r.paper_id, r.path): r.source_paths for r in merging.merged(rows(spark), edges, shared.folder(spark)).where("name = 'other'").collect()}
    assert kept == {("one", "/b/1"): ["/b/1", "/b/2", "/b/3"], ("two", "/b/1"): ["/b/1", "/b/3"], ("two", "/b/2"): ["/b/2"]}
    none = merging.merged(rows(spark), edges.limit(0), shared.folder(spark))
    assert none.count() == 2 * len(FACTS) and none.where("size(source_paths) <> 1").count() == 0


def test_pairs_are_joined_once(spark):
    links = spark.createDataFrame([("one", "truth", "/l/0", "/a/0")], "paper_id string, side string, left_path string, right_path string")
    plain = merging.copies(rows(spark), links)
    kept = merging.copies(rows(spark), links, shared.folder(spark))
    for a, b in zip(plain, kept):
        assert "Join" not in b._jdf.queryExecution().executedPlan().toString() and sorted(a.collect()) == sorted(b.collect()) != []


def test_claims_of_a_batch_are_those_of_their_rows():
    rows = [("5 nm", None, None), (None, 5.0, "nm"), ("5", 5.0, "nm"), ("5", 5.0, None), ("5 nm", None, None), ("1-2", None, "V"), ("5", None, "nm"), ("x", 5.0, "nm"), (None, None, None), ("5", 6.0, "nm")] * 3
    kinds = (pa.string(), pa.float64(), pa.string())
    read = qt._read_all(*[pa.array(x, t) for x, t in zip(zip(*rows), kinds)]).to_pylist()
    assert read == [None if r[0] is None else dict.fromkeys(qt._CLAIM) | qt.read_claim(*r) for r in rows]
    assert len(qt._read_all(*[pa.array([], t) for t in kinds])) == 0
