"""Revisions: one writer wins, lost tasks leave nothing, sealed files are told from changed ones."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from lodestone.sources import revisions


def test_published_once(spark, tmp_path):
    path = str(tmp_path / "table")
    assert revisions.revisions(spark, path) == []
    with pytest.raises(ValueError):
        revisions.read(spark, path)
    revisions.publish(spark.range(10), path, 1)
    with pytest.raises(revisions.RevisionExists):
        revisions.publish(spark.range(99), path, 1)
    assert revisions.read(spark, path).count() == 10 and revisions.abandoned(spark, path) == []
    revisions.publish(spark.range(0), path, 2)
    assert revisions.read(spark, path).count() == 0 and revisions.read(spark, path, 1).agg(F.sum("id")).first()[0] == 45
    assert revisions.revisions(spark, path) == [1, 2]
    with pytest.raises(ValueError):
        revisions.manifest(spark, path, 3)


def test_compare_and_swap(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    revisions.compare_and_swap(spark.range(1), path, 0)
    revisions.compare_and_swap(spark.range(2), path, 1)
    with pytest.raises(revisions.Conflict) as told:
        revisions.compare_and_swap(spark.range(3), path, 1)
    assert (told.value.expected, told.value.current) == (1, 2) and revisions.read(spark, path).count() == 2


def test_of_racing_writers_one_wins(spark, tmp_path):
    path, won, lost = str(tmp_path / "race"), [], []
    start = threading.Barrier(4)

    def writer(k):
        df = spark.range(k + 1)
        start.wait()
        try:
            revisions.compare_and_swap(df, path, 0)
            won.append(k)
        except revisions.Conflict:
            lost.append(k)

    threads = [threading.Thread(target=writer, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 3
    assert revisions.read(spark, path).count() == won[0] + 1 and revisions.abandoned(spark, path) == []


def test_a_failed_job_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "failed")
    bad = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception, match="lost"):
        revisions.publish(bad, path, 1)
    assert revisions.revisions(spark, path) == []
    left = [n for f in revisions.abandoned(spark, path) for n in os.listdir(os.path.join(path, f)) if n.startswith("part-")]
    assert left == []
    revisions.publish(spark.range(3), path, 1)
    assert revisions.read(spark, path).count() == 3


def test_seals(spark, tmp_path):
    path = str(tmp_path / "sealed")
    own = revisions.publish(spark.range(20).repartition(2), path, 1)
    assert revisions.differences(spark, path, 1).count() == 0
    folder = os.path.join(path, own["data"])
    first, second = (os.path.join(folder, f["name"]) for f in own["files"])
    with open(first, "ab") as out:
        out.write(b"x")
    for name in (first, second):  # the local file system's own checksums, which would stop the reading
        os.unlink(os.path.join(folder, f".{os.path.basename(name)}.crc"))
    os.unlink(second)
    with open(os.path.join(folder, "part-9.parquet"), "w") as out:
        out.write("new")
    assert sorted(r.problem for r in revisions.differences(spark, path, 1).collect()) == ["added", "changed", "missing"]
