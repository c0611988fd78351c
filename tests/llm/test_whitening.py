"""Whitening against numpy on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import common as c
from lodestone.llm import whitening


def _plain(vectors, components=4):
    """n, deviation, whitened and explained of each vector, read from the definition."""
    x = np.floor(256 * np.array(vectors, float)).astype(int)
    once = np.unique(x, axis=0)
    n, sums = len(once), once.sum(0)
    centred = once - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, directions = values[order], directions[:, order]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, (x - sums / n) @ directions[:, :components] / np.sqrt(values[:components]), values / values.sum()


@pytest.mark.parametrize("dims", [1, 3, 16, 37])
def test_whitening_against_numpy(spark, dims):
    rng = np.random.default_rng(dims)
    vectors = (rng.normal(size=(60, dims)) * np.arange(1, dims + 1)).astype(np.float32)
    vectors[20:40] = vectors[3]  # a third of the rows are one vector
    bad = [None, [], [None] * dims, [float("nan")] * dims, [float("inf")] * dims, [0.5] * (dims + 1)]
    rows = [(i if i % 7 else None, [float(v) for v in row]) for i, row in enumerate(vectors)] + [(100 + i, v) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit("mine")).withColumn("component", F.lit(9))
    got = whitening.report(df, c.scratch(spark)).collect()
    n, deviation, want, explained = _plain(vectors)
    kept = min(4, dims)
    assert len(got) == 60 * kept and {r.n for r in got} == {n} and got[0].identity_error < 1e-9
    for k in range(kept):
        own = [r for r in got if r.component == k + 1]
        assert {round(r.explained, 9) for r in own} == {round(explained[k], 9)}
        same = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, round(abs(r.whitened), 6)) for r in own)
        assert same == sorted((rows[i][0] is None, rows[i][0] or 0, deviation[i], round(abs(want[i, k]), 6)) for i in range(60))
        signs = {np.sign(r.whitened * want[r.vec_id, k]) for r in own if r.vec_id is not None and abs(r.whitened) > 1e-6}
        assert len(signs) == 1
    rows_ = whitening.quantised(df)
    assert rows_.count() == 60 and "component" in rows_.columns


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.report(spark.createDataFrame([], schema), c.scratch(spark)).count() == 0
    assert whitening.report(spark.createDataFrame([(1, None)], schema), c.scratch(spark)).count() == 0
    same = whitening.report(spark.createDataFrame([(1, [1.0, -2.0]), (1, [1.0, -2.0])], schema), c.scratch(spark)).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(1, 1, 0, None, None, None)] * 4
    far = whitening.report(spark.createDataFrame([(1, [3e30, 1.0]), (2, [-3e30, 1.0]), (3, [0.0, 1.0])], schema), c.scratch(spark)).collect()
    assert len(far) == 6 and {r.deviation for r in far if r.vec_id != 3} == {None}
    flat = whitening.report(spark.createDataFrame([(i, [float(i), 2.0]) for i in range(5)], schema), c.scratch(spark)).collect()
    assert all(r.whitened is None for r in flat if r.component == 2) and flat[0].identity_error < 1e-12


def test_long_and_decimal_deviations_agree(spark):
    rows = whitening.quantised(spark.createDataFrame([(1, [0.5, -1.25]), (2, [3.0, 0.1]), (3, [-7.0, 2.0])], "vec_id long, embedding array<double>"))
    model = whitening.fit(rows, c.scratch(spark))
    near = {r.vec_id: r.deviation for r in whitening.whitened(rows, model).collect()}
    model.largest = 2**60
    assert near == {r.vec_id: r.deviation for r in whitening.whitened(rows, model).collect()}
