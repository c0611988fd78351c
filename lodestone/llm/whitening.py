"""Whitening of embeddings: one SQL aggregation sums the centred products of every pair of dimensions,
LAPACK decomposes the covariance that comes of them, rows are projected by generated expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

#: Entries are multiplied by this and rounded down.
SCALE = 256
#: Side of the blocks of the upper triangle: so many squared sums are one group's columns.
TILE = 16
_ADDED = ["x", "deviation", "whitened"]


@dataclass
class Whitening:
    """What is known of the fit list: its size, sums, eigenvalues (falling) and unit eigenvectors (rows)."""

    dims: int = 0
    n: int = 0
    sums: list[int] = field(default_factory=list)
    largest: int = 0
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    identity_error: float | None = None

    @property
    def mean(self) -> list[float]:
        return [s / self.n for s in self.sums]

    def varies(self, k: int) -> bool:
        """Whether component k (from 0) has variance beyond rounding."""
        return bool(self.values[k] > self.values[0] * self.dims * np.finfo(float).eps)

    def explained(self, k: int) -> float | None:
        whole = float(self.values.sum())
        return float(self.values[k]) / whole if whole > 0 else None


def _total(terms: list[str]) -> str:
    """The sum of the terms as a balanced expression, so that its depth is the logarithm of their number."""
    while len(terms) > 1:
        terms = [f"({' + '.join(terms[i : i + 2])})" for i in range(0, len(terms), 2)]
    return terms[0]


def quantised(df: DataFrame, column: str = "embedding", dims: int | None = None) -> DataFrame:
    """The rows of ``df`` that have a whole vector, with x: its entries as longs, floor(256 * entry).

    Rows go whose vector is null, is empty, or holds null or non-finite entries, and those of another
    length than ``dims`` (by default the commonest length of the others, of equally common ones the
    greatest). Entries beyond the range of a long become its ends."""
    held = F.col(f"`{column}`")
    whole = F.coalesce(F.forall(held, lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False))), F.lit(False)) & (F.size(held) > 0)
    rows = c.without(df, [n for n in _ADDED if n != column.lower()]).where(whole)
    if dims is None:
        common = rows.groupBy(F.size(held).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
        dims = common[0]["d"] if common else 0
    x = F.transform(held, lambda e: F.floor(F.lit(float(SCALE)) * e.cast("double")).cast("long"))
    return rows.where(F.size(held) == dims).withColumn("x", x)


def covariance(fit_list: DataFrame, mean: list[float], n: int, tile: int = TILE) -> np.ndarray:
    """Covariance (divisor ``n``) of the vectors x of ``fit_list``, from one aggregation.

    The upper triangle of dimension pairs is cut into squares of ``tile`` dimensions a side. A row
    gives a pair of slices for each square, and the square's group sums the products of all pairs
    of the slices' entries, centred before: one column each, with partial sums in every task. The
    driver gets one row a square, so as many numbers as the matrix has, whatever the rows."""
    dims = len(mean)
    sides = range(-(-dims // tile))
    centred = F.expr("array(" + ", ".join(f"x[{i}] - {m!r}D" for i, m in enumerate(mean)) + ")")
    squares = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.slice("v", a * tile + 1, tile).alias("l"), F.slice("v", b * tile + 1, tile).alias("r")) for a in sides for b in sides if a <= b]
    sums = [F.expr(f"sum(get(l, {i}) * get(r, {j}))").alias(f"s{i}_{j}") for i in range(tile) for j in range(tile)]
    dealt = fit_list.select(centred.alias("v")).select(F.explode(F.array(*squares)).alias("t")).select("t.*")
    out = np.zeros((dims, dims))
    for row in dealt.groupBy("a", "b").agg(*sums).collect():
        at, to = row["a"] * tile, row["b"] * tile
        block = np.array(row[2:], float).reshape(tile, tile)[: dims - at, : dims - to]
        out[at : at + tile, to : to + tile] = block
        out[to : to + tile, at : at + tile] = block.T
    return (np.triu(out) + np.triu(out, 1).T) / n


def _projected(model: Whitening, k: int) -> str:
    """SQL of x on component k (from 0) over the root of its eigenvalue; null if it has no variance."""
    if not model.varies(k):
        return "cast(null as double)"
    weights = model.vectors[k] / np.sqrt(model.values[k])
    return _total([f"(x[{i}] - {m!r}D) * {float(w)!r}D" for i, (m, w) in enumerate(zip(model.mean, weights))])


def fit(rows: DataFrame, folder: str, components: int = 4) -> Whitening:
    """Fits on each distinct vector x of quantised ``rows`` once.

    The list of distinct vectors is made by a grouping with partial aggregation, so a vector that a
    third of the rows repeat is one row a task, and is written once. The driver gets sums of
    dimensions and of pairs of dimensions. identity_error is measured on the list: the largest
    absolute entry of the covariance of the first ``components`` whitened ones (those with
    variance), less the identity. An empty table gives a model of no dimension."""
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return Whitening()
    dims = first["d"]
    fit_list = c.materialise(rows.select("x").distinct(), folder, "distinct")
    stats = fit_list.agg(F.count("*"), F.max(F.greatest(F.array_max("x"), -F.array_min("x").cast("decimal(20,0)"))), *[F.expr(f"sum(cast(x[{i}] as decimal(20,0)))") for i in range(dims)]).first()
    model = Whitening(dims, stats[0], [int(s) for s in stats[2:]], int(stats[1]))
    values, vectors = np.linalg.eigh(covariance(fit_list, model.mean, model.n))
    model.values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1].T
    model.vectors = vectors * np.sign(vectors[np.arange(dims), np.abs(vectors).argmax(1)])[:, None]  # the same sign each time
    used = [k for k in range(min(components, dims)) if model.varies(k)]
    if used:
        pairs = [(a, b) for a in used for b in used if a <= b]
        seen = fit_list.select(*[F.expr(_projected(model, k)).alias(f"w{k}") for k in used]).agg(*[F.covar_pop(f"w{a}", f"w{b}") for a, b in pairs]).first()
        model.identity_error = max(abs(v - (a == b)) for v, (a, b) in zip(seen, pairs))
    return model


def whitened(rows: DataFrame, model: Whitening, components: int = 4) -> DataFrame:
    """Quantised ``rows`` with deviation (decimal: sum over dimensions of (n*x - sum)^2, exact, null
    beyond 38 digits) and whitened (array of the first ``components``; null where a component has no
    variance, as if all vectors are equal)."""
    if not model.n:
        return rows.select("*", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
    n, farthest = model.n, 2 * model.n * max(model.largest, 1)
    if model.dims * farthest**2 < 2**63:  # whole sums fit a long
        deviation = _total([f"({n}L * x[{i}] - {s}L) * ({n}L * x[{i}] - {s}L)" for i, s in enumerate(model.sums)])
    else:
        apart = [f"try_subtract(try_multiply(cast({n} as decimal(38,0)), cast(x[{i}] as decimal(19,0))), cast({s} as decimal(38,0)))" for i, s in enumerate(model.sums)]
        deviation = "cast(0 as decimal(38,0))"
        for a in apart:
            deviation = f"try_add({deviation}, try_multiply({a}, {a}))"
    parts = ", ".join(_projected(model, k) for k in range(min(components, model.dims)))
    return rows.select("*", F.expr(f"cast({deviation} as decimal(38,0))").alias("deviation"), F.expr(f"array({parts})").alias("whitened"))


def report(df: DataFrame, folder: str, key: str = "vec_id", column: str = "embedding", components: int = 4) -> DataFrame:
    """A row for each row of ``df`` with a whole vector and each of the first ``components``: the key,
    component (from 1), n, deviation (long; null beyond it), whitened, explained and identity_error.

    Keys may be null or repeat; each row counts. Other columns are left out. Without such rows the
    result is empty. Equal vectors: one eigenvalue of 0 a dimension, whitened and explained null."""
    rows = quantised(df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{column}`").alias("_vector")), "_vector").select("_key", "x")
    model = fit(rows, folder, components)
    used = range(min(components, model.dims))
    known = F.array(*[F.struct(F.lit(k + 1).alias("component"), F.lit(model.explained(k)).cast("double").alias("explained"), F.col("whitened")[k].alias("whitened")) for k in used]) if model.n else F.lit(None).cast("array<struct<component:int,explained:double,whitened:double>>")
    made = whitened(rows, model, components).select("_key", F.expr("try_cast(deviation as bigint)").alias("deviation"), F.explode(known).alias("p"))
    return made.select(F.col("_key").alias(key), F.col("p.component").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", F.col("p.whitened").alias("whitened"), F.col("p.explained").alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"))
