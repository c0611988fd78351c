import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from lodestone.operators import comparison, linkage, records
from lodestone.plans import registry
from lodestone.sources import shared


def best(scores):
    n, m = scores.shape
    if n > m:
        return best(scores.T)
    return max(sum(scores[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(m), n))


def test_assignment_is_optimal():
    rng = np.random.default_rng(3)
    for n in range(1, 5):
        for m in range(1, 5):
            for _ in range(15):
                scores = rng.integers(0, 6, (n, m)) / 4
                chosen = linkage.assign(scores)
                used = chosen[chosen >= 0]
                assert len(set(used)) == len(used)
                assert abs(sum(scores[i, j] for i, j in enumerate(chosen) if j >= 0) - best(scores)) < 1e-9


def test_common_subsequence():
    def plain(a, b):
        if not a or not b:
            return 0
        return plain(a[:-1], b[:-1]) + 1 if a[-1] == b[-1] else max(plain(a[:-1], b), plain(a, b[:-1]))

    words = ["".join(w) for n in range(5) for w in itertools.product("AB", repeat=n)]
    for a in words:
        for b in words:
            assert linkage.common_subsequence(list(a), list(b)) == plain(a, b)


def test_one_to_one(spark):
    pairs = spark.createDataFrame([("x", 1, 10, 0.9), ("x", 1, 11, 0.8), ("x", 2, 10, 0.8), ("x", 2, 11, 0.1), ("y", 1, 10, 0.2)], "b string, l int, r int, s double")
    rows = {(r.b, r.l, r.r) for r in linkage.one_to_one(pairs, ["b"], "l", "r", "s", 0.3).collect()}
    assert rows == {("x", 1, 11), ("x", 2, 10)}


def test_blocks_are_settled_many_at_once():
    """Blocks where everybody likes another partner best need no matrix, and all blocks give what their matrices give."""
    rng = np.random.default_rng(3)
    tables = [rng.integers(0, 6, rng.integers(1, 5, 2)) / 5 for _ in range(300)] + [np.eye(4) + 0.3]
    cells = [(k + 1, i, j, x) for k, table in enumerate(tables) for (i, j), x in np.ndenumerate(table) if x > 0]
    cells += [(k, i, j, x / 2) for k, i, j, x in cells[::3]]  # a pair that repeats counts with its best score
    rng.shuffle(cells)
    cells.sort(key=lambda c: c[0])
    blocks, left, right, score = (np.array(x) for x in zip(*cells))
    place = {k: n - 1 for n, k in enumerate(np.unique(blocks))}
    numbers = np.searchsorted(np.unique(blocks), blocks) + 1
    at, loose = linkage._settle(numbers, left.astype(int), right.astype(int), score, True)
    got = {}
    for n, free in zip(at, loose):
        got.setdefault(int(blocks[n]), {})[int(left[n])] = (int(right[n]), float(score[n]), bool(free))
    for k in place:
        table = tables[int(k) - 1]
        chosen, free = linkage.assign_unambiguously(table)
        own = got.get(int(k), {})
        assert len({j for j, _, _ in own.values()}) == len(own) and all(x == table[i, j] for i, (j, x, _) in own.items())
        assert abs(sum(x for _, x, _ in own.values()) - sum(table[i, j] for i, j in enumerate(chosen) if j >= 0)) < 1e-9
        clear = {(i, int(chosen[i])) for i in np.flatnonzero(chosen >= 0) if not free[i] and table[i, chosen[i]] > 0}
        assert {(i, j) for i, (j, _, f) in own.items() if not f} == clear


def test_easy_blocks_ask_for_no_matrix(monkeypatch):
    monkeypatch.setattr(linkage, "assign_unambiguously", None)
    square = np.eye(5) + 0.3
    n = np.repeat(np.arange(40), 25) + 1
    i, j = (np.tile(x.ravel(), 40) for x in np.indices((5, 5)))
    at, loose = linkage._settle(n, i, j, np.tile(square.ravel(), 40), True)
    assert len(at) == 200 and not loose.any() and (i[at] == j[at]).all()


def test_assignment_query_reads_whole_texts(spark, tmp_path):
    head = " ".join(f"w{i}" for i in range(600))  # over 2,000 characters, the same in all
    tails = {1: "a", 2: "b", 21: "b", 22: "a"}
    rows = [(k, f"{head} " + " ".join(f"{x}{i}" for i in range(600)), "en", "s") for k, x in tails.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.other, r.score) for r in registry.QUERIES["j03_one_to_one_assignment"](spark, str(tmp_path)).collect()}
    assert got == {(1, 22, 1.0), (2, 21, 1.0)}


def test_set_matches_equals_scored_pairs(spark):
    rng = np.random.default_rng(5)

    def side(start):
        rows = [(str(b), start + i // 2 if i < 4 else start + i, [f"w{x}" for x in rng.integers(0, 12, rng.integers(0, 6))]) for b in range(3) for i in range(9)]
        return [*rows, (None, start, ["w1"]), ("0", start + 50, None), ("9" if start else "8", start, ["w1"])]

    a, b = spark.createDataFrame(side(0), "b string, l long, w array<string>"), spark.createDataFrame(side(100), "b string, r long, w array<string>")
    made = linkage.set_matches(a, b, ["b"], "l", "r", "w", 0.2).collect()
    pairs = a.join(b.withColumnRenamed("w", "v"), ["b"]).withColumn("score", linkage.jaccard(F.array_distinct("w"), F.array_distinct("v")).cast("double"))
    scored = {(r.b, r.l, r.r): r.score for r in pairs.groupBy("b", "l", "r").agg(F.max("score").alias("score")).collect()}
    assert made and all(r.score == scored[r.b, r.l, r.r] >= 0.2 for r in made)
    assert len({(r.b, r.l) for r in made}) == len({(r.b, r.r) for r in made}) == len(made)
    expected = linkage.one_to_one(pairs, ["b"], "l", "r", "score", 0.2).agg(F.sum("score")).first()[0]
    assert abs(sum(r.score for r in made) - expected) < 1e-9


def test_pack_and_upsert(spark):
    rows = spark.createDataFrame([("a", i, s) for i, s in enumerate([5, 6, 20, 1, 1])], "k string, i int, size int")
    got = [r.window for r in records.pack(rows, ["k"], ["i"], "size", 10).orderBy("i").collect()]
    assert got == [0, 1, 2, 3, 3]
    old, new = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a"), (2, None)], [(2, "b"), (3, "c")]))
    assert sorted(map(tuple, records.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_intervals(spark):
    rows = [("a", float(x)) for x in range(40)] + [("b", 3.0), ("c", None), ("a", None)]
    got = {r.g: r for r in comparison.bootstrap(spark.createDataFrame(rows, "g string, v double").repartition(3), ["g"], "v", samples=400, seed=1).collect()}
    a = got["a"]
    assert (a.n, a.mean, a.status) == (40, 19.5, "available") and a.low < 19.5 < a.high and 4 < a.high - a.low < 12
    assert (got["b"].mean, got["b"].low, got["b"].status) == (3.0, None, "insufficient_papers") and got["c"].status == "no_values"
    assert comparison.interval(np.array([1.0, 2.0]), 0, 1)[3] == "disabled"
    draws = comparison.interval(np.array([0.0, 1.0]), 2000, 5)
    assert draws[1:3] == (0.0, 1.0)


def test_bootstrap_query_draws_as_often_as_the_default(spark, monkeypatch):
    drawn = []
    plain = comparison.bootstrap
    monkeypatch.setattr(comparison, "bootstrap", lambda *a, **k: drawn.append(k["samples"]) or plain(*a, **k))
    registry.QUERIES["a03_bootstrap_interval"](spark, "/root/testdata/sf0.001")
    assert drawn == [2000]


def test_alignment_against_all_alignments():
    for n, m in itertools.product(range(5), repeat=2):
        for a in itertools.product("AB", repeat=n):
            for b in itertools.product("AB", repeat=m):
                best = next(x for k in range(min(n, m), -1, -1) if (x := [frozenset(zip(i, j)) for i in itertools.combinations(range(n), k) for j in itertools.combinations(range(m), k) if all(a[p] == b[q] for p, q in zip(i, j))]))
                forced, every = frozenset.intersection(*best), frozenset.union(*best)
                assert linkage.alignment(list(a), list(b)) == (sorted(forced), sorted(every - forced))


def test_ambiguous_assignments_against_all_assignments():
    rng = random.Random(1794)
    for _ in range(300):
        n, m = rng.randint(1, 4), rng.randint(1, 4)
        scores = np.array([[rng.randrange(6) / 4 for _ in range(m)] for _ in range(n)])
        weight = {p: sum(scores[i, j] for i, j in enumerate(p[:n]) if j < m) for p in itertools.permutations(range(max(n, m)))}
        best = [p for p, w in weight.items() if abs(w - max(weight.values())) < 1e-9]
        chosen, loose = linkage.assign_unambiguously(scores)
        assert abs(sum(scores[i, j] for i, j in enumerate(chosen) if j >= 0) - max(weight.values())) < 1e-9
        assert all(loose[i] == any(p[i] != j for p in best) for i, j in enumerate(chosen) if j >= 0)


def test_partners_against_all_pairings():
    rng = random.Random(3)
    for _ in range(300):
        n, m = rng.randint(0, 4), rng.randint(0, 5)
        edges = [[j for j in range(m) if rng.random() < 0.4] for _ in range(n)]
        assert linkage.every_left_has_a_partner(edges) == any(all(j in edges[i] for i, j in enumerate(p)) for p in itertools.permutations(range(m), n))


def test_aligned_items(spark):
    steps = [(1, 1, "clean"), (1, 2, "coat"), (1, 3, "coat"), (2, 5, "clean"), (2, 7, "coat"), (3, None, "coat"), (4, 1, "a"), (4, 1, "b")]
    items = linkage.ordered_items(spark.createDataFrame(steps, "k int, p int, x string"), ["k"], "p", F.col("x"))
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4)], "l int, r int")
    got = linkage.align_items(pairs, items.withColumnRenamed("k", "l"), items.withColumnRenamed("k", "r"), "l", "r").collect()
    assert {(r.l, r.r, r.left, r.right, r.forced) for r in got} == {(1, 2, 0, 0, True), (1, 2, 1, 1, False), (1, 2, 2, 1, False)}
    stacks = spark.createDataFrame([(["a", "b"], ["a", "c"], "v", " v"), (["a"], None, None, None), ([], [], "", "")], "a array<string>, b array<string>, x string, y string")
    assert [r[0] for r in stacks.select(linkage.stack_similarity("a", "b", F.col("x"), F.col("y"))).collect()] == [3 / 5, None, 0.0]


def test_blocks_keep_a_shuffles_partitions(spark):
    """Few bytes are not few tasks: blocks are dealt over as many partitions as a shuffle has, by a number that is kept."""
    pairs = spark.createDataFrame([(k, "a", "b", 0.5) for k in range(50)], "k long, x string, y string, s double")
    assert shared.spread(pairs, "k").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = linkage.one_to_one(pairs, ["k"], "x", "y", "s")
    assert found.count() == 50 and "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()


def test_large_blocks_are_solved_in_tiles(spark, monkeypatch):
    """Blocks beyond a matrix: tiles and rounds give the same sum, and the dense solver is not asked."""
    rng = np.random.default_rng(11)

    def side(start, count):
        return [(b, start + i // 2 if i < 6 else start + i, [f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 30)) % 60]) for b in ("p", "q") for i in range(count)]

    a, b = spark.createDataFrame(side(0, 90), "b string, l long, w array<string>"), spark.createDataFrame(side(1000, 70), "b string, r long, w array<string>")
    dense = linkage.set_matches(a, b, ["b"], "l", "r", "w", 0.05).collect()
    for x, y in ((a, b), (b.withColumnRenamed("r", "l"), a.withColumnRenamed("l", "r"))):
        with monkeypatch.context() as patch:
            patch.setattr(linkage, "DENSE", 100)
            patch.setattr(linkage, "TILE", 40)
            patch.setattr(linkage, "NEAREST", 1)
            tiled = linkage.set_matches(x, y, ["b"], "l", "r", "w", 0.05)
        assert tiled.schema.names == ["b", "l", "r", "score"]
        tiled = tiled.collect()
        assert len({(r.b, r.l) for r in tiled}) == len({(r.b, r.r) for r in tiled}) == len(tiled)
        pairs = x.join(y.withColumnRenamed("w", "v"), ["b"]).withColumn("score", linkage.jaccard(F.array_distinct("w"), F.array_distinct("v")).cast("double"))
        scored = {(r.b, r.l, r.r): r.score for r in pairs.groupBy("b", "l", "r").agg(F.max("score").alias("score")).collect()}
        assert all(r.score == scored[r.b, r.l, r.r] >= 0.05 for r in tiled)
        assert abs(sum(r.score for r in tiled) - sum(r.score for r in dense)) < 1e-8


def test_tiles_are_read_and_not_sent(spark, monkeypatch):
    """Sets are shuffled once, whatever the number of tiles; the old way sent each to all tiles of the other side."""
    rng = np.random.default_rng(2)
    rows = [("p", i, [f"word{int(x)}" for x in rng.integers(0, 4000, 40)]) for i in range(400)]
    a, b = spark.createDataFrame(rows[::2], "b string, l long, w array<string>"), spark.createDataFrame(rows[1::2], "b string, r long, w array<string>")
    monkeypatch.setattr(linkage, "DENSE", 100)
    monkeypatch.setattr(linkage, "TILE", 20)
    seen = []
    real = linkage.shared.spread
    monkeypatch.setattr(linkage.shared, "spread", lambda df, *by: seen.append(df) or real(df, *by))
    linkage.set_matches(a, b, ["b"], "l", "r", "w", 0.0).collect()
    assert sum(df.count() for df in seen if "_w" in df.columns) == 400


def test_auction_is_optimal():
    rng = np.random.default_rng(7)
    for _ in range(200):
        n, m = rng.integers(1, 7, 2)
        scores = rng.integers(0, 6, (n, m)) / 6
        i, j = np.nonzero(scores)
        mate = rng.permutation(max(n, m))[:n]
        mate, price, gain = linkage.auction(i, j, scores[i, j], rng.random(m), np.where(mate < m, mate, -1), 0.02, 1e-11)
        taken = mate[mate >= 0]
        assert len(set(taken)) == len(taken)
        total = sum(scores[x, y] for x, y in enumerate(mate) if y >= 0)
        assert abs(total - best(scores)) < 1e-9 and abs(price.sum() + gain.sum() - total) < 1e-9
