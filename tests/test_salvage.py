import random

from pyspark.sql import functions as F

from lodestone.operators import salvage
from lodestone.sources import shared

KINDS = ["family", "device"]
RECORD = "paper_id string, kind string, record_id string, position int, value int, parent string, extra string"


def plain_quality(rows, baseline):
    """Issues that depend on other records: a parent that is not there, a value twice."""
    ids = {r[2] for r in rows}
    values = [r[4] for r in rows if r[4] is not None]
    lost = {r[4] for r in baseline if r[4] is not None and r[4] >= 8} - set(values)
    return sum(r[5] is not None and r[5] not in ids for r in rows), len(values) - len(set(values)), sum(r[4] is None for r in rows), len(lost)


def quality(rows, baseline):
    papers = rows.select("paper_id").distinct()
    ids = rows.select("paper_id", F.col("record_id").alias("parent")).distinct()
    a = rows.where("parent is not null").join(ids, ["paper_id", "parent"], "left_anti").groupBy("paper_id").agg(F.count("*").alias("v"))
    b = rows.groupBy("paper_id").agg((F.count("value") - F.countDistinct("value")).alias("s"), F.count_if(F.col("value").isNull()).alias("m"))
    lost = baseline.where("value >= 8").select("paper_id", "value").distinct().join(rows.select("paper_id", "value"), ["paper_id", "value"], "left_anti").groupBy("paper_id").agg(F.count("*").alias("l"))
    all_ = papers.join(a, "paper_id", "left").join(b, "paper_id", "left").join(lost, "paper_id", "full_outer")
    return all_.select("paper_id", F.struct(F.col("v").alias("validation_issues"), F.col("s").alias("semantic_issues"), F.col("m").alias("missing_claims"), F.col("l").alias("lost_verified_values")).alias("quality"))


def plain_salvage(rows, proposed, removals):
    state, accepted = list(rows), []
    q = plain_quality(state, state)
    tries = [(False, p) for p in sorted(proposed, key=lambda r: (KINDS.index(r[1]), r[3], r[2]))] + [(True, r) for r in sorted(removals, key=lambda r: (KINDS.index(r[1]), r[2]))]
    for removal, entry in tries:
        trial = [r for r in state if r[1:3] != entry[1:3]] if removal else [entry if r[1:3] == entry[1:3] else r for r in state]
        if not removal and entry not in trial:
            trial.append(entry)
        after = plain_quality(trial, state)
        good = all(x <= y for x, y in zip(after[:3], q[:3])) and after[3] == 0 and (after[0] < q[0] or after[1] < q[1])
        accepted.append((removal, entry[1], entry[2], good))
        if good:
            state, q = trial, after
    return sorted((r[1], r[2], r[4], r[5]) for r in state), accepted


def test_patches_are_salvaged_as_by_a_plain_loop(spark):
    rng, rows, proposed, removals = random.Random(4), [], [], []
    for p in range(25):
        def record(i, kind=None):
            return (f"p{p}", kind or rng.choice(KINDS), f"r{i}", i, rng.choice([None, *range(9)]), rng.choice([None, f"r{rng.randint(0, 7)}"]), "x")

        own = [record(i) for i in range(rng.randint(0, 6))]
        rows += own
        if p % 5:
            kinds = {r[2]: r[1] for r in own}
            picked = rng.sample(range(9), rng.randint(0, 4))
            proposed += [record(i, kinds.get(f"r{i}")) for i in picked]
            removals += [r[:3] for r in own if r[3] not in picked and rng.random() < 0.3]
    table = lambda own: spark.createDataFrame(own, RECORD)
    final, steps, ends = salvage.salvage(table(rows), table(proposed), spark.createDataFrame(removals, "paper_id string, kind string, record_id string"), "position", KINDS, quality, shared.folder(spark))
    got, tried, after = final.collect(), steps.collect(), {r.paper_id: r for r in ends.collect()}
    some = 0
    for p in (f"p{p}" for p in range(25)):
        pick = lambda own: [x for x in own if x[0] == p]
        state, accepted = plain_salvage(pick(rows), pick(proposed), pick(removals))
        assert sorted(((r.kind, r.record_id, r.value, r.parent) for r in pick(got)), key=str) == sorted(state, key=str)
        assert [(r.removal, r.kind, r.record_id, r.accepted) for r in sorted(pick(tried), key=lambda r: r.step)] == accepted
        some += sum(x[3] for x in accepted)
        if accepted:
            assert all(after[p].after[x] <= after[p].before[x] for x in ("validation_issues", "semantic_issues", "missing_claims"))
        assert (p in after) == bool(accepted)
    assert 3 < some < len(tried)


def test_nothing_to_salvage(spark):
    own = spark.createDataFrame([("p", "device", "a", 0, 1, None, "x")], RECORD)
    final, steps, ends = salvage.salvage(own, own.where("false"), own.where("false"), "position", KINDS, quality, shared.folder(spark))
    assert final.collect() == own.collect() and steps.collect() == [] and ends.collect() == []


CLAIM = "paper_id string, claim_id string, optional boolean, record string, at int, content string, grounded boolean"


def plain_issues(rows):
    """Ungrounded claims in order, then records that hold the same claims as another."""
    out = [(r[4], r[1], "unsupported") for r in sorted(rows, key=lambda r: r[4]) if not r[6]]
    records = {}
    for r in sorted(rows, key=lambda r: r[4]):
        records.setdefault(r[3], []).append(r[5])
    seen = {}
    for name, content in records.items():
        seen.setdefault(tuple(content), []).append(name)
    return out + [(1000, None, "same as " + ",".join(sorted(names))) for names in seen.values() if len(names) > 1]


def validate(rows):
    a = rows.where("not grounded").select("paper_id", F.col("at").alias("ordinal"), "claim_id", F.lit("unsupported").alias("reason"))
    records = rows.groupBy("paper_id", "record").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "content"))), lambda x: x["content"]).alias("c"))
    twins = records.groupBy("paper_id", "c").agg(F.array_sort(F.collect_list("record")).alias("r")).where(F.size("r") > 1)
    return a.union(twins.select("paper_id", F.lit(1000), F.lit(None).cast("string"), F.concat(F.lit("same as "), F.array_join("r", ","))))


def plain_drop(rows):
    gone = []
    while True:
        before = plain_issues(rows)
        counts = lambda own: {x: sum(i[2] == x for i in own) for x in {i[2] for i in own}}
        for _, claim, reason in before:
            row = next((r for r in rows if r[1] == claim), None)
            if reason != "unsupported" or not row[2]:
                continue
            after = plain_issues([r for r in rows if r[1] != claim])
            if len(after) < len(before) and all(n <= counts(before).get(x, 0) for x, n in counts(after).items()):
                rows, gone = [r for r in rows if r[1] != claim], [*gone, claim]
                break
        else:
            return rows, gone, before


def test_unsupported_claims_go_as_by_a_plain_loop(spark):
    rng, rows = random.Random(6), []
    for p in range(20):
        rows += [(f"p{p}", f"c{i}", rng.choice([True, True, None]), f"r{rng.randint(0, 2)}", i, rng.choice("ab"), rng.random() < 0.6) for i in range(rng.randint(1, 7))]
    kept, gone, left = salvage.drop_unsupported(spark.createDataFrame(rows, CLAIM), validate, ["unsupported"], shared.folder(spark))
    kept, gone, left = kept.collect(), gone.collect(), left.collect()
    blocked = 0
    for p in (f"p{p}" for p in range(20)):
        pick = lambda own: [x for x in own if x[0] == p]
        want, dropped, issues = plain_drop(pick(rows))
        assert sorted(r.claim_id for r in pick(kept)) == sorted(r[1] for r in want)
        assert [r.claim_id for r in sorted(pick(gone), key=lambda r: r.step)] == dropped
        assert sorted((r.claim_id or "", r.reason) for r in pick(left)) == sorted((c or "", x) for _, c, x in issues)
        blocked += sum(r[2] is True and not r[6] for r in want)
    assert len(gone) > 10 and blocked > 0
    empty = salvage.drop_unsupported(spark.createDataFrame([], CLAIM), validate, ["unsupported"], shared.folder(spark))
    assert all(x.collect() == [] for x in empty)
