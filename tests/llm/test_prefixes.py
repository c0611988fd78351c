"""The prefix trie against plain recursion on small fixtures."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lodestone.llm import common as c
from lodestone.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"


def _plain(rows, group=100):
    """All nodes, from the definition."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {k: [t[2:] for t in sorted(v)] for k, v in own.items()}
    if group:
        whole = {}
        for k in own:
            h = zlib.crc32(str(k).encode()) % 6
            base = k - (k % group if k >= 0 else -(-k % group))
            whole[k] = own.get(base, [])[:h] + own[k][h:]
        own = whole
    members = defaultdict(list)
    for k, turns in own.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(k)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        leaf = [x for x in below if not any(len(y) > len(x) and y[: len(x)] == x for y in members)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(map(str, sorted(k for k in convs if len(own[k]) == len(node))))
        out.append((len(node), min(convs), min(members[node[:-1]]) if node else None, len(convs), sum(len(x) == len(node) + 1 for x in below), len(leaf), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _found(df):
    return sorted((tuple(r[n] for n in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in df.collect()), key=str)


@pytest.mark.parametrize("block, group", [(1024, 100), (2, 100), (3, None)])
def test_trie_against_plain(spark, monkeypatch, block, group):
    monkeypatch.setattr(prefixes, "BLOCK", block)
    monkeypatch.setattr(prefixes, "CHUNK_BYTES", 60)
    rng = random.Random(13)
    convs = [*range(-3, 40), 100, 101, 107, 250, 251, 299, 1200, 1203]
    rows = [(k, rng.choice([None, *range(9)]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bé😀", "", None, "ccc"])) for k in convs for _ in range(rng.randint(1, 12))]
    rows += [(k, t, "user", "same") for k in range(600, 640) for t in range(7)]  # copies of one conversation
    rows += [(None, 1, "user", "lost"), (5, 3, "user", "a"), (5, 3, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit(7)).withColumn("x1", F.lit("mine"))
    assert _found(prefixes.prefix_trie(df, c.scratch(spark), group)) == _plain(rows, group)


def test_trie_of_little(spark):
    assert prefixes.prefix_trie(spark.createDataFrame([], SCHEMA), c.scratch(spark), 100).count() == 0
    assert prefixes.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA), c.scratch(spark)).count() == 0
    long = [(1, t, "user", "x" * (t == 500)) for t in range(3000)] + [(2, t, "user", "x" * (t == 500)) for t in range(2500)]
    got = _found(prefixes.prefix_trie(spark.createDataFrame(long, SCHEMA), c.scratch(spark)))
    assert len(got) == 3001 and {r[6] for r in got if r[0] <= 501} == {1} and {r[5] for r in got} == {1}
    with pytest.raises(ValueError):
        prefixes.ranked(spark.createDataFrame([("a", 1, "user", "x")], "conv_id string, turn long, role string, text string"))
