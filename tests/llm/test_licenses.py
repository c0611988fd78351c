"""License scans against a plain search on small fixtures."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestone.llm import licenses

_LOWER = {i: i + 32 for i in range(65, 91)}


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def _plain(text, known, shift=licenses.SHIFT, least=licenses.LEAST):
    """The row of one text, from the definition: all places of all grams, all diagonals."""
    own, places, base, labels, score = _words(text), [], set(), set(), 0.0
    for label, exact, template in known:
        theirs = _words(template)
        n = len(theirs) - 2
        pairs = [(p - t, t) for p in range(len(own) - 2) for t in range(max(0, n)) if own[p : p + 3] == theirs[t : t + 3]]
        for diagonal in {d for d, _ in pairs}:
            reach = 0 if exact else shift
            share = len({t for d, t in pairs if abs(d - diagonal) <= reach}) / n
            score = max(score, share)
            if exact and share == 1:
                places.append(diagonal)
                base.add(label)
            if share == 1 if exact else share >= least:
                labels.add(label)
    return len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def test_licenses_against_plain_search(spark):
    rng = random.Random(12)
    known = [(a, True, b) for a, b in licenses.PHRASES] + [(a, False, b) for a, b in licenses.NOTICES]
    texts = [None, "", "cc by", "cc by nc", "CC-BY-NC cc by nc", "Under the MİT License", "under the mit license " * 40, "apache license version 20", "Apache License, Version 2.0 É under the MIT licensé"]
    for _, _, notice in known:
        held = notice.split()
        for _ in range(2):
            for _ in range(rng.randint(0, 4)):
                held[rng.randrange(len(held))] = rng.choice(["", "odd", "odd even", "of the software"])
            texts.append(" ".join([*rng.choices(["wide", "of", "the", "software", "work"], k=rng.randint(0, 30)), *held, "end"]))
    texts.append(" ".join(n for _, _, n in known))  # notices one after the other
    texts.append("of this software " * 3000 + licenses.NOTICES[0][1])
    texts += texts[-3:-1]
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)] + [(3, "cc by nc"), (3, "cc by nc"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("label", F.lit(1)).withColumn("m0", F.lit(1))
    got = licenses.scan(df)
    assert "text" in got.columns and "label" in got.columns
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    found = sorted(((r.doc_id, r.text, *(r[n] for n in names)) for r in got.collect()), key=str)
    assert found == sorted(((i, t, *_plain(t, known)) for i, t in rows), key=str)


@pytest.mark.parametrize("most", [0, 1000])
def test_own_templates(spark, monkeypatch, most):
    monkeypatch.setattr(licenses, "BROADCAST_GRAMS", most)
    long = " ".join(f"w{i}" for i in range(300))
    known = [("long", False, long), ("long", False, long), ("short", True, "a b"), (None, True, "x y z"), ("none", None, None), ("abc", True, "a b c")]
    df = spark.createDataFrame([(1, long.upper()), (2, "a b c a b c"), (3, "x y z")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.n_base, r.score) for r in licenses.scan(df, spark.createDataFrame(known, "label string, exact boolean, text string")).collect()}
    assert got == {1: ("long", 0, 1.0), 2: ("abc", 2, 1.0), 3: ("", 0, 0.0)}
    none = spark.createDataFrame([], "label string, exact boolean, text string")
    assert licenses.scan(df, none).where("score > 0 or labels <> ''").count() == 0
    assert licenses.scan(df.limit(0)).count() == 0


def test_words_are_cut_not_extracted(spark):
    """Extraction of each match took most of the query's time; cutting gives the same words."""
    texts = ["", None, " ", "a", ",a", "a,", "..É1, KK İx-\U0001f600y\x00z ", "one  two", "  \x7f9"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", licenses.words(F.col("t")).alias("w"))
    for row in got.collect():
        lowered = (row.t or "").translate({c: c + 32 for c in range(65, 91)})
        assert row.w == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered), row
    assert "regexp_extract_all" not in licenses.scan(df.select(F.lit(1).alias("doc_id"), F.col("t").alias("text")))._jdf.queryExecution().optimizedPlan().toString()
