"""License notices in texts: all word k-grams are joined with the places of template k-grams, votes are
counted on diagonals (place in the text less place in the template), neighbouring diagonals are
merged, and the spans that they make are verified by what they cover. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

#: Words of a gram.
K = 3
#: Words that may be put in or left out on either side of a diagonal.
SHIFT = 8
#: A notice is found if so large a share of its grams stands in one span.
LEAST = 0.7
#: Template grams that are broadcast at most; beyond it they are joined by shuffle.
BROADCAST_GRAMS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, the letters being lower-cased.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BITS = 64

# Phrases that count only word for word.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Notices as published with the licenses, and the usual statements of them.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "Released under the MIT License."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Licensed under the BSD 3-Clause License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
    ("all-rights", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means"),
]
_ADDED = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words; null has none. Cutting at what stands between them takes a fraction of the
    time of extracting them; only before the first and behind the last can a piece be empty."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def templates(spark: SparkSession) -> DataFrame:
    """(label, exact, text) of the phrases and notices above."""
    rows = [F.struct(F.lit(label).alias("label"), F.lit(exact).alias("exact"), F.lit(text).alias("text")) for exact, held in ((True, PHRASES), (False, NOTICES)) for label, text in held]
    return spark.range(1, numPartitions=1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")


def _rolled(df: DataFrame) -> DataFrame:
    """A row for each place of a gram in the array _w: its words _g0, _g1, ... and their hash _h."""
    every = df.select("*", F.posexplode("_w").alias("_pos", "_g0")).where(F.col("_pos") + (K - 1) < F.size("_w"))
    every = every.withColumns({f"_g{i}": F.get("_w", F.col("_pos") + i) for i in range(1, K)}).drop("_w")
    return every.withColumn("_h", F.xxhash64(*[f"_g{i}" for i in range(K)]))


def template_grams(known: DataFrame) -> DataFrame:
    """The grams of ``known`` (label, exact, text): template (a hash of the row), place, and how many it has.

    Rows that repeat are one template; those of fewer than K words can't be voted for and go, as do null labels."""
    known = known.where("label is not null").select("label", F.coalesce("exact", F.lit(False)).alias("exact"), words(F.col("text")).alias("_w")).distinct()
    known = known.withColumn("n_grams", F.size("_w") - (K - 1)).withColumn("template", F.sha2(F.concat_ws(" ", F.col("exact").cast("string"), "label", "_w"), 256))
    return _rolled(known).withColumnRenamed("_pos", "at")


def votes(docs: DataFrame, known: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_key, _digest, template, label, exact, n_grams, diagonal, m0, m1, ...): which grams of the template
    (bits of the masks) stand on the diagonal.

    Only grams that a template has, compared word for word, leave their task, and of those a row for
    each diagonal: masks are joined by OR, so rows of equal key and text count once."""
    grams = template_grams(known)
    size = grams.agg(F.count("*"), F.max("n_grams")).first()
    masks = -(-(size[1] or 1) // _BITS)
    own = docs.select(F.col(f"`{key}`").alias("_key"), _digest(text), words(F.col(f"`{text}`")).alias("_w"))
    theirs = grams.select(F.col("_h").alias("_th"), *[F.col(f"_g{i}").alias(f"_t{i}") for i in range(K)], "template", "label", "exact", "n_grams", "at")
    theirs = F.broadcast(theirs) if size[0] <= BROADCAST_GRAMS else theirs
    same = F.col("_h") == F.col("_th")
    for i in range(K):
        same &= F.col(f"_g{i}") == F.col(f"_t{i}")
    hits = _rolled(own).join(theirs, same)
    bit = [F.bit_or(F.when(F.floor(F.col("at") / _BITS) == m, F.expr(f"shiftleft(1L, at % {_BITS})")).otherwise(F.lit(0).cast("long"))).alias(f"m{m}") for m in range(masks)]
    return hits.groupBy("_key", "_digest", "template", "label", "exact", "n_grams", (F.col("_pos") - F.col("at")).alias("diagonal")).agg(*bit)


def _digest(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"), 256).alias("_digest")


def spans(found: DataFrame, shift: int = SHIFT) -> DataFrame:
    """``found`` votes with covered: the share of the template's grams on the diagonal and on those up to
    ``shift`` words beside it (of exact templates: on the diagonal alone). A window of at most 2 *
    ``shift`` + 1 rows slides over a document's diagonals, so notices that follow each other don't run together."""
    masks = [x for x in found.columns if x[0] == "m" and x[1:].isdigit()]
    near = f"over (partition by _key, _digest, template order by diagonal range between {shift} preceding and {shift} following)"
    alone = sum((F.bit_count(m) for m in masks[1:]), F.bit_count(masks[0]))
    merged = sum((F.expr(f"bit_count(bit_or({m}) {near})") for m in masks[1:]), F.expr(f"bit_count(bit_or({masks[0]}) {near})"))
    return found.withColumn("merged", merged).withColumn("covered", F.when(F.col("exact"), alone).otherwise(F.col("merged")) / F.col("n_grams")).drop("merged", *masks)


def scan(docs: DataFrame, known: DataFrame | None = None, text: str = "text", key: str = "doc_id", keep_text: bool = True, shift: int = SHIFT, least: float = LEAST) -> DataFrame:
    """``docs`` with n_words, n_base (places of exact templates), first_word and last_word (their least and
    greatest start, from 0; else null), base_labels and labels (distinct, sorted, comma-joined; labels also of
    notices of which the share ``least`` is covered) and score (the greatest covered share of any template).

    Null and empty texts have no words, no labels and score 0. Keys may be null or repeat: what is found
    belongs to (key, text), so rows that repeat get the same. Columns with the names of added ones are
    replaced. ``known`` (label, exact, text) may be empty."""
    docs = c.without(docs, [*_ADDED, "_digest", "_key"])
    known = templates(docs.sparkSession) if known is None else known
    covered = spans(votes(docs, known, text, key), shift)
    place = F.col("exact") & (F.col("covered") == 1)
    good = F.when(F.col("exact"), place).otherwise(F.col("covered") >= least)
    joined = lambda x: F.array_join(F.array_sort(F.collect_set(x)), ",")  # noqa: E731  at most as many as there are labels
    each = covered.groupBy("_key", "_digest").agg(
        F.count_if(place).alias("n_base"), F.min(F.when(place, F.col("diagonal"))).cast("long").alias("first_word"), F.max(F.when(place, F.col("diagonal"))).cast("long").alias("last_word"),
        joined(F.when(place, F.col("label"))).alias("base_labels"), joined(F.when(good, F.col("label"))).alias("labels"), F.max("covered").alias("score"),
    )
    keep = [F.col(f"`{n}`") for n in docs.columns if keep_text or n != text]
    every = docs.select(*keep, _digest(text), F.size(words(F.col(f"`{text}`"))).cast("long").alias("n_words"))
    out = every.join(each.withColumnRenamed("_digest", "_d2"), F.col(f"`{key}`").eqNullSafe(F.col("_key")) & (F.col("_digest") == F.col("_d2")), "left").drop("_key", "_d2", "_digest")
    return out.fillna({"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}, subset=["n_base", "base_labels", "labels", "score"])


def oracle_sql() -> str:
    """DuckDB SQL for the rows of the query: the same rules over all pairs of equal grams, each diagonal's
    neighbours by a join."""
    quoted = ", ".join(f"({i}, '{label}', {exact}, '{text.replace(chr(39), chr(39) * 2)}')" for i, (label, exact, text) in enumerate([(p[0], True, p[1]) for p in PHRASES] + [(n[0], False, n[1]) for n in NOTICES]))
    split = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH t AS (SELECT *, {split} AS w FROM (VALUES {quoted}) v(tid, label, exact, text)),
tg AS (SELECT tid, label, exact, len(w) - 2 AS n, p AS spot, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c FROM (SELECT *, unnest(range(1, len(w) - 1)) AS p FROM t)),
d AS (SELECT doc_id, row_number() OVER () AS rid, {split} AS w FROM documents),
dg AS (SELECT rid, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM d)),
h AS (SELECT DISTINCT rid, tid, label, exact, n, p - spot AS diag, spot FROM dg JOIN tg USING (a, b, c)),
e AS (SELECT DISTINCT rid, tid, diag FROM h),
v AS (SELECT h.rid, h.tid, label, exact, n, e.diag, count(DISTINCT spot) / n AS share FROM e JOIN h ON e.rid = h.rid AND e.tid = h.tid AND h.diag BETWEEN e.diag - {SHIFT} * (NOT exact)::INT AND e.diag + {SHIFT} * (NOT exact)::INT GROUP BY h.rid, h.tid, label, exact, n, e.diag),
r AS (SELECT rid, count(*) FILTER (WHERE exact AND share = 1) AS k, min(diag) FILTER (WHERE exact AND share = 1) AS f, max(diag) FILTER (WHERE exact AND share = 1) AS l,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact AND share = 1) AS bl,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE CASE WHEN exact THEN share = 1 ELSE share >= {LEAST} END) AS al, max(share) AS s FROM v GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(k, 0)::BIGINT AS n_base, f::BIGINT AS first_word, l::BIGINT AS last_word, coalesce(bl, '') AS base_labels, coalesce(al, '') AS labels, coalesce(s, 0)::DOUBLE AS score
FROM d LEFT JOIN r USING (rid)"""
