"""The whole pipeline against a plain reading of its stages, on a small fixture."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import langid

_LOWER = {i: i + 32 for i in range(65, 91)}
_DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def fixture():
    rng = random.Random(9)
    bags = {lang: sorted({"".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(250)}) for lang, letters in (("en", "abcdefghijk"), ("de", "lmnopqrstuvwxyz"))}
    draw = lambda lang, n: [rng.choice(bags[lang]) for _ in range(n)]
    rows = []

    def add(text, lang):
        rows.append((len(rows), text, lang, f"src{len(rows) % 3}", None if text is None else len(text)))
        return len(rows) - 1

    for i in range(24):
        lang = ("en", "de")[i % 2]
        add(" ".join(draw(lang, 60)), lang)
    base = rows[4][1].split()
    near = add(" ".join([*base[:30], "kabcd", *base[31:]]), "en")  # 51 of 61 shingles
    copy = add(rows[7][1], "de")
    apart = add(" ".join([*base[:10], "kk", *base[11:25], "kj", *base[26:45], "ki", *base[46:]]), "en")  # 41 of 71
    passage = draw("en", 20)
    dirty = add(" ".join([*draw("en", 30), *passage, *draw("en", 10)]), "en")
    clean = add(" ".join([*draw("en", 400), *passage[:13]]), "en")  # 13 words of 413
    mail = add(" ".join(draw("de", 40)) + " xyz.zyx@opq.lmn.de, 10.2.3.44 und +49 (30) 123-45678", None)
    card = add(" ".join(draw("en", 40)) + " 4111 1111-1111 1111 or 1111 1111 1111 1111", "en")
    gone = [add(None, "en"), add("", "de"), add("123 456 !?", "en")]
    rows.append(rows[2])  # a repeated row
    return rows, [(1, " ".join(passage)), (2, "123"), (None, None)], {"gone": [near, copy, dirty, *gone], "kept": [apart, clean, mail, card]}


def by_language(rows):
    labelled = {(r[2], r[1] or "") for r in rows if r[2] is not None}  # copies count once
    seen = Counter(w for _, text in labelled for w in langid.words_of(text))
    out = []
    for row in rows:
        found = langid.words_of(row[1] or "")
        if found and sum(seen[w] > 1 for w in found) >= corpus_pipeline.KNOWN_SHARE * len(found):
            out.append(row)
    return out


def deduplicated(rows):
    def shingles(text):
        w = words(text)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {text or ""}

    sets, group = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return [min((r for r, g in zip(rows, group) if g == k), key=lambda r: r[0]) for k in sorted(set(group))]


def uncontaminated(rows, items):
    out = []
    for row in rows:
        own, hit = words(row[1]), set()
        for _, item in items:
            ws = words(item)
            size = min(13, len(ws))
            windows = {tuple(ws[p : p + size]) for p in range(len(ws) - size + 1)} if size else set()
            for q in range(len(own) - size + 1 if size else 0):
                if tuple(own[q : q + size]) in windows:
                    hit |= set(range(q, q + size))
        if not hit or 20 * len(hit) < len(own):
            out.append(row)
    return out


def sanitised(text):
    for old, new in (("xyz.zyx@opq.lmn.de", "[EMAIL]"), ("10.2.3.44", "[IP]"), ("+49 (30) 123-45678", "[PHONE]"), ("4111 1111-1111 1111", "[CARD]")):
        text = text.replace(old, new)
    return text


def test_pipeline_against_plain_stages(spark, tmp_path):
    import public_tokenizers
    import tiktoken

    from lodestone.llm import bpe

    rows, items, planted = fixture()
    spark.createDataFrame(rows, _DOCUMENTS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = uncontaminated(deduplicated(by_language(rows)), items)
    ids = {r[0] for r in want}
    assert not ids & set(planted["gone"]) and ids >= set(planted["kept"])

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.lang, r.source, list(r.token_ids)) for r in got} == {r[0]: (r[2], r[3], own.encode_ordinary(sanitised(r[1]))) for r in want}
    assert len(got) == len(want)


def test_stages_keep_the_columns_and_take_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], _DOCUMENTS).withColumn("score", F.lit(1)).withColumn("node", F.lit("mine"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        assert made.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns
