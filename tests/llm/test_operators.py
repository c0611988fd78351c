"""Small fixtures against brute force: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import gzip
import hashlib
import io
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.llm import bpe, decontaminate, fingerprint, langid, neardup, pii, ppm, substring, toxicity, warc
from lodestone.llm import common as c

ROWS = [(1, "Alpha beta gamma. " * 20), (2, None), (3, ""), (4, "Alpha beta gamma. " * 20), (None, "one two three four"), (4, "Alpha beta gamma. " * 20), (7, "x" * 30_000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("n_words", F.lit(-1))


@pytest.fixture
def folder(spark):
    return c.scratch(spark)


def test_suffix_array_search(spark, docs):
    rng = random.Random(4)
    bag = ["a", "bb", "ccc", "é", "9"]
    texts = [(i, " ".join(rng.choice(bag) for _ in range(rng.randint(0, 60))).upper()) for i in range(60)]
    items = [(i, " ".join(rng.choice(bag) for _ in range(rng.randint(0, 16)))) for i in range(12)] + [(50, texts[3][1]), (None, "bb bb"), (51, None)]
    lower = {i: i + 32 for i in range(65, 91)}
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(lower))
    got = {r.doc_id: r for r in decontaminate.contamination(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_bytes=60).collect()}
    for i, text in texts:
        own, hit, found = split(text), set(), set()
        for k, item in items:
            ws = split(item or "")
            size = min(13, len(ws))
            for p in range(len(ws) - size + 1 if size else 0):
                for q in range(len(own) - size + 1):
                    if own[q : q + size] == ws[p : p + size]:
                        hit |= set(range(q, q + size))
                        found.add("null" if k is None else str(k))
        assert (got[i].n_words, got[i].n_hit, got[i].item_ids) == (len(own), len(hit), sorted(found))
    empty = decontaminate.contamination(docs, spark.createDataFrame([], "item_id long, text string"))
    assert empty.where("n_hit > 0").count() == 0 and empty.count() == len(ROWS)


def test_bpe_matches_tiktoken(spark, docs):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choice(" '  \n\tstmdrevlabL1²３é中!. 　̀😀") for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["", " " * 70, "a" * 3000, "it's 've ''s"]
    for (ids, pieces, offsets), text in zip(bpe.encode(texts, path), texts):
        assert ids == own.encode_ordinary(text) and bpe.decode(ids, path) == text.encode() and "".join(pieces) == text and offsets[-1] == len(text)
    assert bpe.encoded(docs, path).where("text is null and n_tokens = 0").count() == 1


def _plain_ppm(training, text, order=5):
    """log10 probability of the text and its end, by escapes and exclusion read from the definition."""
    seen = {}
    for raw in training:
        symbols = [255] * order + list(raw.lower().encode()) + [255]
        for i in range(order, len(symbols)):
            for k in range(order + 1):
                table = seen.setdefault(tuple(symbols[i - k : i]), {})
                table[symbols[i]] = table.get(symbols[i], 0) + 1
    symbols, total = [255] * order + list(text.lower().encode()) + [255], 0.0
    for i in range(order, len(symbols)):
        gone = set()
        for k in range(order, -1, -1):
            table = {x: n for x, n in seen.get(tuple(symbols[i - k : i]), {}).items() if x not in gone}
            if not table:
                continue
            whole = sum(table.values()) + len(table)
            if symbols[i] in table:
                total += math.log10(table[symbols[i]] / whole)
                break
            total += math.log10(len(table) / whole)
            gone |= set(table)
        else:
            total -= math.log10(256 - len(gone))
    return total


@pytest.mark.parametrize("block, head", [(1 << 21, 1 << 19), (40, 5)])
def test_ppm_against_plain_model(spark, docs, folder, monkeypatch, block, head):
    monkeypatch.setattr(ppm, "BLOCK_GRAMS", block)
    monkeypatch.setattr(ppm, "HEAD_WORDS", head)
    rng = random.Random(3)
    texts = ["".join(rng.choice("aab é\tBc") for _ in range(rng.randint(0, 40))) for _ in range(24)] + ["zzz q", "", None, "abab abab", "abab abab"]
    rows = [(i if i != 4 else None, t, i % 3 > 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").withColumn("_row", F.lit("x"))
    got = {(r.doc_id, r.train): r for r in ppm.scored(df, F.col("train"), folder).collect()}
    training = [t or "" for _, t, own in rows if own]
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)})) + ["the end"]
    counts = Counter(w for t in training for w in split(t))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for i, text, own in rows:
        r = got[i, own]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(split(text)), sum(w in counts for w in split(text)), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in split(text)), abs_tol=1e-4)
        assert math.isclose(r.score, _plain_ppm(training, text or ""), rel_tol=1e-5, abs_tol=1e-4)
    none = ppm.scored(docs, F.lit(False), folder + "x").collect()
    assert len(none) == len(ROWS) and all(r.n_known == 0 and math.isclose(r.score, -math.log10(256) * (len(dict(ROWS).get(r.doc_id) or "") + 1), rel_tol=1e-6) for r in none)
    assert ppm.scored(docs.limit(0), F.lit(True), folder + "y").count() == 0


def test_fingerprints(spark, docs):
    rows = [(1, "Café  X"), (2, "café x "), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint.edits(df).collect()}
    assert got[1].fingerprint == got[2].fingerprint and got[3].fingerprint == got[4].fingerprint and got[1].fingerprint != got[3].fingerprint
    order = [r[1] or "" for r in sorted(rows, key=lambda r: -r[0])]
    for i, text in enumerate(order):
        k, after = len(text) // 3, order[(i + 1) % len(order)]
        assert got[4 - i].edited_sha256 == hashlib.sha256((text[: len(text) - k] + after[:k]).encode()).hexdigest() and got[4 - i].n_chars == len(text)
    assert fingerprint.edits(docs).count() == len(ROWS)
    assert {r.class_id for r in fingerprint.exact_groups(docs).where("class_size = 3").collect()} == {1}


@pytest.mark.parametrize("keys", [[2**62, *range(50)], [-(2**63), 0], [-(2**63), 0, 2**63 - 1], [], [None, None, 3], [5, 5, 5, None], [10**i for i in range(18)]])
def test_next_texts_of_uneven_keys(spark, monkeypatch, keys):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 2)
    monkeypatch.setattr(fingerprint, "BLOCK_BOUNDS", 3)
    rows = [(k, f"text {i % 7} of {k}") for i, k in enumerate(keys)]
    got = fingerprint.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = [(k, t, order[(i + 1) % len(order)][1]) for i, (k, t) in enumerate(order)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    with pytest.raises(TypeError):
        fingerprint.with_next(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_canonical_forms_against_unicodedata(spark):
    rng = random.Random(9)
    points = [chr(x) for a, b in ((0x20, 0x180), (0x370, 0x400), (0x1E00, 0x2100), (0x3040, 0x3100), (0xAC00, 0xAC40), (0xFB00, 0xFB10), (0xFF00, 0xFFA0)) for x in range(a, b)]
    points = [x for x in points if unicodedata.category(x) not in ("Cn", "Cs")]
    texts = ["".join(rng.choice(points + [" ", "\n", "\t"]) for _ in range(rng.randint(0, 12))) for _ in range(400)] + [None, "", " \n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: (r.canonical_text, r.fingerprint) for r in fingerprint.fingerprints(df).collect()}
    nfkc = lambda x: unicodedata.normalize("NFKC", x)
    for i, text in enumerate(texts):
        assert got[i][0] == re.sub(r"\s+", " ", nfkc(nfkc(text or "").casefold())).strip(" "), repr(text)
    assert len({f for _, f in got.values()}) == len({t for t, _ in got.values()}) and all(len(f) == 32 for _, f in got.values())


def test_fingerprint_query_groups_all_documents(spark, tmp_path, monkeypatch):
    from lodestone.llm import queries

    rows = [(5, "Café  X"), (2, "café x "), (3, None), (4, ""), (9, "other"), (None, "CAFÉ X")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = {(5, 2, 3), (2, 2, 3), (None, 2, 3), (3, 3, 2), (4, 3, 2), (9, 9, 1)}

    def got():
        return {(r.doc_id, r.class_id, r.class_size) for r in queries.op3_fingerprint(spark, str(tmp_path)).collect()}

    assert got() == expected
    # with one fingerprint for all texts, classes are told apart by their bytes alone
    monkeypatch.setattr(fingerprint, "wide_hash", lambda form: F.when(form.isNotNull(), "0"))
    assert got() == expected


def test_pii(spark, folder):
    df = spark.createDataFrame([(1, "mail a@b.cc, +49 (30) 123-45678, 1.2.3.4 or 4111 1111-1111 1111"), (2, None), (3, "1" * 9000), (4, "a@b" + ".c" * 4000)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.report(pii.find(df, folder), ["doc_id"]).collect()}
    assert got[1].spans == "email:5:11,phone:13:31,ip:33:40,card:44:63" and got[2].spans == "" and got[3].n_card == 0 and got[4].n_email == 1
    assert pii.sanitise(df, folder + "s").orderBy("doc_id").first()["text"] == "mail [EMAIL], [PHONE], [IP] or [CARD]"
    many = spark.createDataFrame([(i, f"case {i} by agent zorblax near a@b.cc and {chr(97 + i) * 4}") for i in range(5)] + [(9, "zorblax alone")], "doc_id long, text string")
    terms = {r.term for r in pii.disclosing_terms(pii.base_spans(many), folder + "t").collect()}
    assert "zorblax" in terms


def test_near_duplicates(spark, docs, folder):
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    near = base[:150] + ["zz"] + base[151:]
    df = spark.createDataFrame([(5, " ".join(base)), (6, " ".join(near)), (8, " ".join(reversed(base))), *ROWS], "doc_id long, text string")
    got = [(r.doc_id, r.class_id) for r in neardup.near_duplicates(df, folder).collect()]
    assert dict(got)[6] == 5 and dict(got)[8] == 8 and got.count((4, 1)) == 2 and dict(got)[3] == dict(got)[2] == 2
    kept = neardup.drop_near_duplicates(df.withColumn("node", F.lit(1)), folder + "k")
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 5, 7, 8] and kept.columns == ["doc_id", "text", "node"]


def test_dart_signatures_estimate_weighted_jaccard():
    rows, hashes, weights = neardup.weighted_sets(pa.array(["a b a b a b a b c d e f g", "a b a b c d e f g h a b"]), 2, True)
    signature = neardup.signatures(rows, hashes, weights, 2, 8000)
    a, b = (dict(zip(hashes[rows == i].tolist(), weights[rows == i])) for i in (0, 1))
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in a | b) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a | b)
    assert abs((signature[0] == signature[1]).mean() - want) < 0.03


def _plain_repeats(rows):
    """doc -> (bytes, removed, kept): a window goes if it was seen before, in the order of keys."""
    seen, want = set(), {}
    for i, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(raw[p : p + 100])
        want[i] = (len(raw), int(gone.sum()), bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return want


def _repeating_rows():
    rng = random.Random(5)
    base = "".join(rng.choice("abcdé fghij") for _ in range(1500))
    rows = []
    for i in range(60):
        a = rng.randint(0, 1200)
        text = "".join(rng.choice("xyz uvw") for _ in range(rng.randint(0, 150))) + base[a : a + rng.randint(50, 300)]
        rows.append((i, None if i % 20 == 7 else "a" * 250 + text if i % 10 == 0 else text + text if i % 15 == 1 else text))
    return rows


@pytest.mark.parametrize("hot", [4096, 3])
def test_repeated_substrings(spark, folder, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "BUCKET_ROWS", 50)
    rows = _repeating_rows()
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, bytes(r.kept)) for r in got} == _plain_repeats(rows)


def test_repeated_substrings_of_odd_rows(spark, folder):
    text = "the same words stand here and there, " * 6
    rows = [(5, text, "a"), (2, text, "b"), (2, text, "c"), (None, text, "d"), (None, None, "e"), (2**63 - 1, text[:120], "f"), (9, "", "g"), (-4, text[7:], "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, k string").withColumn("spans", F.lit(1))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in substring.remove_repeats(df, folder).collect())
    # -4 repeats itself (37 bytes a turn); both rows of 2 are one document, all of whose windows but those in its first 106 bytes stand in -4
    n, least = len(text), _plain_repeats([(-4, text[7:]), (2, text)])
    assert got == sorted([(False, -4, n - 7, least[-4][1]), *[(False, 2, n, least[2][1])] * 2, (False, 5, n, n), (False, 9, 0, 0), (False, 2**63 - 1, 120, 120), (True, 0, n, n), (True, 0, 0, 0)])
    assert substring.remove_repeats(df.limit(0), folder + "e").count() == 0


def test_repeats_survive_equal_hashes(monkeypatch):
    rng = random.Random(8)
    base = bytes(rng.choice(b"abc") for _ in range(160))
    raw = [bytes([rng.choice(b"xyz")]) * rng.randint(0, 3) + base[rng.randint(0, 9) :][: rng.randint(100, 140)] for _ in range(40)]
    numbers = [np.array(x, np.int64) for x in ([7] * 40, range(40), [0] * 40, [0] * 40, [0] * 40)]

    def removed():
        k, _, s, e = substring.repeats(*numbers, raw)
        return {(int(a), i) for a, b, d in zip(k, s, e) for i in range(b, d)}

    want = {(i, p + j) for i, x in enumerate(raw) for p in range(len(x) - 99) for j in range(100) if any(x[p : p + 100] == y[p : p + 100] for y in raw[:i])}
    assert removed() == want
    weak = lambda own, a, b, n: np.ones(len(a), bool)  # noqa: E731  every hash agrees
    monkeypatch.setattr(substring.Suffixes, "same", weak)
    monkeypatch.setattr(c, "window_hashes", lambda prefix, starts, size: np.zeros(len(starts), np.uint64))
    assert removed() == want


def _plain_language(rows, text, longest=5):
    """Label and share of the likelihood: words by log frequency, others by their n-grams, from the definition."""
    split = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    labels = sorted({lang for lang, _ in rows})
    words = {x: Counter(w for lang, t in rows if lang == x for w in split(t)) for x in labels}
    every = set().union(*words.values())
    known = len(every) + 1
    grams = {x: Counter() for x in labels}
    for x in labels:
        for w in every:
            marked = f"^{w}$"
            for size in range(1, longest + 1):
                for i in range(len(marked) - size + 1):
                    grams[x][marked[i : i + size]] += math.sqrt(words[x][w])
    total = {x: max(1, sum(words[x].values())) for x in labels}
    sums = {x: [1 + sum(k for g, k in grams[x].items() if len(g) == size) for size in range(longest + 1)] for x in labels}
    seen = lambda table, key: sum(table[x][key] for x in labels) > 1
    floor = -math.log10(2 * known + max(total.values()))

    def score(x, w):
        if seen(words, w):
            return math.log10((words[x][w] + 0.5) / (total[x] + 0.5 * known))
        marked, out = f"^{w}$", 0.0
        for i in range(len(marked)):
            held = next((marked[i : i + k] for k in range(min(longest, len(marked) - i), 0, -1) if seen(grams, marked[i : i + k])), None)
            out += floor if held is None else math.log10((grams[x][held] + 0.5) / (sums[x][len(held)] + 0.5 * known))
        return out / len(marked)

    found = split(text)
    likely = [sum(score(x, w) for w in found) for x in labels]
    best = max(range(len(labels)), key=lambda i: (likely[i], -i))
    return labels[best], 1 / sum(10 ** max(-300, y - likely[best]) for y in likely), sum(seen(words, w) for w in found) / len(found)


def test_languages(spark, docs):
    rows = [("en", "the cat and the dog")] * 3 + [("en", "and the dogs ran there"), ("de", "der hund und die katze und der rest"), ("de", "die hunde und der kater"), (None, "skip")]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    asked = ["the dogs", "die hunde", "katzen laufen dort", "x", "there and der hundert straße", "thethethe" * 30]
    different = sorted({r for r in rows if r[0]})
    for text, *got in zip(asked, *langid.predict(langid.Table(model), asked)):
        want = _plain_language(different, text)
        assert got[0] == want[0] and all(math.isclose(a, b, rel_tol=1e-4, abs_tol=1e-6) for a, b in zip(got[1:], want[1:])), text
    assert langid.predict(langid.Table(model), ["123", "", "½ ² ① _", "Ⅷ ٣"])[0] == ["und"] * 4
    odd = langid.languages(docs.withColumn("known", F.lit("mine")), model)
    assert odd.count() == len(ROWS) and odd.where("text is null and lang_pred = 'und' and score = 0").count() == 1
    assert langid.predict(langid.Table(langid.Model([])), ["word"])[0] == ["und"]
    tied = langid.Model([("b", "same same"), ("a", "same same")])
    assert langid.predict(langid.Table(tied), ["same"])[:2] == (["a"], [0.5])
    assert langid.recognised(docs, model).columns == docs.columns and langid.recognised(docs.limit(0), model).count() == 0


def test_unseen_words_are_scored_at_once(monkeypatch):
    """One pass over all new words of a batch, each as its own mean over positions; a table beyond its bound begins anew."""
    model = langid.Model([("a", "bana bana mana mana"), ("b", "trost trost frost frost")])
    asked, calls = ["bana nana ½x trostan", "zzz, trost_mana", "Éa frosten! bana", ""], []
    plain = langid.Model.unseen
    monkeypatch.setattr(langid.Model, "unseen", lambda self, words: calls.append(sorted(words)) or plain(self, words))
    got = langid.predict(langid.Table(model), asked)
    assert calls == [["frosten", "nana", "trostan", "x", "zzz", "éa"]]
    one = langid.predict(langid.Table(model, most=1), asked[:1]), langid.predict(langid.Table(model, most=1), asked[1:])
    assert [a + b for a, b in zip(*one)] == list(got)
    for word, row in zip(calls[0], model.unseen(calls[0])):
        marked, total = f"^{word}$", 0
        for at in range(len(marked)):
            known = [model.grams[g] for to in range(len(marked), at, -1) if (g := marked[at:to]) in model.grams]
            total = total + (model.gram_rows[known[0]] if known else model.floor)
        assert np.allclose(row, total / len(marked), rtol=1e-5)


def test_language_fit_is_not_crowded_out(spark):
    rows = [("de", f"wort{i} haus{i}") for i in range(900)] + [("en", "one text")] * 600 + [("sv", f"ord{i} hus") for i in range(5)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    model = langid.fit(df, rows=60)
    assert model.labels == ["de", "en", "sv"]
    again = langid.fit(df.repartition(3), rows=60)
    assert model.words == again.words and (model.word_rows == again.word_rows).all()


def test_toxicity(spark, docs):
    rng = random.Random(6)
    plain = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)) for _ in range(60)]
    toxic = [t + " vilest " + " ".join(rng.sample(t.split(), 8)) + " vilest" for t in plain[:30]]
    table = toxicity.Distances(toxicity.Model(toxic, plain[30:]))
    assert table["vilest"] > 0.45 and table.score("abcde " + "vilest " * 3) > table.score("abcde fghab bcdef")
    assert toxicity.scored(docs, toxicity.Model([], [])).where("score = 0").count() == len(ROWS)


def test_warc_round_trip(spark, folder):
    page = "<p>ü\r\n\r\nWARC/1.1</p>\n" * 60
    rows = [(1, "http://a/ b", page), (2, None, page), (3, "u", ""), (4, "u", None), (5, "u", "short"), (6, "u", "short")]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"), folder).collect()}
    assert got[1].record_type == "revisit" and got[1].refers_to == 2 and got[2].record_type == got[5].record_type == got[6].record_type == "response"
    for i, _, html in rows:
        raw = (html or "").encode()
        assert got[i].payload_bytes == len(raw) and got[i].payload_digest == hashlib.sha1(raw).hexdigest()
    only = warc.read_archives(spark, folder, ["record_id", "payload_length", "headers", "payload"]).where("record_id = '<urn:lodestone:page:5>'").collect()
    assert [(r.payload_length, bytes(r.payload), r.headers["content-type"]) for r in only] == [(5, b"short", "application/http;msgtype=response")]
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", only[0].headers["warc-date"])


def test_warc_of_odd_rows(spark, folder):
    page = "p" * 1200
    rows = [("a\r\nb", None, page, 1), ("null", "u", page, 2), (None, "u", page, 3), ("", "u", "short", 4), ("% ü+", "u", None, 5), ("null", "u", page, 6)]
    df = spark.createDataFrame(rows, "page_id string, url string, html string, record_type int")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(df, folder).collect()), key=repr)
    want = [("a\r\nb", 1200, "revisit", "null"), ("null", 1200, "response", None), (None, 1200, "revisit", "null"), ("", 5, "response", None), ("% ü+", 0, "response", None), ("null", 1200, "response", None)]
    assert got == sorted(want, key=repr)
    warc.write_archives(warc.classify(df), folder + "z", compression="gzip")
    packed = warc.read_archives(spark, folder + "z", ["record_type", "record_id", "payload"])
    assert packed.count() == len(rows) and {bytes(r.payload) for r in packed.where("record_type = 'response'").collect()} == {page.encode(), b"short", b""}
    assert packed.where("record_id = '<urn:lodestone:no-page>'").count() == 1
    assert warc.round_trip(df.limit(0), folder + "e").count() == 0
    warc.write_archives(warc.classify(df), folder + "p", compression="none")
    whole = lambda at: sorted(((r.record_id, r.target_uri, r.payload) for r in warc.read_archives(spark, at).collect()), key=repr)
    assert whole(folder + "p") == whole(folder + "z")


class _Counted(io.BytesIO):
    """A file that counts what is read of it."""

    got = 0

    def read(self, n=-1):
        out = super().read(n)
        self.got += len(out)
        return out

    def size(self):
        return len(self.getbuffer())


def test_unwanted_members_are_skipped(tmp_path):
    rng = random.Random(10)
    def text(i, body):
        return f"WARC/1.1\r\nWARC-Type: {'response' if i % 50 else 'revisit'}\r\nWARC-Record-ID: <{i}>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    bodies = [rng.randbytes(400_000 if i % 50 else 10) for i in range(100)]
    packed = b"".join(warc.member(text(i, b)) for i, b in enumerate(bodies))
    assert gzip.decompress(packed) == b"".join(text(i, b) for i, b in enumerate(bodies))  # any reader of gzip can
    raw = _Counted(packed)
    found = list(warc.members(raw, "a", {"record_type": {"revisit"}}, True))
    assert [r["payload"] for r in found] == [bodies[0], bodies[50]] and found[1]["offset"] == packed.index(warc.member(text(50, bodies[50])))
    inflated = []
    whole = zlib.decompressobj

    class Told:
        def __init__(self, *a):
            self.own = whole(*a)

        def decompress(self, data):
            out = self.own.decompress(data)
            inflated.append(len(out))
            return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(warc.zlib, "decompressobj", Told)
        assert len(list(warc.members(_Counted(packed), "a", {"record_type": {"revisit"}}, True))) == 2
    assert sum(inflated) < 100 * 2048  # headers, not the 39 MB behind them
    (tmp_path / "own.warc.gz").write_bytes(packed)
    (tmp_path / "other.warc.gz").write_bytes(gzip.compress(text(1, b"x")))
    from pyarrow import fs

    assert [warc._tells_lengths(fs.LocalFileSystem(), str(tmp_path / f"{n}.warc.gz")) for n in ("own", "other")] == [True, False]
    with pytest.raises(ValueError):
        list(warc.members(_Counted(packed[:-9]), "a", {}, True))


def test_equal_sha1_is_not_enough(spark, monkeypatch):
    monkeypatch.setattr(warc.F, "sha1", lambda col: F.lit("0" * 40))
    df = spark.createDataFrame([(1, "u", "a" * 1000), (2, "u", "b" * 1000), (3, "u", "b" * 1000)], "page_id long, url string, html string")
    assert sorted((r.page_id, r.record_type) for r in warc.classify(df).collect()) == [(1, "response"), (2, "revisit"), (3, "response")]


def test_archives_that_are_cut(tmp_path):
    from pyarrow import fs

    for content in (b"WARC/1.1\r\nWARC-Type: response\r\n\r\nxx\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nxx", b"WARC/1.1\r\nContent-", b"HTTP/1.1\r\n\r\n"):
        (tmp_path / "a").write_bytes(content)
        with fs.LocalFileSystem().open_input_file(str(tmp_path / "a")) as raw, pytest.raises(ValueError):
            list(warc.records(raw, "a", {}, True))


_PLAIN_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(_PLAIN_PII.items()):
        for m in re.finditer(pattern, text, re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            odd = [int(d) for d in digits[-1::-2]] + [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
            fits = {"email": True, "ip": all(int(x) < 256 for x in m[0].split(".")) if kind == "ip" else False, "card": 14 <= len(digits) <= 19 and sum(odd) % 10 == 0, "phone": 10 <= len(digits) <= 15}
            if fits[kind]:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(out))


def test_pii_against_plain_patterns(spark, folder):
    rng = random.Random(12)
    parts = ["a@b.cc", "4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "999.1.1.1", "+49 (30) 123-45678", "+1 2", "x", "é", " ", "-", ".", "@", "5", "12", "00", "+", "%", "(", "4012888888881881", "a.b+c@d-e.f.g"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("_spans", F.lit("mine"))
    got = {r.doc_id: r for r in pii.report(pii.base_spans(df), ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        assert got[i].spans == _plain_spans(text or ""), repr(text)
    assert pii.report(pii.find(df.limit(0), folder), ["doc_id"]).count() == 0


def test_disclosing_terms_against_plain_counts(spark, folder):
    rng = random.Random(13)
    names, bag = ["anna", "zorblax", "quux", "li"], ["report", "case", "call", "today", "office", "x1", "über"]
    rows = []
    for i in range(160):
        words = [rng.choice(bag) for _ in range(rng.randint(0, 30))]
        if i % 2:
            at = rng.randint(0, len(words))
            words[at:at] = [rng.choice(names), "me@there.org" if i % 4 == 1 else "10.0.0.1"]
        rows.append((i, " ".join(words) if i % 17 else None))
    rows += [rows[1], rows[3]]
    near, total = {}, Counter()
    for _, text in rows:
        text = text or ""
        total.update(re.findall(r"[^\W\d_]{3,}", text.lower()))
        for kind, value in (("email", "me@there.org"), ("ip", "10.0.0.1")):
            for m in re.finditer(re.escape(value), text):
                sides = [text[: m.start()], text[m.end() :]]
                left, right = sides[0][-81:], sides[1][:81]
                left = re.sub(r"^[^\W\d_]+", "", left) if len(left) > 80 else left
                right = re.sub(r"[^\W\d_]+$", "", right) if len(right) > 80 else right
                before, after = re.findall(r"[^\W\d_]{3,}", left.lower())[::-1][:6], re.findall(r"[^\W\d_]{3,}", right.lower())[:6]
                for term in {*before, *after}:
                    near.setdefault((value, term), []).append((tuple(before), tuple(after)))
    want = {}
    for (_, term), places in near.items():
        if len(set(places)) >= 3:
            want[term] = max(want.get(term, 0), len(places))
    want = {t: -math.log2(min(1, n / total[t])) for t, n in want.items()}
    want = {t: b for t, b in want.items() if b <= 1}
    terms = pii.disclosing_terms(pii.base_spans(spark.createDataFrame(rows, "doc_id int, text string")), folder)
    got = {r.term: r.bits for r in terms.collect()} if terms is not None else {}
    assert want and got.keys() == want.keys() and all(math.isclose(got[t], want[t], abs_tol=1e-12) for t in want)


def test_near_duplicate_recall(spark, folder):
    """Classes of 90 groups of edited texts against all pairs: every pair of a similarity of 0.8 or more shares a class."""
    rng = random.Random(21)
    texts = []
    for _ in range(90):
        base = [f"w{rng.randint(0, 10**5)}" for _ in range(rng.randint(20, 120))]
        texts.append(base)
        for _ in range(2):
            other = list(base)
            for _ in range(rng.randint(0, 3)):
                other[rng.randrange(len(other))] = f"x{rng.randint(0, 10**5)}"
            texts.append(other if rng.random() < 0.8 else other + base[: len(base) // 3])
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    want = {}
    for i, g in enumerate(group):
        want.setdefault(g, i)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), folder).collect()}
    alike = sum(got[i] == want[g] for i, g in enumerate(group))
    assert len(set(group)) < 240 and alike / len(texts) >= 0.99


def test_toxicity_fit_of_repeated_keys(spark):
    words = "calm plain words of every day that say nothing much at all here".split()
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(words) for _ in range(12)) + (" vilest " + rng.choice(words) + " vilest" if i < 20 else "")) for i in range(60)]
    labels = [(i, int(i < 20)) for i in range(60)] + [(3, 0), (3, 1), (None, 1), (7, None)]
    spare = [(3, "a different text of the same key"), (None, "no key")]
    schema = "doc_id long, text string"
    one = toxicity.fit(spark.createDataFrame(docs + spare, schema), spark.createDataFrame(labels, "doc_id long, toxic int"), rows=40)
    two = toxicity.fit(spark.createDataFrame((docs + spare)[::-1], schema).repartition(3), spark.createDataFrame(labels[::-1], "doc_id long, toxic int"), rows=40)
    assert one.usable and (one.toxic, one.ordinary) == (two.toxic, two.ordinary) and (one.weights == two.weights).all()
    none = toxicity.fit(spark.createDataFrame([], schema), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert not none.usable and toxicity.scored(spark.createDataFrame(docs, schema), none).where("score <> 0").count() == 0
