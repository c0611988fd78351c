import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from lodestone.functions import grounding as gr
from lodestone.operators import excerpts

FIRST = "The complete photovoltaic device stack contains the reported absorber."
SECOND = "The same source passage reports the measured power conversion efficiency."


def test_two_spans_are_the_blocks_of_longest_matches(spark):
    """Against the standard library's matching blocks, on small alphabets, where ties and inner pieces are common."""
    rng, cases = random.Random(2), []
    for n in range(400):
        letters = "ab" if n % 2 else "abcdefgh"
        source = "".join(rng.choices(letters, k=rng.randint(4, 40)))
        a, b = sorted(rng.sample(range(len(source)), 2))
        query = source[a : a + rng.randint(1, 8)] + source[b : b + rng.randint(1, 8)]
        if n % 5 == 0:
            query += rng.choice("abz")
        found = [m for m in SequenceMatcher(None, query, source, autojunk=False).get_matching_blocks() if m.size]
        good = len(found) == 2 and min(m.size for m in found) >= 3 and sum(m.size for m in found) == len(query)
        cases.append((n, query, source, [(m.b, m.size) for m in found] if good else None))
    assert 40 < sum(c[3] is not None for c in cases) < 360
    rows = spark.createDataFrame([c[:3] for c in cases], "n int, q string, s string").select("n", excerpts.two_spans(F.col("q"), F.col("s"), 3).alias("got")).collect()
    got = {r.n: r.got and [tuple(x) for x in r.got] for r in rows}
    for n, query, source, want in cases:
        assert got[n] == want, (query, source)


def test_ordered_subset(spark):
    cases = [("ace", "abcde", True), ("aec", "abcde", False), ("", "x", True), ("aa", "a", False), ("é😀", "aéb😀", True)]
    rows = spark.createDataFrame(cases, "q string, s string, want boolean")
    assert all(r.got == r.want for r in rows.select("want", excerpts.is_ordered_subset(F.col("q"), F.col("s")).alias("got")).collect())


def test_stitched_quotes(spark):
    short = f"{FIRST} Intervening source material is retained separately. {SECOND}"
    long = f"{FIRST} {'intervening ' * 150} {SECOND.replace('power', 'ﬁne – power')}"
    blocks = [("p", "short", short), ("p", "long", long), ("p", "other", "x" * 100), ("p", "null", None)]
    stitched = f"{FIRST} {SECOND}"
    fine = f"{FIRST} {SECOND.replace('power', 'fine - power')}"
    cited = [("p", "l1", "short", stitched), ("p", "l1", "long", fine), ("p", "l1", "long", FIRST), ("p", "l2", "other", stitched), ("p", "l2", "null", stitched), ("p", "l2", "gone", stitched), ("p", "l2", "short", None), ("p", None, "long", "short words")]
    cited += [("p", "full", "long", fine)] * 8
    out = excerpts.restitched(spark.createDataFrame(cited, "paper_id string, list string, block_id string, quote string"), spark.createDataFrame(blocks, "paper_id string, block_id string, text string"), ["list"]).collect()
    assert len(out) == len(cited)
    got = {(r["list"], r.block_id, r.quote): (r.rule, r.new_quotes) for r in out}
    assert got[("l1", "short", stitched)] == ("restore_complete_short_block", [short])
    rule, quotes = got[("l1", "long", fine)]
    assert rule == "split_two_exact_source_spans" and quotes[0] == FIRST.rstrip(".") + "." and quotes[1] == SECOND.replace("power", "fine - power")
    assert got[("full", "long", fine)] == ("retain_longest_exact_source_span", [SECOND.replace("power", "fine - power")])
    for key in [("l1", "long", FIRST), ("l2", "other", stitched), ("l2", "null", stitched), ("l2", "gone", stitched), ("l2", "short", None), (None, "long", "short words")]:
        assert got[key] == (None, [key[2]])


def test_a_quotation_cut_within_a_word_stands_there_folded(spark):
    """j24's SQL asks for the folded text alone; by the operator's own rule a match must not run on into a word."""
    text = f"{FIRST} Intervening source material. {SECOND}"
    inside = text.replace("source material", "source-material")[4:-6].replace("-material", "  material")
    blocks = spark.createDataFrame([("p", "b", text)], "paper_id string, block_id string, text string")
    cited = spark.createDataFrame([("p", "b", inside), ("p", "b", f"{FIRST} {SECOND}")], "paper_id string, block_id string, quote string")
    for stands, want in ((gr.contains_quote, "restore_complete_short_block"), (gr.contains_folded, None)):
        got = {r.quote: r.rule for r in excerpts.restitched(cited, blocks, [], stands).collect()}
        assert got == {inside: want, f"{FIRST} {SECOND}": "restore_complete_short_block"}
