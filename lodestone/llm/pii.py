"""Personal data: patterns first, then terms that give a protected entity away.

DataFrame and SQL functions only. Offsets come from the pieces between matches: splitting a text
by a pattern and extracting the pattern's matches give alternating pieces, whose lengths add up.
The patterns are written with possessive runs and a start rule (not inside a run, unless a
match just ended), which finds the same leftmost matches in linear time and constant stack.

The corpus then says how strongly a term reveals an entity: of all places where the term stands,
the share that is near the entity, in bits -log2. A term with enough different neighbourhoods
and few enough bits is a disclosure wherever it stands, and is sanitised like the entity.

Near is within 80 code points and six words on a side, and not beyond the next match of the same
kind; a term has three letters or more. A name that never stands so near to its entity, or is
shorter, is not found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

_START = r"(?:(?<!{0})|\G)"
_LOCAL = "[A-Za-z0-9._%+-]"
#: kind -> pattern, in the order in which kinds are listed
PATTERNS = {
    "email": _START.format(_LOCAL) + _LOCAL + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _START.format("[0-9]") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
#: What every valid match holds: texts without it are not searched for the kind.
HOLDS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Neighbourhood: so many characters and words on each side.
NEAR_CHARS, NEAR_WORDS = 80, 6
#: A disclosing term: so many different neighbourhoods of the entity, at most so many bits.
CONTEXTS, BITS = 3, 1.0
_TERM = r"\p{L}{3,}"
_BLOCK = 64


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda a, v: a + v)


def _before(sizes: Column, blocks: Column, i: Column) -> Column:
    """Sum of the first i sizes, with the sums of whole blocks at hand."""
    whole = F.floor(i / _BLOCK).cast("int")
    return _sum(F.slice(blocks, F.lit(1), whole)) + _sum(F.slice(sizes, whole * _BLOCK + 1, i - whole * _BLOCK))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    back = F.regexp_extract_all(F.reverse(_digits(value)), F.lit("[0-9]"), F.lit(0))
    parts = F.transform(back, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return _sum(parts) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _located(df: DataFrame, kind: str, pattern: Column, text: str) -> DataFrame:
    """``df`` with _k_<kind>: array of (start, rank, end, kind, value, left, right)."""
    rank = KINDS.index(kind)
    m, p, s, b = (f"_{x}_{kind}" for x in "mpsb")
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    df = df.withColumn(m, F.when(HOLDS[kind](F.col(text)), found) if kind in HOLDS else found)
    some = F.size(m) > 0
    df = df.withColumn(p, F.when(some, F.split(text, pattern, -1)))
    df = df.withColumn(s, F.when(some, F.zip_with(p, F.array_append(F.col(m), F.lit("")), lambda x, y: F.length(x) + F.length(y))))
    df = df.withColumn(b, F.when(some, F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / _BLOCK).cast("int")), lambda k: _sum(F.slice(s, k * _BLOCK + 1, F.lit(_BLOCK))))))

    def row(value: Column, i: Column) -> Column:
        start = _before(F.col(s), F.col(b), i) + F.length(F.get(F.col(p), i))
        return F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(value)).alias("end"), F.lit(kind).alias("kind"), value.alias("value"),
            F.right(F.get(F.col(p), i), F.lit(NEAR_CHARS + 1)).alias("left"), F.left(F.get(F.col(p), i + 1), F.lit(NEAR_CHARS + 1)).alias("right"),
        )

    rows = F.filter(F.transform(m, row), lambda x: _valid(kind, x["value"]))
    return df.withColumn(f"_k_{kind}", F.when(some, rows)).drop(m, p, s, b)


_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string,left:string,right:string>>"


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with _spans: all base matches by start, then kind. Null texts have none."""
    docs = c.without(docs, ["_spans", "_t"]).withColumn("_t", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    for kind, pattern in PATTERNS.items():
        docs = _located(docs, kind, F.lit(pattern), "_t")
    empty = F.array().cast(_SPAN)
    return docs.withColumn("_spans", F.array_sort(F.concat(*[F.coalesce(f"_k_{k}", empty) for k in PATTERNS]))).drop(*[f"_k_{k}" for k in PATTERNS])


def disclosing_terms(spans: DataFrame, folder: str, contexts: int = CONTEXTS, bits: float = BITS) -> DataFrame | None:
    """(term, bits) of the terms that reveal an entity, from ``spans`` (_t, _spans) of all rows;
    None if there is none.

    Counts of (entity, term, neighbourhood) are pre-aggregated, so copies of one text count as
    one neighbourhood, and an entity or term in a third of all rows sends a row a task."""
    spans = spans.select("_t", "_spans")

    def cut(x: str, end: str) -> Column:  # without a word that goes on beyond the neighbourhood
        return F.lower(F.when(F.length(x) > NEAR_CHARS, F.regexp_replace(x, end, "")).otherwise(F.col(x)))

    # explode_outer: of explode Spark infers a filter that would compute all spans once more
    near = spans.select(F.explode_outer("_spans").alias("s")).where("s is not null").select(
        F.md5(F.concat_ws(":", "s.kind", F.lower("s.value"))).alias("entity"),
        F.slice(F.reverse(F.regexp_extract_all(cut("s.left", r"^\p{L}+"), F.lit(_TERM), F.lit(0))), 1, NEAR_WORDS).alias("l"),
        F.slice(F.regexp_extract_all(cut("s.right", r"\p{L}+$"), F.lit(_TERM), F.lit(0)), 1, NEAR_WORDS).alias("r"),
    )
    pairs = near.select("entity", F.xxhash64("l", "r").alias("place"), F.explode_outer(F.array_distinct(F.concat("l", "r"))).alias("term")).where("term is not null")
    counted = pairs.groupBy("entity", "term", "place").agg(F.count("*").alias("n")).groupBy("entity", "term").agg(F.sum("n").alias("n"), F.count("*").alias("places"))
    likely = c.materialise(counted.where(F.col("places") >= contexts).groupBy("term").agg(F.max("n").alias("n")), folder, "likely")
    if likely.isEmpty():
        return None
    tokens = spans.select(F.explode_outer(F.regexp_extract_all(F.lower("_t"), F.lit(_TERM), F.lit(0))).alias("term"))
    # counted before the join: which words are likely is no matter of the corpus's size then
    total = tokens.groupBy("term").agg(F.count("*").alias("total"))
    terms = likely.join(total, "term").select("term", (-F.log2(F.least(F.col("n") / F.col("total"), F.lit(1.0)))).alias("bits")).where(F.col("bits") <= bits)
    terms = c.materialise(terms, folder, "terms")
    return None if terms.isEmpty() else terms


def find(docs: DataFrame, folder: str, text: str = "text", contexts: int = CONTEXTS, bits: float = BITS) -> DataFrame:
    """``docs`` with _t (the text, null as empty) and _spans: base matches and disclosing terms.

    Statistics cover all rows of ``docs``. Empty tables have no terms; repeated rows count as
    often as they stand, except that equal neighbourhoods are one, so ties of terms are all kept.
    Null texts have no spans. Columns named _t, _spans, _id, _p or _terms are replaced."""
    found = base_spans(docs, text)
    terms = disclosing_terms(found, folder, contexts, bits)
    if terms is None:
        return found
    held = found.withColumn("_id", F.md5("_t"))
    own = held.select("_id", F.explode_outer(F.array_distinct(F.regexp_extract_all(F.lower("_t"), F.lit(_TERM), F.lit(0)))).alias("term")).join(terms, "term", "left_semi").groupBy("_id").agg(F.collect_set("term").alias("_terms"))
    held = held.join(own, "_id", "left")
    pattern = F.when(F.col("_terms").isNull(), F.lit(r"(?!)")).otherwise(F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.array_sort("_terms"), "|"), F.lit(r")(?!\p{L})")))
    held = _located(held.withColumn("_p", pattern), "term", F.col("_p"), "_t")
    return held.withColumn("_spans", F.array_sort(F.concat("_spans", F.coalesce("_k_term", F.array().cast(_SPAN))))).drop("_k_term", "_p", "_terms", "_id")


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns with n_email, n_ip, n_card, n_phone, n_term, base_sha256 and spans."""
    base = F.filter("_spans", lambda s: s["kind"] != "term")

    def count(kind: str) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select(*keep, *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("_spans")).alias("spans"))


def sanitise(docs: DataFrame, folder: str, text: str = "text", **options) -> DataFrame:
    """``docs`` with each span of the text generalised to its kind in brackets ([EMAIL], ...);
    overlapping spans become one, of the first's kind. Other columns and null texts stay."""
    names = docs.columns
    found = find(docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), F.col(f"`{text}`").alias("text")), folder, "text", **options)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.concat(acc["out"], F.substring(F.col("_t"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], kept).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("_spans", start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("_t"), acc["at"] + 1, F.length("_t"))))
    clean = F.when(F.size("_spans") > 0, clean).otherwise(F.col("text"))
    return found.select(*[clean.alias(n) if n == text else F.col("_row")[n].alias(n) for n in names])
