"""Text and identifier expressions, all of them built from SQL functions.

Unicode normalisation and case folding are static methods of the ICU library that Spark ships,
HTML entities are decoded by its text library; SQL's ``reflect`` calls them inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of numbers, DOIs and panel markers.
_NUMBERS = r"[+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_DOI = r"(?i)10\.[0-9]{4,9}/[-._;()/:A-Z0-9]+"
_PANEL = r"(?iU)\(([a-z])\)|(?<!\w)([a-z])\)(?=\s|[,:;.])"
_CODE = r"[A-Za-z0-9]+(?:[-_/][A-Za-z0-9]+)*"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda's variable is bound, where a column would be copied."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _by_icu(text: Column, name: str, method: str, flag: bool, plain=lambda x: x) -> Column:
    """ICU's method of a text, computed once; texts of ASCII alone, which are most, get ``plain``. Null stays null."""
    called = lambda x: F.reflect(F.lit(f"com.ibm.icu.{name}"), F.lit(method), x, F.lit(flag))
    return let(text, lambda x: F.when(F.length(x) == F.octet_length(x), plain(x)).when(x.isNotNull(), called(x)))


def nfc(text: Column) -> Column:
    """Unicode NFC; null stays null."""
    return _by_icu(text, "text.Normalizer", "compose", False)


def nfkc(text: Column) -> Column:
    """Unicode NFKC; null stays null."""
    return _by_icu(text, "text.Normalizer", "compose", True)


def casefold(text: Column) -> Column:
    """Full Unicode case folding; null stays null."""
    return _by_icu(text, "lang.UCharacter", "foldCase", True, F.lower)


def unescape(html: Column) -> Column:
    """HTML 4 entities and character numbers decoded; null stays null."""
    return F.when(html.isNotNull(), F.reflect(F.lit("org.apache.commons.text.StringEscapeUtils"), F.lit("unescapeHtml4"), html))


def has_term(text: Column, term: str) -> Column:
    """Case-insensitive term between word boundaries; the term is taken literally."""
    return text.rlike(rf"(?iU)(?<!\w)\Q{term}\E(?!\w)")


def any_term(text: Column, terms: list[str]) -> Column:
    out = F.lit(False)
    for term in terms:
        out = out | has_term(text, term)
    return out


def accepts(text: Column, groups: list[list[str]]) -> Column:
    """At least one term of every group."""
    out = F.lit(True)
    for terms in groups:
        out = out & any_term(text, terms)
    return out


def missing(value: Column) -> Column:
    """null, empty, or not_reported."""
    return value.isNull() | value.isin("", "not_reported")


def collapse(text: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def scientific_text(text: Column) -> Column:
    """NFC, minus signs unified, white space collapsed; charges and subscripts stay what they are."""
    return collapse(F.replace(nfc(text), F.lit("−"), F.lit("-")))


def token_key(text: Column) -> Column:
    """Case folded; anything but letters, digits, point, plus, percent and minus is one blank."""
    return F.trim(F.regexp_replace(casefold(text), r"[^a-z0-9.+%-]+", " "))


def tokens(text: Column) -> Column:
    """The different words of ``token_key``."""
    return F.array_distinct(F.filter(F.split(token_key(text), " "), lambda x: x != ""))


def snake(text: Column) -> Column:
    """A label in lower case, its blanks and dashes as one underscore."""
    return F.regexp_replace(casefold(F.regexp_replace(text, r"(?U)^\s+|\s+$", "")), r"(?U)[-\s]+", "_")


def plain_text(html: Column) -> Column:
    """Entities are decoded first, then tags become blanks and white space is collapsed."""
    return collapse(F.regexp_replace(unescape(html), r"<[^>]+>", " "))


def doi(text: Column) -> Column:
    """The first DOI of an HTML text, lower case, without trailing punctuation; null if there is none."""
    found = F.regexp_extract(unescape(text), f"({_DOI})", 1)
    return F.when(found != "", F.lower(F.rtrim(found, F.lit(".,;)"))))


def first_doi(*fields: Column) -> Column:
    """The DOI of the first field that has one."""
    return F.coalesce(*[doi(x) for x in fields])


def identifier(doi_: Column, *others: Column) -> Column:
    """The DOI, else the first field that is not empty, else an empty text."""
    return F.coalesce(doi_, *[F.nullif(x, F.lit("")) for x in others], F.lit(""))


def safe_name(doi_: Column) -> Column:
    """A file name that keeps what can be read of an identifier and tells different ones apart."""
    trim = lambda x: F.trim(x, F.lit(".-"))
    readable = F.coalesce(F.nullif(trim(F.regexp_replace(doi_, r"[^A-Za-z0-9._-]+", "--")), F.lit("")), F.lit("paper"))
    return F.concat(F.rtrim(F.left(readable, F.lit(160)), F.lit(".-")), F.lit("--"), F.left(F.sha2(doi_, 256), F.lit(12)), F.lit(".pdf"))


def publication_date(text: Column) -> Column:
    """The first YYYY-MM-DD that stands alone, as a date; null if absent or no date."""
    return F.try_to_date(F.nullif(F.regexp_extract(text, r"(?U)\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b", 1), F.lit("")), "yyyy-MM-dd")


def numbers(text: Column) -> Column:
    """Sorted array of the numeric tokens of a text, with signs and exponents (a multiset key)."""
    return F.array_sort(F.regexp_extract_all(F.replace(text, F.lit("−"), F.lit("-")), F.lit(_NUMBERS), F.lit(0)))


def same_numbers(left: Column, right: Column) -> Column:
    """Whether two texts hold the same numbers, each as often."""
    return numbers(left) == numbers(right)


def token_estimate(text: Column) -> Column:
    """Upper bound for tokens: a third of the bytes, rounded up, and 64."""
    return F.ceil(F.octet_length(text) / 3) + 64


def block_id(source: Column, page: Column, order: Column, kind: Column, text: Column) -> Column:
    """Source, page, order in four digits or more, kind, and twelve digits of the text's hash."""
    return F.format_string("%s_p%d_%04d_%s_%s", source, page, order, kind, F.left(F.sha2(text, 256), F.lit(12)))


def panel_labels(caption: Column) -> Column:
    """Sorted array of the panels that a caption marks as (a) or b)."""
    both = [F.regexp_extract_all(caption, F.lit(_PANEL), F.lit(i)) for i in (1, 2)]
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.concat(*both), F.lower), lambda x: x != "")))


def layout_text(text: Column) -> Column:
    """Lines with blanks collapsed; empty lines go."""
    lines = F.transform(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), lambda x: F.regexp_replace(F.regexp_replace(x, r"[ \t]+", " "), r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def block_key(text: Column) -> Column:
    """What whole blocks are compared by: line ends and horizontal blanks do not count."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"[ \t]+", " "), r"(?U)^\s+|\s+$", "")


def sample_code(label: Column, variant: Column) -> Column:
    """The compact code of a sample that label and variant name; null if none or several.

    A code is a row of single letters, or holds a digit."""

    def codes(text: Column) -> Column:
        named = F.regexp_extract_all(text, F.lit(rf"(?iU)\b(?:device|sample|cell|specimen|film)\s+({_CODE})\b"), F.lit(1))
        alone = F.when(text.rlike(rf"^(?:{_CODE})$"), F.array(text)).otherwise(F.array().cast("array<string>"))
        return F.concat(named, alone)

    found = F.array_distinct(F.filter(F.concat(*[codes(F.coalesce(x, F.lit(""))) for x in (label, variant)]), lambda x: x.rlike(r"^[A-Za-z](?:[-_/][A-Za-z])*$") | x.rlike("[0-9]")))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def overlap_fraction(first: list[Column], second: list[Column]) -> Column:
    """Share of the rectangle ``first`` (x0, y0, x1, y1) that ``second`` covers; sides count as one at least in its area."""
    zero, one = F.lit(0.0), F.lit(1.0)
    wide = [F.greatest(zero, F.least(first[i + 2], second[i + 2]) - F.greatest(first[i], second[i])) for i in (0, 1)]
    area = [F.greatest(one, first[i + 2] - first[i]) for i in (0, 1)]
    return wide[0] * wide[1] / (area[0] * area[1])


def abstract(index: Column) -> Column:
    """A text from its index (map of word to places): words in order, the first one of a place wins."""
    pairs = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(F.filter(e["value"], lambda p: p >= 0), lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    none = F.struct(F.lit(-1).cast("long").alias("p"), F.array().cast("array<string>").alias("out"))
    step = lambda acc, x: F.struct(x["p"].cast("long").alias("p"), F.when(x["p"] == acc["p"], acc["out"]).otherwise(F.array_append(acc["out"], x["w"])).alias("out"))
    numbered = F.transform(pairs, lambda x, i: F.struct(x["p"].alias("p"), i.alias("i"), x["w"].alias("w")))
    return F.coalesce(F.array_join(F.aggregate(F.array_sort(numbered), none, step, lambda a: a["out"]), " "), F.lit(""))
