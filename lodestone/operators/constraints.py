"""Constraints as rows: each function gives the records that break a rule, and why."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as tx
from lodestone.operators import metrics


def broken(df: DataFrame, by: list[str], rules: dict[str, Column]) -> DataFrame:
    """(by, issue): a row for each rule of each record that is not true; unknown counts as broken."""
    found = F.filter(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()]), lambda x: x.isNotNull())
    return df.select(*by, F.explode(found).alias("issue"))


def rates_follow_counts(df: DataFrame, by: list[str], places: float = 1e-9) -> DataFrame:
    """Rows whose precision, recall and f1 are not those of predicted, truth and matched, or with more matches than either."""
    own = metrics.precision_recall(df.select(*by, "predicted", "truth", "matched", *[F.col(x).alias(f"_{x}") for x in ("precision", "recall", "f1")]), "predicted", "truth", "matched")
    same = lambda x: (F.col(x).isNull() & F.col(f"_{x}").isNull()) | F.coalesce(F.abs(F.col(x) - F.col(f"_{x}")) <= places, F.lit(False))
    return broken(own, by, {"more matches than facts": (F.col("matched") <= F.col("predicted")) & (F.col("matched") <= F.col("truth")), **{f"{x} is not that of the counts": same(x) for x in ("precision", "recall", "f1")}})


def exact_cover(inventory: DataFrame, used: DataFrame, key: list[str]) -> DataFrame:
    """(key, issue): entries of the inventory that are used not once, and used ones that it lacks."""
    a = inventory.groupBy(*key).agg(F.count("*").alias("_a"))
    b = used.groupBy(*key).agg(F.count("*").alias("_b"))
    issue = F.when(F.col("_a").isNull(), "unknown").when(F.col("_b").isNull(), "unused").when(F.col("_b") > 1, "used more than once").when(F.col("_a") > 1, "repeated in the inventory")
    return a.join(b, key, "full_outer").select(*key, issue.alias("issue")).where("issue is not null")


def same_inventory(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """(key, side): entries that only one of two views has, each as often as it has more of them."""
    a, b = left.select(*key), right.select(*key)
    return a.exceptAll(b).withColumn("side", F.lit("left")).union(b.exceptAll(a).withColumn("side", F.lit("right")))


def chained_aliases(aliases: DataFrame) -> DataFrame:
    """(alias, target) of aliases that stand for themselves, for another alias, or for two targets. Texts are folded."""
    own = aliases.select(tx.casefold(tx.scientific_text(F.col("alias"))).alias("alias"), tx.casefold(tx.scientific_text(F.col("target"))).alias("target"))
    keys = own.select(F.col("alias").alias("target")).distinct()
    several = own.groupBy("alias").agg(F.countDistinct("target").alias("n")).where("n > 1").select("alias")
    return own.join(keys, "target", "left_semi").select("alias", "target").union(own.join(several, "alias", "left_semi").select("alias", "target")).distinct()


def overlapping_rules(rules: DataFrame, by: list[str], members: str) -> DataFrame:
    """(by, member): members that stand in several equivalence rules of one scope."""
    return rules.select(*by, F.monotonically_increasing_id().alias("_r"), F.explode(F.array_distinct(members)).alias("member")).groupBy(*by, "member").agg(F.count("*").alias("n")).where("n > 1").drop("n")


def link_issues(tests: DataFrame, by: list[str]) -> DataFrame:
    """Tests whose link_status does not fit their ids: linked ones have a family or device, others none."""
    some = F.col("family_id").isNotNull() | F.col("device_id").isNotNull()
    return broken(tests, by, {"link status and ids disagree": F.when(F.col("link_status") == "linked", some).otherwise(~some)})


def champion_issues(devices: DataFrame, by: list[str]) -> DataFrame:
    """Devices flagged as champion without that selection basis, or the reverse."""
    return broken(devices, by, {"champion flag and selection basis disagree": (F.col("champion_status") == "yes") == (F.col("selection_basis") == "champion")})


def form_issues(layers: DataFrame, by: list[str]) -> DataFrame:
    """Layers with a normalised form but no text for it, or the reverse."""
    return broken(layers, by, {"form and its text disagree": (F.col("material_form") != "not_reported") == F.col("material_form_raw").isNotNull()})


def scoped_absorbers(families: DataFrame) -> DataFrame:
    """``families`` with absorbers: of records that hold absorber_formula, absorber_properties and
    absorber_constituents instead, one absorber with all of them, in the sole absorber layer if there is
    one, with the first 15 different citations of its claims (else of the family)."""
    citation = "array<struct<block_id:string,quote:string>>"
    none = F.array().cast(citation)
    each = lambda x: F.coalesce(F.flatten(F.transform(x, lambda v: F.coalesce(v["evidence"], none))), none)
    old = F.col("absorber_formula").isNotNull() | (F.coalesce(F.size("absorber_properties"), F.lit(0)) > 0) | (F.coalesce(F.size("absorber_constituents"), F.lit(0)) > 0)
    cited = F.array_distinct(F.concat(F.coalesce("absorber_formula.evidence", none), each("absorber_properties"), each("absorber_constituents")))
    cited = F.slice(F.when(F.size(cited) > 0, cited).otherwise(F.array_distinct(F.coalesce("evidence", none))), 1, 15)
    layers = F.filter("layers", lambda x: x["role"] == "absorber")
    layer = F.when(F.size(layers) == 1, F.get(layers, F.lit(0)))
    one = F.array(F.struct(
        F.concat(F.left("family_id", F.lit(188)), F.lit("-absorber-1")).alias("absorber_id"), layer["layer_id"].alias("layer_id"), F.coalesce(layer["material"], F.lit("Unscoped absorber")).alias("label"),
        F.col("absorber_formula").alias("formula"), F.col("absorber_properties").alias("properties"), F.col("absorber_constituents").alias("constituents"), cited.alias("evidence"),
    ))
    return families.withColumn("absorbers", F.when(old, one).otherwise(F.slice(one, 1, 0))).drop("absorber_formula", "absorber_properties", "absorber_constituents")


def sources_of(sources: Column, source_feed: Column) -> Column:
    """The list of sources; of older records the one source that they name."""
    return F.coalesce(sources, F.when(source_feed.isNotNull(), F.array(source_feed)), F.array().cast("array<string>"))


def roster_issue(releases: DataFrame, papers: DataFrame) -> DataFrame:
    """(release, paper_count, found) of releases whose paper_count is not that of their different papers, or whose papers repeat."""
    held = papers.groupBy("release").agg(F.countDistinct("paper_id").alias("found"), (F.count("*") > F.countDistinct("paper_id")).alias("_twice"))
    both = releases.join(held, "release", "left").fillna(0, ["found"])
    return both.where((F.col("paper_count") != F.col("found")) | F.coalesce("_twice", F.lit(False))).select("release", "paper_count", "found")


def term_groups(groups: Column) -> Column:
    """Groups of terms, trimmed, each term once; null if there is no group or an empty one."""
    clean = F.transform(groups, lambda g: F.array_distinct(F.filter(F.transform(g, lambda x: F.trim(x)), lambda x: x != "")))
    return F.when((F.size(clean) > 0) & ~F.exists(clean, lambda g: F.size(g) == 0), clean)


def panel_key(paper: Column, figure: Column, panel: Column) -> Column:
    """The composite key of a figure's panel: case and blanks around do not count."""
    fold = lambda x: F.coalesce(tx.casefold(F.trim(x)), F.lit(""))
    return F.struct(paper.alias("paper_id"), fold(figure).alias("figure"), fold(panel).alias("panel"))


def panel_issues(rows: DataFrame, paper: str, figure: str, panel: str) -> DataFrame:
    """(key, issue): panels without a figure, and keys that repeat."""
    keyed = rows.select(panel_key(F.col(paper), F.col(figure), F.col(panel)).alias("key"))
    return keyed.where("key.figure = ''").select("key", F.lit("no figure").alias("issue")).union(keyed.groupBy("key").count().where("count > 1").select("key", F.lit("repeated").alias("issue")))


def count_issues(df: DataFrame, by: list[str], parts: dict[str, str]) -> DataFrame:
    """Rows whose counts are negative or whose parts are above their wholes (part -> whole)."""
    rules = {f"{part} above {whole}": (F.col(part) >= 0) & (F.col(part) <= F.col(whole)) for part, whole in parts.items()}
    return broken(df, by, rules)


def loss_counts(panels: DataFrame, by: list[str], relevant: str, counts: list[str]) -> DataFrame:
    """(by, counts): sums over the panels that belong to the schema; the others add nothing."""
    return panels.groupBy(*by).agg(*[F.sum(F.when(F.coalesce(F.col(relevant), F.lit(False)), F.coalesce(F.col(x), F.lit(0))).otherwise(0)).alias(x) for x in counts])


def new_issues(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Issues that an edit adds."""
    return after.select(*key).exceptAll(before.select(*key))


def request_issues(tokens: Column, reserved: Column, most_input: Column, context: Column) -> Column:
    """Array of the limits that a request breaks: input tokens, and input with the reserved output."""
    over = F.array(F.when(tokens > most_input, "input tokens above the limit"), F.when(tokens + reserved > context, "input and output above the context"))
    return F.filter(over, lambda x: x.isNotNull())


def repeated_ids(records: DataFrame, by: list[str]) -> DataFrame:
    """(by, kind, record_id, n): ids that stand more than once in a kind of records."""
    return records.groupBy(*by, "kind", "record_id").agg(F.count("*").alias("n")).where("n > 1")


def suite(*checks: tuple[str, DataFrame]) -> DataFrame:
    """(check, n): how many rows each check found, checks without any included."""
    return reduce(DataFrame.union, [df.agg(F.lit(name).alias("check"), F.count("*").alias("n")) for name, df in checks])
