"""Registered queries over the driver's tables, each beside SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions import quantities as qt
from lodestone.functions import text as tx
from lodestone.functions import vocabulary as vo
from lodestone.operators import comparison, constraints, linkage, metrics, nested, passages, projections, records, repair, review

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (t), where t(name) reads a table."""

    def add(build: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered already")
        QUERIES[name] = lambda spark, sf_dir: build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return add


def long(column) -> F.Column:
    return (F.col(column) if isinstance(column, str) else column).cast("long")


# ------------------------------------------------------------ filters, predicates
GROUPS = [["the", "und", "les"], ["and", "der", "que"]]
_HAS = "regexp_matches({0}, '(?i)(^|[^\\p{{L}}\\p{{N}}\\p{{M}}_])({1})($|[^\\p{{L}}\\p{{N}}\\p{{M}}_])')"


@query("f04_accepts_term_groups", f"SELECT doc_id FROM documents WHERE {_HAS.format('text', 'the|und|les')} AND {_HAS.format('text', 'and|der|que')}")
def _(t):
    return t("documents").where(tx.accepts(F.col("text"), GROUPS)).select("doc_id")


@query("f03_candidate_any_group", f"SELECT doc_id, {_HAS.format('text', 'was|von')} AS candidate FROM documents")
def _(t):
    return t("documents").select("doc_id", tx.any_term(F.col("text"), ["was", "von"]).alias("candidate"))


@query("f02_excludes_title", f"SELECT page_id FROM pages WHERE {_HAS.format('url', 'wiki|blog|index')}")
def _(t):
    return t("pages").where(tx.any_term(F.col("url"), ["wiki", "blog", "index"])).select("page_id")


_NUMBERS = "list_sort(regexp_extract_all(replace({0}, '−', '-'), '[+-]?(?:[0-9]+(?:\\.[0-9]+)?|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?'))"


@query("f06_same_numbers", f"WITH n AS (SELECT doc_id, {_NUMBERS.format('text')} AS k FROM documents) SELECT array_to_string(k, '|') AS tokens, count(*) AS n FROM n WHERE len(k) > 0 GROUP BY 1")
def _(t):
    return t("documents").select(tx.numbers(F.col("text")).alias("k")).where(F.size("k") > 0).groupBy(F.array_join("k", "|").alias("tokens")).agg(F.count("*").alias("n"))


@query("f15_missing_values", "SELECT event_type, count(*) FILTER (value IS NULL) AS n_missing, count(*) FILTER (event_type IN ('', 'not_reported')) AS n_placeholder, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return t("events").groupBy("event_type").agg(F.count_if(F.col("value").isNull()).alias("n_missing"), F.count_if(tx.missing(F.col("event_type"))).alias("n_placeholder"), F.count("*").alias("n"))


@query("f17_known_material", "SELECT p_partkey, lower(split_part(p_name, ' ', 1)) IN ('gold', 'silver', 'copper', 'nickel') OR split_part(p_name, ' ', 1) IN ('Au', 'Ag', 'Cu', 'Ni', 'glass') AS known FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Gold' WHEN 1 THEN 'nickel layer' WHEN 2 THEN 'Cu' WHEN 3 THEN 'doped gold' ELSE p_name END AS p_name FROM part) WHERE p_name NOT LIKE 'doped%' UNION ALL SELECT p_partkey, false FROM part WHERE p_partkey % 5 = 3")
def _(t):
    name = F.when(F.col("p_partkey") % 5 == 0, "Gold").when(F.col("p_partkey") % 5 == 1, "nickel layer").when(F.col("p_partkey") % 5 == 2, "Cu").when(F.col("p_partkey") % 5 == 3, "doped gold").otherwise(F.col("p_name"))
    return t("part").select("p_partkey", vo.known_material(name).alias("known"))


@query("f27_conservative_relevance", "WITH p AS (SELECT CASE l_linenumber % 4 WHEN 0 THEN 'device_structure' WHEN 1 THEN 'jv' WHEN 2 THEN 'characterization' ELSE 'stability' END AS c, CASE l_returnflag WHEN 'A' THEN 'mixed' WHEN 'R' THEN 'inset_table' ELSE 'plotted_values_only' END AS d FROM lineitem) SELECT c, d, c = 'device_structure' OR (c IN ('jv', 'stability') AND d <> 'plotted_values_only') AS relevant, count(*) AS n FROM p GROUP BY 1, 2, 3")
def _(t):
    kind = F.when(F.col("l_linenumber") % 4 == 0, "device_structure").when(F.col("l_linenumber") % 4 == 1, "jv").when(F.col("l_linenumber") % 4 == 2, "characterization").otherwise("stability")
    shown = F.when(F.col("l_returnflag") == "A", "mixed").when(F.col("l_returnflag") == "R", "inset_table").otherwise("plotted_values_only")
    panels = t("lineitem").select(kind.alias("c"), shown.alias("d"))
    return panels.groupBy("c", "d", projections.schema_relevant(F.col("c"), F.col("d")).alias("relevant")).agg(F.count("*").alias("n"))


@query("f28_caption_panel_labels", r"WITH d AS (SELECT doc_id, regexp_replace('(A) ' || text, '([^\p{L}\p{N}\p{M}_])', '\1\1', 'g') AS t FROM documents), l AS (SELECT doc_id, list_concat(regexp_extract_all(t, '(?i)\(([a-z])\)', 1), regexp_extract_all(t, '(?i)(?:^|[^\p{L}\p{N}\p{M}_])([a-z])\)\)(?:\s|[,:;.])', 1)) AS k FROM d) SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(k, lambda x: lower(x)))), ',') AS labels FROM l")
def _(t):
    return t("documents").select("doc_id", F.array_join(tx.panel_labels(F.concat(F.lit("(A) "), "text")), ",").alias("labels"))


@query("f31_monotonic_quality", "WITH q AS (SELECT l_orderkey, max(l_quantity) FILTER (l_returnflag = 'A') AS a1, max(l_quantity) FILTER (l_returnflag = 'N') AS b1, count(*) FILTER (l_returnflag = 'A') AS a2, count(*) FILTER (l_returnflag = 'N') AS b2, min(l_linenumber) FILTER (l_returnflag = 'A') AS a3, min(l_linenumber) FILTER (l_returnflag = 'N') AS b3, count(*) FILTER (l_returnflag = 'R') AS lost FROM lineitem GROUP BY 1) SELECT l_orderkey, CASE WHEN b1 <= a1 AND b2 <= a2 AND b3 <= a3 AND lost = 0 THEN 'candidate' ELSE 'draft' END AS chosen FROM q")
def _(t):
    def quality(flag: str) -> F.Column:
        own = F.col("l_returnflag") == flag
        return F.struct(F.max(F.when(own, F.col("l_quantity"))).alias("validation_issues"), F.count_if(own).alias("semantic_issues"), F.min(F.when(own, F.col("l_linenumber"))).alias("missing_claims"), F.count_if(F.col("l_returnflag") == "R").alias("lost_verified_values")).alias("quality")

    lines = t("lineitem").groupBy("l_orderkey")
    return repair.choose(lines.agg(quality("A")), lines.agg(quality("N")), ["l_orderkey"])


@query("f32_scoped_patch", "WITH p AS (SELECT l_orderkey AS paper_id, l_returnflag AS kind, l_linenumber::VARCHAR AS record_id FROM lineitem), w AS (SELECT DISTINCT o_orderkey AS paper_id, CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'N' ELSE 'A' END AS kind, o_custkey % 2 = 0 AS unclaimed FROM orders), r AS (SELECT paper_id, kind, '1' AS record_id FROM w) SELECT 'kind is no work' AS issue, count(*) AS n FROM p ANTI JOIN w USING (paper_id, kind) UNION ALL SELECT 'removal not asked for', count(*) FROM r ANTI JOIN (SELECT paper_id, kind FROM w WHERE unclaimed) USING (paper_id, kind) UNION ALL SELECT 'proposed and removed', count(DISTINCT (paper_id, kind, record_id)) FROM p JOIN r USING (paper_id, kind, record_id) UNION ALL SELECT 'repeated id', count(*) FROM (SELECT 1 FROM p GROUP BY paper_id, kind, record_id HAVING count(*) > 1) HAVING count(*) > 0")
def _(t):
    proposed = t("lineitem").select(F.col("l_orderkey").alias("paper_id"), F.col("l_returnflag").alias("kind"), F.col("l_linenumber").cast("string").alias("record_id"))
    kind = F.when(F.col("o_orderstatus") == "F", "R").when(F.col("o_orderstatus") == "O", "N").otherwise("A")
    work = t("orders").select(F.col("o_orderkey").alias("paper_id"), kind.alias("kind"), F.when(F.col("o_custkey") % 2 == 0, "unclaimed_record").otherwise("claim_unmatched").alias("reason"), F.array(F.lit("1")).alias("record_ids"))
    found = repair.scope_issues(proposed, work.select("paper_id", "kind", F.lit("1").alias("record_id")), work)
    return found.groupBy("issue").agg(F.count("*").alias("n"))


# -------------------------------------------------------- projections, unnesting
@query("p16_scalar_items", "SELECT event_id, 'k' AS path, (props::JSON ->> 'k')::BIGINT AS value FROM events WHERE props IS NOT NULL")
def _(t):
    items = t("events").where("props is not null").select("event_id", F.explode(F.from_json("props", "map<string,bigint>")))
    return items.select("event_id", F.col("key").alias("path"), "value")


@query("p28_unique_metric_pivot", "SELECT l_orderkey, CASE WHEN count(*) FILTER (l_returnflag = 'R') = 1 THEN max(l_quantity) FILTER (l_returnflag = 'R') END AS r_quantity, CASE WHEN count(*) FILTER (l_returnflag = 'N') = 1 THEN max(l_quantity) FILTER (l_returnflag = 'N') END AS n_quantity, count(*) AS n_candidates FROM lineitem GROUP BY 1")
def _(t):
    def only(flag: str):
        return F.when(F.count_if(F.col("l_returnflag") == flag) == 1, F.max(F.when(F.col("l_returnflag") == flag, F.col("l_quantity"))))

    return t("lineitem").groupBy("l_orderkey").agg(only("R").alias("r_quantity"), only("N").alias("n_quantity"), F.count("*").alias("n_candidates"))


@query("p04_outcome_context", "SELECT l_orderkey, l_linenumber, o_orderpriority, c_mktsegment, n_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey WHERE l_quantity >= 45")
def _(t):
    rows = t("lineitem").where("l_quantity >= 45").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.join(F.broadcast(t("nation").select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("l_orderkey", "l_linenumber", "o_orderpriority", "c_mktsegment", "n_name")


@query("p46_first_identifier", "SELECT page_id, coalesce(nullif(url, ''), 'page:' || page_id) AS identifier FROM pages")
def _(t):
    return t("pages").select("page_id", F.coalesce(F.nullif("url", F.lit("")), F.concat(F.lit("page:"), F.col("page_id").cast("string"))).alias("identifier"))


# ------------------------------------------------------------- joins, matching
_USES = "SELECT conv_id, list(DISTINCT {{'method': role, 'direction': CASE turn % 3 WHEN 0 THEN 'forward' WHEN 1 THEN 'reverse' END}}) AS u FROM conversations WHERE role <> 'system' AND turn % 2 = {0} GROUP BY 1"


def _uses(t, part: int):
    direction = F.when(F.col("turn") % 3 == 0, "forward").when(F.col("turn") % 3 == 1, "reverse").otherwise("not_reported")
    method = F.when(F.col("role") == "system", "other").otherwise(F.col("role"))
    return linkage.measurement_uses(t("conversations").where(F.col("turn") % 2 == part).select("conv_id", method.alias("m"), direction.alias("d")), ["conv_id"], "m", "d")


@query("j18_subject_measurements", f"WITH a AS ({_USES.format(0)}) SELECT conv_id, array_to_string(list_sort(list_transform(u, lambda x: x.method || ':' || coalesce(x.direction, '-'))), ',') AS uses FROM a")
def _(t):
    return _uses(t, 0).select("conv_id", F.array_join(F.array_sort(F.transform("uses", lambda x: F.concat(x["method"], F.lit(":"), F.coalesce(x["direction"], F.lit("-"))))), ",").alias("uses"))


@query("j17_use_similarity", f"WITH a AS ({_USES.format(0)}), b AS ({_USES.format(1)}), m AS (SELECT a.conv_id, list_distinct(list_transform(a.u, lambda x: x.method)) AS ma, list_distinct(list_transform(b.u, lambda x: x.method)) AS mb, list_filter(a.u, lambda x: x.direction IS NOT NULL) AS k, b.u AS bu FROM a JOIN b USING (conv_id)), d AS (SELECT conv_id, len(list_intersect(ma, mb))::DOUBLE / len(list_distinct(list_concat(ma, mb))) AS o, k, list_filter(bu, lambda x: x.direction IS NOT NULL AND list_contains(list_transform(k, lambda y: y.method), x.method)) AS s FROM m) SELECT conv_id, CASE WHEN len(k) = 0 THEN o ELSE (o + len(list_intersect(k, s))::DOUBLE / len(list_distinct(list_concat(k, s)))) / 2 END AS similarity FROM d")
def _(t):
    both = _uses(t, 0).withColumnRenamed("uses", "a").join(_uses(t, 1).withColumnRenamed("uses", "b"), "conv_id")
    return both.select("conv_id", linkage.use_similarity(F.col("a"), F.col("b")).alias("similarity"))


@query("j27_paired_means", "WITH p AS (SELECT l_orderkey, avg(l_extendedprice) FILTER (l_returnflag = 'R') AS c, avg(l_extendedprice) FILTER (l_returnflag = 'A') AS x FROM lineitem GROUP BY 1) SELECT count(*) AS n_pairs, avg(x - c) AS mean_delta FROM p WHERE c IS NOT NULL AND x IS NOT NULL")
def _(t):
    return linkage.paired_arms(t("lineitem"), ["l_orderkey"], "l_returnflag", "l_extendedprice", "R", "A").agg(F.count("*").alias("n_pairs"), F.avg("delta").alias("mean_delta"))


@query("j31_panel_agreement", "WITH a AS (SELECT doc_id, quality FROM labels), b AS (SELECT doc_id, toxic FROM labels WHERE doc_id % 3 <> 0) SELECT a.quality AS truth, b.toxic AS predicted, count(*) FILTER (a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL) AS matched, count(*) FILTER (b.doc_id IS NULL) AS missed, count(*) FILTER (a.doc_id IS NULL) AS extra FROM a FULL JOIN b ON a.doc_id = b.doc_id GROUP BY 1, 2")
def _(t):
    right = t("labels").where("doc_id % 3 <> 0").select("doc_id", F.col("toxic").alias("quality"))
    return metrics.agreement(t("labels").select("doc_id", "quality"), right, ["doc_id"], "quality")


@query("j22_cited_neighbours", "WITH c AS (SELECT conv_id, turn, role = 'user' AS cited FROM conversations), n AS (SELECT *, coalesce(lag(cited) OVER w, false) OR coalesce(lead(cited) OVER w, false) OR cited AS kept FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn FROM n WHERE kept")
def _(t):
    w = Window.partitionBy("conv_id").orderBy("turn")
    cited = F.col("role") == "user"
    near = cited | F.coalesce(F.lag(cited).over(w), F.lit(False)) | F.coalesce(F.lead(cited).over(w), F.lit(False))
    return t("conversations").withColumn("kept", near).where("kept").select("conv_id", "turn")


@query("j25_constraint_suite", "SELECT 'dangling_order' AS issue, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'dangling_customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'repeated_line', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def _(t):
    a = records.dangling(t("lineitem"), "l_orderkey", t("orders"), "o_orderkey").agg(F.lit("dangling_order").alias("issue"), F.count("*").alias("n"))
    b = records.dangling(t("orders"), "o_custkey", t("customer"), "c_custkey").agg(F.lit("dangling_customer").alias("issue"), F.count("*").alias("n"))
    d = t("lineitem").groupBy("l_orderkey", "l_linenumber").count().where("count > 1").agg(F.lit("repeated_line").alias("issue"), F.count("*").alias("n"))
    return a.union(b).union(d)


@query("j03_one_to_one_assignment")
def _(t):
    docs = t("documents").select("doc_id", "lang", "source", F.split(F.lower("text"), " ").alias("w"))
    a, b = docs.where("floor(doc_id / 20) % 2 = 0"), docs.where("floor(doc_id / 20) % 2 = 1")
    return linkage.set_matches(a, b.withColumnRenamed("doc_id", "other"), ["lang", "source"], "doc_id", "other", "w", 0.05)


@query("j12_ordered_overlap")
def _(t):
    turns = t("conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]).alias("roles"))
    return turns.withColumn("reverse", F.reverse("roles")).select("conv_id", linkage.ordered_overlap("roles", "reverse").alias("overlap"))


# ---------------------------------------------------------------- aggregations
@query("a01_precision_recall", "WITH c AS (SELECT l_returnflag AS k, count(*) AS p, count(*) FILTER (l_quantity > 10) AS t, count(*) FILTER (l_quantity > 25) AS m FROM lineitem GROUP BY 1) SELECT k, p, t, m, m / p AS precision, m / t AS recall, 2 * m / (p + t) AS f1 FROM c")
def _(t):
    counts = t("lineitem").groupBy(F.col("l_returnflag").alias("k")).agg(F.count("*").alias("p"), F.count_if(F.col("l_quantity") > 10).alias("t"), F.count_if(F.col("l_quantity") > 25).alias("m"))
    return metrics.precision_recall(counts, "p", "t", "m")


@query("a04_micro_macro", "WITH c AS (SELECT o_orderpriority, o_orderkey, count(*) AS p, count(*) FILTER (l_quantity > 10) AS t, count(*) FILTER (l_quantity > 25) AS m FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) SELECT o_orderpriority, sum(p)::BIGINT AS p, sum(t)::BIGINT AS t, sum(m)::BIGINT AS m, avg(2 * m / (p + t)) AS macro_f1, count(*) AS n_defined, 2 * sum(m) / (sum(p) + sum(t)) AS micro_f1 FROM c GROUP BY 1")
def _(t):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("p"), F.count_if(F.col("l_quantity") > 10).alias("t"), F.count_if(F.col("l_quantity") > 25).alias("m"))
    return metrics.micro_macro(lines.join(t("orders").select("o_orderkey", "o_orderpriority"), "o_orderkey"), ["o_orderpriority"], "p", "t", "m")


@query("a05_field_totals", "SELECT (props::JSON ->> 'k')::BIGINT AS field, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return t("events").groupBy(F.get_json_object("props", "$.k").cast("long").alias("field")).agg(F.count("*").alias("n"))


@query("a06_score_views", "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS total FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
def _(t):
    return t("lineitem").groupingSets([[F.col("l_returnflag")], [F.col("l_linestatus")], []], F.col("l_returnflag"), F.col("l_linestatus")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"))


@query("a08_multiset_agreement", "WITH x AS (SELECT o_custkey, o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS a, count(*) FILTER (o_orderstatus <> 'F') AS b FROM orders GROUP BY 1, 2), s AS (SELECT o_custkey, sum(least(a, b))::BIGINT AS shared, sum(a)::BIGINT AS n_left, sum(b)::BIGINT AS n_right FROM x GROUP BY 1) SELECT *, shared / greatest(n_left, n_right) AS agreement FROM s")
def _(t):
    o = t("orders")
    return metrics.multiset_agreement(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus <> 'F'"), ["o_custkey"], "o_orderpriority")


@query("a12_known_sums", "WITH v AS (SELECT event_type, CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN NULL ELSE value END AS cost FROM events) SELECT event_type, CASE WHEN count(*) = count(cost) THEN sum(cost) END AS cost, coalesce(sum(cost), 0) AS cost_known, count(*) = count(cost) AS cost_complete FROM v GROUP BY 1")
def _(t):
    usage = t("events").withColumn("cost", F.when(~((F.col("event_type") == "error") & (F.col("event_id") % 7 == 0)), F.col("value")))
    return usage.groupBy("event_type").agg(*metrics.known_sum("cost", "cost"))


@query("a18_verdict_pivot", "SELECT c_mktsegment, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def _(t):
    pivoted = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").pivot("o_orderstatus", ["F", "O", "P"]).count()
    return pivoted.select("c_mktsegment", *[F.coalesce(F.col(x), F.lit(0)).alias(x.lower()) for x in ("F", "O", "P")])


@query("a17_distinct_tuples", "SELECT count(DISTINCT (l_partkey, l_suppkey)) AS n_pairs, count(*) AS n, sum(l_quantity) AS total FROM lineitem")
def _(t):
    return t("lineitem").agg(F.countDistinct("l_partkey", "l_suppkey").alias("n_pairs"), F.count("*").alias("n"), F.sum("l_quantity").alias("total"))


@query("a14_blocker_counts", "SELECT lang, count(*) FILTER (n_chars < 200) AS short, count(*) FILTER (text LIKE '%@%') AS mail, count(*) AS n FROM documents GROUP BY 1")
def _(t):
    return t("documents").groupBy("lang").agg(F.count_if(F.col("n_chars") < 200).alias("short"), F.count_if(F.col("text").contains("@")).alias("mail"), F.count("*").alias("n"))


@query("a20_open_counter", "SELECT source, count(*) AS n FROM documents GROUP BY 1")
def _(t):
    return t("documents").groupBy("source").agg(F.count("*").alias("n"))


@query("a03_bootstrap_interval")
def _(t):
    return comparison.bootstrap(t("orders").groupBy("o_orderpriority", "o_custkey").agg(F.avg("o_totalprice").alias("v")), ["o_orderpriority"], "v", samples=2000, seed=17)


# --------------------------------------------------------------- ordered, windows
@query("w01_contiguous_sections", "WITH n AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS s FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn, (sum(s) OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT AS island FROM n")
def _(t):
    return records.islands(t("conversations"), ["conv_id"], ["turn"], "role").select("conv_id", "turn", "island")


@query("w03_greedy_packing", "WITH RECURSIVE r AS (SELECT conv_id, turn, length(text)::BIGINT AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations), p AS (SELECT conv_id, turn, size, i, size AS used, 0 AS win FROM r WHERE i = 1 UNION ALL SELECT r.conv_id, r.turn, r.size, r.i, CASE WHEN used > 0 AND used + r.size > 400 THEN r.size ELSE used + r.size END, win + CASE WHEN used > 0 AND used + r.size > 400 THEN 1 ELSE 0 END FROM p JOIN r ON r.conv_id = p.conv_id AND r.i = p.i + 1) SELECT conv_id, turn, size, win AS \"window\" FROM p")
def _(t):
    return records.pack(t("conversations").withColumn("size", F.length("text")), ["conv_id"], ["turn"], "size", 400)


@query("w06_exact_cover", "SELECT conv_id, count(*) AS n, count(DISTINCT turn) = count(*) AND max(turn) - min(turn) + 1 = count(*) AS covered FROM conversations GROUP BY 1")
def _(t):
    return t("conversations").groupBy("conv_id").agg(F.count("*").alias("n"), ((F.countDistinct("turn") == F.count("*")) & (F.max("turn") - F.min("turn") + 1 == F.count("*"))).alias("covered"))


@query("w07_number_passages")
def _(t):
    blocks = t("conversations").withColumn("kind", F.when(F.col("role") == "system", "table").otherwise("text"))
    return passages.number_passages(blocks, ["conv_id"], "turn", "turn", "text", "kind").select("conv_id", "span_id", "turn", F.sha2("text", 256).alias("sha"))


@query("w11_total_order", "SELECT conv_id, CASE WHEN count(DISTINCT turn) = count(*) THEN string_agg(role, '>' ORDER BY turn) END AS roles FROM conversations GROUP BY 1")
def _(t):
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ">")
    return t("conversations").groupBy("conv_id").agg(F.when(F.countDistinct("turn") == F.count("*"), ordered).alias("roles"))


# ------------------------------------------------------- samples, rankings, search
@query("t01_top_candidates", "SELECT l_orderkey, l_linenumber, rank FROM (SELECT l_orderkey, l_linenumber, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber))::BIGINT AS rank FROM lineitem) WHERE rank <= 3")
def _(t):
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber")
    return t("lineitem").select("l_orderkey", "l_linenumber", long(F.row_number().over(w)).alias("rank")).where("rank <= 3")


@query("t02_stratified_sample", "WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256(doc_id::VARCHAR), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents) SELECT doc_id, lang, least(1.0, 20 / n) AS probability FROM r WHERE k <= 20")
def _(t):
    docs = t("documents").select("doc_id", "lang", F.sha2(F.col("doc_id").cast("string"), 256).alias("h"))
    w = Window.partitionBy("lang").orderBy("h", "doc_id")
    sizes = docs.groupBy("lang").agg(F.count("*").alias("n"))
    chosen = docs.withColumn("k", F.row_number().over(w)).where("k <= 20")
    return chosen.join(F.broadcast(sizes), "lang").select("doc_id", "lang", F.least(F.lit(1.0), 20 / F.col("n")).alias("probability"))


@query("t04_decision_changes", "SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN 'added' WHEN o_custkey % 7 = 0 THEN 'removed' ELSE 'changed' END AS change FROM orders WHERE (o_custkey % 5 = 0 OR o_custkey % 7 = 0 OR o_orderstatus = 'P') AND NOT (o_custkey % 5 = 0 AND o_custkey % 7 = 0)")
def _(t):
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    before = orders.where("o_custkey % 5 <> 0").select("o_orderkey", F.col("o_orderstatus").alias("x"))
    after = orders.where("o_custkey % 7 <> 0").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")).alias("x"))
    return records.changes(before, after, ["o_orderkey"], ["x"])


@query("t05_search_blocks", "SELECT doc_id FROM documents WHERE contains(lower(text), 'the the') ORDER BY doc_id LIMIT 100")
def _(t):
    return t("documents").where(F.lower("text").contains("the the")).select("doc_id").orderBy("doc_id").limit(100)


# ------------------------------------------------------ duplicates, merges, diffs
@query("o01_block_duplicates", r"WITH d AS (SELECT lang, doc_id, doc_id % 3 = 0 AS main, regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS k FROM documents), m AS (SELECT lang, k, max(doc_id) AS keeper FROM d WHERE main AND length(k) > 40 GROUP BY 1, 2), g AS (SELECT d.lang, d.doc_id, keeper FROM d JOIN m USING (lang, k) WHERE NOT main) SELECT d.doc_id, count(g.doc_id) AS n_left_out FROM d LEFT JOIN g ON g.keeper = d.doc_id AND g.lang = d.lang WHERE d.doc_id NOT IN (SELECT doc_id FROM g) GROUP BY 1")
def _(t):
    blocks = t("documents").select("lang", "doc_id", "text", F.when(F.col("doc_id") % 3 == 0, "main").otherwise("si").alias("from"), (F.col("doc_id") % 7).alias("page"), F.col("doc_id").alias("order"))
    kept = passages.drop_repeated_supplement(blocks, ["lang"], "from", "text", "doc_id", "page", "order")
    return kept.select("doc_id", F.coalesce(F.size("duplicate_locations"), F.lit(0)).cast("long").alias("n_left_out"))


@query("o05_merge_records", "SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses, bool_or(o_totalprice > 400000) AS curated, count(*) AS n_records FROM orders GROUP BY 1")
def _(t):
    rows = t("orders").withColumn("curated", F.col("o_totalprice") > 400000)
    merged = records.merge_records(rows, ["o_custkey"], [F.col("o_orderkey")], first=["o_orderpriority"], union=["o_orderstatus"], either=["curated"])
    return merged.select("o_custkey", "o_orderpriority", F.array_join("o_orderstatus", ",").alias("statuses"), "curated", "n_records")


@query("o12_exact_duplicates", "SELECT min(p_partkey) AS first_key, count(*) AS n, array_to_string(list_sort(list(p_partkey)), ',') AS keys FROM part GROUP BY p_brand, p_type, p_size HAVING count(*) > 1")
def _(t):
    return records.duplicates(t("part"), ["p_brand", "p_type", "p_size"], "p_partkey").select("first_key", "n", F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("keys"))


@query("o13_duplicate_ids", "SELECT l_suppkey AS paper_id, l_returnflag AS kind, l_partkey::VARCHAR AS record_id, count(*) AS n FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1")
def _(t):
    rows = t("lineitem").select(F.col("l_suppkey").alias("paper_id"), F.col("l_returnflag").alias("kind"), F.col("l_partkey").cast("string").alias("record_id"))
    return constraints.repeated_ids(rows, ["paper_id"])


@query("o15_upsert", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, 0.0 FROM orders WHERE o_orderstatus = 'P'")
def _(t):
    current = t("orders").select("o_orderkey", "o_totalprice")
    return records.upsert(current, t("orders").where("o_orderstatus = 'P'").select("o_orderkey", F.lit(0.0).alias("o_totalprice")), ["o_orderkey"])


@query("o17_worklist", "WITH g AS (SELECT o_custkey AS paper_id, CASE WHEN o_orderstatus = 'P' THEN 'unclaimed_record' WHEN o_totalprice > 300000 THEN 'shared_quantity_scope' ELSE 'claim_unmatched' END AS reason, o_orderkey, o_clerk FROM (SELECT *, substr(o_orderpriority, 1, 1) AS o_clerk FROM orders) WHERE o_orderstatus <> 'F') SELECT paper_id, reason, o_clerk AS detail, count(*) AS n_same, max(o_orderkey)::VARCHAR AS block FROM g GROUP BY 1, 2, 3")
def _(t):
    status = F.when(F.col("o_orderstatus") == "P", "unclaimed").when(F.col("o_orderstatus") == "F", "covered").otherwise("unmatched")
    gaps = t("orders").select(F.col("o_custkey").alias("paper_id"), F.col("o_orderkey").alias("ordinal"), status.alias("status"), F.lit("order").alias("kind"), F.array(F.lit("x")).alias("record_ids"), F.array(F.col("o_orderkey").cast("string")).alias("block_ids"), F.substring("o_orderpriority", 1, 1).alias("label"), (F.col("o_totalprice") > 300000).alias("has_missing_targets"))
    none = gaps.limit(0).select("paper_id", "ordinal", "kind", F.lit("").alias("record_id"), "block_ids", F.lit("").alias("path"), F.lit("").alias("reason"))
    work = repair.worklist(gaps, none).select("paper_id", "reason", "detail", F.get("block_ids", F.lit(0)).alias("block"))
    why = F.when(F.col("status") == "unclaimed", "unclaimed_record").when(F.col("has_missing_targets"), "shared_quantity_scope").otherwise("claim_unmatched")
    sizes = gaps.where("status <> 'covered'").groupBy("paper_id", why.alias("reason"), F.col("label").alias("detail")).agg(F.count("*").alias("n_same"))
    return work.join(sizes, ["paper_id", "reason", "detail"])


# ----------------------------------------------------------------- text, numbers
@query("x01_scientific_text", r"SELECT doc_id, sha256(trim(regexp_replace(replace(nfc_normalize(text), '−', '-'), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))) AS sha FROM documents")
def _(t):
    return t("documents").select("doc_id", F.sha2(tx.scientific_text(F.col("text")), 256).alias("sha"))


@query("x03_token_key", "SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9.+%-]+', ' ', 'g')) AS key FROM part")
def _(t):
    return t("part").select("p_partkey", tx.token_key(F.col("p_name")).alias("key"))


@query("x10_snake_label", r"SELECT p_partkey, regexp_replace(lower(trim(p_type || ' (x-1) ')), '[-\s]+', '_', 'g') AS label FROM part")
def _(t):
    return t("part").select("p_partkey", tx.snake(F.concat("p_type", F.lit(" (x-1) "))).alias("label"))


@query("x05_jaccard", "WITH w AS (SELECT p_partkey, list_distinct(string_split(p_name, ' ')) AS a, list_distinct(string_split(p_type, ' ')) AS b FROM part) SELECT p_partkey, len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))) AS similarity FROM w")
def _(t):
    return t("part").select("p_partkey", linkage.jaccard(F.array_distinct(F.split("p_name", " ")), F.array_distinct(F.split("p_type", " "))).cast("double").alias("similarity"))


@query("x12_block_id", "SELECT conv_id, turn, role || '_p' || conv_id || '_' || CASE WHEN turn * 997 < 10000 THEN lpad((turn * 997)::VARCHAR, 4, '0') ELSE (turn * 997)::VARCHAR END || '_turn_' || left(sha256(text), 12) AS block_id FROM conversations")
def _(t):
    return t("conversations").select("conv_id", "turn", tx.block_id(F.col("role"), F.col("conv_id"), F.col("turn") * 997, F.lit("turn"), F.col("text")).alias("block_id"))


@query("x13_extract_doi", r"SELECT page_id, lower(rtrim(nullif(regexp_extract(replace(html || ' doi 10.1000/Page.' || page_id || '&amp;x).', '&amp;', '&'), '(?i)10\.[0-9]{4,9}/[-._;()/:A-Z0-9]+'), ''), '.,;)')) AS doi FROM pages")
def _(t):
    return t("pages").select("page_id", tx.doi(F.concat("html", F.lit(" doi 10.1000/Page."), F.col("page_id").cast("string"), F.lit("&amp;x)."))).alias("doi"))


@query("x14_plain_text", "SELECT page_id, sha256(trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(html || '&lt;i&gt;x &amp;lt;', '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&nbsp;', chr(160)), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&'), '<[^>]+>', ' ', 'g'), '[\\s\\x{A0}]+', ' ', 'g'))) AS sha FROM pages")
def _(t):
    return t("pages").select("page_id", F.sha2(tx.plain_text(F.concat("html", F.lit("&lt;i&gt;x &amp;lt;"))), 256).alias("sha"))


@query("d01_publication_date", r"SELECT o_orderkey, try_cast(nullif(regexp_extract('v2' || strftime(o_orderdate, '%Y-%m-%d') || '1 on ' || strftime(o_orderdate, '%Y-%m-%d') || ', at', '\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b', 1), '') AS DATE)::VARCHAR AS day FROM orders")
def _(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t("orders").select("o_orderkey", tx.publication_date(F.concat(F.lit("v2"), day, F.lit("1 on "), day, F.lit(", at"))).cast("string").alias("day"))


@query("d04_content_digest", "SELECT event_id, sha256('{\"k\":' || (props::JSON ->> 'k') || '}' || chr(10)) AS digest FROM events WHERE props IS NOT NULL")
def _(t):
    return t("events").where("props is not null").select("event_id", nested.content_digest(F.col("props"), end="\n").alias("digest"))


@query("n14_token_estimate", "SELECT conv_id, sum(ceil(octet_length(encode(text)) / 3) + 64)::BIGINT AS tokens FROM conversations GROUP BY 1")
def _(t):
    return t("conversations").groupBy("conv_id").agg(F.sum(tx.token_estimate(F.col("text"))).alias("tokens"))


@query("n02_finite_number", "WITH r AS (SELECT o_orderkey, (o_custkey % 97)::VARCHAR || 'e' || (o_orderkey % 700 - 350)::VARCHAR AS raw FROM orders), n AS (SELECT *, TRY_CAST(raw AS DOUBLE) AS v FROM r) SELECT o_orderkey, CASE WHEN isfinite(v) AND NOT (v = 0 AND regexp_matches(split_part(raw, 'e', 1), '[1-9]')) THEN v END AS number FROM n")
def _(t):
    raw = F.concat((F.col("o_custkey") % 97).cast("string"), F.lit("e"), (F.col("o_orderkey") % 700 - 350).cast("string"))
    return t("orders").select("o_orderkey", qt.finite_number(raw).alias("number"))


@query("n05_equal_claims", "SELECT l_returnflag, count(*) FILTER (abs(x - p_retailprice) <= greatest(0.05 * greatest(abs(x), abs(p_retailprice)), 1.0)) AS n_equal, count(*) AS n FROM (SELECT l_returnflag, l_partkey, l_extendedprice / l_quantity AS x FROM lineitem) JOIN part ON l_partkey = p_partkey GROUP BY 1")
def _(t):
    lines = t("lineitem").select("l_returnflag", F.col("l_partkey").alias("p_partkey"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("x"))
    same = qt.close(F.col("x"), F.col("p_retailprice"), 0.05, 1.0)
    return lines.join(t("part").select("p_partkey", "p_retailprice"), "p_partkey").groupBy("l_returnflag").agg(F.count_if(same).alias("n_equal"), F.count("*").alias("n"))


# ------------------------------------------------------------------- event logs
_LOG = "WITH e AS (SELECT user_id AS paper_id, row_number() OVER w AS revision, event_id, 'r' || event_id % 2 AS reviewer_id, CASE event_type WHEN 'signup' THEN 'review_reset' WHEN 'error' THEN 'undo' WHEN 'view' THEN 'stage_complete' ELSE 'record_decision' END AS kind, CASE WHEN event_type = 'error' THEN lag(event_id, 2) OVER w END AS undoes, event_id % 5 AS record_key, event_id % 3 AS record_digest, event_type AS decision FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), l AS (SELECT e.* FROM e WHERE NOT EXISTS (SELECT 1 FROM e u WHERE u.paper_id = e.paper_id AND u.undoes = e.event_id)), r AS (SELECT paper_id, reviewer_id, max(revision) AS reset FROM l WHERE kind = 'review_reset' GROUP BY 1, 2), s AS (SELECT l.* FROM l LEFT JOIN r USING (paper_id, reviewer_id) WHERE kind <> 'review_reset' AND revision > coalesce(reset, -1))"


def _log(t):
    """The events table as a review log: every error undoes the event two before it."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    kind = F.when(F.col("event_type") == "signup", "review_reset").when(F.col("event_type") == "error", "undo").when(F.col("event_type") == "view", "stage_complete").otherwise("record_decision")
    return t("events").select(
        F.col("user_id").alias("paper_id"), long(F.row_number().over(w)).alias("revision"), "event_id", F.concat(F.lit("r"), (F.col("event_id") % 2).cast("string")).alias("reviewer_id"), kind.alias("kind"),
        F.when(F.col("event_type") == "error", F.lag("event_id", 2).over(w)).alias("undoes"), (F.col("event_id") % 5).alias("record_key"), (F.col("event_id") % 3).alias("record_digest"), F.col("event_type").alias("decision"), F.col("event_type").alias("stage"),
    )


def _catalog(t):
    """(paper_id, record_key, digest): five records a user, whose content has the digest 1 or 2."""
    keys = t("events").select(F.col("user_id").alias("paper_id")).distinct().select("paper_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("record_key"))
    return keys.withColumn("digest", 1 + F.col("record_key") % 2)


@query("p24_event_rows_undone", _LOG + " SELECT event_id, EXISTS (SELECT 1 FROM e u WHERE u.paper_id = e.paper_id AND u.undoes = e.event_id) AS is_undone FROM e")
def _(t):
    return review.marked_undone(_log(t)).select("event_id", "is_undone")


@query("z11_current_decisions", _LOG + " SELECT paper_id, reviewer_id, record_key, arg_max(decision, (revision, event_id)) AS decision FROM s WHERE kind = 'record_decision' AND record_digest = 1 + record_key % 2 GROUP BY 1, 2, 3")
def _(t):
    return review.current_decisions(_log(t), _catalog(t)).select("paper_id", "reviewer_id", "record_key", "decision")


@query("z12_badge_events", _LOG + " SELECT DISTINCT paper_id, reviewer_id, event_id FROM (SELECT paper_id, reviewer_id, arg_max(event_id, (revision, event_id)) AS event_id FROM s WHERE kind = 'record_decision' AND record_digest = 1 + record_key % 2 GROUP BY paper_id, reviewer_id, record_key UNION ALL SELECT paper_id, reviewer_id, arg_max(event_id, (revision, event_id)) FROM s WHERE kind = 'stage_complete' GROUP BY 1, 2)")
def _(t):
    return review.badge_events(_log(t), _catalog(t))


@query("w15_last_review", _LOG + " SELECT paper_id, reviewer_id, max(revision) AS revision FROM s WHERE undoes IS NULL AND kind = 'record_decision' GROUP BY 1, 2")
def _(t):
    return review.last_review(_log(t)).select("paper_id", "reviewer_id", "revision")


@query("a19_reviewer_progress", _LOG + " , d AS (SELECT reviewer_id, paper_id, count(DISTINCT record_key) AS n FROM s WHERE kind = 'record_decision' AND record_digest = 1 + record_key % 2 GROUP BY 1, 2), g AS (SELECT DISTINCT reviewer_id, paper_id FROM s WHERE kind = 'stage_complete') SELECT reviewer_id, (SELECT count(*) FROM (SELECT paper_id FROM d WHERE d.reviewer_id = x.reviewer_id UNION SELECT paper_id FROM g WHERE g.reviewer_id = x.reviewer_id)) AS n_papers, (SELECT sum(n) FROM d WHERE d.reviewer_id = x.reviewer_id)::BIGINT AS n_decisions, (SELECT count(*) FROM g WHERE g.reviewer_id = x.reviewer_id) AS n_stages FROM (SELECT DISTINCT reviewer_id FROM s WHERE kind IN ('record_decision', 'stage_complete')) x")
def _(t):
    return review.progress(_log(t), _catalog(t)).select("reviewer_id", long("n_papers").alias("n_papers"), "n_decisions", "n_stages")


@query("y09_paper_summaries", _LOG + " SELECT p.paper_id, 5::BIGINT AS n_records, count(DISTINCT record_key) FILTER (kind = 'record_decision' AND record_digest = 1 + record_key % 2) AS n_decided FROM (SELECT DISTINCT paper_id FROM e) p LEFT JOIN s USING (paper_id) GROUP BY 1")
def _(t):
    return review.summaries(_log(t), _catalog(t), _log(t)).select("paper_id", "n_records", "n_decided")


@query("v18_history_issues", "WITH h AS (SELECT user_id AS paper_id, count(*) - CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END AS revision, count(*) AS n FROM events GROUP BY 1) SELECT paper_id, revision, n AS expected FROM h WHERE revision <> n")
def _(t):
    log = _log(t)
    heads = log.groupBy("paper_id").agg(F.max("revision").alias("n")).select("paper_id", (F.col("n") - F.when(F.col("paper_id") % 4 == 0, 1).otherwise(0)).alias("revision"))
    return review.history_issues(log, heads)


@query("z09_event_sequence", "SELECT event_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id))::BIGINT AS sequence FROM events")
def _(t):
    return review.sequenced(t("events"), ["user_id"], ["ts", "event_id"]).select("event_id", "sequence")


@query("z10_stage_spans", "SELECT user_id, props::JSON ->> 'k' AS span, strftime(min(ts) FILTER (event_type = 'click'), '%Y-%m-%d %H:%M:%S') AS started, round(epoch(max(ts) FILTER (event_type = 'purchase')) - epoch(min(ts) FILTER (event_type = 'click')), 3) AS seconds FROM events GROUP BY 1, 2 HAVING count(*) FILTER (event_type = 'click') > 0")
def _(t):
    rows = t("events").withColumn("span", F.get_json_object("props", "$.k"))
    spans = review.stage_spans(rows, ["user_id"], "span", "event_type", F.col("ts"), "click", "purchase")
    return spans.select("user_id", "span", F.date_format("started", "yyyy-MM-dd HH:mm:ss").alias("started"), F.round("seconds", 3).alias("seconds"))


@query("v02_rates_follow_counts", "WITH c AS (SELECT o_custkey, count(*) AS predicted, count(*) FILTER (o_totalprice > 100000) + o_custkey % 2 AS truth, count(*) FILTER (o_totalprice > 200000) + o_custkey % 3 AS matched FROM orders GROUP BY 1) SELECT o_custkey, 'more matches than facts' AS issue FROM c WHERE NOT (matched <= predicted AND matched <= truth) UNION ALL SELECT o_custkey, 'recall is not that of the counts' FROM c WHERE o_custkey % 5 = 0 AND truth > 0")
def _(t):
    counts = t("orders").groupBy("o_custkey").agg(F.count("*").alias("predicted"), (F.count_if(F.col("o_totalprice") > 100000) + F.col("o_custkey") % 2).alias("truth"), (F.count_if(F.col("o_totalprice") > 200000) + F.col("o_custkey") % 3).alias("matched"))
    stored = metrics.precision_recall(counts, "predicted", "truth", "matched").withColumn("recall", F.when(F.col("o_custkey") % 5 == 0, F.col("recall") + 1).otherwise(F.col("recall")))
    return constraints.rates_follow_counts(stored, ["o_custkey"])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro and macro agreement of lines by order priority."""
    return QUERIES["a04_micro_macro"](spark, sf_dir)
