"""Registered queries of the pairing of records, of copies of facts, of published revisions and of discovery runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import quantities as qt
from lodestone.operators import facts, merging, pairing
from lodestone.plans.registry import query
from lodestone.sources import feeds, revisions, shared


def _studies(orders: DataFrame) -> DataFrame:
    """A paper for each customer: the orders as devices with an observation each, their states as families; the
    prediction leaves things out, changes them, or names another sample (which nobody measured)."""
    key = F.col("o_orderkey")
    out = []
    for side in ("truth", "prediction"):
        told = side == "truth"

        def lost(k: int, column, value=None, told=told):
            return column if told else F.when(key % k != 0, column).otherwise(value)

        price = F.when(F.lit(told), F.col("o_totalprice")).otherwise(F.col("o_totalprice") * F.when(key % 11 == 0, 2.0).otherwise(1.005))
        champion = F.when((F.col("o_orderstatus") == "F") != (F.lit(not told) & (key % 5 == 0)), "yes").otherwise("no")
        device = F.struct(
            key.cast("string").alias("device_id"), lost(7, F.col("o_orderstatus")).alias("family_id"), F.concat(F.lit("Cell "), F.when(F.lit(not told) & (key % 13 == 0), "X").otherwise(""), key.cast("string")).alias("label"),
            lost(3, F.concat(F.lit("arm "), F.col("o_orderpriority"))).alias("variant"), champion.alias("champion_status"),
        )
        measured = F.struct(
            key.cast("string").alias("observation_id"), key.cast("string").alias("device_id"), F.lit("jv_scan").alias("measurement_type"), lost(2, F.lit("reverse"), F.lit("not_reported")).alias("scan_direction"),
            F.array(F.struct(F.lit("scan rate").alias("name"), F.concat(price.cast("string"), F.lit(" mV/s")).alias("raw_value"), price.alias("value_number"), F.lit("mV/s").alias("unit"))).alias("measurement_conditions"),
        )
        variant = F.concat(F.lit("arm "), F.col("o_orderstatus"))
        family = F.struct(F.col("o_orderstatus").alias("family_id"), F.lit("Design").alias("label"), F.concat(F.lit("stack "), F.col("o_orderstatus")).alias("full_stack_raw"), (variant if told else F.when(F.col("o_custkey") % 4 != 0, variant)).alias("variant"))
        rows = orders.groupBy("o_custkey").agg(F.collect_set(family).alias("device_families"), F.collect_list(device).alias("individual_devices"), F.collect_list(F.when(key % 13 != 0, measured)).alias("performance_observations"))
        out.append(rows.select(F.col("o_custkey").cast("string").alias("paper_id"), F.lit(side).alias("side"), F.to_json(F.struct("device_families", "individual_devices", "performance_observations")).alias("document")))
    return facts.read_studies(out[0].union(out[1]))


_PAIRS = """
WITH o AS (SELECT o_custkey::VARCHAR AS paper_id, o_custkey AS c, o_orderkey AS k, o_orderstatus AS s FROM orders),
f AS (SELECT DISTINCT paper_id, 'device_families' AS kind, s AS id, CASE WHEN c % 4 = 0 THEN 3 / 5 ELSE 1.0 END AS x FROM o),
d AS (SELECT paper_id, k, 2 + (k % 3 <> 0)::INT + (k % 5 <> 0)::INT AS shared, 3 + (k % 3 <> 0)::INT AS theirs FROM o WHERE k % 13 <> 0),
e AS (SELECT paper_id, 'individual_devices' AS kind, k::VARCHAR AS id, CASE WHEN k % 7 <> 0 THEN ((shared / (4 + theirs - shared) + 1) / 2 + CASE WHEN k % 2 = 0 THEN 0.5 ELSE 1 END) / 2 ELSE shared / (4 + theirs - shared) END AS x FROM d),
m AS (SELECT paper_id, 'performance_observations' AS kind, k::VARCHAR AS id, ((CASE WHEN k % 2 = 0 THEN 2 ELSE 3 END + (k % 11 <> 0)::INT) / (3 + CASE WHEN k % 11 <> 0 THEN 1 ELSE 2 END) + 1) / 2 AS x FROM o WHERE k % 13 <> 0)
SELECT paper_id, kind, id AS truth_id, id AS prediction_id, round(x, 9)::DOUBLE AS similarity, false AS ambiguous FROM (FROM f UNION ALL FROM e UNION ALL FROM m)"""


@query("j04_record_pairs", _PAIRS)
def _(t):
    orders = t("orders")
    found = pairing.record_pairs(_studies(orders), shared.folder(orders.sparkSession))
    return found.withColumn("similarity", F.round("similarity", 9))


@query("j05_relationships", "WITH k AS (SELECT o_custkey::VARCHAR AS paper_id, o_orderkey AS k FROM orders WHERE o_orderkey % 13 <> 0) SELECT paper_id, 'individual_devices' AS kind, count(*) AS compared, count(*) FILTER (k % 7 <> 0) AS agreed FROM k GROUP BY 1 UNION ALL SELECT paper_id, 'performance_observations', count(*), count(*) FROM k GROUP BY 1")
def _(t):
    orders = t("orders")
    spark, place = orders.sparkSession, shared.folder(orders.sparkSession)
    own = shared.written(pairing.records(shared.written(shared.spread(_studies(orders), "paper_id", "side"), f"{place}/studies")), f"{place}/records")
    return pairing.relationships(own, pairing.paired(own, shared.folder(spark)))


@query("k12_published_revisions", "SELECT 1 AS revision, o_orderstatus AS state, count(*) AS n, 'kept' AS outcome FROM orders GROUP BY 2 UNION ALL SELECT 2, o_orderpriority, count(*), 'kept' FROM orders GROUP BY 2 UNION ALL SELECT 3, NULL, NULL, 'refused'")
def _(t):
    orders = t("orders")
    spark, path = orders.sparkSession, shared.folder(orders.sparkSession)
    counts = lambda column: orders.groupBy(F.col(column).alias("state")).agg(F.count("*").alias("n"))
    revisions.compare_and_swap(counts("o_orderstatus"), path, 0)
    revisions.compare_and_swap(counts("o_orderpriority"), path, 1)
    outcome = "kept"
    try:
        revisions.compare_and_swap(counts("o_custkey"), path, 1)  # a writer that has not seen the second one
    except revisions.Conflict as told:
        outcome = "refused" if told.current == 2 else "lost"
    kept = [revisions.read(spark, path, k).select(F.lit(k).alias("revision"), "state", "n", F.lit("kept").alias("outcome")) for k in (1, 2)]
    return kept[0].union(kept[1]).union(orders.limit(1).select(F.lit(3), F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(outcome)))


@query("z01_discovery", "SELECT event_type AS source, event_id::VARCHAR AS entry, NULL AS error FROM events WHERE event_type <> 'error' UNION ALL SELECT DISTINCT 'error', NULL, 'failed' FROM events WHERE event_type = 'error'")
def _(t):
    events = t("events")
    spark, path = events.sparkSession, shared.folder(events.sparkSession)
    page = F.floor(F.col("event_id") / 500)
    pages = events.groupBy(F.col("event_type").alias("source"), page.alias("page")).agg(F.collect_list(F.struct(F.col("event_id").cast("string").alias("id"))).alias("entries"))  # at most 500 a page
    order = Window.partitionBy("source").orderBy("page")
    numbered = pages.select("source", (F.row_number().over(order) - 1).alias("page"), F.lead("page").over(order).isNotNull().alias("more"), "entries")
    following = F.when(F.col("source") == "error", F.lit("0")).when(F.col("more"), (F.col("page") + 1).cast("string"))  # the last source's cursors lead back
    text = F.to_json(F.struct("entries", following.alias("next")))
    numbered.select("source", "page", text.alias("value")).repartition("source", "page").write.partitionBy("source", "page").text(f"{path}/service")
    sources = [r[0] for r in numbered.select("source").distinct().collect()]  # the kinds of events
    found, failed = feeds.run(spark, f"folder:{path}/service", sources, f"{path}/state")
    rows = found.select("source", F.get_json_object("entry", "$.id").alias("entry"), F.lit(None).cast("string").alias("error"))
    return rows.unionByName(failed.select("source", F.lit(None).cast("string").alias("entry"), F.lit("failed").alias("error")))


@query(
    "o06_linked_representations",
    "WITH f AS (SELECT l_orderkey, l_linenumber, l_returnflag AS name, l_quantity AS q, l_linenumber % 2 AS s, CASE l_linenumber % 2 WHEN 1 THEN '/l/' ELSE '/a/' END || l_linenumber || '/' || l_partkey || '/' || l_suppkey || '/' || l_extendedprice AS path FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, name, q, s ORDER BY length(path), path) AS k, count(*) OVER (PARTITION BY l_orderkey, name, s) AS n FROM f), "
    "c AS (SELECT a.l_orderkey, a.path, b.path AS other FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.name = b.name AND a.q = b.q AND a.k = b.k AND a.s = 1 AND b.s = 0), x AS (SELECT a.l_orderkey, a.path, b.path AS other FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.name = b.name AND a.q <> b.q AND a.n = 1 AND b.n = 1 AND a.s = 1 AND b.s = 0) "
    "SELECT f.l_orderkey, f.path, f.path || coalesce(',' || c.other, '') AS paths, x.other AS contradiction FROM f LEFT JOIN c USING (l_orderkey, path) LEFT JOIN x USING (l_orderkey, path) WHERE NOT EXISTS (FROM c d WHERE d.l_orderkey = f.l_orderkey AND d.other = f.path)",
)
def _(t):
    lines = t("lineitem")
    spark = lines.sparkSession
    odd = F.col("l_linenumber") % 2 == 1
    raw = F.when(odd, F.col("l_quantity")).otherwise(F.col("l_quantity") / 1000)
    unit = F.when(odd, "nm").otherwise("µm")  # the same values in another unit
    rows = lines.select(
        F.col("l_orderkey").alias("paper_id"), F.lit("truth").alias("side"), F.concat_ws("/", F.when(odd, "/l").otherwise("/a"), *[F.col(x).cast("string") for x in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]).alias("path"), F.col("l_returnflag").alias("name"), F.lit("stack").alias("source"), F.lit("o").alias("owner"),
        F.create_map(F.lit("k"), F.lit("v")).alias("context"), qt.claim(raw.cast("string"), raw, unit).alias("claim"), F.lit(None).cast("string").alias("text"),
    )
    place = shared.folder(spark)
    rows = shared.written(rows, f"{place}/rows")
    links = rows.select("paper_id", "side").distinct().select("*", F.lit("/l").alias("left_path"), F.lit("/a").alias("right_path"))
    found, against = merging.copies(rows, links, place)
    kept = merging.merged(rows, found, f"{place}/merged").join(against, ["paper_id", "side", "path"], "left")
    return kept.select(F.col("paper_id").alias("l_orderkey"), "path", F.array_join("source_paths", ",").alias("paths"), F.col("other_path").alias("contradiction"))
