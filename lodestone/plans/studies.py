"""Registered queries of study records, quantities, names, ledgers and repairs, over columns of the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.functions import grounding as gr
from lodestone.functions import quantities as qt
from lodestone.functions import text as tx
from lodestone.functions import units as un
from lodestone.functions import vocabulary as vo
from lodestone.operators import claims, comparison, constraints, facts, ingest, linkage, nested, passages, projections, repair
from lodestone.plans.registry import long, query
from lodestone.sources import shared


def pick(column: str, *values) -> F.Column:
    """values[column modulo their number]."""
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col(column) % len(values)).cast("int"))


def sql_pick(column: str, *values) -> str:
    quoted = ", ".join("NULL" if v is None else "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v).lower() for v in values)
    return f"([{quoted}])[({column} % {len(values)} + 1)::INT]"


# ------------------------------------------------------------------ quantities, units
_RAW = ("{} mA/cm2", "{}-1000 nm", "{} ± 0.5 °C", "about {}", "{}", "x = {} V", "{} × 10^-3 s")


@query("n04_normalize_claim", f"WITH r AS (SELECT o_orderkey, o_custkey % 97 AS x, o_orderkey % 7 AS k FROM orders) SELECT o_orderkey, {sql_pick('k', 'scalar', 'range', 'uncertainty', 'literal', 'scalar', 'scalar', 'scalar')} AS kind, round(CASE k WHEN 0 THEN x * 10 WHEN 1 THEN x * 1e-9 WHEN 2 THEN x + 273.15 WHEN 5 THEN x WHEN 6 THEN x * 1e-3 END, 12)::DOUBLE AS base FROM r")
def _(t):
    raw = F.replace(pick("o_orderkey", *_RAW), F.lit("{}"), (F.col("o_custkey") % 97).cast("string"))
    read = t("orders").select("o_orderkey", qt.claim(raw, F.lit(None).cast("double"), F.lit(None).cast("string")).alias("c"))
    base = F.when(F.col("c.kind") == "scalar", F.col("c.canonical")).when(F.col("c.kind").isin("range", "uncertainty"), F.col("c.first"))
    return read.select("o_orderkey", F.col("c.kind").alias("kind"), F.round(base, 12).alias("base"))


@query("n03_compound_quantity", "SELECT l_orderkey, l_linenumber, 'uncertainty' AS kind, round(l_quantity / 1000, 9)::DOUBLE AS first, round(l_discount / 1000, 9)::DOUBLE AS second FROM lineitem")
def _(t):
    raw = F.concat(F.col("l_quantity").cast("string"), F.lit(" ± "), F.col("l_discount").cast("string"))
    read = t("lineitem").select("l_orderkey", "l_linenumber", qt.claim(raw, F.col("l_quantity"), F.lit("mV")).alias("c"))
    return read.select("l_orderkey", "l_linenumber", F.col("c.kind").alias("kind"), F.round("c.first", 9).alias("first"), F.round("c.second", 9).alias("second"))


_UNITS = ("mV", "°C", "min", "mA cm−2", "foo", "%")


@query("n09_base_quantity", "SELECT p_partkey, round([p_size / 1000.0, p_size + 273.15, p_size * 60.0, p_size * 10.0, NULL, p_size / 100.0][(p_partkey % 6 + 1)::INT], 9)::DOUBLE AS base, ['A-1 kg m2 s-3', 'K', 's', 'A m-2', NULL, ''][(p_partkey % 6 + 1)::INT] AS dims FROM part")
def _(t):
    read = t("part").select("p_partkey", "p_size", un.unit(pick("p_partkey", *_UNITS)).alias("u"))
    return read.select("p_partkey", F.round(un.in_base(F.col("p_size"), F.col("u")), 9).alias("base"), F.col("u.dims").alias("dims"))


@query("n08_convert", "SELECT p_partkey, round([p_size / 1000.0, NULL, NULL, NULL][(p_partkey % 4 + 1)::INT], 9)::DOUBLE AS volts FROM part")
def _(t):
    read = t("part").select("p_partkey", "p_size", un.unit(pick("p_partkey", "mV", "s", "", "V/m")).alias("a"), un.unit(F.lit("V")).alias("b"))
    return read.select("p_partkey", F.round(un.converted(F.col("p_size"), F.col("a"), F.col("b")), 9).alias("volts"))


@query("n11_same_unit", f"SELECT p_partkey, {sql_pick('p_partkey', True, False, True, False, True)} AS same FROM part")
def _(t):
    read = t("part").select("p_partkey", un.unit(pick("p_partkey", "h", "h", "W m-2", "°C", "mol/L")).alias("a"), un.unit(pick("p_partkey", "hours", "s", "W/m^2", "K", "M")).alias("b"))
    return read.select("p_partkey", un.same_spelling(F.col("a"), F.col("b")).alias("same"))


@query("n12_concentration", f"SELECT p_partkey, {sql_pick('p_partkey', True, True, False, True, False)} AS concentration FROM part")
def _(t):
    unit = pick("p_partkey", "mg/mL", "wt%", "nm", "mM", "V")
    return t("part").select("p_partkey", un.is_concentration(unit, un.unit(unit)).alias("concentration"))


@query("n07_unit_text", f"SELECT p_partkey, {sql_pick('p_partkey', 's-1', 'A-2 kg m2 s-3', 'm-3 mol', None, 'kg s-3')} AS dims FROM part")
def _(t):
    return t("part").select("p_partkey", un.unit(pick("p_partkey", "kHz", "Ω/sq", "mmol·L⁻¹", "Ω/", "mW cm -2"))["dims"].alias("dims"))


@query("n06_equal_value", "SELECT l_returnflag, count(*) FILTER (abs(l_quantity - l_quantity * (1 + l_tax / 4)) <= 0.01 * l_quantity * (1 + l_tax / 4)) AS n_equal, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    left = qt.claim(F.concat(F.col("l_quantity").cast("string"), F.lit(" mV")), F.col("l_quantity"), F.lit("mV"))
    other = F.col("l_quantity") * (1 + F.col("l_tax") / 4)
    right = qt.claim(F.concat((other / 1000).cast("string"), F.lit(" V")), other / 1000, F.lit("V"))
    read = t("lineitem").select("l_returnflag", left.alias("a"), right.alias("b"))
    return read.groupBy("l_returnflag").agg(F.count_if(qt.equal_claims(F.col("a"), F.col("b"))).alias("n_equal"), F.count("*").alias("n"))


@query("j10_contains_context", "SELECT o_custkey, count(DISTINCT o_orderkey % 50) = count(*) AS apart FROM orders GROUP BY 1")
def _(t):
    keys = F.col("o_orderkey") % 50
    lists = t("orders").groupBy("o_custkey").agg(F.collect_list((keys * 10.0 + 1)).alias("a"), F.array_distinct(F.collect_list(keys * 10.0 + 1)).alias("b"))
    return lists.select("o_custkey", linkage.contains_within(F.col("a"), F.col("b"), 1e-9).alias("apart"))


# ------------------------------------------------------------------ names
_NAMES = ("Power conversion efficiency", "Fill factor (FF)", "open-circuit_voltage", "Sample size", "Odd Thing (x)", "PCE retention")


@query("x17_property_name", f"SELECT p_partkey, {sql_pick('p_partkey', 'pce', 'ff', 'voc', 'sample_size', 'oddthing(x)', 'efficiencyretention')} AS name FROM part")
def _(t):
    return t("part").select("p_partkey", vo.property_name(pick("p_partkey", *_NAMES)).alias("name"))


@query("x18_protocol_name", f"SELECT p_partkey, {sql_pick('p_partkey', 'scanrate', 'illuminationintensity', None, 'scanvoltagerange')} AS name FROM part")
def _(t):
    return t("part").select("p_partkey", vo.protocol_name(pick("p_partkey", "JV scan rate", "Irradiance", "PCE", "voltage sweep")).alias("name"))


@query("x19_material_name", f"SELECT p_partkey, {sql_pick('p_partkey', 'Au', 'TiO2', 'FTO', 'compact TiO2', 'doped TiO2', 'Gold (Ag)', 'spiro-MeOTAD', 'CH3NH3PbI3')} AS name FROM part")
def _(t):
    names = ("Gold (Au)", "titanium dioxide layer", "Fluorine–doped tin oxide", "Compact TiO₂ layer", "doped TiO2", "Gold (Ag)", "Spiro-MeOTAD HTM", "CH₃NH₃PbI₃")
    return t("part").select("p_partkey", vo.material_name(pick("p_partkey", *names)).alias("name"))


@query("x21_material_stage", f"SELECT p_partkey, {sql_pick('p_partkey', 'finished', 'recipe', 'unspecified', 'unspecified')} AS stage, {sql_pick('p_partkey', 'hole_transport_layer', 'precursor_additive', 'odd role', None)} AS role, {sql_pick('p_partkey', True, False, False, True)} AS whole FROM part")
def _(t):
    role = pick("p_partkey", "HTL", "precursor-additive", "odd role", None)
    return t("part").select("p_partkey", vo.material_stage(role).alias("stage"), vo.material_role(role).alias("role"), vo.whole_material_role(role).alias("whole"))


@query("x22_treatment_name", f"SELECT p_partkey, {sql_pick('p_partkey', 'duration', 'electrodeposition_potential@PEDOT', None, 'temperature')} AS name FROM part")
def _(t):
    return t("part").select("p_partkey", vo.treatment_name(pick("p_partkey", "Annealing time", "PEDOT deposition potential", "starting temperature", "temperature")).alias("name"))


@query("x23_scoped_property", f"SELECT p_partkey, {sql_pick('p_partkey', 'thickness', 'silvercontactthickness', 'roughness', 'oddthing')} AS name FROM part")
def _(t):
    return t("part").select("p_partkey", vo.scoped_property(pick("p_partkey", "Gold contact thickness", "silver contact thickness", "Au roughness", "odd thing"), F.lit("gold")).alias("name"))


@query("x24_error_bars", f"SELECT p_partkey, {sql_pick('p_partkey', 'standard_deviation', 'standard_error', 'range of 5')} AS statistic FROM part")
def _(t):
    return t("part").select("p_partkey", vo.error_bar_statistic(pick("p_partkey", "Standard deviation", "standard_error of the mean", "range of 5")).alias("statistic"))


@query("x25_concept", f"SELECT p_partkey, {sql_pick('p_partkey', 'measurement', 'aging_outcome', 'recipe', 'material', 'processing', 'aging_protocol')} AS space, {sql_pick('p_partkey', 'performance', 'stability', 'processing', 'material_device_identity', 'processing', 'stability')} AS domain FROM part")
def _(t):
    group = pick("p_partkey", "population", "stability", "composition", "stack", "processing", "stability")
    space = vo.concept_space(group, pick("p_partkey", "pce", "pce", "precursor ratio", "material", "operation", "time"), F.lit(None).cast("string"), F.col("p_partkey") % 6 == 1)
    return t("part").select("p_partkey", space.alias("space"), vo.fact_domain(space).alias("domain"))


@query("x26_subfield", f"SELECT p_partkey, {sql_pick('p_partkey', 'photovoltaic_metrics', 'statistical_metadata', 'measurement_protocol', 'unparsed_measurement_claims', 'qualitative_observations', 'stability_outcomes', 'processing_materials', 'material_identity', 'recipe_composition', 'composition_amounts')} AS field FROM part")
def _(t):
    group = pick("p_partkey", "performance", "population", "performance", "performance", "performance", "stability", "processing", "stack", "composition", "composition")
    name = pick("p_partkey", "pce", "sample_size", "scanrate", "gain", "gain", "pce", "material", "formula", "precursor", "constituent_amount:x")
    literal = pick("p_partkey", None, None, None, "less than half", "higher", None, None, None, None, None)
    return t("part").select("p_partkey", vo.fact_subfield(group, name, F.lit("/a/0/outcomes/1"), F.lit(None).cast("string"), literal).alias("field"))


@query("x29_condition_name", f"SELECT p_partkey, {sql_pick('p_partkey', 'duration', 'speed', 'odd', 'temperature')} AS name FROM part")
def _(t):
    return t("part").select("p_partkey", vo.condition_name(pick("p_partkey", "annealing time", "Spin speed", "odd", "Temperature"), pick("p_partkey", "annealing", "spin coating", "annealing", "annealing")).alias("name"))


@query("x32_metric_parts", f"SELECT p_partkey, {sql_pick('p_partkey', 'pce', 'voc', 'ff', 'jsc(v)')} AS metric, {sql_pick('p_partkey', 'mean', None, None, None)} AS statistic, {sql_pick('p_partkey', 'jv_scan', None, None, None)} AS method, {sql_pick('p_partkey', '%', 'mV', None, None)} AS unit FROM part")
def _(t):
    name = pick("p_partkey", "Average PCE from J-V curve (%)", "Voc [mV]", "Fill factor (FF)", "Jsc (V)")
    parts = shared.spread(t("part").select("p_partkey"), "p_partkey")
    return parts.select("p_partkey", vo.metric_parts(name, lambda u: un.unit(u)["dims"]).alias("m")).select("p_partkey", "m.*")


@query("x28_sample_code", f"SELECT p_partkey, {sql_pick('p_partkey', 'A', 'S-12', None, None)} AS code FROM part")
def _(t):
    return t("part").select("p_partkey", tx.sample_code(pick("p_partkey", "Device A, Table 1", "sample S-12", "control device", "device A and device B"), F.lit(None).cast("string")).alias("code"))


@query("x02_formula_text", f"SELECT p_partkey, {sql_pick('p_partkey', 'CH3NH3PbI3-x', 'TiO2', 'a mixture of x', 'Fe³⁺')} AS formula FROM part")
def _(t):
    return t("part").select("p_partkey", vo.formula_text(pick("p_partkey", "CH₃NH₃PbI_{3-x}", "Ti O_2", "a mixture of x", "Fe³⁺")).alias("formula"))


@query("x34_label_key", "SELECT p_partkey, regexp_replace(lower(p_name || ' Ucm-2'), '[^a-z0-9]+', '', 'g') AS key FROM part")
def _(t):
    return t("part").select("p_partkey", projections.label_key(F.concat("p_name", F.lit(" µcm⁻²"))).alias("key"))


@query("x06_value_similarity", "WITH w AS (SELECT p_partkey, p_type = p_brand AS same, list_distinct(list_filter(string_split(lower(p_name), ' '), lambda x: x <> '')) AS a, list_distinct(list_filter(string_split(lower(p_name || ' odd'), ' '), lambda x: x <> '')) AS b FROM part) SELECT p_partkey, round(0.8 * same::INT + 0.2 * len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))), 9)::DOUBLE AS similarity FROM w")
def _(t):
    name = F.regexp_replace("p_name", "[^a-z0-9.+%-]", " ")
    return t("part").select("p_partkey", F.round(linkage.value_similarity(F.col("p_type"), F.col("p_brand"), F.col("p_name"), F.concat("p_name", F.lit(" odd"))), 9).alias("similarity"))


@query("x11_overlap_fraction", "SELECT p_partkey, round(greatest(0, least(10, p_size) - 4) * 5 / 60.0, 9)::DOUBLE AS share FROM part")
def _(t):
    box = [F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(6.0)]
    other = [F.lit(4.0), F.lit(1.0), F.col("p_size").cast("double"), F.lit(9.0)]
    return t("part").select("p_partkey", F.round(tx.overlap_fraction(box, other), 9).alias("share"))


@query("x09_layout_text", r"SELECT conv_id, turn, sha256(array_to_string(list_filter(list_transform(string_split(text || chr(10) || chr(10) || ' a  b ', chr(10)), lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'))), lambda x: x <> ''), chr(10))) AS sha FROM conversations")
def _(t):
    return t("conversations").select("conv_id", "turn", F.sha2(tx.layout_text(F.concat("text", F.lit("\n\n a  b "))), 256).alias("sha"))


@query("x15_safe_name", "SELECT page_id, 'a--b.c-' || page_id || '--' || left(sha256('.a//b.c-' || page_id || '-'), 12) || '.pdf' AS name FROM pages")
def _(t):
    return t("pages").select("page_id", tx.safe_name(F.concat(F.lit(".a//b.c-"), F.col("page_id").cast("string"), F.lit("-"))).alias("name"))


@query("w12_abstract", "SELECT p_partkey, p_name AS abstract FROM part")
def _(t):
    words = t("part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("p", "w")).groupBy("p_partkey", "w").agg(F.collect_list("p").alias("places"))
    index = words.groupBy("p_partkey").agg(F.map_from_entries(F.collect_list(F.struct("w", "places"))).alias("index"))
    return index.select("p_partkey", tx.abstract(F.col("index")).alias("abstract"))


# ------------------------------------------------------------------ grounding
@query("f07_holds_quote", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN length(substr(coalesce(text, ''), 5, 60)) > 0 WHEN 1 THEN false ELSE true END AS grounded FROM documents")
def _(t):
    docs = t("documents").withColumn("text", F.coalesce("text", F.lit("")))
    quote = F.when(F.col("doc_id") % 3 == 0, F.substring("text", 5, 60)).when(F.col("doc_id") % 3 == 1, F.lit("no such passage 4711x")).otherwise(F.lit("range 200-300 nm"))
    source = F.when(F.col("doc_id") % 3 == 2, F.concat("text", F.lit(" RANGE 200–300 nm."))).otherwise(F.col("text"))
    return docs.select("doc_id", gr.contains_quote(source, quote).alias("grounded"))


@query("f08_holds_value", f"SELECT doc_id, {sql_pick('doc_id', True, False, False, True, False)} AS grounded FROM documents")
def _(t):
    source = F.concat("text", F.lit(" gave 20.1 % at Fe³⁺ and −0.5 V x"))
    return t("documents").select("doc_id", gr.contains_value(source, pick("doc_id", "20.1%", "0.1%4711", "Fe³4711", "-0.5 V", "0.5 V x4711")).alias("grounded"))


@query("f09_assembled", f"SELECT p_partkey, {sql_pick('p_partkey', True, False, True)} AS assembled FROM part")
def _(t):
    quotes = F.array(F.concat("p_brand", F.lit(" 1")), F.col("p_type"))
    value = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_brand", F.lit("1"), "p_type")).when(F.col("p_partkey") % 3 == 1, F.concat("p_brand", F.lit("2"), "p_type")).otherwise(F.concat("p_brand", F.lit("1; "), "p_type"))
    return t("part").select("p_partkey", gr.assembled_from(value, quotes).alias("assembled"))


@query("f11_token_sequence", "SELECT p_partkey, contains(' ' || lower(p_name) || ' ', ' ' || lower(split_part(p_name, ' ', 2)) || ' ') AND split_part(p_name, ' ', 2) <> '' AS held FROM part")
def _(t):
    return t("part").select("p_partkey", gr.holds_words(F.upper(F.split_part("p_name", F.lit(" "), F.lit(2))), F.col("p_name")).alias("held"))


@query("f12_raw_value", "SELECT l_orderkey, l_linenumber, l_quantity >= 10 AND l_linenumber % 2 = 0 AS held FROM lineitem")
def _(t):
    hay = F.when(F.col("l_linenumber") % 2 == 0, F.when(F.col("l_quantity") >= 10, "about 12 V").otherwise("about 112 V")).otherwise("12.5 V")
    return t("lineitem").select("l_orderkey", "l_linenumber", gr.holds_raw_value(F.lit("12"), hay).alias("held"))


def _ledger(t):
    """Conversations as a source with blocks by turn; every user turn is noted as a claim on its first words."""
    blocks = t("conversations").select(F.col("conv_id").alias("paper_id"), F.col("turn").alias("block_id"), "text", F.when(F.col("turn") % 2 == 0, "main").otherwise("si").alias("source"), (F.col("turn") % 3).alias("page"), F.col("turn").alias("order"))
    noted = t("conversations").where("role = 'user'").select(F.col("conv_id").alias("paper_id"), F.col("turn").alias("block_id"), F.concat(F.lit("c"), F.col("turn").cast("string")).alias("owner_id"), F.col("text").alias("quote"))
    return blocks, noted


@query("j21_cited_blocks", "WITH c AS (SELECT conv_id, turn, role = 'user' AS cited, turn % 2 = 0 AND turn % 3 = min(CASE WHEN turn % 2 = 0 THEN turn % 3 END) OVER w AS head FROM conversations WINDOW w AS (PARTITION BY conv_id)), s AS (SELECT *, bool_or(cited) OVER w AS noted, bool_or(cited OR coalesce(head, false)) OVER w AS anyone FROM c WINDOW w AS (PARTITION BY conv_id)) SELECT conv_id AS paper_id, turn AS block_id FROM s WHERE cited OR head OR NOT noted OR NOT anyone")
def _(t):
    blocks, noted = _ledger(t)
    return claims.cited_blocks(blocks, noted).select("paper_id", "block_id")


@query("j23_relink", "WITH u AS (SELECT conv_id, turn, text, length(regexp_replace(lower(text), '[^a-z0-9_.%<>~=+/-]', '', 'g')) >= 12 AS long FROM conversations WHERE role = 'user' AND regexp_full_match(text, '[ -~]+')) SELECT conv_id AS paper_id, turn AS block_id, turn AS new_block_id FROM u WHERE long")
def _(t):
    blocks, noted = _ledger(t)
    ascii_ = F.col("quote").rlike(r"^[ -~]+$") & (F.length(F.regexp_replace(F.lower("quote"), "[^a-z0-9_.%<>~=+/-]", "")) >= 12)
    return claims.relinked(noted.where(ascii_), blocks).select("paper_id", "block_id", "new_block_id")


@query(
    "j23_relink_elsewhere",
    "WITH c AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations), q AS (SELECT c.*, n.text AS cited FROM c LEFT JOIN c n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1), h AS (SELECT q.conv_id, q.turn, count(DISTINCT b.turn) AS n, min(b.turn) AS new FROM q JOIN c b ON b.conv_id = q.conv_id AND contains(b.text, q.text) GROUP BY 1, 2), "
    "w AS (SELECT q.*, n, new, length(regexp_replace(lower(text), '[^\\p{L}\\p{N}_.%<>~=+/-]', '', 'g')) >= 12 AND len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) >= 2 AS long, coalesce(contains(cited, text) AND text <> '', false) AS ok FROM q LEFT JOIN h USING (conv_id, turn)) "
    "SELECT conv_id AS paper_id, turn + 1 AS block_id, CASE WHEN ok THEN turn + 1 WHEN long AND n = 1 THEN new END AS new_block_id, CASE WHEN ok THEN 'kept' WHEN NOT long THEN 'too_short' WHEN n = 1 THEN 'relinked' ELSE 'unresolved' END AS status FROM w",
)
def _(t):
    turns = t("conversations").select(F.col("conv_id").alias("paper_id"), F.col("turn").alias("block_id"), F.coalesce("text", F.lit("")).alias("text"))
    noted = turns.select("paper_id", (F.col("block_id") + 1).alias("block_id"), F.col("text").alias("quote"))  # each text is cited as the next block's
    return claims.relinked(noted, turns, shared.folder(turns.sparkSession)).select("paper_id", "block_id", "new_block_id", "status")


@query("v01_id_issues", "SELECT conv_id AS paper_id, role AS id, 'repeated' AS issue FROM conversations GROUP BY 1, 2 HAVING count(*) > 1 UNION ALL SELECT DISTINCT conv_id, 'nobody', 'no such subject' FROM conversations WHERE turn = 0")
def _(t):
    objects = t("conversations").select(F.col("conv_id").alias("paper_id"), F.col("role").alias("object_id"))
    noted = t("conversations").select(F.col("conv_id").alias("paper_id"), F.concat(F.lit("c"), F.col("turn").cast("string")).alias("claim_id")).distinct()
    subjects = t("conversations").select(F.col("conv_id").alias("paper_id"), F.concat(F.lit("c"), F.col("turn").cast("string")).alias("claim_id"), F.when(F.col("turn") == 0, "nobody").otherwise(F.col("role")).alias("object_id"))
    return claims.id_issues(objects, noted, subjects)


@query("p43_expand_spans", "SELECT conv_id AS paper_id, turn AS span_id, role AS block_id FROM conversations WHERE turn % 2 = 0")
def _(t):
    spans = t("conversations").select(F.col("conv_id").alias("paper_id"), F.col("turn").alias("span_id"), F.col("role").alias("block_id"), "text")
    asked = spans.where("span_id % 2 = 0").select("paper_id", "span_id").union(spans.limit(1).select("paper_id", F.lit(-5).cast("long")))
    return claims.expand_spans(asked, spans)[0].select("paper_id", "span_id", "block_id")


# ------------------------------------------------------------------ windows of blocks
@query("w04_plan_windows")
def _(t):
    blocks = t("conversations").select("conv_id", F.col("turn").alias("order"), F.when(F.col("turn") % 4 == 3, "si").otherwise("main").alias("source"), (F.col("turn") / 3).cast("int").cast("string").alias("section"), (F.col("turn") / 2).cast("long").alias("page"), F.length("text").alias("size"), F.col("turn").cast("string").alias("block_id"))
    return passages.plan_windows(blocks, ["conv_id"], "order", budget=600, context_budget=150)


@query("f05_evidence_blocks", "SELECT event_type, count(*) FILTER (event_id % 4 <> 0) AS kept FROM events GROUP BY 1")
def _(t):
    kept = passages.evidence_blocks(t("events"), F.when(F.col("event_id") % 4 == 0, False).when(F.col("event_id") % 4 == 1, True))
    return kept.groupBy("event_type").agg(F.count("*").alias("kept"))


# ------------------------------------------------------------------ experiments
def _runs(t):
    """Orders as runs: a paper is a customer, a repeat the order's place, an arm its parity."""
    w = Window.partitionBy("o_custkey", F.col("o_orderkey") % 2).orderBy("o_orderkey")
    return t("orders").select(F.col("o_custkey").alias("paper_id"), F.row_number().over(w).alias("repeat"), F.when(F.col("o_orderkey") % 2 == 0, "control").otherwise("treatment").alias("arm"), "o_totalprice", "o_orderpriority", "o_orderkey")


_SQL_RUNS = "WITH r AS (SELECT o_custkey AS paper_id, row_number() OVER (PARTITION BY o_custkey, o_orderkey % 2 ORDER BY o_orderkey) AS repeat, CASE WHEN o_orderkey % 2 = 0 THEN 'control' ELSE 'treatment' END AS arm, o_totalprice, o_orderpriority, o_orderkey FROM orders)"


@query("j27_reference_agreement", _SQL_RUNS + ", d AS (SELECT paper_id, repeat, max(o_totalprice) FILTER (arm = 'treatment') - max(o_totalprice) FILTER (arm = 'control') AS d FROM r GROUP BY 1, 2), p AS (SELECT paper_id, avg(d) AS d FROM d WHERE d IS NOT NULL GROUP BY 1) SELECT (SELECT count(*) FROM d) AS planned, (SELECT count(d) FROM d) AS complete, count(*) AS papers, round(avg(d), 4) AS mean_delta, 'conditional_on_complete_pairs' AS status FROM p")
def _(t):
    runs = _runs(t)
    return comparison.agreement(runs, runs.select("paper_id", "repeat"), "o_totalprice", samples=200).select("planned", "complete", "papers", F.round("mean_delta", 4).alias("mean_delta"), "status")


@query("j28_cohort_issues", _SQL_RUNS + ", e AS (SELECT c_custkey AS paper_id, unnest([1, 2]) AS repeat FROM customer), a AS (SELECT DISTINCT paper_id, repeat::INT AS repeat FROM r) SELECT *, 'missing' AS issue FROM (SELECT * FROM e EXCEPT SELECT * FROM a) UNION ALL SELECT *, 'unexpected' FROM (SELECT * FROM a EXCEPT SELECT * FROM e)")
def _(t):
    expected = comparison.expected_pairs(t("customer").select(F.col("c_custkey").alias("paper_id")), 2)
    return comparison.cohort_issues(expected, _runs(t))


def _settings(t):
    runs = _runs(t)
    values = F.array(F.struct(F.lit("model").alias("name"), F.when(F.col("arm") == "control", '"a"').otherwise('"b"').alias("value")), F.struct(F.lit("priority").alias("name"), F.to_json(F.struct(F.substring("o_orderpriority", 1, 1).alias("p"))).alias("value")))
    return runs, runs.select("paper_id", "repeat", "arm", F.explode(values).alias("x")).select("paper_id", "repeat", "arm", "x.*")


@query("j29_factor_issues", _SQL_RUNS + " SELECT paper_id, repeat::INT AS repeat, arm, 'model' AS name FROM r WHERE arm = 'treatment'")
def _(t):
    runs, settings = _settings(t)
    return comparison.factor_issues(settings, runs, [("model", '"a"', '"c"')]).select("paper_id", "repeat", "arm", "name")


@query("j29_drift_issues", _SQL_RUNS + ", f AS (SELECT arm, arg_min(left(o_orderpriority, 1), (paper_id, repeat)) AS p, min((paper_id, repeat)) AS k FROM r GROUP BY 1) SELECT paper_id, repeat::INT AS repeat, arm, 'priority' AS name FROM r JOIN f USING (arm) WHERE left(o_orderpriority, 1) <> p AND (paper_id, repeat) <> k")
def _(t):
    runs, settings = _settings(t)
    return comparison.drift_issues(settings, runs)


@query("j26_roster_issues", _SQL_RUNS + ", x AS (SELECT paper_id, repeat, arm, 'd' || (o_orderkey - o_orderkey % 400) AS run_dir FROM r) SELECT 'other arm missing' AS issue, count(*) AS n FROM (SELECT 1 FROM x GROUP BY paper_id, repeat HAVING count(DISTINCT arm) < 2) UNION ALL SELECT 'reused folder', count(*) FROM (SELECT 1 FROM x GROUP BY run_dir HAVING count(*) > 1)")
def _(t):
    roster = _runs(t).select("paper_id", "repeat", "arm", F.concat(F.lit("d"), (F.col("o_orderkey") - F.col("o_orderkey") % 400).cast("string")).alias("run_dir"), F.lit(None).cast("string").alias("role"))
    return comparison.roster_issues(roster).groupBy("issue").agg(F.count("*").alias("n"))


@query("v15_source_hashes", "SELECT o_custkey, 'different sources' AS issue FROM (SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) AS a, list_sort(list(DISTINCT o_orderpriority) FILTER (o_orderstatus <> 'P')) AS b FROM orders GROUP BY 1) WHERE a <> b AND len(coalesce(b, [])) > 0 UNION ALL SELECT o_custkey, 'missing' FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus <> 'P') = 0")
def _(t):
    return comparison.hash_issues(t("orders"), t("orders").where("o_orderstatus <> 'P'"), ["o_custkey"], "o_orderpriority")


@query("a12_usage", "SELECT user_id, sum(CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 100 END)::BIGINT AS prompt_tokens, round(sum(CASE WHEN event_id % 11 = 0 THEN 0 ELSE value END), 4) AS cost, bool_and(event_id % 11 <> 0) AS cost_tracking_complete, bool_and(event_id % 3 <> 0) AS token_tracking_complete, count(*) FILTER (event_type <> 'error') AS provider_responses, CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) END AS provider FROM events GROUP BY 1")
def _(t):
    calls = t("events").select(
        "user_id", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 100).alias("prompt_tokens"), F.lit(1).alias("completion_tokens"), F.lit(2).alias("total_tokens"), F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("cost"),
        F.lit(0.5).alias("latency_seconds"), (F.col("event_type") != "error").alias("response_received"), F.lit("m").alias("response_model"), F.col("event_type").alias("provider"),
    )
    out = comparison.usage(calls, ["user_id"], "event_id")
    return out.select("user_id", "prompt_tokens", F.round("cost", 4).alias("cost"), "cost_tracking_complete", "token_tracking_complete", "provider_responses", "provider")


@query("a13_call_counts", "SELECT user_id, count(*) AS logical_calls, count(*) FILTER (event_type <> 'view' AND event_id % 4 > 0) AS live_calls, count(*) FILTER (event_type = 'view') AS cache_hits, count(*) FILTER (event_type = 'error') AS blocked_calls, sum(event_id % 4)::BIGINT AS provider_attempts FROM events GROUP BY 1")
def _(t):
    calls = t("events").select("user_id", (F.col("event_type") == "view").alias("cache_hit"), (F.col("event_id") % 4).alias("attempt_count"), F.when(F.col("event_type") == "error", "blocked").alias("status"))
    return comparison.call_summary(calls, ["user_id"])


# ------------------------------------------------------------------ nested documents
@query("p20_flattened", "SELECT event_id, 'a.k' AS path, props::JSON ->> 'k' AS value FROM events WHERE props IS NOT NULL UNION ALL SELECT event_id, 'b', '[1,{\"c\":2}]' FROM events WHERE props IS NOT NULL")
def _(t):
    doc = F.concat(F.lit('{"a": '), "props", F.lit(', "b": [1, {"c": 2}]}'))
    return t("events").where("props is not null").select("event_id", F.explode(nested.flattened(doc)).alias("x")).select("event_id", "x.path", "x.value")


@query("p15_reported_values", "SELECT event_id, '/r/0/v' AS path, (props::JSON ->> 'k') || ' V' AS raw_value, (props::JSON ->> 'k')::DOUBLE AS number FROM events WHERE props IS NOT NULL")
def _(t):
    k = F.get_json_object("props", "$.k")
    doc = F.concat(F.lit('{"evidence": [{"raw_value": "no"}], "r": [{"v": {"name": "x", "unit": "V", "raw_value": "'), k, F.lit(' V", "value_number": '), k, F.lit("}}]}"))
    return t("events").where("props is not null").select("event_id", F.explode(nested.reported_values(doc)).alias("x")).select("event_id", "x.path", "x.raw_value", "x.number")


@query("a08_scalar_items", "SELECT user_id, greatest(count(*), count(*) FILTER (event_type <> 'error')) * 2 AS compared, count(*) FILTER (event_type <> 'error') * 2 AS agreed FROM events GROUP BY 1")
def _(t):
    doc = F.concat(F.lit('{"label": "'), F.upper("event_type"), F.lit('", "n": {"deep": ['), F.col("event_id").cast("string"), F.lit(']}, "unit": "V", "v": {"raw_value": "1"}}'))
    rows = t("events").select("user_id", "event_type", doc.alias("doc"))
    return nested.scalar_agreement(rows, rows.where("event_type <> 'error'"), ["user_id"], "doc")


@query("p18_record_evidence", "SELECT event_id, event_type AS block_id, 'q' || (props::JSON ->> 'k') AS quote FROM events WHERE props IS NOT NULL")
def _(t):
    doc = F.concat(F.lit('{"a": [{"evidence": [{"block_id": "'), "event_type", F.lit('", "quote": "q'), F.get_json_object("props", "$.k"), F.lit('"}]}]}'))
    return t("events").where("props is not null").select("event_id", F.explode(nested.citations(doc)).alias("x")).select("event_id", "x.block_id", "x.quote")


@query("p22_neutral_claims", "SELECT user_id, count(DISTINCT event_type) + count(DISTINCT value) AS n_claims FROM events GROUP BY 1")
def _(t):
    doc = F.to_json(F.struct("event_type", F.col("value").alias("value"), F.lit("x").alias("paper_id")))
    return nested.claims(t("events").select("user_id", doc.alias("doc")), ["user_id"], "doc").groupBy("user_id").agg(F.count("*").alias("n_claims"))


@query("o11_fingerprint", "SELECT event_id, sha256('{\"b\":\"' || event_type || '\"}') AS fingerprint FROM events")
def _(t):
    doc = F.concat(F.lit('{"evidence": [1], "b": "'), "event_type", F.lit('", "test_id": '), F.col("event_id").cast("string"), F.lit("}"))
    return t("events").select("event_id", nested.content_digest(doc, ("evidence", "test_id")).alias("fingerprint"))


@query("x40_same_setting", f"SELECT event_id, {sql_pick('event_id', True, False, True)} AS same FROM events")
def _(t):
    return t("events").select("event_id", nested.same_json(pick("event_id", '{"a": [1, true]}', '{"a": true}', "[1.0]"), pick("event_id", '{"a": [1, true]}', '{"a": 1}', "[1]")).alias("same"))


@query("d07_edit", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{\"k\":\"new\"}' WHEN 1 THEN '{}' END AS document, CASE WHEN event_id % 3 < 2 THEN props::JSON ->> 'k' END AS before FROM events WHERE props IS NOT NULL")
def _(t):
    action, pointer = pick("event_id", "replace", "remove", "add"), pick("event_id", "/k", "/k", "/k")
    return t("events").where("props is not null").select("event_id", nested.edited(F.col("props"), action, pointer, F.lit('"new"')).alias("x")).select("event_id", "x.document", "x.before")


@query("z14_undo", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{\"k\":0}' END AS document FROM events WHERE props IS NOT NULL")
def _(t):
    after = F.when(F.col("event_id") % 2 == 0, F.get_json_object("props", "$.k")).otherwise(F.lit("-5"))
    return t("events").where("props is not null").select("event_id", nested.undone(F.col("props"), F.lit("replace"), F.lit("/k"), F.lit("0"), after)["document"].alias("document"))


@query("d06_pointer", "SELECT p_partkey, p_brand || '|a/b~c|0' AS parts, '$.' || p_brand || '.a/b~c[0]' AS path FROM part")
def _(t):
    parts = nested.pointer_parts(F.concat(F.lit("/"), "p_brand", F.lit("/a~1b~0c/0")))
    return t("part").select("p_partkey", F.array_join(parts, "|").alias("parts"), nested.json_path(parts).alias("path"))


@query("d09_dropped_paths", "SELECT event_id, '/a/0/x,/b' AS paths FROM events WHERE props IS NOT NULL")
def _(t):
    kept = F.concat(F.lit('{"p": '), "props", F.lit(', "a": [{}]}'))
    whole = F.concat(F.lit('{"p": '), "props", F.lit(', "a": [{"x": 1}, 2], "b": 3}'))
    return t("events").where("props is not null").select("event_id", F.array_join(nested.dropped_paths(whole, kept), ",").alias("paths"))


# ------------------------------------------------------------------ flat projections
_METRICS = ("PCE", "Jsc", "Voc", "fill factor", "PCE", "note")


@query("p28_unique_metrics", "WITH v AS (SELECT l_orderkey, l_linenumber % 6 AS k, l_quantity AS x FROM lineitem), c AS (SELECT l_orderkey, count(*) FILTER (k IN (0, 4)) AS n0, max(x) FILTER (k IN (0, 4)) AS pce, count(*) FILTER (k = 1) AS n1, max(x) FILTER (k = 1) AS jsc, count(*) FILTER (k = 2) AS n2, max(x) FILTER (k = 2) AS voc FROM v GROUP BY 1) SELECT l_orderkey, CASE WHEN n0 = 1 THEN pce END AS pce, CASE WHEN n1 = 1 THEN jsc END AS jsc, CASE WHEN n1 = 1 THEN 'mA cm^-2' END AS jsc_unit, NULL::DOUBLE AS voc FROM c")
def _(t):
    unit = pick("l_linenumber", "%", "mA/cm²", "s", "%", "percent", None)
    values = t("lineitem").select("l_orderkey", pick("l_linenumber", *_METRICS).alias("name"), F.col("l_quantity").alias("value_number"), unit.alias("unit"))
    return projections.project_metrics(values, ["l_orderkey"])[0].select("l_orderkey", "pce", "jsc", "jsc_unit", "voc")


@query("p33_converted_metrics", "SELECT l_orderkey, CASE WHEN count(*) FILTER (l_linenumber % 6 = 2) = 1 THEN round(max(l_quantity) FILTER (l_linenumber % 6 = 2) / 1000, 9) END::DOUBLE AS voc FROM lineitem GROUP BY 1")
def _(t):
    values = t("lineitem").select("l_orderkey", pick("l_linenumber", *_METRICS).alias("name"), F.col("l_quantity").alias("value_number"), F.lit("mV").alias("unit"))
    return projections.converted_metrics(values, ["l_orderkey"], {"voc": "V"})[0].select("l_orderkey", F.round("voc", 9).alias("voc"))


@query("p37_stability_summary", "WITH x AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) * 500 + o_custkey % 2 AS h, o_totalprice AS p FROM orders) SELECT o_custkey, arg_max(h, i) AS hours, CASE WHEN arg_min(h, i) = 0 THEN arg_min(p, i) END AS pce_at_start, arg_max(p, i) AS pce_at_end, max(p) FILTER (h = 1000) AS pce_after_1000_hours FROM x GROUP BY 1")
def _(t):
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    points = t("orders").select("o_custkey", "o_orderkey", ((place - 1) * 500 + F.col("o_custkey") % 2).alias("hours"), F.col("o_totalprice").alias("pce"))
    return projections.stability_summary(points, ["o_custkey"], "o_orderkey")


# ------------------------------------------------------------------ ledgers, patches
def _records(t, shift: int):
    rows = t("orders").select(F.col("o_custkey").alias("paper_id"), F.col("o_orderstatus").alias("kind"), F.col("o_orderkey").cast("string").alias("record_id"), (F.col("o_orderkey") % 8).alias("position"), F.substring("o_orderpriority", 1, 1).alias("content"))
    return rows.where(F.col("position") > shift)


_SQL_RECORDS = "WITH o AS (SELECT o_custkey AS paper_id, o_orderstatus AS kind, o_orderkey::VARCHAR AS record_id, o_orderkey % 8 AS position, left(o_orderpriority, 1) AS content FROM orders)"


@query("o16_apply_patch", _SQL_RECORDS + " SELECT paper_id, kind, record_id, CASE WHEN position = 2 THEN 'new' ELSE content END AS content FROM o WHERE position <> 3 UNION ALL SELECT DISTINCT paper_id, 'N', 'x', 'new' FROM o")
def _(t):
    own = _records(t, -1)
    added = own.select("paper_id", F.lit("N").alias("kind"), F.lit("x").alias("record_id"), F.lit(0).cast("long").alias("position"), F.lit("new").alias("content")).distinct()
    patch = own.where("position = 2").withColumn("content", F.lit("new")).union(added)
    return repair.apply_patch(own, patch, own.where("position = 3"), "position").select("paper_id", "kind", "record_id", "content")


@query("o18_record_changes", _SQL_RECORDS + ", a AS (SELECT * FROM o WHERE position > 1), b AS (SELECT paper_id, kind, record_id, CASE WHEN position = 2 THEN 'z' ELSE content END AS content FROM o WHERE position < 4) SELECT change, count(*) AS n FROM (SELECT CASE WHEN a.content IS NULL THEN 'added' WHEN b.content IS NULL THEN 'removed' WHEN a.content <> b.content THEN 'changed' END AS change FROM a FULL JOIN b USING (paper_id, kind, record_id)) WHERE change IS NOT NULL GROUP BY 1")
def _(t):
    after = _records(t, -1).where("position < 4").withColumn("content", F.when(F.col("position") == 2, "z").otherwise(F.col("content")))
    return repair.record_changes(_records(t, 1), after, "content").groupBy("change").agg(F.count("*").alias("n"))


@query("f33_restrict_patch", _SQL_RECORDS + " SELECT kind, count(*) FILTER (NOT (position = 2 OR kind = 'P')) AS discarded, count(*) FILTER (position = 2 OR kind = 'P') AS kept FROM o GROUP BY 1")
def _(t):
    own = _records(t, -1)
    named = own.where("position = 2").select("paper_id", F.lit("claim_unmatched").alias("reason"), "kind", F.array("record_id").alias("record_ids"))
    fresh = own.select("paper_id").distinct().select("paper_id", F.lit("claim_unmatched").alias("reason"), F.lit("P").alias("kind"), F.array().cast("array<string>").alias("record_ids"))
    kept, _, lost = repair.restrict(own, own.limit(0), named.union(fresh))
    counts = kept.groupBy("kind").agg(F.count("*").alias("kept"))
    gone = lost.groupBy("kind").agg(F.sum("discarded").alias("discarded"))
    return counts.join(gone, "kind", "full_outer").select("kind", F.coalesce("discarded", F.lit(0)).alias("discarded"), F.coalesce("kept", F.lit(0)).alias("kept"))


@query("a24_lost_values", "SELECT l_orderkey AS paper_id, count(DISTINCT (l_returnflag, l_linestatus, l_linenumber)) FILTER (l_linenumber > 3) AS lost FROM lineitem GROUP BY 1")
def _(t):
    keys = t("lineitem").select(F.col("l_orderkey").alias("paper_id"), F.col("l_returnflag").alias("scope"), F.col("l_linestatus").alias("name"), F.col("l_linenumber").alias("raw_value"), F.lit("b").alias("block_id"))
    return repair.lost_values(keys, keys.where("raw_value <= 3"))


@query("o03_combine_objects", "WITH o AS (SELECT user_id, event_id % 3 AS reading, event_type || (event_id % 4)::VARCHAR AS content, event_id FROM events), t AS (SELECT DISTINCT user_id, content FROM (SELECT user_id, reading, content FROM o GROUP BY 1, 2, 3 HAVING count(*) > 1)), f AS (SELECT user_id, content, arg_min(event_id, (reading, event_id)) AS first FROM o GROUP BY 1, 2) SELECT o.user_id AS paper_id, event_id AS object_id, CASE WHEN t.user_id IS NULL THEN first ELSE event_id END AS retained_id FROM o JOIN f USING (user_id, content) LEFT JOIN t USING (user_id, content)")
def _(t):
    objects = t("events").select(F.col("user_id").alias("paper_id"), (F.col("event_id") % 3).alias("reading"), F.col("event_id").alias("object_id"), F.concat("event_type", (F.col("event_id") % 4).cast("string")).alias("label"))
    return repair.combine_objects(objects, ["label"]).select("paper_id", "object_id", "retained_id")


# ------------------------------------------------------------------ constraints
@query("v03_exact_cover", "WITH i AS (SELECT p_partkey AS k FROM part), u AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1) SELECT issue, count(*) AS n FROM (SELECT CASE WHEN u.k IS NULL THEN 'unused' WHEN u.n > 1 THEN 'used more than once' END AS issue FROM i LEFT JOIN u USING (k)) WHERE issue IS NOT NULL GROUP BY 1")
def _(t):
    found = constraints.exact_cover(t("part").select(F.col("p_partkey").alias("k")), t("lineitem").select(F.col("l_partkey").alias("k")), ["k"])
    return found.groupBy("issue").agg(F.count("*").alias("n"))


@query("v04_same_inventory", "SELECT l_returnflag, l_linenumber, 'left' AS side, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1, 2")
def _(t):
    key = ["l_returnflag", "l_linenumber"]
    return constraints.same_inventory(t("lineitem"), t("lineitem").where("l_quantity <= 45"), key).groupBy(*key, "side").agg(F.count("*").alias("n"))


@query("v05_chained_aliases", "WITH a AS (SELECT lower(n_name) AS alias, lower(r_name) AS target FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT lower(r_name), 'world' FROM region) SELECT alias, target FROM a WHERE target IN (SELECT alias FROM a)")
def _(t):
    a = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("alias"), F.col("r_name").alias("target"))
    return constraints.chained_aliases(a.union(t("region").select("r_name", F.lit("World"))))


@query("v07_link_issues", "SELECT o_orderkey, 'link status and ids disagree' AS issue FROM orders WHERE (o_orderstatus = 'F') <> (o_custkey % 3 = 0)")
def _(t):
    tests = t("orders").select("o_orderkey", F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).alias("family_id"), F.lit(None).cast("string").alias("device_id"), F.when(F.col("o_orderstatus") == "F", "linked").otherwise("unlinked").alias("link_status"))
    return constraints.link_issues(tests, ["o_orderkey"])


@query("v08_champion_issues", "SELECT o_orderkey, 'champion flag and selection basis disagree' AS issue FROM orders WHERE (o_orderstatus = 'F') <> (o_custkey % 2 = 0)")
def _(t):
    devices = t("orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("champion_status"), F.when(F.col("o_custkey") % 2 == 0, "champion").otherwise("other").alias("selection_basis"))
    return constraints.champion_issues(devices, ["o_orderkey"])


@query("v09_form_issues", "SELECT p_partkey, 'form and its text disagree' AS issue FROM part WHERE (p_size > 25) <> (p_partkey % 2 = 0)")
def _(t):
    layers = t("part").select("p_partkey", F.when(F.col("p_size") > 25, "monolayer").otherwise("not_reported").alias("material_form"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("material_form_raw"))
    return constraints.form_issues(layers, ["p_partkey"])


@query("v13_roster", "WITH c AS (SELECT o_custkey AS release, count(DISTINCT o_orderpriority) AS found, count(*) > count(DISTINCT o_orderpriority) AS twice FROM orders GROUP BY 1) SELECT c_custkey AS release, 3 AS paper_count, coalesce(found, 0) AS found FROM customer LEFT JOIN c ON release = c_custkey WHERE coalesce(found, 0) <> 3 OR coalesce(twice, false)")
def _(t):
    return constraints.roster_issue(t("customer").select(F.col("c_custkey").alias("release"), F.lit(3).alias("paper_count")), t("orders").select(F.col("o_custkey").alias("release"), F.col("o_orderpriority").alias("paper_id")))


@query("v17_term_groups", f"SELECT p_partkey, {sql_pick('p_partkey', 'a,b', None, 'x')} AS first_group FROM part")
def _(t):
    groups = F.when(F.col("p_partkey") % 3 == 0, F.array(F.array(F.lit(" a"), F.lit("b "), F.lit("a")))).when(F.col("p_partkey") % 3 == 1, F.array(F.array(F.lit("a")), F.array(F.lit(" ")))).otherwise(F.array(F.array(F.lit("x"), F.lit(""))))
    return t("part").select("p_partkey", F.array_join(F.get(constraints.term_groups(groups), F.lit(0)), ",").alias("first_group"))


@query("v20_loss_counts", "SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END)::BIGINT AS lost FROM lineitem GROUP BY 1")
def _(t):
    panels = t("lineitem").select("l_orderkey", (F.col("l_returnflag") == "R").alias("relevant"), F.col("l_linenumber").alias("lost"))
    return constraints.loss_counts(panels, ["l_orderkey"], "relevant", ["lost"])


@query("v21_count_issues", "SELECT l_orderkey, l_linenumber, 'found above total' AS issue FROM lineitem WHERE l_linenumber * 8 > l_quantity")
def _(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") * 8).alias("found"), F.col("l_quantity").alias("total"))
    return constraints.count_issues(rows, ["l_orderkey", "l_linenumber"], {"found": "total"})


@query("v26_new_issues", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 30 GROUP BY 1")
def _(t):
    after = t("lineitem").select("l_orderkey", "l_returnflag", "l_partkey", "l_quantity")
    return constraints.new_issues(after.where("l_quantity <= 30"), after, ["l_orderkey", "l_returnflag", "l_partkey", "l_quantity"]).groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("v28_panel_issues", "SELECT 'repeated' AS issue, count(*) AS n FROM (SELECT 1 FROM part GROUP BY p_brand, lower(p_type), p_size % 3 HAVING count(*) > 1)")
def _(t):
    rows = t("part").select("p_brand", F.concat(F.lit(" "), F.upper("p_type")).alias("figure"), (F.col("p_size") % 3).cast("string").alias("panel"))
    return constraints.panel_issues(rows, "p_brand", "figure", "panel").groupBy("issue").agg(F.count("*").alias("n"))


@query("f24_request_limits", "SELECT p_partkey, CASE WHEN p_size > 30 THEN 1 ELSE 0 END + CASE WHEN p_size + 10 > 35 THEN 1 ELSE 0 END AS n_issues FROM part")
def _(t):
    return t("part").select("p_partkey", F.size(constraints.request_issues(F.col("p_size"), F.lit(10), F.lit(30), F.lit(35))).alias("n_issues"))


@query("v12_sources_of", f"SELECT p_partkey, {sql_pick('p_partkey', 'a', 'feed', '')} AS sources FROM part")
def _(t):
    lists = F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit("a")))
    return t("part").select("p_partkey", F.array_join(constraints.sources_of(lists, F.when(F.col("p_partkey") % 3 < 2, "feed")), ",").alias("sources"))


# ------------------------------------------------------------------ intake
def _entries(t):
    link = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://doi.org/10.1234/AB."), (F.col("page_id") % 50).cast("string"))).otherwise(F.concat(F.lit("u:"), (F.col("page_id") % 40).cast("string")))
    return t("pages").select("page_id", link.alias("link"), F.concat(F.lit("<b>T</b> "), "url").alias("title"), F.lit("").alias("summary"))


_SQL_ENTRIES = "WITH e AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '10.1234/ab.' || page_id % 50 ELSE 'u:' || page_id % 40 END AS identifier, 'T ' || url AS title FROM pages WHERE url IS NOT NULL)"


@query("p46_entry_record", _SQL_ENTRIES + " SELECT identifier, min(title) AS title, count(*) AS n FROM e GROUP BY 1")
def _(t):
    return ingest.feed_records(_entries(t).where("title is not null"), "feed").groupBy("identifier").agg(F.min("title").alias("title"), F.count("*").alias("n"))


@query("o05_merge_papers", _SQL_ENTRIES + ", m AS (SELECT identifier, max(length(title)) AS n FROM e GROUP BY 1) SELECT e.identifier, min(title) FILTER (length(title) = n) AS title, count(*) AS n_records FROM e JOIN m USING (identifier) GROUP BY 1")
def _(t):
    return ingest.merge_records(ingest.feed_records(_entries(t).where("title is not null"), "feed"), ["title"]).select("identifier", "title", "n_records")


@query("j32_merge_previous", "SELECT o_orderkey::VARCHAR AS identifier, CASE WHEN o_custkey % 2 = 0 THEN 2 WHEN o_custkey % 5 = 0 THEN 7 ELSE 0 END AS attempts, CASE WHEN o_custkey % 2 = 0 THEN o_orderkey::VARCHAR WHEN o_custkey % 5 = 0 THEN 'old' || o_custkey END AS previous FROM orders")
def _(t):
    orders = t("orders").select(F.col("o_orderkey").cast("string").alias("identifier"), F.concat(F.lit("10.1/"), F.col("o_custkey").cast("string")).alias("doi"), "o_custkey")
    base = orders.select("identifier", "doi", F.array(F.lit("s")).alias("sources"), F.array().cast("array<string>").alias("topic_ids"), F.lit(None).cast("string").alias("pdf_url"), F.lit(False).alias("curated"))
    state = orders.where("o_custkey % 2 = 0").select("identifier", F.lit(None).cast("string").alias("doi"), F.lit(2).alias("attempts")).union(orders.where("o_custkey % 5 = 0 and o_custkey % 2 <> 0").select(F.concat(F.lit("old"), F.col("o_custkey").cast("string")), "doi", F.lit(7)).distinct())
    state = state.withColumns({"sources": F.array(F.lit("t")), "topic_ids": F.array().cast("array<string>"), "status": F.lit("error"), "pdf_url": F.lit(None).cast("string"), "curated": F.lit(False)})
    return ingest.merge_previous(base, state).select("identifier", "attempts", "previous")


@query("j33_pending_retries", "SELECT o_orderkey::VARCHAR AS identifier FROM orders WHERE o_orderstatus <> 'P' AND o_custkey % 3 <> 0 AND (o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%') AND o_custkey % 5 < 3")
def _(t):
    status = F.when(F.col("o_orderpriority").startswith("1"), "error").when(F.col("o_orderpriority").startswith("2"), "no_pdf").otherwise("irrelevant")
    state = t("orders").select(F.col("o_orderkey").cast("string").alias("identifier"), F.col("o_custkey").cast("string").alias("doi"), status.alias("status"), (F.col("o_custkey") % 5).alias("attempts"), (F.col("o_custkey") % 3 == 0).alias("curated"), "o_orderstatus")
    return ingest.pending_retries(state, state.where("o_orderstatus = 'P'").select("identifier", F.lit(None).cast("string").alias("doi")), 3).select("identifier")


@query("z02_next_status", f"SELECT o_orderkey, CASE WHEN o_custkey % 4 = 3 THEN 'error' ELSE {sql_pick('o_orderkey', 'excluded', 'irrelevant', 'missing_doi', 'error', 'no_pdf', 'downloaded')} END AS status FROM orders")
def _(t):
    k = F.col("o_orderkey") % 6
    status = ingest.next_status(F.lit("error"), F.col("o_custkey") % 4, k == 0, k != 1, F.when(k != 2, "10.1/x"), k == 5, F.when(k == 3, "timeout"), 3)
    return t("orders").select("o_orderkey", status.alias("status"))


@query("a21_outcome_counts", "SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'terminal:' || o_orderpriority END AS counter, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return ingest.outcome_counts(t("orders").select(F.col("o_orderpriority").alias("status"), F.when(F.col("o_orderstatus") == "F", "evaluated").otherwise("skipped_terminal").alias("disposition")))


@query("f26_is_current", "SELECT o_orderkey, o_orderkey % 7 < 3 AS is_current FROM orders")
def _(t):
    records = t("orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("downloaded_file"), F.lit("h").alias("pdf_sha256"))
    files = t("orders").select(F.col("o_orderkey").cast("string").alias("path"), F.when(F.col("o_orderkey") % 7 < 3, "h").otherwise("other").alias("sha256"))
    return ingest.is_current(records, files).select("o_orderkey", "is_current")


@query("z08_first_success", "SELECT o_custkey, arg_min(o_totalprice, o_orderkey) FILTER (o_orderstatus = 'P') AS price, count(*) FILTER (o_orderstatus = 'F' AND o_orderkey < coalesce(f, 1e18)) AS n_failures FROM (SELECT *, min(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) OVER (PARTITION BY o_custkey) AS f FROM orders) GROUP BY 1")
def _(t):
    attempts = t("orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")).alias("price"), F.when(F.col("o_orderstatus") == "F", "no").alias("error"))
    out = ingest.first_success(attempts, ["o_custkey"], "o_orderkey", "price", "error")
    return out.select("o_custkey", "price", long(F.size("failures")).alias("n_failures"))


# ------------------------------------------------------------------ facts of nested studies
_SQL_LINES = "WITH x AS (SELECT l_orderkey AS paper_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS j, l_linenumber % 3 AS k, l_quantity FROM lineitem)"


def _studies(t, collection: str, entry, wrap):
    """A study for each order, as JSON: ``wrap`` of the list of its lines' entries. Read once, whatever the number of projections."""
    lines = shared.spread(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"), "l_orderkey")
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")))
    lists = lines.groupBy(F.col("l_orderkey").alias("paper_id")).agg(F.transform(rows, entry).alias("e"))
    made = lists.select("paper_id", F.lit("truth").alias("side"), F.to_json(F.struct(F.array(wrap(F.col("e"))).alias(collection))).alias("document"))
    read = shared.written(facts.read_studies(made), f"{shared.folder(lines.sparkSession)}/studies")
    return read.withColumn("ids", F.create_map().cast("map<string,string>"))


def _value(name: F.Column, number: F.Column, unit: str) -> F.Column:
    return F.struct(name.alias("name"), F.concat_ws(" ", number.cast("string"), F.lit(unit)).alias("raw_value"), number.alias("value_number"), F.lit(unit).alias("unit"))


@query("p11_performance_facts", _SQL_LINES + " SELECT paper_id, '/performance_observations/0/metrics/' || j AS path, ['pce', 'voc', 'scanrate'][(k + 1)::INT] AS name, l_quantity AS number, k < 2 AS has_method FROM x")
def _(t):
    entry = lambda x: _value(F.get(F.array(F.lit("Power conversion efficiency"), F.lit("Voc"), F.lit("JV scan rate")), x["l_linenumber"] % 3), x["l_quantity"], "%")
    rows = facts.performance_facts(_studies(t, "performance_observations", entry, lambda e: F.struct(F.lit("o").alias("observation_id"), F.lit("jv_scan").alias("measurement_type"), e.alias("metrics"))))
    return rows.select("paper_id", "path", "name", F.col("value.value_number").alias("number"), ((F.size("protocol") > 0) | (F.col("name") != "scanrate")).alias("has_method"))


@query("p14_stability_facts", _SQL_LINES + " SELECT paper_id, '/stability_tests/0/checkpoints/' || j || '/time' AS path, 'time' AS name, l_quantity AS number FROM x UNION ALL SELECT paper_id, '/stability_tests/0/checkpoints/' || j || '/outcomes/0', 'efficiencyretention', l_quantity FROM x")
def _(t):
    entry = lambda x: F.struct(F.lit("c").alias("checkpoint_id"), _value(F.lit("time"), x["l_quantity"], "h").alias("time"), F.array(_value(F.lit("PCE retention"), x["l_quantity"], "%")).alias("outcomes"))
    rows = facts.stability_facts(_studies(t, "stability_tests", entry, lambda e: F.struct(F.lit("s").alias("test_id"), e.alias("checkpoints"))))
    return rows.select("paper_id", "path", "name", F.col("value.value_number").alias("number"))


@query("p10_device_facts", _SQL_LINES + " SELECT paper_id, '/individual_devices/0/reported_properties/' || j AS path, ['treatment:duration', 'activearea', 'treatment:temperature'][(k + 1)::INT] AS name FROM x")
def _(t):
    entry = lambda x: _value(F.get(F.array(F.lit("annealing time"), F.lit("Active area"), F.lit("annealing temperature")), x["l_linenumber"] % 3), x["l_quantity"], "s")
    rows = facts.device_facts(_studies(t, "individual_devices", entry, lambda e: F.struct(F.lit("d").alias("device_id"), e.alias("reported_properties"))))
    return rows.select("paper_id", "path", "name")


@query("p09_family_facts", _SQL_LINES + " SELECT paper_id, '/device_families/0/layers/' || j || '/material' AS path, 'material' AS name, ['Au', 'Ag', 'odd stuff'][(k + 1)::INT] AS text FROM x UNION ALL SELECT paper_id, '/device_families/0/layers/' || j || '/role', 'role', 'absorber' FROM x UNION ALL SELECT DISTINCT paper_id, '/device_families/0/polarity', 'polarity', 'n-i-p' FROM x")
def _(t):
    entry = lambda x: F.struct(F.lit("l").alias("layer_id"), F.lit("absorber").alias("role"), F.get(F.array(F.lit("Gold"), F.lit("Ag layer"), F.lit("odd stuff")), x["l_linenumber"] % 3).alias("material"))
    rows = facts.family_facts(_studies(t, "device_families", entry, lambda e: F.struct(F.lit("f").alias("family_id"), F.lit("n-i-p").alias("polarity"), e.alias("layers"))))
    return rows.select("paper_id", "path", "name", "text")
