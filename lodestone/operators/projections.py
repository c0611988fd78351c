"""Nested studies as flat rows for other schemas: metrics that are unique and fit, everything else kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as tx
from lodestone.functions import units as un
from lodestone.functions import vocabulary as vo

# Names of metrics and the units that the flat schema takes.
METRIC_NAMES = {"pce": "pce", "powerconversionefficiency": "pce", "efficiency": "pce", "jsc": "jsc", "shortcircuitcurrentdensity": "jsc", "voc": "voc", "opencircuitvoltage": "voc", "ff": "ff", "fillfactor": "ff"}
CURRENT_UNITS = {"macm2": "mA cm^-2", "acm2": "A cm^-2", "am2": "A m^-2", "mam2": "mA m^-2", "uacm2": "uA cm^-2"}
VOLTAGE_UNITS = {"v": "V", "mv": "mV"}
ROLES = {"substrate": "Substrate", "transparent_electrode": "Contact", "hole_transport_layer": "Hole-transport", "electron_transport_layer": "Electron-transport", "absorber": "Absorber", "back_electrode": "Contact"}


def label_key(text: Column) -> Column:
    """Letters and digits of a label; glyphs of micro, square and minus as plain ones."""
    return F.regexp_replace(F.translate(tx.casefold(text), "µμ²⁻−", "uu2--"), "[^a-z0-9]+", "")


def metric_field(name: Column) -> Column:
    """The metric that a name means; null for others."""
    return vo.lookup(METRIC_NAMES, label_key(name))


def metric_unit(field: Column, unit: Column) -> Column:
    """The unit under which a metric is flattened; null if its unit does not fit."""
    key = label_key(F.coalesce(unit, F.lit("")))
    percent = (unit == "%") | key.isin("percent", "percentage")
    return F.when(field.isin("pce", "ff") & percent, "%").when(field == "jsc", vo.lookup(CURRENT_UNITS, key)).when(field == "voc", vo.lookup(VOLTAGE_UNITS, key))


def project_metrics(values: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(by, pce, pce_unit, jsc, ...) of reported values (by, name, value_number, unit), and what was not
    flattened (by, name, value_number, unit, issue; null for values that are no metric).

    A metric is flattened if a record has exactly one value of it, with a number and a fitting unit."""
    field = metric_field(F.col("name"))
    tagged = values.select(*by, "name", "value_number", "unit", field.alias("field"))
    tagged = tagged.withColumn("fits", F.when(F.col("value_number").isNotNull(), metric_unit(F.col("field"), F.col("unit"))))
    names = sorted(set(METRIC_NAMES.values()))
    counts = tagged.groupBy(*by).agg(*[F.count_if(F.col("field") == n).alias(f"_{n}") for n in names], *[F.max(F.when(F.col("field") == n, F.struct("value_number", "fits"))).alias(n) for n in names])
    good = {n: (F.col(f"_{n}") == 1) & F.col(f"{n}.fits").isNotNull() for n in names}
    flat = counts.select(*by, *[F.when(good[n], F.col(f"{n}.value_number")).alias(n) for n in names], *[F.when(good[n], F.col(f"{n}.fits")).alias(f"{n}_unit") for n in names])
    sizes = tagged.where("field is not null").groupBy(*by, "field").agg(F.count("*").alias("_n"))
    rest = tagged.join(sizes, [*by, "field"], "left")
    issue = F.when(F.col("field").isNull(), None).when(F.col("_n") > 1, "ambiguous_metric").when(F.col("fits").isNull(), "incompatible_metric_unit").otherwise("")
    return flat, rest.withColumn("issue", issue).where("issue is null or issue <> ''").select(*by, "name", "value_number", "unit", "issue")


def converted_metrics(values: DataFrame, by: list[str], units: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Like ``project_metrics``, with any unit that converts to the field's unit in ``units``; percent takes percent only."""
    tagged = values.select(*by, "name", "value_number", "unit", metric_field(F.col("name")).alias("field")).withColumn("_u", un.unit(F.col("unit")))
    number = F.lit(None).cast("double")
    for field, unit in units.items():
        target = un.read_unit(unit)
        fixed = F.struct(F.lit(float(target.scale)).alias("scale"), F.lit(float(target.offset)).alias("offset"), F.lit(target.dims).alias("dims"))
        own = F.when((F.trim("unit") == "%") | label_key(F.col("unit")).isin("percent", "percentage"), F.col("value_number")) if unit == "percent" else un.converted(F.col("value_number"), F.col("_u"), fixed)
        number = F.when(F.col("field") == field, own).otherwise(number)
    tagged = tagged.withColumn("number", number)
    flat = tagged.groupBy(*by).agg(*[F.when(F.count_if(F.col("field") == f) == 1, F.max(F.when(F.col("field") == f, F.col("number")))).alias(f) for f in units])
    sizes = tagged.where("field is not null").groupBy(*by, "field").agg(F.count("*").alias("_n"))
    rest = tagged.join(sizes, [*by, "field"], "left").withColumn("issue", F.when(F.col("field").isNull(), None).when(F.col("_n") > 1, "ambiguous_metric").when(F.col("number").isNull(), "incompatible_metric").otherwise(""))
    return flat, rest.where("issue is null or issue <> ''").select(*by, "name", "value_number", "unit", "issue")


def unique_value(values: Column, names: list[str]) -> Column:
    """The one value of an array whose name's letters and digits are among ``names``; null for none or several."""
    found = F.filter(values, lambda v: label_key(v["name"]).isin(*names))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def stability_summary(points: DataFrame, by: list[str], order: str) -> DataFrame:
    """(by, hours, pce_at_start, pce_at_end, pce_after_1000_hours) of checkpoints (by, order, hours, pce): the start
    counts only at 0 hours, the last checkpoint gives the duration, and 1000 hours must be stated exactly."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("hours").alias("h"), F.col("pce").alias("p"))))
    held = points.groupBy(*by).agg(rows.alias("_r"))
    first, last = F.get("_r", F.lit(0)), F.element_at("_r", -1)
    later = F.filter("_r", lambda x: (x["h"] == 1000) & x["p"].isNotNull())
    return held.select(*by, last["h"].alias("hours"), F.when(first["h"] == 0, first["p"]).alias("pce_at_start"), last["p"].alias("pce_at_end"), F.when(F.size(later) > 0, F.element_at(later, -1)["p"]).alias("pce_after_1000_hours"))


def step_payload(step: Column) -> Column:
    """A processing step as JSON that loses nothing: name, materials and conditions."""
    return F.to_json(F.struct(step["operation"].alias("step_name"), step["step_id"].alias("source_step_id"), step["materials"].alias("materials"), step["conditions"].alias("conditions")))


def aggregation_label(statistic: Column, champion: Column, measurement: Column) -> Column:
    """How a flat row's values came about: certified, stabilized, champion, a statistic, or unknown."""
    return F.when(measurement == "certified_measurement", "certified").when(measurement == "stabilized_power_output", "stabilized").when(champion == "yes", "champion").when(~tx.missing(statistic), statistic)


def schema_relevant(figure_class: Column, presentation: Column) -> Column:
    """Whether a panel counts by default: device diagrams do, result plots only with printed values or a table."""
    plots = figure_class.isin("jv", "eqe", "population_statistics", "stability") & presentation.isin("explicit_numeric_labels", "inset_table", "mixed")
    return (figure_class == "device_structure") | plots


def rectangle_gap(picture: list[Column], caption: list[Column], height: Column, least: float = 0.25) -> Column:
    """How far a caption is below or above a picture on a page, as a share of its height; null unless they
    overlap sideways by ``least`` of the narrower one. Rectangles are (x0, y0, x1, y1)."""
    shared = F.least(picture[2], caption[2]) - F.greatest(picture[0], caption[0])
    narrow = F.least(picture[2] - picture[0], caption[2] - caption[0])
    gap = F.greatest(caption[1] - picture[3], picture[1] - caption[3], F.lit(0.0))
    return F.when((narrow > 0) & (shared / narrow >= least), gap / height)
