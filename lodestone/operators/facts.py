"""Studies as flat facts with their context, and the agreement of two studies' facts.

A study is a nested record of one paper: families of devices with layers, absorbers and processing
steps; devices; observations; populations; stability tests. A fact is one reported value or text with
its owner, its name and the context that it needs to mean the same. Fields and rules that are not
projected: absorber links of layer properties, scopes of repeated steps, and treatment identities
beyond the stated conditions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import quantities as qt
from lodestone.functions import text as tx
from lodestone.functions import units as un
from lodestone.functions import vocabulary as vo
from lodestone.operators import linkage, metrics

VALUE = "struct<name:string,raw_value:string,value_number:double,unit:string>"
_PART = f"struct<name:string,role:string,amount:{VALUE}>"
_SUBJECT = f"struct<treatment_stage:string,treated_material:string,conditions:array<{VALUE}>>"
_LAYER = f"struct<layer_id:string,sequence:int,role:string,material:string,constituents:array<{_PART}>,material_form:string,reported_properties:array<{VALUE}>>"
_ABSORBER = f"struct<absorber_id:string,layer_id:string,label:string,formula:{VALUE},properties:array<{VALUE}>,constituents:array<{_PART}>>"
_STEP = f"struct<step_id:string,sequence:int,operation:string,target_layer_ids:array<string>,materials:array<string>,conditions:array<{VALUE}>>"
_FAMILY = f"struct<family_id:string,label:string,variant:string,architecture:string,polarity:string,full_stack_raw:string,layers:array<{_LAYER}>,absorbers:array<{_ABSORBER}>,processing_steps:array<{_STEP}>>"
_DEVICE = f"struct<device_id:string,family_id:string,label:string,variant:string,champion_status:string,selection_basis:string,subject_context:{_SUBJECT},reported_properties:array<{VALUE}>>"
_OBSERVATION = f"struct<observation_id:string,device_id:string,measurement_type:string,scan_direction:string,measurement_conditions:array<{VALUE}>,metrics:array<{VALUE}>>"
_POPULATION = f"struct<population_id:string,family_id:string,label:string,statistic_type:string,sample_size:int,subjects:array<{_SUBJECT}>,error_bar_type:string,measurement_type:string,scan_direction:string,measurement_conditions:array<{VALUE}>,metrics:array<{VALUE}>>"
_CHECKPOINT = f"struct<checkpoint_id:string,time:{VALUE},conditions:array<{VALUE}>,outcomes:array<{VALUE}>>"
_TEST = f"struct<test_id:string,family_id:string,device_id:string,specimen_label:string,link_status:string,conditions:array<{VALUE}>,checkpoints:array<{_CHECKPOINT}>>"
STUDY = f"struct<device_families:array<{_FAMILY}>,individual_devices:array<{_DEVICE}>,performance_observations:array<{_OBSERVATION}>,population_statistics:array<{_POPULATION}>,stability_tests:array<{_TEST}>>"
# Collections with the field that identifies a record.
RECORDS = {"device_families": "family_id", "individual_devices": "device_id", "performance_observations": "observation_id", "population_statistics": "population_id", "stability_tests": "test_id"}
_KEY = ["paper_id", "side"]
_UNMATCHED = "unmatched:"
#: Facts of a paper's concept on both sides beyond which scoring is refused rather than cut.
MOST_PAIRS = 1_000_000


def read_studies(rows: DataFrame, document: str = "document") -> DataFrame:
    """(paper_id, side, study) of JSON documents; a text that is no JSON object is an error."""
    return rows.select(*_KEY, F.from_json(document, STUDY, {"mode": "FAILFAST"}).alias("study"))


def with_identities(studies: DataFrame, identities: DataFrame) -> DataFrame:
    """``studies`` with ids: a map of kind:id to the key of the record's pair.

    ``identities``: (paper_id, kind, truth_id, prediction_id). A record without a pair has no entry."""
    key = F.concat_ws(":", "kind", "truth_id")
    rows = reduce(DataFrame.union, [identities.select("paper_id", F.lit(side).alias("side"), F.concat_ws(":", "kind", f"{side}_id").alias("own"), key.alias("key")) for side in ("truth", "prediction")])
    maps = rows.groupBy(*_KEY).agg(F.map_from_entries(F.collect_set(F.struct("own", "key"))).alias("ids"))
    return studies.join(maps, _KEY, "left").withColumn("ids", F.coalesce("ids", F.create_map().cast("map<string,string>")))


def reference(kind: str, identifier: Column) -> Column:
    """The key of the record's pair; a record without one has a key of its own side."""
    own = F.concat(F.lit(f"{kind}:"), identifier)
    return F.coalesce(F.try_element_at("ids", own), F.concat(F.lit(_UNMATCHED), F.col("side"), F.lit("|"), own))


def _written(values: Column) -> Column:
    """An unordered list of values as one text."""
    return F.to_json(F.array_sort(F.transform(values, lambda v: F.struct(vo.property_name(v["name"]).alias("n"), vo.formula_text(v["raw_value"]).alias("r"), v["unit"].alias("u")))))


def _subject(subject: Column) -> Column:
    return F.when(subject.isNotNull(), F.to_json(F.struct(subject["treatment_stage"].alias("stage"), vo.material_name(subject["treated_material"]).alias("material"), _written(subject["conditions"]).alias("conditions"))))


def _context(**parts: Column) -> Column:
    return F.create_map(*[x for name, value in parts.items() for x in (F.lit(name), value.cast("string"))])


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _rows(df: DataFrame, group: str, path: Column, owner: Column, name: Column, context: Column, value: Column | None = None, text: Column | None = None, protocol: Column | None = None, kind: Column | None = None) -> DataFrame:
    """Facts of one field; empty texts, and values and texts that are not reported, are none."""
    out = df.select(
        *_KEY, F.lit(group).alias("source"), path.alias("path"), owner.alias("owner"), name.alias("name"), (value if value is not None else _none(VALUE)).cast(VALUE).alias("value"), (text if text is not None else _none("string")).cast("string").alias("text"),
        context.cast("map<string,string>").alias("context"), (protocol if protocol is not None else F.array()).cast(f"array<{VALUE}>").alias("protocol"), (kind if kind is not None else _none("string")).alias("measurement"),
    )
    placeholder = F.lower(F.trim("value.raw_value")).isin("not_reported", "not reported") & F.col("value.value_number").isNull() & F.col("value.unit").isNull()
    return out.where(~tx.missing(F.col("text")) | (F.col("value.raw_value").isNotNull() & ~F.coalesce(placeholder, F.lit(False))))


def _collection(studies: DataFrame, name: str) -> DataFrame:
    """A row for each record: r, path, owner, and the study's devices."""
    out = studies.select(*_KEY, "ids", F.col("study.individual_devices").alias("devices"), F.posexplode(f"study.{name}").alias("_i", "r"))
    return out.withColumn("path", F.concat(F.lit(f"/{name}/"), F.col("_i").cast("string"))).withColumn("owner", reference(name, F.col(f"r.{RECORDS[name]}")))


def _each(df: DataFrame, array: str, name: str) -> DataFrame:
    """A row for each entry of an array, with its place in the path."""
    return df.select("*", F.posexplode(array).alias(f"_{name}_i", name)).withColumn(f"{name}_path", F.concat("path", F.lit("/" + array.split(".", 1)[-1].replace(".", "/") + "/"), F.col(f"_{name}_i").cast("string")))


def _family_facts(studies: DataFrame) -> list[DataFrame]:
    families = _collection(studies, "device_families")
    none = F.create_map()
    out = [_rows(families, "stack", F.concat("path", F.lit("/polarity")), F.col("owner"), F.lit("polarity"), none, text=F.col("r.polarity"))]
    out.append(_rows(families.where(F.coalesce(F.size("r.layers"), F.lit(0)) <= 0), "stack", F.concat("path", F.lit("/full_stack_raw")), F.col("owner"), F.lit("stack"), none, text=F.coalesce(F.nullif("r.full_stack_raw", F.lit("")), F.col("r.architecture"))))
    each, named = _each(families, "r.layers", "layer"), vo.material_name(F.col("layer.material"))
    place = _context(layer_sequence=F.col("layer.sequence"), layer_material=F.col("material"))
    fields = F.array(*[F.struct(F.lit(name).alias("field"), text.alias("text")) for name, text in (("material", F.col("material")), ("role", F.col("layer.role")), ("material_form", F.col("layer.material_form")))])
    fields = each.withColumn("material", named).select(*_KEY, "layer_path", "owner", F.col("layer.sequence").alias("sequence"), "material", fields.alias("_a"))
    fields = fields.select("*", F.explode("_a").alias("_f"))
    at = _context(layer_sequence=F.col("sequence"))
    own = F.when(F.col("_f.field") == "material", at).otherwise(F.map_concat(at, _context(layer_material=F.col("material"))))
    out.append(_rows(fields, "stack", F.concat("layer_path", F.lit("/"), "_f.field"), F.col("owner"), F.col("_f.field"), own, text=F.col("_f.text")))
    # a layer's material is read where there is something to place in it
    properties = each.select("*", F.posexplode("layer.reported_properties").alias("_j", "v")).withColumn("material", named)
    out.append(_rows(properties, "stack", F.concat("layer_path", F.lit("/reported_properties/"), F.col("_j").cast("string")), F.col("owner"), vo.property_name(vo.scoped_property(F.col("v.name"), F.col("layer.material"))), place, value=F.col("v")))
    out += _part_facts(each, "layer", _context(layer_sequence=F.col("layer.sequence"), layer_material=named))
    absorbers = _each(families, "r.absorbers", "absorber")
    count = F.size("r.absorbers")
    link = _context(absorber=F.when(count > 1, tx.scientific_text(F.col("absorber.label"))))
    out.append(_rows(absorbers, "composition", F.concat("absorber_path", F.lit("/formula")), F.col("owner"), F.lit("formula"), link, value=F.col("absorber.formula")))
    properties = absorbers.select("*", F.posexplode("absorber.properties").alias("_j", "v"))
    out.append(_rows(properties, "composition", F.concat("absorber_path", F.lit("/properties/"), F.col("_j").cast("string")), F.col("owner"), vo.property_name(F.col("v.name")), link, value=F.col("v")))
    out += _part_facts(absorbers, "absorber", link)
    steps = _each(families, "r.processing_steps", "step").withColumn("operation", operation_name(F.col("step.operation")))
    targets = F.to_json(F.array_sort(F.transform("step.target_layer_ids", lambda t: vo.material_name(F.get(F.filter("r.layers", lambda x: x["layer_id"] == t), F.lit(0))["material"]))))
    scope = _context(step_sequence=F.col("step.sequence"), operation=F.col("operation"), target_layers=targets)
    out.append(_rows(steps, "processing", F.concat("step_path", F.lit("/operation")), F.col("owner"), F.lit("operation"), _context(step_sequence=F.col("step.sequence"), target_layers=targets), text=F.col("operation")))
    materials = steps.select("*", F.posexplode("step.materials").alias("_j", "m"))
    out.append(_rows(materials, "processing", F.concat("step_path", F.lit("/materials/"), F.col("_j").cast("string")), F.col("owner"), F.lit("material"), scope, text=vo.material_name(F.col("m"))))
    conditions = steps.select("*", F.posexplode("step.conditions").alias("_j", "v"))
    out.append(_rows(conditions, "processing", F.concat("step_path", F.lit("/conditions/"), F.col("_j").cast("string")), F.col("owner"), vo.condition_name(F.col("v.name"), F.col("operation")), scope, value=F.col("v")))
    return out


def operation_name(operation: Column) -> Column:
    """An operation under its usual name; sonication is told from other cleaning."""
    own = tx.casefold(tx.scientific_text(operation))
    own = F.coalesce(vo.lookup({"thermal annealing": "annealing", "annealed": "annealing", "spincoating": "spin coating", "spin_coating": "spin coating", "spin-coating": "spin coating"}, own), own)
    return F.when(own.isin("ultrasonic cleaning", "cleaning by sonication"), "sonication cleaning").otherwise(own)


def _part_facts(df: DataFrame, name: str, context: Column) -> list[DataFrame]:
    """Facts of constituents: name, role and amount; a precursor's belong to the recipe."""
    parts = df.select("*", F.posexplode(f"{name}.constituents").alias("_j", "c"))
    base = F.concat(F.col(f"{name}_path"), F.lit("/constituents/"), F.col("_j").cast("string"))
    stage = F.map_concat(context, _context(material_stage=vo.material_stage(F.col("c.role"))))
    known = F.map_concat(stage, _context(name=vo.material_name(F.col("c.name"))))
    amount = F.concat(F.lit("constituent_amount:"), vo.property_name(F.col("c.amount.name")))
    return [
        _rows(parts, "composition", F.concat(base, F.lit("/name")), F.col("owner"), F.lit("constituent"), stage, text=vo.material_name(F.col("c.name"))),
        _rows(parts, "composition", F.concat(base, F.lit("/role")), F.col("owner"), F.lit("constituent_role"), known, text=vo.material_role(F.col("c.role"))),
        _rows(parts, "composition", F.concat(base, F.lit("/amount")), F.col("owner"), amount, known, value=F.col("c.amount")),
    ]


def _treatment_facts(df: DataFrame, subject: str, path: Column, context: Column) -> list[DataFrame]:
    rows = df.where(F.col(subject).isNotNull())
    conditions = rows.withColumn("_p", path).select("*", F.posexplode(f"{subject}.conditions").alias("_j", "v"))
    name = F.concat(F.lit("treatment:"), F.coalesce(vo.treatment_name(F.col("v.name")), vo.property_name(F.col("v.name"))))
    return [
        _rows(rows, "processing", F.concat(path, F.lit("/treatment_stage")), F.col("owner"), F.lit("treatment_stage"), context, text=F.col(f"{subject}.treatment_stage")),
        _rows(rows, "processing", F.concat(path, F.lit("/treated_material")), F.col("owner"), F.lit("treated_material"), context, text=vo.material_name(F.col(f"{subject}.treated_material"))),
        _rows(conditions, "processing", F.concat("_p", F.lit("/conditions/"), F.col("_j").cast("string")), F.col("owner"), name, context, value=F.col("v")),
    ]


def _device_facts(studies: DataFrame) -> list[DataFrame]:
    devices = _collection(studies, "individual_devices")
    context = _context(family_id=reference("device_families", F.col("r.family_id")), variant=F.col("r.variant"))
    own = devices.select("*", F.posexplode("r.reported_properties").alias("_j", "v"))
    name = vo.let(vo.treatment_name(F.col("v.name")), lambda treated: F.coalesce(F.concat(F.lit("treatment:"), treated), vo.property_name(F.col("v.name"))))
    out = [_rows(own, "processing", F.concat("path", F.lit("/reported_properties/"), F.col("_j").cast("string")), F.col("owner"), name, context, value=F.col("v"))]
    return out + _treatment_facts(devices, "r.subject_context", F.concat("path", F.lit("/subject_context")), _context(family_id=reference("device_families", F.col("r.family_id")), subject_context=_subject(F.col("r.subject_context"))))


def device_context(identifier: Column) -> Column:
    """What a specimen brings into its outcomes: its key, family, variant, selection and treatment."""
    device = F.get(F.filter("devices", lambda d: d["device_id"] == identifier), F.lit(0))
    return _context(
        device_id=reference("individual_devices", identifier), family_id=F.when(device["family_id"].isNotNull(), reference("device_families", device["family_id"])), variant=device["variant"],
        champion_status=device["champion_status"], selection_basis=device["selection_basis"], subject_context=_subject(device["subject_context"]),
    )


def _outcomes(df: DataFrame, group: str, context: Column) -> list[DataFrame]:
    """Facts of metrics and conditions of an observation or population. Conditions among the metrics are conditions."""
    protocol = F.concat(F.coalesce("r.measurement_conditions", F.array().cast(f"array<{VALUE}>")), F.filter(F.coalesce("r.metrics", F.array().cast(f"array<{VALUE}>")), lambda m: vo.protocol_name(m["name"]).isNotNull()))
    metrics_ = _each(df.withColumn("_c", context).withColumn("_o", protocol), "r.metrics", "v")
    named = vo.metric_parts(F.col("v.name"), lambda u: un.unit(u)["dims"])
    metrics_ = metrics_.withColumn("_m", named).withColumn("_p", vo.protocol_name(F.col("v.name")))
    stated = F.map_from_entries(F.filter(F.array(F.struct(F.lit("statistic_type").alias("k"), F.col("_m.statistic").alias("v")), F.struct(F.lit("measurement_type").alias("k"), F.col("_m.method").alias("v"))), lambda e: e["v"].isNotNull()))
    full = F.map_concat(F.map_filter("_c", lambda k, v: ~F.array_contains(F.map_keys(stated), k)), stated)
    name = vo.performance_name(F.col("_m.metric"), F.col("_p"), F.col("r.measurement_type"))
    # a unit in the name, or percentage points for bare shares, as the value's unit
    unit = F.when(F.nullif("v.unit", F.lit("")).isNotNull(), F.col("v.unit")).when(F.col("_m.unit").isNotNull(), F.col("_m.unit")).when(name.isin("pce", "ff") & qt.bare_number(F.col("v.raw_value")), "%")
    value = F.struct(F.col("v.name").alias("name"), F.col("v.raw_value").alias("raw_value"), F.col("v.value_number").alias("value_number"), unit.alias("unit"))
    measured = F.col("_p").isNull()  # the others are conditions
    out = [_rows(
        metrics_, group, F.col("v_path"), F.col("owner"), name, F.when(measured, full).otherwise(F.col("_c")), value=F.when(measured, value).otherwise(F.col("v").cast(VALUE)),
        protocol=F.when(measured, F.col("_o")).otherwise(F.array().cast(f"array<{VALUE}>")), kind=F.when(measured, F.col("r.measurement_type")),
    )]
    conditions = _each(df.withColumn("_c", context), "r.measurement_conditions", "v")
    out.append(_rows(conditions, group, F.col("v_path"), F.col("owner"), F.coalesce(vo.protocol_name(F.col("v.name")), vo.property_name(F.col("v.name"))), F.col("_c"), value=F.col("v")))
    return out


def _performance_facts(studies: DataFrame) -> list[DataFrame]:
    rows = _collection(studies, "performance_observations")
    own = _context(statistical_level=F.lit("individual"), measurement_type=F.col("r.measurement_type"), scan_direction=F.col("r.scan_direction"))
    return _outcomes(rows, "performance", F.map_concat(device_context(F.col("r.device_id")), own))


def _population_facts(studies: DataFrame) -> list[DataFrame]:
    rows = _collection(studies, "population_statistics")
    code = tx.sample_code(F.col("r.label"), F.lit(None).cast("string"))
    label = F.when(code.isNotNull(), F.concat(F.lit("sample:"), code)).otherwise(tx.scientific_text(F.col("r.label")))
    subjects = F.to_json(F.array_sort(F.transform(F.coalesce("r.subjects", F.array().cast(f"array<{_SUBJECT}>")), _subject)))
    context = _context(statistical_level=F.lit("population"), family_id=reference("device_families", F.col("r.family_id")), label=label, subjects=subjects)
    full = F.map_concat(context, _context(sample_size=F.col("r.sample_size"), statistic_type=F.col("r.statistic_type"), measurement_type=F.col("r.measurement_type"), scan_direction=F.col("r.scan_direction")))
    out = [
        _rows(rows, "population", F.concat("path", F.lit("/sample_size")), F.col("owner"), F.lit("sample_size"), context, text=F.col("r.sample_size")),
        _rows(rows, "population", F.concat("path", F.lit("/error_bar_type")), F.col("owner"), F.lit("errorbarstatistic"), context, text=vo.error_bar_statistic(F.col("r.error_bar_type"))),
    ]
    each = _each(rows, "r.subjects", "subject")
    return out + _outcomes(rows, "population", full) + _treatment_facts(each, "subject", F.col("subject_path"), _context(subject_context=_subject(F.col("subject"))))


def _stability_facts(studies: DataFrame) -> list[DataFrame]:
    rows = _collection(studies, "stability_tests")
    context = F.map_concat(device_context(F.col("r.device_id")), _context(test_family=reference("device_families", F.col("r.family_id")), link_status=F.col("r.link_status"), specimen=F.when(F.col("r.device_id").isNull(), tx.scientific_text(F.col("r.specimen_label")))))
    own = _each(rows.withColumn("_c", context), "r.conditions", "v")
    out = [_rows(own, "stability", F.col("v_path"), F.col("owner"), vo.property_name(F.col("v.name")), F.col("_c"), value=F.col("v"))]
    tested = F.map_concat(context, _context(test_conditions=_written(F.col("r.conditions"))))
    points = _each(rows.withColumn("_c", tested), "r.checkpoints", "point")
    time = _context(time=F.concat_ws(" ", vo.formula_text(F.col("point.time.raw_value")), "point.time.unit"))
    state = _context(checkpoint_conditions=_written(F.col("point.conditions")))
    out.append(_rows(points, "stability", F.concat("point_path", F.lit("/time")), F.col("owner"), F.lit("time"), F.map_concat("_c", state), value=F.col("point.time")))
    for field, more in (("conditions", time), ("outcomes", F.map_concat(time, state))):
        values = points.withColumn("_d", F.map_concat("_c", more)).select("*", F.posexplode(f"point.{field}").alias("_j", "v"))
        out.append(_rows(values, "stability", F.concat("point_path", F.lit(f"/{field}/"), F.col("_j").cast("string")), F.col("owner"), vo.property_name(F.col("v.name")), F.col("_d"), value=F.col("v")))
    return out


def _united(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def family_facts(studies: DataFrame) -> DataFrame:
    """Facts of designs: stack, layers, absorbers, constituents and processing steps."""
    return _united(_family_facts(studies))


def device_facts(studies: DataFrame) -> DataFrame:
    """Facts of specimens: how each was prepared."""
    return _united(_device_facts(studies))


def performance_facts(studies: DataFrame) -> DataFrame:
    """Facts of observations: metrics and conditions, in the context of the specimen."""
    return _united(_performance_facts(studies))


def population_facts(studies: DataFrame) -> DataFrame:
    """Facts of cohorts: sizes, statistics and conditions."""
    return _united(_population_facts(studies))


def stability_facts(studies: DataFrame) -> DataFrame:
    """Facts of tests: conditions, times and outcomes of checkpoints."""
    return _united(_stability_facts(studies))


def facts(studies: DataFrame) -> DataFrame:
    """The facts of studies (paper_id, side, study, ids), each read as a claim, with the space and name of its
    concept, the field and the domain in which it counts. Null collections are empty."""
    parts = [x for build in (_family_facts, _device_facts, _performance_facts, _population_facts, _stability_facts) for x in build(studies)]
    rows = reduce(DataFrame.unionByName, parts)
    stage = F.try_element_at("context", F.lit("material_stage"))
    outcome = F.contains("path", F.lit("/outcomes/"))
    rows = rows.withColumn("claim", qt.claim(F.col("value.raw_value"), F.col("value.value_number"), F.col("value.unit")))
    strange = F.contains("path", F.lit("/measurement_conditions/")) & vo.protocol_name(F.col("name")).isNull()
    rows = rows.withColumn("space", F.when(strange, "measurement_condition").otherwise(vo.concept_space(F.col("source"), F.col("name"), stage, outcome))).withColumn("concept", vo.concept_name(F.col("source"), F.col("name")))
    literal = F.when(F.col("claim.kind") == "literal", F.col("claim.text"))
    rows = rows.withColumn("subfield", vo.fact_subfield(F.col("source"), F.col("name"), F.col("path"), stage, literal)).withColumn("domain", vo.fact_domain(F.col("space")))
    strata = [F.coalesce(F.nullif(F.try_element_at("context", F.lit(x)), F.lit("")), F.lit("not_reported")) for x in ("statistical_level", "statistic_type", "measurement_type")]
    field = F.concat_ws(":", "space", "concept")
    return rows.withColumn("field", field).withColumn("stratum", F.concat_ws("|", field, *strata)).drop("measurement")


# Contexts that photovoltaic outcomes need, and those that count only where both sides state them.
INDIVIDUAL = ("device_id", "family_id", "champion_status", "subject_context", "statistical_level", "measurement_type", "scan_direction")
POPULATION = ("family_id", "label", "subjects", "statistical_level", "statistic_type", "measurement_type", "scan_direction", "sample_size")


def _is_missing(value: Column) -> Column:
    return value.isNull() | value.isin("", "not_reported", "[]") | value.startswith(_UNMATCHED)


def context_issues(left: str = "a", right: str = "b", relative: float = 0.01, absolute: float = 0.0) -> Column:
    """Array of (name, reason) in which the contexts of two facts (structs) differ; reason is missing_required or
    conflict.

    Photovoltaic outcomes need their rule's names only. Of those a missing scan direction, method,
    treatment or cohort of the reference (left) asks nothing, a missing champion flag on either side
    nothing, and a sample size counts if both have one. Conditions of the measurement that the
    reference states are needed, others not."""
    a, b = F.col(left), F.col(right)
    solar = (a["space"] == "measurement") & a["concept"].isin(*vo.METRICS)
    level = F.try_element_at(a["context"], F.lit("statistical_level"))
    rule = F.when(solar & (level == "individual"), F.array(*map(F.lit, INDIVIDUAL))).when(solar & (level == "population"), F.array(*map(F.lit, POPULATION)))
    names = F.coalesce(rule, F.array_union(F.map_keys(a["context"]), F.map_keys(b["context"])))

    def differs(name: Column) -> Column:
        x, y = F.try_element_at(a["context"], name), F.try_element_at(b["context"], name)
        lenient = rule.isNotNull() & (
            (name.isin("scan_direction", "measurement_type", "subject_context", "subjects", "champion_status") & _is_missing(x)) | ((name == "measurement_type") & (x == "other"))
            | ((name == "champion_status") & _is_missing(y)) | ((name == "sample_size") & (x.isNull() | y.isNull()))
        )
        known = F.map_contains_key(a["context"], name) & F.map_contains_key(b["context"], name)
        # values that are missing on both sides agree, as equal ones do
        reason = F.when(_is_missing(x) | _is_missing(y) | ~known, "missing_required").otherwise("conflict")
        return F.struct(name.alias("name"), F.when(F.coalesce(lenient, F.lit(False)) | (x.eqNullSafe(y) & (~F.coalesce(x.startswith(_UNMATCHED), F.lit(False)))), None).otherwise(reason).alias("reason"))

    found = F.filter(F.transform(names, differs), lambda d: d["reason"].isNotNull())
    owner = F.when((a["owner"] != b["owner"]) | a["owner"].startswith(_UNMATCHED), F.array(F.struct(F.lit("owner").alias("name"), F.when(a["owner"].startswith(_UNMATCHED) | b["owner"].startswith(_UNMATCHED), "missing_required").otherwise("conflict").alias("reason"))))
    protocol = F.when(rule.isNotNull(), F.transform(F.filter(a["protocol"], lambda p: ~F.exists(b["protocol"], lambda q: _same_condition(p, q))), lambda p: F.struct(
        F.concat(F.lit("protocol:"), vo.property_name(p["name"])).alias("name"), F.when(F.exists(b["protocol"], lambda q: vo.property_name(q["name"]) == vo.property_name(p["name"])), "conflict").otherwise("missing_required").alias("reason"))))
    none = F.array().cast("array<struct<name:string,reason:string>>")
    return F.concat(*[F.coalesce(x, none) for x in (found, owner, protocol)])


def _same_condition(p: Column, q: Column) -> Column:
    """One name, and the same text and unit, or numbers that differ by a rounding error."""
    text = (vo.formula_text(p["raw_value"]) == vo.formula_text(q["raw_value"])) & p["unit"].eqNullSafe(q["unit"])
    number = qt.close(p["value_number"], q["value_number"], 0.01) & p["unit"].eqNullSafe(q["unit"])
    return (vo.property_name(p["name"]) == vo.property_name(q["name"])) & (text | number)


def compared(rows: DataFrame, relative: float = 0.01, absolute: float = 0.0) -> DataFrame:
    """(paper_id, field, a, b, value_equal, issues): every pair of truth and prediction facts of one paper and
    concept. More than MOST_PAIRS pairs of one concept are an error, as no score is made of a part."""
    keys = ["paper_id", "space", "concept"]
    wanted = ["path", "owner", "space", "concept", "text", "claim", "context", "protocol", "domain", "subfield", "field", "stratum"]
    sides = [rows.where(F.col("side") == side).select(*keys, F.struct(*wanted).alias(name)) for side, name in (("truth", "a"), ("prediction", "b"))]
    sizes = [x.groupBy(*keys).agg(F.count("*").alias(n)) for x, n in zip(sides, ("_n", "_m"))]
    limit = sizes[0].join(sizes[1], keys).select(*keys, F.when(F.col("_n") * F.col("_m") > MOST_PAIRS, F.raise_error(F.concat_ws(" ", F.lit("too many candidate pairs of"), *keys))).alias("_over"))
    both = sides[0].join(sides[1], keys).join(limit, keys)
    same = F.when(F.col("a.text").isNotNull() & F.col("b.text").isNotNull(), vo.formula_text(F.col("a.text")) == vo.formula_text(F.col("b.text"))).when(F.col("a.text").isNull() & F.col("b.text").isNull(), qt.equal_claims(F.col("a.claim"), F.col("b.claim"), relative, absolute))
    return both.where("_over is null").select("paper_id", F.col("a.field").alias("field"), "a", "b", F.coalesce(same, F.lit(False)).alias("value_equal"), context_issues(relative=relative, absolute=absolute).alias("issues"))


def matches(pairs: DataFrame, view: str = "attributed") -> DataFrame:
    """(paper_id, field, truth_path, predicted_path, domain, subfield, stratum): the most one-to-one matches of pairs
    with equal values (view recovery) and, attributed, without issues of context."""
    fit = F.col("value_equal") if view == "recovery" else F.col("value_equal") & (F.size("issues") == 0)
    rows = pairs.where(fit).select("paper_id", "field", F.col("a.path").alias("truth_path"), F.col("b.path").alias("predicted_path"), F.lit(1.0).alias("score"))
    found = linkage.one_to_one(rows, ["paper_id", "field"], "truth_path", "predicted_path", "score")
    kinds = pairs.select("paper_id", F.col("a.path").alias("truth_path"), "a.domain", "a.subfield", "a.stratum").distinct()
    return found.drop("score").join(kinds, ["paper_id", "truth_path"])


def view(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(paper_id, by, key, predicted, truth, matched, precision, recall, f1) by domain, subfield, field, stratum and all.

    A matched prediction counts in the stratum of its reference."""
    own = rows.join(found.select("paper_id", F.col("predicted_path").alias("path"), F.col("stratum").alias("_s"), F.lit("prediction").alias("side")), ["paper_id", "side", "path"], "left").withColumn("stratum", F.coalesce("_s", "stratum"))
    total = F.lit("all").alias("all")
    parts = []
    for by in ("domain", "subfield", "field", "stratum", "all"):
        key = total if by == "all" else F.col(by)
        counts = own.groupBy("paper_id", key.alias("key")).agg(F.count_if(F.col("side") == "prediction").alias("predicted"), F.count_if(F.col("side") == "truth").alias("truth"))
        hits = found.groupBy("paper_id", key.alias("key")).agg(F.count("*").alias("matched"))
        parts.append(counts.join(hits, ["paper_id", "key"], "left").fillna(0, ["matched"]).withColumn("by", F.lit(by)))
    return metrics.precision_recall(reduce(DataFrame.unionByName, parts), "predicted", "truth", "matched")


def blockers(rows: DataFrame, pairs: DataFrame, found: DataFrame) -> DataFrame:
    """(paper_id, side, path, state): why a fact has no match: matched, no_candidate (no fact of its concept), no_equal_value,
    missing_context, conflicting_context, or assignment (all fitting ones are taken)."""
    out = []
    for side, own, name in (("truth", "a", "truth_path"), ("prediction", "b", "predicted_path")):
        missing = F.exists("issues", lambda d: d["reason"] == "missing_required") & ~F.exists("issues", lambda d: d["reason"] == "conflict")
        tried = pairs.groupBy("paper_id", F.col(f"{own}.path").alias("path")).agg(F.bool_or("value_equal").alias("_v"), F.bool_or(F.col("value_equal") & (F.size("issues") == 0)).alias("_f"), F.bool_or(F.col("value_equal") & missing).alias("_m"))
        hit = found.select("paper_id", F.col(name).alias("path")).withColumn("_hit", F.lit(True))
        both = rows.where(F.col("side") == side).select("paper_id", "side", "path").join(tried, ["paper_id", "path"], "left").join(hit, ["paper_id", "path"], "left")
        state = F.when(F.col("_hit"), "matched").when(F.col("_v").isNull(), "no_candidate").when(~F.col("_v"), "no_equal_value").when(F.col("_f"), "assignment").when(F.col("_m"), "missing_context").otherwise("conflicting_context")
        out.append(both.select("paper_id", "side", "path", state.alias("state")))
    return out[0].union(out[1])
