"""Which record of one study is which of the other: families first, then devices, then what was measured.

Two records are compared by what identifies them and by their protocol, never by their outcomes. A
pair of parents supports their children: the assignment of one stage is evidence of the next. Each
stage joins the records of a paper that nothing tells apart, scores the pairs in columns, and assigns
them one to one within (paper, kind)."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from lodestone.functions import quantities as qt
from lodestone.functions import text as tx
from lodestone.functions import vocabulary as vo
from lodestone.operators import linkage, metrics
from lodestone.operators.facts import MOST_PAIRS, RECORDS, VALUE
from lodestone.sources import shared

#: A pair of less similarity is none.
LEAST = 0.35
# The fields that name a record's parents, and the stages in which kinds are paired.
PARENTS = {
    "device_families": (),
    "individual_devices": (("family_id", "device_families"),),
    "performance_observations": (("device_id", "individual_devices"),),
    "population_statistics": (("family_id", "device_families"),),
    "stability_tests": (("family_id", "device_families"), ("device_id", "individual_devices")),
}
STAGES = (("device_families",), ("individual_devices",), ("performance_observations", "population_statistics", "stability_tests"))
#: Copies of a value in two places are one if they differ by rounding only.
ROUNDING = 16 * 2.0**-52
_AIR_MASS = r"(?i)^am\s*1[.]5\s*g(?:\s+(?:irradiation|illumination|spectrum))?$"
_NAMED = f"array<struct<name:string,value:{VALUE}>>"
_GROUP = f"struct<head:array<string>,conditions:{_NAMED}>"


def _names(studies: DataFrame) -> DataFrame:
    """(paper_id, side, names): the texts of a study that name a value or a material, each with what it is
    called among properties, conditions, treatments and materials. The vocabulary is asked once a text,
    by one expression each, however many studies hold it."""
    study = lambda path: F.col(f"study.{path}")
    none = "array<string>"

    def texts(*columns: Column) -> Column:
        return F.flatten(F.array(*[F.coalesce(x, F.array()).cast(none) for x in columns]))

    def inner(path: str, read) -> Column:
        return F.flatten(F.transform(F.coalesce(study(path), F.array()), lambda r: F.concat(*[F.coalesce(x, F.array()).cast(none) for x in read(r)])))

    def named(*values: Column) -> list[Column]:
        return [F.transform(v, lambda x: x["name"]) for v in values]

    def within(items: Column, read) -> Column:  # a missing list among them is an empty one
        return F.flatten(F.transform(items, lambda x: F.coalesce(read(x), F.array().cast(none))))

    held = texts(
        inner("device_families", lambda r: [F.array(r["variant"], r["full_stack_raw"], r["architecture"]), F.transform(r["layers"], lambda x: x["material"]), within(r["layers"], lambda x: F.transform(x["constituents"], lambda y: y["name"])), F.transform(r["absorbers"], lambda x: x["formula"]["raw_value"]), within(r["absorbers"], lambda x: F.transform(x["constituents"], lambda y: y["name"]))]),
        inner("individual_devices", lambda r: [F.array(r["subject_context"]["treated_material"]), *named(r["subject_context"]["conditions"], r["reported_properties"])]),
        inner("performance_observations", lambda r: named(r["metrics"], r["measurement_conditions"])),
        inner("population_statistics", lambda r: [*named(r["metrics"], r["measurement_conditions"]), F.flatten(F.transform(r["subjects"], lambda x: F.concat(F.array(x["treated_material"]), F.coalesce(F.transform(x["conditions"], lambda v: v["name"]), F.array().cast(none)))))]),
        inner("stability_tests", lambda r: [*named(r["conditions"]), F.flatten(F.transform(r["checkpoints"], lambda x: F.concat(F.array(x["time"]["name"]), F.coalesce(F.transform(x["conditions"], lambda v: v["name"]), F.array().cast(none)))))]),
    )
    each = studies.select("paper_id", "side", F.explode(F.array_distinct(held)).alias("text")).where("text is not null")
    text = F.col("text")
    own = F.struct(vo.property_name(text).alias("property"), vo.protocol_name(text).alias("protocol"), vo.treatment_name(text).alias("treatment"), vo.material_name(text).alias("material"))
    known = shared.spread(each.select("text").distinct(), "text").select("text", own.alias("value"))
    return each.join(known, "text").select("paper_id", "side", F.struct(text.alias("key"), F.col("value")).alias("e")).groupBy("paper_id", "side").agg(F.map_from_entries(F.collect_list("e")).alias("names"))


def _called(text: Column, kind: str) -> Column:
    """What a text of the study is called; see ``_names``."""
    return F.try_element_at(F.col("names"), text)[kind]


def _said(value: Column) -> Column:
    """The text where it says something."""
    return F.when(~value.isin("", "not_reported"), value)


def _list(values: Column, kind: str = f"array<{VALUE}>") -> Column:
    return F.coalesce(values, F.array().cast(kind))


def _named(values: Column, name) -> Column:
    """Values with the name under which they are compared."""
    return F.transform(_list(values), lambda v: F.struct(name(v).alias("name"), F.struct(*[v[x].alias(x) for x in ("name", "raw_value", "value_number", "unit")]).alias("value")))


def _is_air_mass(v: Column) -> Column:
    return F.coalesce(F.trim(v["raw_value"]).rlike(_AIR_MASS) & v["value_number"].isNull() & v["unit"].isNull(), F.lit(False))


def condition_name(v: Column) -> Column:
    """The registered or else the plain name of a condition; an air-mass spectrum is a spectrum under any name of illumination."""
    own = F.coalesce(_called(v["name"], "protocol"), _called(v["name"], "property"))
    return vo.let(own, lambda n: F.when(n.isin("illumination", "illuminationstandard") & _is_air_mass(v), "illuminationspectrum").otherwise(n))


def _condition(v: Column) -> Column:
    """A condition with its name and whether it is a registered one; spellings of the air-mass spectrum are one."""
    def made(name: Column) -> Column:
        raw = F.when((name == "illuminationspectrum") & _is_air_mass(v), "AM1.5G").otherwise(v["raw_value"])
        return F.struct(name.alias("name"), F.struct(v["name"].alias("name"), raw.alias("raw_value"), v["value_number"].alias("value_number"), v["unit"].alias("unit")).alias("value"), _called(v["name"], "protocol").isNotNull().alias("supported"))

    return vo.let(condition_name(v), made)


def same_value(a: Column, b: Column, relative: float = ROUNDING) -> Column:
    """Equal texts and units, or numbers of one unit within the tolerance: copies of one statement."""
    text = (vo.formula_text(a["raw_value"]) == vo.formula_text(b["raw_value"])) & a["unit"].eqNullSafe(b["unit"]) & a["value_number"].eqNullSafe(b["value_number"])
    return F.coalesce(text | (qt.close(a["value_number"], b["value_number"], relative) & a["unit"].eqNullSafe(b["unit"])), F.lit(False))


def conditions(metrics_: Column, stated: Column) -> Column:
    """Array of (name, value, supported): registered conditions among the metrics, then the stated ones.

    A stated one that alone of its name repeats the only metric of that name is the same statement;
    others stay, repeated or contradictory as they may be."""
    old = F.transform(F.filter(_list(metrics_), lambda v: _called(v["name"], "protocol").isNotNull()), _condition)
    new = F.transform(_list(stated), _condition)

    def merged(x: Column) -> Column:
        def copy(item: Column) -> Column:
            before = F.filter(x["old"], lambda o: o["name"] == item["name"])
            return (F.size(before) == 1) & (F.size(F.filter(x["new"], lambda o: o["name"] == item["name"])) == 1) & F.exists(before, lambda o: same_value(o["value"], item["value"]))

        return F.concat(x["old"], F.filter(x["new"], lambda item: ~copy(item)))

    return vo.let(F.struct(old.alias("old"), new.alias("new")), merged)


def has_identity(subject: Column) -> Column:
    """Whether a subject states an input quantity of its treatment."""
    return F.exists(_list(subject["conditions"]), lambda v: _called(v["name"], "treatment").isNotNull())


def _inputs(values: Column) -> Column:
    return F.filter(_named(values, lambda v: _called(v["name"], "treatment")), lambda x: x["name"].isNotNull())


def subject_identity(subject: Column) -> Column:
    """(head, conditions) of a treated subject: its stage and material, and the input quantities."""
    head = F.array(vo.formula_text(subject["treatment_stage"]), vo.formula_text(_called(subject["treated_material"], "material")))
    return F.struct(head.alias("head"), _inputs(subject["conditions"]).alias("conditions")).cast(_GROUP)


def device_treatment(device: Column) -> Column:
    """(head, conditions) of how a device was treated, from its subject and its properties; null if neither
    states anything. A property that repeats a condition of the subject counts once."""
    subject = device["subject_context"]

    def joined(x: Column) -> Column:
        def copy(p: Column, i: Column) -> Column:
            alike = lambda own: F.size(F.filter(own, lambda o: (o["name"] == p["name"]) & same_value(o["value"], p["value"])))
            return alike(F.slice(x["own"], F.lit(1), i)) < alike(x["given"])

        return F.concat(x["given"], F.filter(x["own"], lambda p, i: ~copy(p, i)))

    inputs = vo.let(F.struct(_inputs(subject["conditions"]).alias("given"), _inputs(device["reported_properties"]).alias("own")), joined)
    stage, material = F.coalesce(subject["treatment_stage"], F.lit("not_reported")), F.coalesce(_called(_said(subject["treated_material"]), "material"), F.lit("not_reported"))
    some = (F.size(inputs) > 0) | (stage != "not_reported") | (material != "not_reported")
    return F.when(some, F.struct(F.array(stage, vo.formula_text(material)).alias("head"), inputs.alias("conditions")).cast(_GROUP))


def device_identity(device: Column) -> Column:
    """(head, conditions): variant (unless treatment inputs tell it), selection, and the treatment."""
    treatment = device_treatment(device)
    variant = F.when(F.size(treatment["conditions"]) == 0, tx.scientific_text(F.nullif(device["variant"], F.lit(""))))
    head = F.concat(F.array(vo.formula_text(variant), device["champion_status"], vo.formula_text(device["selection_basis"])), treatment["head"])
    return F.when(treatment.isNotNull(), F.struct(head.alias("head"), treatment["conditions"].alias("conditions")).cast(_GROUP))


def _features(kind: str, **fields: Column) -> Column:
    """What a record states of itself, as name:text, with its kind."""
    own = [F.concat(F.lit(f"{name}:"), tx.scientific_text(_said(value))) for name, value in fields.items()]
    return F.filter(F.array(*own, F.lit(f"record_type:{kind}")), lambda x: x.isNotNull())


def _words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(tx.casefold(text), "[^a-z0-9.+%-]+", " "), " "), lambda x: x != "")


def family_features(family: Column) -> Column:
    """A design's materials with their places, constituents that are no precursors, formulas and variant,
    whole and as words; without layers its printed stack or architecture."""
    none = "array<string>"

    def parts(holders: Column, own) -> Column:
        return F.flatten(F.transform(F.coalesce(holders, F.array()), lambda x: F.concat(F.array(own(x)), F.transform(F.filter(F.coalesce(x["constituents"], F.array()), lambda c: ~F.coalesce(vo.material_stage(c["role"]) == "recipe", F.lit(False))), lambda c: c["name"]))))

    layers = F.coalesce(family["layers"], F.array())
    printed = F.when(F.size(layers) == 0, F.array(F.coalesce(F.nullif(family["full_stack_raw"], F.lit("")), family["architecture"]))).otherwise(F.array().cast(none))
    values = F.concat(parts(family["layers"], lambda x: x["material"]), parts(family["absorbers"], lambda x: x["formula"]["raw_value"]), printed).cast(none)
    named = F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: _called(v, "material"))
    placed = F.flatten(F.transform(F.filter(layers, lambda x: x["sequence"].isNotNull()), lambda x: vo.let(_called(x["material"], "material"), lambda m: F.transform(F.concat(F.array(F.concat(F.lit("material:"), m)), _words(m)), lambda w: F.concat(F.lit("layer:"), x["sequence"].cast("string"), F.lit(":"), w)))))
    variant = F.nullif(family["variant"], F.lit(""))
    own = F.when(variant.isNotNull(), F.concat(_words(_called(variant, "material")), F.array(F.concat(F.lit("variant:"), tx.scientific_text(variant))))).otherwise(F.array().cast(none))
    return vo.let(named, lambda n: F.array_distinct(F.concat(F.flatten(F.transform(n, _words)), F.transform(n, lambda m: F.concat(F.lit("material:"), m)), own, placed)))


def family_stack(family: Column) -> Column:
    """The materials of the layers in order; null unless every place is known and different."""
    layers = F.coalesce(family["layers"], F.array())
    places = F.transform(layers, lambda x: x["sequence"])
    whole = (F.size(layers) > 0) & ~F.exists(places, lambda p: p.isNull()) & (F.size(F.array_distinct(places)) == F.size(layers))
    ordered = F.array_sort(F.transform(layers, lambda x: F.struct(x["sequence"].alias("p"), x["material"].alias("m"))))
    return F.when(whole, F.transform(ordered, lambda x: _called(x["m"], "material")))


def _record(rows: DataFrame, kind: str, **columns: Column) -> DataFrame:
    """The common columns of a kind's records; r is the record."""
    empty = {
        "family_id": "string", "device_id": "string", "code": "string", "descriptor": "string", "features": "array<string>", "stack": "array<string>", "variant": "string", "groups": f"array<{_GROUP}>", "conditions": _NAMED,
        "uses": "array<struct<method:string,direction:string>>", "measurement_type": "string", "scan_direction": "string", "statistic_type": "string",
    }
    made = [columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in empty.items()]
    return rows.select("paper_id", "side", F.lit(kind).alias("kind"), F.col(f"r.{RECORDS[kind]}").alias("id"), *made)


def records(studies: DataFrame) -> DataFrame:
    """A row for each record of studies (paper_id, side, study) with what pairs it: parents, sample code,
    descriptor (a cohort's or loose specimen's label, which must agree), features, the order of layers,
    treatments (groups; null if not all are told by inputs), protocol, and how devices were measured."""
    def rows(kind: str) -> DataFrame:
        return studies.select("paper_id", "side", "names", F.col("study.performance_observations").alias("observations"), F.explode(f"study.{kind}").alias("r"))

    studies = shared.spread(studies.join(_names(studies), ["paper_id", "side"], "left"), "paper_id", "side")
    r = F.col("r")
    families = _record(rows("device_families"), "device_families", code=tx.sample_code(r["label"], r["variant"]), features=family_features(r), stack=family_stack(r), variant=r["variant"])
    used = F.filter(F.coalesce("observations", F.array()), lambda o: (o["device_id"] == r["device_id"]) & ~o["measurement_type"].isin("not_reported", "other"))
    uses = F.array_distinct(F.transform(used, lambda o: F.struct(o["measurement_type"].alias("method"), F.when(o["scan_direction"].isin("forward", "reverse"), o["scan_direction"]).alias("direction"))))
    devices = _record(
        rows("individual_devices"), "individual_devices", family_id=r["family_id"], code=tx.sample_code(r["label"], r["variant"]), uses=uses, groups=F.when(device_treatment(r).isNotNull(), F.array(device_identity(r))),
        features=_features("device", label=r["label"], variant=r["variant"], champion_status=r["champion_status"], selection_basis=r["selection_basis"]),
    )

    def protocol(own: Column) -> Column:
        return F.transform(F.filter(conditions(own["metrics"], own["measurement_conditions"]), lambda x: x["supported"]), lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value")))

    observations = _record(rows("performance_observations"), "performance_observations", device_id=r["device_id"], conditions=protocol(r), measurement_type=r["measurement_type"], scan_direction=r["scan_direction"], features=_features("observation", measurement_type=r["measurement_type"], scan_direction=r["scan_direction"]))
    subjects = F.coalesce(r["subjects"], F.array())
    told = (F.size(subjects) > 0) & F.forall(subjects, has_identity)
    code = tx.sample_code(r["label"], F.lit(None).cast("string"))
    populations = _record(
        rows("population_statistics"), "population_statistics", family_id=r["family_id"], groups=F.when(told, F.transform(subjects, subject_identity)), conditions=protocol(r), measurement_type=r["measurement_type"], scan_direction=r["scan_direction"], statistic_type=r["statistic_type"],
        descriptor=F.when(code.isNotNull(), F.concat(F.lit("sample:"), code)).when(~told, tx.scientific_text(r["label"])), features=_features("population", label=r["label"], statistic_type=r["statistic_type"]),
    )

    def tagged(values: Column, tag: str) -> Column:
        return _named(values, lambda v: F.concat(F.lit(f"{tag}:"), _called(v["name"], "property")))

    points = F.coalesce(r["checkpoints"], F.array())
    times = tagged(F.filter(F.transform(points, lambda p: p["time"]), lambda t: t.isNotNull()), "checkpoint_time")
    tests = _record(
        rows("stability_tests"), "stability_tests", family_id=r["family_id"], device_id=r["device_id"], descriptor=F.when(r["device_id"].isNull(), tx.scientific_text(r["specimen_label"])),
        conditions=F.concat(tagged(r["conditions"], "test"), times, F.flatten(F.transform(points, lambda p: tagged(p["conditions"], "checkpoint_condition")))),
        features=_features("test", link_status=r["link_status"], specimen_label=F.when(r["device_id"].isNull(), r["specimen_label"])),
    )
    whole = reduce(DataFrame.unionByName, [families, devices, observations, populations, tests])
    # each value is read as a claim once, here, and not once a pair
    inputs = F.flatten(F.transform("groups", lambda g: g["conditions"]))
    whole = whole.withColumn("inputs", _claims(_list(inputs, _NAMED))).withColumn("protocol", _claims(_list(F.col("conditions"), _NAMED)))
    return whole.withColumn("groups", F.transform("groups", lambda g: F.struct(g["head"].alias("head"), F.size(g["conditions"]).alias("n")))).drop("conditions")


# -------------------------------------------------------------------- agreement of lists
@F.arrow_udf(BooleanType())
def _matched(edges: pa.Array) -> pa.Array:
    """Whether every left entry of the graphs has a right one of its own."""
    return pa.array([None if own is None else linkage.every_left_has_a_partner([[j for j, edge in enumerate(row) if edge] for row in own]) for own in edges.to_pylist()], pa.bool_())


# evaluated where it stands: as a filter's part it would be pushed into the join and computed twice
_matched = _matched.asNondeterministic()


def _settled(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that later ones see as computed. Spark leaves a Python function whose arguments hold
    repeated parts of lambdas in the plan unevaluated (Spark 4.1); behind a generator they are plain columns."""
    made = df.select("*", F.explode_outer(F.array(F.struct(*[v.alias(n) for n, v in columns.items()]))).alias("_s"))
    return made.select("*", *[F.col(f"_s.{n}").alias(n) for n in columns]).drop("_s")


def _edges(left: Column, right: Column, same) -> Column:
    return F.transform(left, lambda a: F.transform(right, lambda b: same(a, b)))


def _claims(named: Column) -> Column:
    """Named values with their claims: (name, claim)."""
    values = [F.transform(named, _field(n)) for n in ("raw_value", "value_number", "unit")]
    return F.transform(F.arrays_zip(named.alias("n"), qt.claims(*values).alias("c")), lambda x: F.struct(x["n"]["name"].alias("name"), x["c"].alias("claim")))


def _field(name: str):
    return lambda x: x["value"][name]


def similarity(pairs: DataFrame, relative: float = 0.01, absolute: float = 0.0) -> DataFrame:
    """``pairs`` (a, b: records of one kind) with content, how alike their identities are from 0 to 1.

    Ordered stacks of two families by their order; treatments told on both sides by being the same,
    one to one; all others by the share of common features, to which the conditions that both name
    count as one feature if they agree and as two that differ if not."""
    def agree(x: Column, y: Column) -> Column:
        return (x["name"] == y["name"]) & qt.equal_claims(x["claim"], y["claim"], relative, absolute)

    both = (F.coalesce(F.size("a.groups"), F.lit(0)) > 0) & (F.coalesce(F.size("b.groups"), F.lit(0)) > 0)
    one = both & (F.size("a.groups") == 1) & (F.size("b.groups") == 1)
    few = lambda field: (F.size(f"a.{field}") <= 1) & (F.size(f"b.{field}") <= 1)
    # lists of one entry at most need no matching, and no Python: these are most pairs
    plain = F.coalesce((F.col("a.stack").isNull() | F.col("b.stack").isNull()) & few("protocol") & (~both | (one & few("inputs"))), F.lit(False))
    heads = lambda g, h: F.forall(F.arrays_zip(g["head"].alias("x"), h["head"].alias("y")), lambda z: z["x"].eqNullSafe(z["y"]))
    first = {x: F.get(F.col(f"{x}.groups"), F.lit(0)) for x in "ab"}
    stated = (F.size("a.protocol") > 0) | (F.size("b.protocol") > 0)

    def content(ordered: Column, alone: Column, many: Column, same: Column) -> Column:
        told = F.when(both, F.when(one, heads(first["a"], first["b"]) & F.coalesce(alone, F.lit(False))).otherwise(F.coalesce(many, F.lit(False))).cast("double"))
        shared_ = F.size(F.array_intersect("a.features", "b.features")) + (stated & F.coalesce(same, F.lit(False))).cast("int")
        total = F.size(F.array_union("a.features", "b.features")) + F.when(stated, F.when(F.coalesce(same, F.lit(False)), 1).otherwise(2)).otherwise(0)
        return F.coalesce(ordered, told, F.when(total == 0, 1.0).otherwise(shared_ / total))

    x, y = (F.get(F.col(f"{side}.inputs"), F.lit(0)) for side in "ab")
    alone = F.when(F.size("a.inputs") == F.size("b.inputs"), (F.size("a.inputs") == 0) | F.coalesce(agree(x, y), F.lit(False)))
    x, y = (F.get(F.col(f"{side}.protocol"), F.lit(0)) for side in "ab")
    same = ~F.coalesce(x["name"] == y["name"], F.lit(False)) | F.coalesce(agree(x, y), F.lit(False))
    easy = pairs.where(plain).withColumn("_c", content(F.lit(None).cast("double"), alone, F.lit(None).cast("boolean"), same))
    easy = _settled(easy, content=F.col("_c")).drop("_c")  # else a condition on it would be pushed below the join's shuffle, and it be computed twice

    # groups: heads alike, and the conditions of each one to one
    alone = F.when(one & (F.size("a.inputs") == F.size("b.inputs")), _edges(F.col("a.inputs"), F.col("b.inputs"), agree))
    # several subjects: each condition must have an equal one in the other subject's list, both ways
    inner = lambda i, j: (F.size(i) == F.size(j)) & F.forall(i, lambda x: F.exists(j, lambda y: agree(x, y))) & F.forall(j, lambda y: F.exists(i, lambda x: agree(x, y)))
    own = {x: F.transform(F.col(f"{x}.groups"), _with_own(x)) for x in "ab"}
    many = _edges(own["a"], own["b"], lambda p, q: heads(p["g"], q["g"]) & inner(p["k"], q["k"]))
    many = F.when(both & ~one & (F.size("a.groups") == F.size("b.groups")), many)
    # protocols: of the names that both state
    names = F.array_intersect(F.transform("a.protocol", lambda x: x["name"]), F.transform("b.protocol", lambda x: x["name"]))
    out = _settled(pairs.where(~plain), _names=names)
    out = _settled(out, **{f"_{x}_p": F.filter(F.col(f"{x}.protocol"), lambda p: F.array_contains("_names", p["name"])) for x in "ab"})
    out = _settled(out, _one=alone, _many=many, _same=F.when(F.size("_a_p") == F.size("_b_p"), _edges(F.col("_a_p"), F.col("_b_p"), agree)))
    out = out.withColumns({n: _matched(F.col(n)) for n in ("_one", "_many", "_same")})
    out = out.withColumn("_x", F.col("a.stack")).withColumn("_y", F.col("b.stack"))
    ordered = linkage.stack_similarity("_x", "_y", F.col("a.variant"), F.col("b.variant"))
    out = out.withColumn("content", content(ordered, F.col("_one"), F.col("_many"), F.col("_same")))
    return easy.unionByName(out.drop("_x", "_y", "_same", "_names", "_one", "_many", "_a_p", "_b_p"))


def _with_own(side: str):
    """A group with its run of the record's inputs."""
    def made(group: Column, i: Column) -> Column:
        before = F.aggregate(F.slice(F.col(f"{side}.groups"), F.lit(1), i), F.lit(0), lambda n, g: n + g["n"])
        return F.struct(group.alias("g"), F.slice(F.col(f"{side}.inputs"), before + 1, group["n"]).alias("k"))

    return made


def scores(truth: DataFrame, prediction: DataFrame, least: float = LEAST, relative: float = 0.01, absolute: float = 0.0) -> DataFrame:
    """(paper_id, kind, truth_id, prediction_id, score, similarity) of the pairs that may be assigned.

    ``truth`` has the predicted keys of its parents (mapped_family_id, mapped_device_id). Records with
    different descriptors, or with different sample codes, are none. A pair of parents counts as much
    as the content does; the uses of devices with such a pair as much again; with equal method,
    direction and statistic it goes before all pairs without one. More than MOST_PAIRS pairs of a
    paper's kind are an error."""
    keys = ["paper_id", "kind"]
    sizes = [x.groupBy(*keys).agg(F.count("*").alias(n)) for x, n in ((truth, "_n"), (prediction, "_m"))]
    limit = sizes[0].join(sizes[1], keys).select(*keys, F.when(F.col("_n") * F.col("_m") > MOST_PAIRS, F.raise_error(F.concat_ws(" ", F.lit("too many candidate pairs of"), *keys))).alias("_over"))
    sides = [x.select(*keys, F.coalesce("descriptor", F.lit("\x00")).alias("_d"), F.struct(*[c for c in x.columns if c not in ("side", *keys)]).alias(n)) for x, n in ((truth.join(limit, keys), "a"), (prediction, "b"))]
    a, b = F.col("a"), F.col("b")
    apart = F.coalesce(a["code"] != b["code"], F.lit(False)) & F.col("kind").isin("device_families", "individual_devices")
    candidates = shared.spread(sides[0].join(sides[1], [*keys, "_d"]).where("a._over is null").where(~apart), *keys)
    pairs = similarity(candidates, relative, absolute)
    content = F.when((F.col("kind") == "device_families") & (a["code"] == b["code"]), (F.col("content") + 1) / 2).otherwise(F.col("content"))
    some, fit = F.lit(False), F.lit(True)
    for field in ("family_id", "device_id"):
        asked = F.col("kind").isin(*[k for k, parents in PARENTS.items() if field in dict(parents)])
        some |= asked & a[field].isNotNull()
        fit &= ~asked | (a[field].isNull() & b[field].isNull()) | F.coalesce(a[f"mapped_{field}"] == b[field], F.lit(False))
    pairs = pairs.withColumn("_fit", some & fit).withColumn("content", F.when(F.col("_fit"), (content + 1) / 2).otherwise(content)).where(F.col("content") >= least)
    device = (F.col("kind") == "individual_devices") & F.col("_fit")
    uses = linkage.use_similarity(_list(a["uses"], "array<struct<method:string,direction:string>>"), _list(b["uses"], "array<struct<method:string,direction:string>>"))
    alike = reduce(Column.__and__, [a[x].eqNullSafe(b[x]) for x in ("measurement_type", "scan_direction", "statistic_type")])
    pairs = pairs.withColumn("similarity", F.when(device, (F.col("content") + uses) / 2).otherwise(F.col("content")))
    return pairs.select(*keys, a["id"].alias("truth_id"), b["id"].alias("prediction_id"), (F.col("similarity") + F.when(F.col("_fit") & alike, 2).otherwise(0)).alias("score"), "similarity")


def paired(own: DataFrame, folder: str, least: float = LEAST, relative: float = 0.01, absolute: float = 0.0) -> DataFrame:
    """(paper_id, kind, truth_id, prediction_id, similarity, ambiguous) of ``records``, in three stages.

    ambiguous: another assignment of the paper's kind is as good without the pair. Keys that repeat
    within a kind of one side are an error, as facts would go to the wrong record. Null keys have no
    pair. Tables between stages go to ``folder``."""
    again = own.where("id is not null").groupBy("paper_id", "side", "kind", "id").count().where("count > 1").select(F.raise_error(F.concat_ws(" ", F.lit("repeated record"), "paper_id", "side", "kind", "id")).alias("e"))
    again.collect()
    own = own.where("id is not null")
    truth, prediction = (own.where(F.col("side") == side) for side in ("truth", "prediction"))
    found: list[DataFrame] = []
    for k, kinds in enumerate(STAGES):
        asked = truth.where(F.col("kind").isin(*kinds))
        for field, parent in (("family_id", "device_families"), ("device_id", "individual_devices")):
            known = next((f for f, names in zip(found, STAGES) if parent in names), None)
            if known is None:
                asked = asked.withColumn(f"mapped_{field}", F.lit(None).cast("string"))
            else:
                asked = asked.join(known.select("paper_id", F.col("truth_id").alias(field), F.col("prediction_id").alias(f"mapped_{field}")), ["paper_id", field], "left")
        scored = shared.written(scores(asked, prediction.where(F.col("kind").isin(*kinds)), least, relative, absolute), f"{folder}/scores{k}")
        chosen = linkage.one_to_one(scored, ["paper_id", "kind"], "truth_id", "prediction_id", "score", ambiguity=True)
        chosen = chosen.join(scored.drop("score"), ["paper_id", "kind", "truth_id", "prediction_id"])
        found.append(shared.written(chosen.select("paper_id", "kind", "truth_id", "prediction_id", "similarity", "ambiguous"), f"{folder}/pairs{k}"))
    return reduce(DataFrame.unionByName, found)


def record_pairs(studies: DataFrame, folder: str, **limits: float) -> DataFrame:
    """``paired`` of studies (paper_id, side, study). The studies are read once, the records written once."""
    own = shared.written(shared.spread(studies.select("paper_id", "side", "study"), "paper_id", "side"), f"{folder}/studies")
    return paired(shared.written(records(own), f"{folder}/records"), folder, **limits)


def relationships(own: DataFrame, pairs: DataFrame) -> DataFrame:
    """(paper_id, kind, compared, agreed): of paired records' parent links, how many are stated on either side
    and how many lead to paired parents."""
    sides = [own.where(F.col("side") == side).select("paper_id", "kind", F.col("id").alias(f"{side}_id"), F.struct("family_id", "device_id").alias(n)) for side, n in (("truth", "a"), ("prediction", "b"))]
    both = pairs.select("paper_id", "kind", "truth_id", "prediction_id").join(sides[0], ["paper_id", "kind", "truth_id"]).join(sides[1], ["paper_id", "kind", "prediction_id"])
    links = F.array(*[F.struct(F.lit(kind).alias("child"), F.lit(parent).alias("parent"), F.col(f"a.{field}").alias("x"), F.col(f"b.{field}").alias("y")) for kind, parents in PARENTS.items() for field, parent in parents])
    each = both.select("paper_id", "kind", F.explode(links).alias("l")).where("l.child = kind and (l.x is not null or l.y is not null)").select("paper_id", "kind", "l.parent", "l.x", "l.y")
    known = pairs.select("paper_id", F.col("kind").alias("parent"), F.col("truth_id").alias("x"), F.col("prediction_id").alias("mapped"))
    return each.join(known, ["paper_id", "parent", "x"], "left").groupBy("paper_id", "kind").agg(F.count("*").alias("compared"), F.count_if(F.col("mapped") == F.col("y")).alias("agreed"))


def inventory(own: DataFrame, pairs: DataFrame) -> DataFrame:
    """(paper_id, kind, predicted, truth, matched, ambiguous, precision, recall, f1): records found, by kind."""
    counts = own.groupBy("paper_id", "kind").agg(F.count_if(F.col("side") == "prediction").alias("predicted"), F.count_if(F.col("side") == "truth").alias("truth"))
    hits = pairs.groupBy("paper_id", "kind").agg(F.count("*").alias("matched"), F.count_if("ambiguous").alias("ambiguous"))
    return metrics.precision_recall(counts.join(hits, ["paper_id", "kind"], "left").fillna(0, ["matched", "ambiguous"]), "predicted", "truth", "matched")


def unpaired(own: DataFrame, pairs: DataFrame) -> DataFrame:
    """(paper_id, side, kind, id) of the records without a pair."""
    used = reduce(DataFrame.union, [pairs.select("paper_id", F.lit(side).alias("side"), "kind", F.col(f"{side}_id").alias("id")) for side in ("truth", "prediction")])
    return own.select("paper_id", "side", "kind", "id").join(used, ["paper_id", "side", "kind", "id"], "left_anti")


def family_evidence(own: DataFrame, pairs: DataFrame) -> DataFrame:
    """What pairs two families: their codes, and their stacks if both are ordered, else the features that
    both have and that only one has."""
    rows = own.where("kind = 'device_families'")
    sides = [rows.where(F.col("side") == side).select("paper_id", F.col("id").alias(f"{side}_id"), F.struct("code", "stack", "variant", "features").alias(n)) for side, n in (("truth", "a"), ("prediction", "b"))]
    both = pairs.where("kind = 'device_families'").select("paper_id", "truth_id", "prediction_id").join(sides[0], ["paper_id", "truth_id"]).join(sides[1], ["paper_id", "prediction_id"])
    ordered = F.col("a.stack").isNotNull() & F.col("b.stack").isNotNull()
    told = {"truth_stack": F.col("a.stack"), "prediction_stack": F.col("b.stack")}
    loose = {"shared": F.array_intersect("a.features", "b.features"), "truth_only": F.array_except("a.features", "b.features"), "prediction_only": F.array_except("b.features", "a.features")}
    return both.select("paper_id", "truth_id", "prediction_id", F.col("a.code").alias("truth_code"), F.col("b.code").alias("prediction_code"), *[F.when(ordered, v).alias(n) for n, v in told.items()], *[F.when(~ordered, F.array_sort(v)).alias(n) for n, v in loose.items()])
