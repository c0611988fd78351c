"""Names of properties, conditions, materials and roles: checked synonyms, everything else literal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import text as tx
from lodestone.functions.text import let

# Synonyms of properties, conditions, treatments, roles and materials.
PROPERTIES = {
    "powerconversionefficiency": "pce",
    "opencircuitvoltage": "voc",
    "shortcircuitcurrentdensity": "jsc",
    "fillfactor": "ff",
    "referenceefficiencyretained": "efficiencyretention",
    "pceretention": "efficiencyretention",
    "referencecell'sefficiencyretained": "efficiencyretention",
    "errorbarstatistic": "errorbarstatistic",
    "errorbarstatisticforphotovoltaicparameters": "errorbarstatistic",
    "samplesize": "sample_size",
    "chlorineinresultingperovskitefilms": "chlorineinresultingperovskitefilm",
}
METRICS = ("pce", "voc", "jsc", "ff")
CONDITIONS = {
    "illuminationintensity": ("irradiance",),
    "illumination": (),
    "illuminationspectrum": (),
    "illuminationstandard": (),
    "scanrate": ("jvscanrate", "scanspeed"),
    "scanvoltagerange": ("scanprotocol", "voltagescanprotocol", "voltagescanningprotocol", "voltagesweep", "voltagesweeprange"),
    "voltagestep": (),
    "measurementtemperature": (),
    "measurementatmosphere": (),
    "measurementcondition": (),
    "storagebeforemeasurement": (),
    "storageinglovebox": (),
}
ERROR_BARS = {"standard deviation": "standard_deviation", "standard error": "standard_error", "standard error of the mean": "standard_error", "confidence interval": "confidence_interval"}
TREATMENTS = {
    "atmosphere": "atmosphere",
    "treatmentatmosphere": "atmosphere",
    "temperature": "temperature",
    "annealingtemperature": "temperature",
    "duration": "duration",
    "annealingtime": "duration",
    "annealingduration": "duration",
    "treatmentduration": "duration",
    "treatment": "treatment",
    "concentration": "concentration",
    "pressure": "pressure",
    "relativehumidity": "relativehumidity",
    "illumination": "illumination",
    "illuminationintensity": "illuminationintensity",
    "electrodepositionpotential": "electrodeposition_potential",
    "depositionpotential": "electrodeposition_potential",
    "polymerizationchargedensity": "charge_density",
    "chargedensity": "charge_density",
    "postreductionpotential": "postreduction_potential",
    "postreductiontime": "postreduction_duration",
    "postreductionduration": "postreduction_duration",
}
ROLES = {
    "perovskiteabsorber": "absorber",
    "hostabsorber": "absorber",
    "absorber": "absorber",
    "holetransportmaterial": "hole_transport_layer",
    "holetransportlayer": "hole_transport_layer",
    "htl": "hole_transport_layer",
    "electrontransportmaterial": "electron_transport_layer",
    "electrontransportlayer": "electron_transport_layer",
    "etl": "electron_transport_layer",
    "transparentelectrode": "transparent_electrode",
    "backelectrode": "back_electrode",
    "electrode": "electrode",
    "contact": "contact",
    "substrate": "substrate",
    "precursor": "precursor",
    "perovskiteprecursor": "precursor",
    "precursoradditive": "precursor_additive",
}
RECIPE_ROLES = ("precursor", "precursor_additive")
MATERIALS = {
    "gold": "Au",
    "silver": "Ag",
    "aluminium": "Al",
    "aluminum": "Al",
    "copper": "Cu",
    "nickel": "Ni",
    "titanium dioxide": "TiO2",
    "tin dioxide": "SnO2",
    "zinc oxide": "ZnO",
    "indium tin oxide": "ITO",
    "fluorine-doped tin oxide": "FTO",
    "poly(3-hexylthiophene)": "P3HT",
    "poly-3-hexylthiophene": "P3HT",
    "methylammonium lead triiodide": "MAPbI3",
    "poly(3,4-ethylenedioxythiophene)": "PEDOT",
    "glass": "glass",
    "spiro-meotad": "spiro-MeOTAD",
    "spiromeotad": "spiro-MeOTAD",
    "pc61bm": "PC61BM",
    "fluorinedoped tin oxide conducting glass": "FTO",
}
SYMBOLS = tuple(sorted(set(MATERIALS.values())))
CONTAINERS = (" layer", " electrode", " contact", " substrate")
OPERATIONS = {
    "annealing": {"annealingtime": "duration", "annealingduration": "duration", "time": "duration", "duration": "duration", "annealingtemperature": "temperature", "temperature": "temperature"},
    "spin coating": {"spintime": "duration", "spinduration": "duration", "time": "duration", "duration": "duration", "spinspeed": "speed", "spincoatingspeed": "speed"},
}
DOMAINS = {
    "measurement": "performance",
    "measurement_condition": "performance",
    "material": "material_device_identity",
    "recipe": "processing",
    "processing": "processing",
    "aging_protocol": "stability",
    "aging_outcome": "stability",
}
_NUMERIC_CUE = r"(?i)[0-9<>≤≥±%]|\b(?:half|quarter|third|percent|twice)\b"
_COEFFICIENT = r"(?:[0-9]+(?:\.[0-9]+)?(?:\s*-\s*[xyz])?|[xyz])"


def _quoted(values) -> str:
    return ", ".join("'" + x.replace("'", "\\'") + "'" for x in values)


def lookup(table: dict[str, str], key: Column) -> Column:
    """The table's entry for the key, null if it has none."""
    return F.try_element_at(F.expr(f"map({_quoted(x for pair in table.items() for x in pair)})"), key)


def one_of(value: Column, words) -> Column:
    """Whether the value is one of the words; null for null."""
    return F.array_contains(F.expr(f"array({_quoted(words)})"), value)


def _key(text: Column) -> Column:
    return F.regexp_replace(tx.casefold(text), r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000_-]+", "")


def formula_text(text: Column) -> Column:
    """``scientific_text`` with numeric subscripts on the line, if the whole is a formula of elements."""
    return let(tx.scientific_text(text), formula_of)


def formula_of(own: Column) -> Column:
    """``formula_text`` of a text that is ``scientific_text`` already."""

    def flat(own: Column) -> Column:
        out = F.translate(own, "₀₁₂₃₄₅₆₇₈₉", "0123456789")
        out = F.regexp_replace(out, rf"_(?:\{{\s*({_COEFFICIENT})\s*\}}|({_COEFFICIENT}))", "$1$2")
        return F.regexp_replace(out, r"(?<=[A-Za-z])\s+(?=[0-9])", "")

    whole = rf"^(?:[A-Z][a-z]?\s*(?:{_COEFFICIENT})?\s*)+$"
    return F.when(own.rlike("^[A-Z]"), let(flat(own), lambda x: F.when(x.rlike(whole), F.replace(x, F.lit(" "), F.lit(""))).otherwise(own))).otherwise(own)


def property_name(name: Column) -> Column:
    """Case, blanks and dashes do not count; synonyms are one name, and so is "Full name (ABBR)" where both agree."""

    def concept(part: Column) -> Column:
        return let(_key(part), lambda key: F.coalesce(lookup(PROPERTIES, key), key))

    pair = r"^(.+?)\s*\(([^()]+)\)$"

    def read(own: Column) -> Column:
        full, short = concept(F.regexp_extract(own, pair, 1)), concept(F.regexp_extract(own, pair, 2))
        return F.when(own.rlike(pair), let(full, lambda x: F.when((x == short) & one_of(x, METRICS), x).otherwise(concept(own)))).otherwise(concept(own))

    return let(tx.scientific_text(name), read)


def protocol_name(name: Column) -> Column:
    """The measurement condition that a name denotes; null if it is none."""
    return lookup({x: main for main, others in CONDITIONS.items() for x in (main, *others)}, property_name(name))


def error_bar_statistic(value: Column) -> Column:
    """The named statistic of error bars; other texts as they are."""
    return F.coalesce(lookup(ERROR_BARS, F.replace(tx.casefold(tx.scientific_text(value)), F.lit("_"), F.lit(" "))), value)


def material_role(role: Column) -> Column:
    """The checked role, else the text; null for none."""
    return F.when(F.nullif(role, F.lit("")).isNotNull(), F.coalesce(lookup(ROLES, property_name(role)), tx.scientific_text(role)))


def _function_roles() -> list[str]:
    return sorted(set(ROLES.values()) - set(RECIPE_ROLES))


def material_stage(role: Column) -> Column:
    """recipe for precursors, finished for functions in the device, else unspecified."""
    own = material_role(role)
    return F.when(one_of(own, RECIPE_ROLES), "recipe").when(one_of(own, _function_roles()), "finished").otherwise("unspecified")


def whole_material_role(role: Column) -> Column:
    """No role, or a function that a whole layer has."""
    return F.coalesce(role.isNull() | one_of(material_role(role), _function_roles()), F.lit(False))


def _checked(text: Column) -> Column:
    """The symbol of a known material: itself, or of its full name in any case; else null."""
    return F.when(one_of(text, SYMBOLS), text).otherwise(lookup(MATERIALS, tx.casefold(text)))


def material_name(value: Column) -> Column:
    """The symbol of a known material, also under a container word, with its synonym or maker in
    brackets, with a stated form, or as a hole conductor; every other text literal."""
    pair, maker, form = r"^(.+?)\s*\(([^()]+)\)$", r"^(.+?)\s*\(([^(),]+),\s*[^()]+\)$", r"(?i)^(compact|mesoporous)\s+(.+?)(?: layer)?$"
    contained = rf"(?i)^(.*?)(?:{'|'.join(CONTAINERS)})$"

    def agreed(own: Column, pattern: str, as_formula: bool) -> Column:
        parts = [F.trim(F.regexp_extract(own, pattern, i)) for i in (1, 2)]
        left, right = (let(formula_text(x), _checked) if as_formula else _checked(x) for x in parts)
        return F.when(own.rlike(pattern) & (left == right), left)

    def bare(own: Column) -> Column:
        return F.coalesce(_checked(own), F.when(own.rlike(contained), let(formula_text(F.regexp_extract(own, contained, 1)), _checked)))

    def read(own: Column) -> Column:
        formed = F.when(own.rlike(form), F.concat(F.lower(F.regexp_extract(own, form, 1)), F.lit(" "), let(formula_text(F.regexp_extract(own, form, 2)), bare)))
        conductor = F.when(own.rlike("(?i) htm$"), _checked(F.left(own, F.length(own) - 4)))
        return F.coalesce(bare(own), agreed(own, pair, True), agreed(own, maker, False), formed, conductor, own)

    return let(F.translate(formula_text(value), "‐‑‒–", "----"), read)


def known_material(value: Column) -> Column:
    return one_of(material_name(value), SYMBOLS)


def treatment_name(name: Column) -> Column:
    """The registered treatment condition; with a known material before it, condition@material; else null."""

    def scoped(words: Column) -> Column:
        def cut(i: Column) -> Column:
            condition = lookup(TREATMENTS, property_name(F.array_join(F.slice(words, i + 1, F.size(words) - i), " ")))
            return F.when(condition.isNotNull(), let(material_name(F.array_join(F.slice(words, F.lit(1), i), " ")), lambda m: F.when(one_of(m, SYMBOLS), F.concat(condition, F.lit("@"), m))))

        return F.when(F.size(words) > 1, F.get(F.filter(F.transform(F.sequence(F.lit(1), F.size(words) - 1), cut), lambda x: x.isNotNull()), F.lit(0)))

    return F.coalesce(lookup(TREATMENTS, property_name(name)), let(F.split(tx.scientific_text(name), " "), scoped))


def condition_name(name: Column, operation: Column) -> Column:
    """The name of a step's condition, as its operation knows it."""
    own = property_name(name)
    of = reduce(lambda out, kv: out.when(operation == kv[0], lookup(kv[1], own)), OPERATIONS.items(), F.when(F.lit(False), F.lit(None).cast("string")))
    return F.coalesce(of, own)


def concept_space(group: Column, name: Column, stage: Column, outcome: Column) -> Column:
    """The name space of a fact: outcomes, protocols, recipes and materials are told apart."""
    recipe = F.coalesce((stage == "recipe"), F.lit(False)) | name.startswith("precursor")
    return (
        F.when(group.isin("performance", "population"), "measurement").when(group == "stability", F.when(outcome, "aging_outcome").otherwise("aging_protocol"))
        .when(group.isin("composition", "stack"), F.when(recipe, "recipe").otherwise("material")).otherwise(group)
    )


def concept_name(group: Column, name: Column) -> Column:
    return F.when(group == "processing", F.regexp_replace(name, "^treatment:", "")).otherwise(name)


def fact_domain(space: Column) -> Column:
    """The domain in which facts of a name space are counted."""
    return lookup(DOMAINS, space)


def fact_subfield(group: Column, name: Column, path: Column, stage: Column, literal: Column) -> Column:
    """The field in which a fact is counted. ``literal`` is the text of a claim that is no quantity, else null."""
    measured = (
        F.when(name.isin("sample_size", "errorbarstatistic"), "statistical_metadata")
        .when(protocol_name(name).isNotNull() | path.contains("/measurement_conditions/"), "measurement_protocol")
        .when(one_of(name, METRICS), "photovoltaic_metrics").when(name == "efficiencyretention", "relative_performance")
        .when(literal.rlike(_NUMERIC_CUE), "unparsed_measurement_claims").when(literal.isNotNull(), "qualitative_observations").otherwise("other_measurement_fields")
    )
    processed = F.when(name == "operation", "processing_operations").when(name.isin("material", "treated_material"), "processing_materials").otherwise("processing_conditions")
    built = (
        F.when(F.coalesce(stage == "recipe", F.lit(False)) | name.startswith("precursor"), "recipe_composition").when(name.isin("formula", "constituent", "material"), "material_identity")
        .when(name == "constituent_role", "material_roles").when(name.startswith("constituent_amount"), "composition_amounts")
        .when(name.isin("role", "material_form", "polarity", "stack"), "device_structure").when(name == "chlorineinresultingperovskitefilm", "composition_properties").otherwise("material_properties")
    )
    aged = F.when(path.contains("/outcomes/"), "stability_outcomes").otherwise("stability_protocol")
    return F.when(group.isin("performance", "population"), measured).when(group == "stability", aged).when(group == "processing", processed).when(group.isin("composition", "stack"), built)


# Fixed value: how a metric's name states its statistic and method.
_METRIC = r"^(?:((?:population[- ]+)?(?:average|mean))\s+)?(pce|power conversion efficiency|ff|fill factor|voc|open circuit voltage|jsc|short circuit current density)(\s+(?:extracted\s+)?from\s+(?:the\s+)?j[- ]?v(?:\s+curve)?)?$"


def metric_parts(name: Column, unit_dims) -> Column:
    """Struct of metric, statistic, method and unit that a name such as "average PCE (%)" states.

    ``unit_dims`` gives the dimensions of a unit text, null if unreadable: a unit leaves the name only
    if it fits the metric."""
    suffix = r"^(.+?)\s*(?:\[([^\[\]()]+)\]|\(([^\[\]()]+)\))$"
    dims = {"pce": "", "ff": "", "voc": "A-1 kg m2 s-3", "jsc": "A m-2"}
    none = F.lit(None).cast("string")

    def cut(own: Column) -> Column:
        return F.when(own.rlike(suffix), F.trim(F.concat(F.regexp_extract(own, suffix, 2), F.regexp_extract(own, suffix, 3))))

    def based(x: Column) -> Column:
        base = let(F.trim(x["name"]), lambda own: F.when(own.rlike(suffix), F.trim(F.regexp_extract(own, suffix, 1))).otherwise(x["name"]))
        return let(base, lambda base: let(F.struct(base.alias("base"), tx.collapse(F.translate(tx.casefold(base), "–−", "--")).alias("plain")), lambda y: keyed(x, y)))

    def keyed(x: Column, y: Column) -> Column:
        key = F.when(y["plain"].rlike(_METRIC), property_name(F.regexp_extract(y["plain"], _METRIC, 2)))
        return let(key, lambda key: named(x, y, key))

    def named(x: Column, y: Column, key: Column) -> Column:
        alias = x["unit"].isNotNull() & (property_name(x["unit"]) == property_name(y["base"]))
        fits = x["unit"].isNull() | F.coalesce(x["dims"] == lookup(dims, key), F.lit(False))
        read = key.isNotNull() & fits & ~F.coalesce(alias, F.lit(False))
        return let(F.coalesce(read, F.lit(False)), lambda read: F.struct(
            F.when(read, key).otherwise(property_name(x["name"])).alias("metric"),
            F.when(read & (F.regexp_extract(y["plain"], _METRIC, 1) != ""), "mean").otherwise(none).alias("statistic"),
            F.when(read & (F.regexp_extract(y["plain"], _METRIC, 3) != ""), "jv_scan").otherwise(none).alias("method"),
            F.when(read, x["unit"]).otherwise(none).alias("unit"),
        ))

    unit = let(F.trim(name), cut)
    return let(F.struct(name.alias("name"), unit.alias("unit"), unit_dims(unit).alias("dims")), based)


def performance_name(metric: Column, condition: Column, measurement: Column) -> Column:
    """Eta is power efficiency in photovoltaic measurements only; conditions have their registered name (of ``protocol_name``)."""
    solar = measurement.isin("jv_scan", "stabilized_power_output", "certified_measurement")
    return F.when(metric.isin("η", "efficiency") & F.coalesce(solar, F.lit(False)), "pce").otherwise(F.coalesce(condition, metric))


def scoped_property(name: Column, material: Column) -> Column:
    """A layer's property without a name of the layer's own material before it; others literal."""
    properties = r"^(?:layer|film|contact|electrode|substrate)?(thickness|sheetresistance|bandgap|roughness|workfunction)$"
    prefixes = [("".join(ch for ch in x if ch not in " _-"), symbol, x == symbol) for symbol in SYMBOLS for x in (symbol, *(n for n, y in MATERIALS.items() if y == symbol))]

    def read(spelt: Column) -> Column:
        def of(subject: Column) -> Column:
            found = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(symbol).alias("s"), F.lit(cased).alias("c")) for p, symbol, cased in prefixes])
            rest = F.transform(F.filter(found, lambda x: (x["s"] == subject) & F.when(x["c"], F.startswith(spelt, x["p"])).otherwise(F.startswith(tx.casefold(spelt), x["p"]))), lambda x: F.regexp_extract(tx.casefold(F.substring(spelt, F.length(x["p"]) + 1, F.lit(1 << 30))), properties, 1))
            return F.coalesce(F.get(F.filter(rest, lambda x: x != ""), F.lit(0)), tx.casefold(spelt))

        return let(material_name(material), of)

    return let(F.regexp_replace(F.translate(tx.scientific_text(name), "‐‑‒–", "----"), r"(?U)[\s_-]+", ""), read)
