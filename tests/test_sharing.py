"""What several columns need is computed once, and small tables of much work are dealt over a shuffle's partitions."""

from pyspark.sql import functions as F

from lodestone.functions import text as tx
from lodestone.functions import vocabulary as vo
from lodestone.plans import registry

DATA = "/root/testdata/sf0.001"


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_studies_are_read_once(spark):
    for name in ("p09_family_facts", "p10_device_facts", "p11_performance_facts", "p14_stability_facts"):
        made = registry.QUERIES[name](spark, DATA)
        assert "from_json" not in plan(made), name


def test_metric_names_are_read_once(spark):
    names = ["Average PCE from J-V curve (%)", "Voc [mV]", "Fill factor (FF)", "Jsc (V)", None, "odd", "η (%)", "PCE ()"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(names)], "i int, x string")
    made = df.select("i", vo.metric_parts(F.col("x"), lambda u: F.when(u == "mV", "A-1 kg m2 s-3").when(u == "%", "")).alias("m"))
    assert plan(made).count("short circuit current density") <= 4
    got = [tuple(r.m) for r in made.orderBy("i").collect()]
    none = (None, None, None)
    assert got == [("pce", "mean", "jv_scan", "%"), ("voc", None, None, "mV"), ("ff", *none), ("jsc(v)", *none), (None, *none), ("odd", *none), ("η(%)", *none), ("pce()", *none)]
    assert "REPARTITION_BY_NUM" in plan(registry.QUERIES["x32_metric_parts"](spark, DATA), "executedPlan")


def test_texts_beyond_ascii_still_go_through_icu(spark):
    texts = ["Plain TEXT", "", None, "Straße", "e\u0301", "ﬁn µ", "ΑΣ", "İ"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = df.orderBy("i").select(*[f(F.col("x")) for f in (tx.casefold, tx.nfc, tx.nfkc)]).collect()
    import unicodedata as u

    assert [tuple(r) for r in got] == [(None,) * 3 if x is None else (x.casefold(), u.normalize("NFC", x), u.normalize("NFKC", x)) for x in texts]


def test_places_of_studies_are_judged_once(spark):
    for name in ("j25_study_issues", "j25_study_reports"):
        assert plan(registry.QUERIES[name](spark, DATA)).count("ArrowEvalPython") == 1, name  # the records' digests


def test_windows_keep_a_shuffles_partitions(spark):
    made = registry.QUERIES["w04_plan_windows"](spark, DATA)
    assert "REPARTITION_BY_NUM" in plan(made, "executedPlan") and made.count() == spark.read.parquet(f"{DATA}/conversations.parquet").count()
