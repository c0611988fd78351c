"""Runs, studies, events and tables as they lie in folders, read by Spark's readers; and ledgers written back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_VERSION = 1
EVENTS = "event_version int, event string, event_id string, sequence long, timestamp timestamp, run_id string, stage_id string, parent_id string, details map<string,string>"
ROSTER = "paper_id string, arm string, repeat int, run_dir string, role string"
USAGE = "prompt_tokens long, completion_tokens long, total_tokens long, cost double, latency_seconds double, provider string, response_model string, response_received boolean"


def read_documents(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(path, document, sha256): each file below ``path`` as one text, with the hash of its bytes. A file is one row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.decode("content", "UTF-8").alias("document"), F.sha2("content", 256).alias("sha256"))


def file_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, bytes, sha256) of all files below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def read_events(spark: SparkSession, path: str, version: int = EVENT_VERSION) -> DataFrame:
    """Events of JSON lines files. A line that is no event, or one of a newer version, is an error; but a
    file's last line that was never ended, and is no event, is what an interrupted writer left, and goes."""
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"), F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("_at"))
    read = lines.withColumn("_bad", F.from_json("value", f"{EVENTS}, _bad string", {"columnNameOfCorruptRecord": "_bad"})["_bad"].isNotNull())
    files = read.groupBy("_file", "_size").agg(F.sum(F.octet_length("value").cast("long") + 1).alias("_bytes"), F.max_by("_bad", "_at").alias("_cut"), F.max_by("value", "_at").alias("_last"), F.count_if("_bad").alias("_n"))
    cut = files.where((F.col("_bytes") == F.col("_size") + 1) & F.col("_cut") & (F.col("_n") == 1)).select("_file", F.col("_last").alias("value"))
    kept = read.join(cut, ["_file", "value"], "left_anti").where(F.trim("value") != "")
    rows = kept.select(F.from_json("value", EVENTS, {"mode": "FAILFAST"}).alias("e")).select("e.*")
    newer = F.col("event_version") > version
    return rows.withColumn("event_version", F.when(newer, F.raise_error(F.concat(F.lit("event version "), F.col("event_version").cast("string")))).otherwise(F.col("event_version")))


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """The runs of an experiment from a CSV file with a header; role is paired where it is empty or absent."""
    rows = spark.read.option("header", "true").option("mode", "FAILFAST").csv(path)
    known = {f.name: f.dataType for f in T.StructType.fromDDL(ROSTER)}
    if not {"paper_id", "arm", "repeat", "run_dir"} <= set(rows.columns) or set(rows.columns) - set(known):
        raise ValueError(f"a roster has the columns {', '.join(known)}, not {', '.join(rows.columns)}")
    role = F.coalesce(F.nullif(F.col("role"), F.lit("")), F.lit("paired")) if "role" in rows.columns else F.lit("paired")
    return rows.select("paper_id", "arm", F.nullif("repeat", F.lit("")).cast("int").alias("repeat"), "run_dir", role.alias("role"))


def read_usage(documents: DataFrame) -> DataFrame:
    """``documents`` (path, document) as usage records."""
    return documents.select("path", F.from_json("document", USAGE, {"mode": "FAILFAST"}).alias("u")).select("path", "u.*")


def read_state(documents: DataFrame, version: int) -> DataFrame:
    """(path, papers): the saved states of version ``version`` or older; a newer one is an error."""
    kind = "version int, papers map<string,string>"
    rows = documents.select("path", F.from_json("document", kind, {"mode": "FAILFAST"}).alias("s"))
    return rows.select("path", F.when(F.col("s.version") > version, F.raise_error(F.lit("the state is of a newer version"))).otherwise(F.col("s.papers")).alias("papers"))


def verify_manifest(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, issue): files of a manifest (path, sha256) that are missing or differ, and files that it does not name."""
    a, b = manifest.select("path", F.col("sha256").alias("_a")), files.select("path", F.col("sha256").alias("_b"))
    issue = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "not listed").when(F.col("_a") != F.col("_b"), "changed")
    return a.join(b, "path", "full_outer").select("path", issue.alias("issue")).where("issue is not null")


def append_ledger(rows: DataFrame, path: str, run_id: str) -> None:
    """Adds a run's rows to a ledger by run; a run that is written again replaces its own rows only."""
    rows.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def write_lines(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines, nulls included."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
