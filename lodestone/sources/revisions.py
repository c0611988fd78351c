"""Tables that are published once: numbered revisions below a folder, each written by one job or refused.

Spark writes the rows to a folder of the writer's own, with its usual committer, so that lost and
repeated tasks leave nothing behind. Then the driver creates the revision's manifest, which names that
folder and seals its files by size and SHA-256. The manifest is created exclusively: of two writers
of one revision one gets it, the other an error, and nothing that is published ever changes. Readers
see a revision only through its manifest."""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = "revision-{:012d}.json"


class RevisionExists(ValueError):
    """The revision is another writer's."""


class Conflict(ValueError):
    """The table has moved on from the revision that the writer knew."""

    def __init__(self, expected: int, current: int):
        super().__init__(f"expected revision {expected}, found {current}")
        self.expected, self.current = expected, current


def _system(spark: SparkSession, path: str):
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = held.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(held)


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with its whole content, or says that it is there already.

    On a shared folder a finished file is linked to the name, which fails if the name is taken; other
    systems create without overwriting, which theirs do atomically."""
    system, place = _system(spark, path)
    whole = urlparse(place.toString())
    if whole.scheme == "file":
        name = unquote(whole.path)
        own = f"{name}.{uuid.uuid4().hex}"
        with open(own, "x") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(own, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
        return True
    if system.exists(place):
        return False
    try:
        out = system.create(place, False)
    except Exception as error:  # the gateway's error carries Hadoop's
        if "AlreadyExists" in str(error):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def seal(spark: SparkSession, folder: str) -> DataFrame:
    """(name, size, sha256) of the data files below a folder; the tasks read and hash them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256")).where(~F.col("name").rlike("^[_.]"))


def publish(df: DataFrame, path: str, revision: int) -> dict:
    """Writes ``df`` as the revision (1, 2, ...) and returns its manifest; RevisionExists if there is one.

    The loser's rows are removed. An empty table is published as such. The manifest has a line of
    data for each file, so as many as the writing job has tasks."""
    if revision < 1:
        raise ValueError("revisions are numbered from 1")
    spark, own = df.sparkSession, uuid.uuid4().hex
    system, root = _system(spark, path)
    system.mkdirs(root)
    folder = f"{root.toString()}/data-{own}"
    df.write.parquet(folder)
    files = [r.asDict() for r in seal(spark, folder).orderBy("name").collect()]
    manifest = {"revision": revision, "data": f"data-{own}", "schema": json.loads(df.schema.json()), "files": files}
    if not _create(spark, f"{root.toString()}/{_NAME.format(revision)}", json.dumps(manifest, sort_keys=True) + "\n"):
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)
        raise RevisionExists(f"revision {revision} of {path} is published already")
    return manifest


def revisions(spark: SparkSession, path: str) -> list[int]:
    """The published revisions, in order."""
    system, root = _system(spark, path)
    if not system.exists(root):
        return []
    names = [x.getPath().getName() for x in system.listStatus(root)]
    return sorted(int(n[9:-5]) for n in names if n.startswith("revision-") and n.endswith(".json") and n[9:-5].isdecimal())


def manifest(spark: SparkSession, path: str, revision: int) -> dict:
    _, root = _system(spark, path)
    if revision not in revisions(spark, path):
        raise ValueError(f"{path} has no revision {revision}")
    text = "".join(r.value for r in spark.read.text(f"{root.toString()}/{_NAME.format(revision)}", wholetext=True).collect())
    if not text.endswith("\n"):
        raise ValueError(f"revision {revision} of {path} is still being published")
    return json.loads(text)


def read(spark: SparkSession, path: str, revision: int | None = None) -> DataFrame:
    """The rows of a revision, by default the last one."""
    known = revisions(spark, path)
    if not known:
        raise ValueError(f"{path} has no revision")
    from pyspark.sql.types import StructType

    own = manifest(spark, path, known[-1] if revision is None else revision)
    _, root = _system(spark, path)
    return spark.read.schema(StructType.fromJson(own["schema"])).parquet(f"{root.toString()}/{own['data']}")


def compare_and_swap(df: DataFrame, path: str, expected: int) -> dict:
    """Publishes ``df`` as the revision after ``expected`` (0: there is none yet) if that is still the last one;
    else Conflict, which tells the current one. Of two writers that know the same revision one succeeds."""
    spark = df.sparkSession
    current = max(revisions(spark, path), default=0)
    if current != expected:
        raise Conflict(expected, current)
    try:
        return publish(df, path, expected + 1)
    except RevisionExists:
        raise Conflict(expected, max(revisions(spark, path))) from None


def differences(spark: SparkSession, path: str, revision: int) -> DataFrame:
    """(name, problem) of the files that are not as sealed: missing, added or changed."""
    own = manifest(spark, path, revision)
    _, root = _system(spark, path)
    sealed = spark.createDataFrame([(f["name"], f["size"], f["sha256"]) for f in own["files"]], "name string, size long, sha256 string")
    now = seal(spark, f"{root.toString()}/{own['data']}").select("name", F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    both = sealed.join(now, "name", "full_outer")
    problem = F.when(F.col("_sha").isNull(), "missing").when(F.col("sha256").isNull(), "added").when((F.col("size") != F.col("_size")) | (F.col("sha256") != F.col("_sha")), "changed")
    return both.select("name", problem.alias("problem")).where("problem is not null")


def abandoned(spark: SparkSession, path: str) -> list[str]:
    """Data folders that no manifest names: of writers that died between writing and publishing, or that
    are still at work. To be removed when none is."""
    system, root = _system(spark, path)
    used = {manifest(spark, path, r)["data"] for r in revisions(spark, path)}
    return sorted(n for n in (x.getPath().getName() for x in system.listStatus(root)) if n.startswith("data-") and n not in used)
