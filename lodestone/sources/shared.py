"""Tables between the steps of a job, in the folder that driver and executors share."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; only a local session without that setting gets one set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "/tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/lodestone-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table at ``path``, read back: what comes after does not compute it again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt by the keys over as many partitions as a shuffle has. A count that is given is kept, where
    partitions of few bytes would else become a few tasks, however much work a row is."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *map(F.col, by))


def folder_table(path: str) -> pa.Table | None:
    """What ``path``, a folder of Parquet files below ``folder``, holds, read in a task; None if there is no such folder."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    system, own = (pa.fs.LocalFileSystem(), path) if path.startswith("/") else pa.fs.FileSystem.from_uri(path)
    if system.get_file_info(own).type == pa.fs.FileType.NotFound:
        return None
    return pa.parquet.read_table(own, filesystem=system, partitioning=None)
