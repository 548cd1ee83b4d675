"""Cutting long lineages: tables written to the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``). Where the setting is missing in local
    mode, as in tests, a new temporary folder is made and set for the rest of the session; elsewhere
    executors could not see it, and the call raises."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="meterflow-")
        spark.sparkContext.setCheckpointDir(where)
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def _on_disk(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


_folders: dict[tuple[str, str], str] = {}


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's folder in the shared folder; that goes when the application ends."""
    key = (spark.sparkContext.applicationId, shared_dir(spark))
    if key not in _folders:
        folder = f"{key[1]}/meterflow-{key[0]}-{uuid.uuid4().hex}"
        fs, where = _on_disk(spark, folder)
        fs.mkdirs(where)
        fs.deleteOnExit(where)
        _folders[key] = folder
    return f"{_folders[key]}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` written once as Parquet, with the writer's `options`, and read back: what follows neither
    recomputes it nor depends on the executors that made it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def counted(df: DataFrame, name: str, **of: Column) -> tuple[DataFrame, dict[str, int]]:
    """`staged`, and the number of rows for which each condition in `of` holds, counted on the way: loops
    need no job of their own to see whether they are done."""
    seen = Observation()
    out = staged(df.observe(seen, *(F.count_if(c).alias(n) for n, c in of.items())), name)
    return out, {n: seen.get.get(n) or 0 for n in of}


def release(*tables: DataFrame) -> None:
    """Delete tables that `staged` returned and nothing will read any more."""
    for t in tables:
        fs, where = _on_disk(t.sparkSession, t._staged_path)
        fs.delete(where, True)
