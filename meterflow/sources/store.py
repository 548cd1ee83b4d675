"""Tables kept by month: Parquet in a folder per month, clustered by a hash of the series or meter.

A month is the unit of change: `put_months` replaces those that the rows lie in and leaves the files of
all others alone. Filters on time read only their months' folders. Within a month rows are dealt out by
a hash of the key, so a month with most of the rows is written by many tasks, and sorted by key and time,
so that a key's rows lie in few row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

MONTH = "month"


def month_start(time: Column) -> Column:
    return F.trunc(time.cast("date"), "month")


def _by_month(df: DataFrame, key: str, parts: int) -> DataFrame:
    rows = df.withColumn(MONTH, month_start(F.col("timestamp"))).withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)))
    return rows.repartition(MONTH, "_part").sortWithinPartitions(MONTH, key, "timestamp").drop("_part")


def put_months(df: DataFrame, path: str, key: str = "timeseries_id", parts: int = 16) -> None:
    """Write `df` (with a column timestamp), replacing the months that it has rows in."""
    _by_month(df, key, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def add_rows(df: DataFrame, path: str, key: str = "timeseries_id", parts: int = 16) -> None:
    """Write `df` beside what its months have."""
    _by_month(df, key, parts).write.mode("append").partitionBy(MONTH).parquet(path)


def read_months(spark: SparkSession, path: str, schema: StructType, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows with times in [start, end), from the folders of these months only; `month` is kept."""
    rows = spark.read.schema(StructType([*schema.fields, StructField(MONTH, DateType())])).parquet(path)
    time = F.col("timestamp")
    if start is not None:
        rows = rows.where((F.col(MONTH) >= month_start(F.lit(start))) & (time >= start))
    if end is not None:
        rows = rows.where((F.col(MONTH) <= month_start(F.lit(end))) & (time < end))
    return rows
