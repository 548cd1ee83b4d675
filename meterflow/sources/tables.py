"""Reading, writing and assembling the model's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from meterflow.functions.temporal import lower, upper
from meterflow.plans.intervals import breakpoints, by_interval, located
from meterflow.schemas import DEFAULTS, TABLES

TRUE, FALSE = ("", "true", "1", "yes"), ("false", "0", "no")


def schema_of(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])


def split_list(text: Column) -> Column:
    """A pipe-joined list as an array without empty items; null is an empty list."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\|"), lambda x: x != "")


def typed(df: DataFrame, schema: StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """String columns cast to `schema`: empty cells become defaults or null, pipe lists arrays,
    Boolean words Booleans (unknown words null); missing columns are as empty. Empty Booleans
    without a default are true."""
    defaults = defaults or {}

    def column(f: StructField) -> Column:
        raw = F.trim(F.col(f"`{f.name}`")) if f.name in df.columns else F.lit(None).cast("string")
        if isinstance(f.dataType, ArrayType):
            return split_list(raw).alias(f.name)
        if isinstance(f.dataType, BooleanType):
            word = F.lower(F.nullif(raw, F.lit("")))
            value = F.when(word.isin(*TRUE), True).when(word.isin(*FALSE), False)
            empty = F.lit(bool(defaults.get(f.name, True)))
            return F.when(word.isNull(), empty).otherwise(value).alias(f.name)
        value = F.nullif(raw, F.lit("")).try_cast(f.dataType)
        return (F.coalesce(value, F.lit(defaults[f.name])) if f.name in defaults else value).alias(f.name)

    return df.select(*(column(f) for f in schema))


def scan_table(spark: SparkSession, path: str, schema: StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """A CSV table with a header as `schema`. A missing file is an empty table."""
    try:
        raw = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    return typed(raw, schema, defaults)


def write_table(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """CSV in the declared order of columns: null is empty, arrays are pipe-joined."""
    flat = [
        F.array_join(f.name, "|").alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name).cast("string").alias(f.name)
        for f in (df.schema[c] for c in (columns or df.columns))
    ]
    df.select(*flat).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def load_dataset(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The 13 tables of a folder of CSV files, by name; missing ones are empty with their columns."""
    return {n: scan_table(spark, f"{folder}/{n}.csv", schema_of(n), DEFAULTS.get(n)) for n in TABLES}


def scan_register(export: DataFrame, meters: DataFrame, quantity: str) -> DataFrame:
    """(meter_id, day, v_first, v_last, n_readings) of the listed meters and one quantity. Rows whose
    first or last value is no number are dropped; an unreadable count is 0."""
    rows = export.where(F.col("QUANTITY") == quantity).join(meters.select(F.col("meter_id").alias("METER_ID")), "METER_ID", "left_semi")
    return rows.select(
        F.col("METER_ID").alias("meter_id"),
        F.col("DAY").cast("date").alias("day"),
        F.col("V_FIRST").try_cast("double").alias("v_first"),
        F.col("V_LAST").try_cast("double").alias("v_last"),
        F.coalesce(F.col("N_READINGS").try_cast("long"), F.lit(0)).alias("n_readings"),
    ).where("v_first is not null and v_last is not null")


def first_or_last(df: DataFrame, key: str, position: str, last: bool = False) -> DataFrame:
    """One row per key: that of the smallest (or largest) position."""
    rest = F.struct(*(c for c in df.columns if c != key))
    pick = F.max_by if last else F.min_by
    return df.groupBy(key).agg(pick(rest, position).alias("r")).select(key, *(f"r.{c}" for c in df.columns if c != key))


def assemble_site(workstreams: dict[str, dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Tables of several media put together, in the order given: media types keep their first row,
    buildings their last; reported totals and comparisons get a column `media` from the source."""
    out: dict[str, DataFrame] = {}
    for name in sorted({t for w in workstreams.values() for t in w}):
        parts = []
        for i, (media, tables) in enumerate(workstreams.items()):
            if name in tables:
                part = tables[name].withColumn("_source", F.lit(i))
                parts.append(part.withColumn("media", F.lit(media)) if name in ("reported", "comparisons") else part)
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if name in ("media_types", "buildings"):
            df = first_or_last(df, "media_type_id" if name == "media_types" else "building_id", "_source", last=name == "buildings")
        out[name] = df.drop("_source")
    return out


def extract_readings(export: DataFrame, refs: DataFrame) -> DataFrame:
    """(timeseries_id, timestamp, value): an export row gives a reading to every reference with its
    external id whose window holds the day; the value is the day's last."""
    r = refs.where("external_id is not null and external_id <> ''")
    r = r.select("timeseries_id", F.col("external_id").alias("meter_id"), lower(F.col("valid_from")).alias("lo"), upper(F.col("valid_to")).alias("hi")).where("lo < hi")
    marks = breakpoints(r)
    rows = export.where("v_last is not null").join(r.select("meter_id").distinct(), "meter_id", "left_semi").withColumn("timestamp", F.col("day").cast("timestamp"))
    rows = located(rows.select("meter_id", "timestamp", F.col("v_last").alias("value")), marks).join(by_interval(r, marks), ["meter_id", "since"])
    return rows.select("timeseries_id", "timestamp", "value")


def default_measures(meters: DataFrame, campus: str) -> DataFrame:
    """A meter measures its building, or the campus if it has none."""
    inside = F.col("building_id").isNotNull() & (F.col("building_id") != "")
    return meters.select(
        "meter_id", F.when(inside, "building").otherwise("campus").alias("target_kind"), F.when(inside, F.col("building_id")).otherwise(campus).alias("target_id"),
        F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
    )


def keyed_overlay(base: DataFrame, patch: DataFrame, deletes: DataFrame, key: list[str]) -> DataFrame:
    """`base` without the deleted keys, rows of patched keys replaced, other patches added. Applying
    it again changes nothing. Columns of the patch that the table lacks are refused."""
    unknown = set(patch.columns) - set(base.columns)
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")
    kept = base.join(deletes.select(key).distinct(), key, "left_anti").join(patch.select(key).distinct(), key, "left_anti")
    return kept.select(base.columns).unionByName(patch, allowMissingColumns=True)
