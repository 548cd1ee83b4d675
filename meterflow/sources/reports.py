"""Reported figures, formula terms and id lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def inject_manual(refs: DataFrame, readings: DataFrame, monthly: DataFrame) -> DataFrame:
    """(timeseries_id, timestamp, value): for raw references without readings, a counter of the
    manual monthly values (external_id, month, value) at month ends, from 0 on the last day of the
    year before the first."""
    open_ = refs.where("kind = 'raw'").join(readings.select("timeseries_id").distinct(), "timeseries_id", "left_anti")
    rows = open_.select("timeseries_id", "external_id").join(monthly, "external_id").where("value is not null")
    day = F.last_day(F.to_date(F.concat("month", F.lit("-01"))))
    total = F.sum("value").over(Window.partitionBy("timeseries_id").orderBy("month"))
    counted = rows.select("timeseries_id", day.cast("timestamp").alias("timestamp"), total.alias("value"))
    start = rows.groupBy("timeseries_id").agg(F.min("month").alias("m")).select(
        "timeseries_id", F.date_sub(F.trunc(F.to_date(F.concat("m", F.lit("-01"))), "year"), 1).cast("timestamp").alias("timestamp"), F.lit(0.0).alias("value")
    )
    return start.unionByName(counted)


def unpivot_months(wide: DataFrame, id_col: str, months: dict[str, str]) -> DataFrame:
    """(id_col, month, value) from one column per month (column -> month key); cells that are no numbers are skipped."""
    text = wide.select(id_col, *(F.col(c).cast("string").alias(m) for c, m in months.items()))
    long = text.unpivot(id_col, list(months.values()), "month", "raw")
    return long.select(id_col, "month", F.col("raw").try_cast("double").alias("value")).where("value is not null")


def building_id_of(label: Column) -> Column:
    """Building id of a report's row label, or null for rows to skip.

    Summaries and gardens are skipped; an intake's id is the last word with B and a digit in its
    label; of labels with a bracket only those with (T) are buildings, without it; parking is
    BPARKING; labels that start like a building but have a dot are meters and skipped; every other
    label is kept, with the prefix B. Null and empty labels are null.
    """
    t = F.regexp_replace(label, r"^\s+|\s+$", "")
    low = F.lower(t)
    words = F.filter(F.split(t, r"\s+"), lambda w: w.startswith("B") & w.rlike("[0-9]"))
    bare = F.trim(F.substring_index(t, "(", 1))
    in_brackets = F.trim(F.regexp_extract(t, r"^[^(]*\(([^)]*)\)", 1))
    return (
        F.when(t.isNull() | (t == "") | low.startswith("summa") | low.startswith("trädgård"), None)
        .when(low.startswith("intagsmätare"), F.coalesce(F.get(words, F.size(words) - 1), F.concat(F.lit("B"), t)))
        .when(t.contains("("), F.when(in_brackets == "T", F.when(bare.startswith("B"), bare).otherwise(F.concat(F.lit("B"), bare))))
        .when(low == "parkering", "BPARKING")
        .when(t.rlike("^B[0-9]"), F.when(~t.contains("."), t))
        .otherwise(F.concat(F.lit("B"), t))
    )


def dedupe_totals(totals: DataFrame) -> DataFrame:
    """One row per (building_id, month): the larger absolute value, the first position on a tie."""
    best = F.max_by(F.struct("value", "position"), F.struct(F.abs("value"), -F.col("position")))
    return totals.groupBy("building_id", "month").agg(best.alias("r")).select("building_id", "month", "r.value")


def sheet_factor(terms: DataFrame) -> DataFrame:
    """(sheet, factor): an explicit scalar in (0, 1); else the factor that all terms share; else 1."""
    explicit = F.max(F.when((F.col("scalar") > 0) & (F.col("scalar") < 1), F.col("scalar")))
    shared = F.when((F.count_distinct("faktor") == 1) & (F.count("faktor") == F.count("*")), F.min("faktor"))
    return terms.groupBy("sheet").agg(F.coalesce(explicit, shared, F.lit(1.0)).alias("factor"))


def apply_sheet_factor(totals: DataFrame, factors: DataFrame) -> DataFrame:
    """Totals (sheet, building_id, month, value) divided by their sheet's factor."""
    return totals.join(factors, "sheet", "left").withColumn("value", F.col("value") / F.coalesce("factor", F.lit(1.0))).drop("factor")


def meters_used(terms: DataFrame) -> DataFrame:
    """(meter_id, roles, buildings): sorted, pipe-joined sets."""
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "|")
    return terms.groupBy("meter_id").agg(joined("role").alias("roles"), joined("building").alias("buildings"))


def intake_catalog(rows: DataFrame, media: str) -> DataFrame:
    """Rows of one medium, whatever its case and outer blanks; missing cells are empty."""
    return rows.where(F.lower(F.trim("media")) == media.lower()).fillna("")


def crosswalk(rows: DataFrame, key: str, value: str, own: bool = False) -> DataFrame:
    """(key, id): rows with a key and an id; with `own`, a missing id is the key itself."""
    clean = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    target = F.coalesce(clean(value), clean(key)) if own else clean(value)
    return rows.select(clean(key).alias("key"), target.alias("id")).where("key is not null and id is not null").distinct()


def crosswalk_by_labels(rows: DataFrame, value: str, labels: list[Column], position: str) -> DataFrame:
    """(key, id): every non-empty label of a row leads to its id; of several rows the last counts."""
    keys = rows.where(F.coalesce(F.trim(F.col(value)), F.lit("")) != "").select(F.explode(F.array(*labels)).alias("key"), F.col(value).alias("id"), F.col(position).alias("p"))
    return keys.where("key is not null and key <> ''").groupBy("key").agg(F.max_by("id", F.struct("p", "id")).alias("id"))


def draft_crosswalk(sources: list[DataFrame], id_col: str) -> DataFrame:
    """The distinct ids of several extracts."""
    ids = (df.select(F.col(id_col)).where(F.coalesce(F.col(id_col), F.lit("")) != "") for df in sources)
    return reduce(lambda a, b: a.union(b), ids).distinct()
