"""Own consumption kept up to date as readings and late corrections arrive (X1 through C9 and Q2).

A folder holds, by month: all readings, every series' last reading of the month, net flow per meter, and
consumption per place. A batch of readings changes the differences of their series in their months, and
the first one in the next month that a series has. Of what follows from them, flow, sub-meters, feeds and
places, everything is a matter of one time. So exactly these months are computed again, from their own
readings and the last ones carried into them, and their folders replaced; all others stay as they are.
A batch that is applied again, as after a failure, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, StructField, StructType, TimestampType

from meterflow.operators.flow import measured_flow, meter_flow, meter_net
from meterflow.operators.rollup import attributed, consumption
from meterflow.plans.scan import CHUNK
from meterflow.plans.stage import staged
from meterflow.sources.store import MONTH, add_rows, month_start, put_months, read_months


def _schema(**kinds: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


READINGS = _schema(timeseries_id=StringType(), timestamp=TimestampType(), value=DoubleType(), recorded_at=TimestampType())
NET = _schema(meter_id=StringType(), timestamp=TimestampType(), net=DoubleType())
PLACES = _schema(level=StringType(), id=StringType(), timestamp=TimestampType(), net=DoubleType())


def refresh(arrived: DataFrame, folder: str, site: dict[str, DataFrame]) -> list[str]:
    """Apply a batch of readings to `folder`; `site` has refs, sensors, relations, measures, zones and
    buildings. Returns the months that were computed again."""
    spark = arrived.sparkSession
    new = staged(arrived.select("timeseries_id", "timestamp", F.col("value").cast("double").alias("value"), "recorded_at").where("timestamp is not null"), "arrived")
    if new.isEmpty():
        return []
    add_rows(new, f"{folder}/readings")
    touched = new.select("timeseries_id", month_start(F.col("timestamp")).alias(MONTH)).distinct()
    in_months = lambda rows, months: rows.where(F.col(MONTH).isin(months))
    dates = lambda rows: sorted(r[0] for r in rows.select(MONTH).distinct().collect())  # noqa: E731  as many as the data has months
    here = dates(touched)
    readings = read_months(spark, f"{folder}/readings", READINGS)
    last = F.max(F.struct("timestamp", "recorded_at", "value")).alias("last")
    put_months(in_months(readings, here).groupBy("timeseries_id", MONTH).agg(last).select("timeseries_id", "last.*"), f"{folder}/lasts")
    lasts = read_months(spark, f"{folder}/lasts", READINGS)
    later = touched.join(lasts.select("timeseries_id", F.col(MONTH).alias("next")), "timeseries_id").where(F.col("next") > F.col(MONTH))
    following = later.groupBy("timeseries_id", MONTH).agg(F.min("next").alias("next")).select(F.col("next").alias(MONTH))
    again = dates(touched.select(MONTH).union(following))
    carried = lasts.where(F.col(MONTH) <= again[-1]).withColumnRenamed(MONTH, CHUNK)
    measured = measured_flow(in_months(readings, again).drop(MONTH), site["refs"], site["sensors"], lasts=carried)
    net = staged(meter_net(meter_flow(measured, site["relations"]), site["relations"]), "net")
    put_months(net, f"{folder}/net", "meter_id")
    put_months(consumption(attributed(net, site["measures"], site["zones"], site["buildings"])), f"{folder}/places", "id")
    return [d.isoformat()[:7] for d in again]


def refresh_stream(readings: DataFrame, folder: str, site: dict[str, DataFrame], checkpoint: str):
    """`refresh` for every batch of a stream of readings, until all that is there now is read."""
    writer = readings.writeStream.foreachBatch(lambda batch, _: refresh(batch, folder, site) and None)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def net_table(spark: SparkSession, folder: str, start: str | None = None, end: str | None = None) -> DataFrame:
    return read_months(spark, f"{folder}/net", NET, start, end).drop(MONTH)


def places_table(spark: SparkSession, folder: str, start: str | None = None, end: str | None = None) -> DataFrame:
    return read_months(spark, f"{folder}/places", PLACES, start, end).drop(MONTH)
