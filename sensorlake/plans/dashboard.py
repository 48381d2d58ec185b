"""Dashboard queries (DSH-1 .. DSH-9), batch form.

The same column logic serves the streaming form in ``sensorlake.streaming.live``; only the
operators Structured Streaming refuses (exact distinct, row_number) are swapped there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake import config
from sensorlake.functions import pollution_level
from sensorlake.operators.dedup import keep_greatest

PM = (config.PM10, config.PM25)


def active_sensors(readings: DataFrame, window: str = "1 hour") -> DataFrame:
    """Distinct sensors reporting per event-time window (DSH-1, exact)."""
    w = F.window("event_ts_utc", window)
    return (readings.where(F.col("event_ts_utc").isNotNull())
                    .groupBy(w.alias("w"))
                    .agg(F.count_distinct("sensor_id").alias("active_sensors"))
                    .select(F.col("w.start").alias("window_start"),
                            F.col("w.end").alias("window_end"), "active_sensors"))


def pm_trend(readings: DataFrame, window: str = "1 hour") -> DataFrame:
    """Average PM10 / PM2.5 per event-time window (DSH-2)."""
    w = F.window("event_ts_utc", window)
    return (readings.where(F.col("value_type").isin(*PM) & F.col("event_ts_utc").isNotNull())
                    .groupBy(w.alias("w"), "value_type")
                    .agg(F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n_readings"))
                    .select(F.col("w.start").alias("window_start"),
                            F.col("w.end").alias("window_end"),
                            "value_type", "avg_value", "n_readings"))


def latest_by_sensor(readings: DataFrame) -> DataFrame:
    """Latest PM reading per sensor and metric with position and colour band (DSH-3)."""
    pm = readings.where(F.col("value_type").isin(*PM)).select(
        "sensor_id", "value_type", "event_ts_utc", "value", "latitude", "longitude")
    latest = keep_greatest(pm, ["sensor_id", "value_type"], ["event_ts_utc"])
    return latest.withColumn("level", pollution_level("value_type", "value"))


def top_polluted(readings: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` locations with the highest average PM10, ties by location id (DSH-4).

    ``orderBy().limit()`` plans as a per-partition top-n followed by one small merge, so no
    global sort of the aggregated locations is needed.
    """
    per_loc = (readings.where(F.col("value_type").isin(*PM))
                       .groupBy("location_id")
                       .agg(F.avg(F.when(F.col("value_type") == config.PM10, F.col("value")))
                             .alias("avg_pm10"),
                            F.avg(F.when(F.col("value_type") == config.PM25, F.col("value")))
                             .alias("avg_pm25"),
                            F.count(F.lit(1)).alias("n_readings")))
    return (per_loc.orderBy(F.col("avg_pm10").desc_nulls_last(), F.col("location_id").asc())
                   .limit(n))


def active_by_region(health: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Active sensors per region: country health rolled up through nation -> region (DSH-5).

    A sensor belongs to one country, so summing per-country distinct counts is exact. Countries
    that name no nation fall into region NULL.
    """
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
                 .select(F.col("n_name").alias("country"), F.col("r_name").alias("region")))
    return (health.join(geo, "country", "left")
                  .groupBy("region")
                  .agg(F.sum("active_sensors").alias("active_sensors"),
                       F.max("last_seen").alias("last_seen"),
                       F.count(F.lit(1)).alias("n_countries")))


def pm_hourly(hourly: DataFrame) -> DataFrame:
    """Hourly averages restricted to PM10 / PM2.5 (DSH-6)."""
    return (hourly.where(F.col("value_type").isin(*PM))
                  .select("country", "hour", "value_type", "avg_value", "n_readings"))


def metric_first_seen(live_readings: DataFrame) -> DataFrame:
    """When each metric first appeared in the live stream (DSH-9)."""
    return (live_readings.groupBy("value_type")
                         .agg(F.min("event_ts_utc").alias("first_event_ts"),
                              F.min("_ingested_at").alias("first_ingested_at"),
                              F.count(F.lit(1)).alias("n_readings")))
