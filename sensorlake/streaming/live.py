"""Live dashboard queries on Structured Streaming (DSH-1 .. DSH-3) and streaming readings.

All three give exact results: active sensors are kept as one (window, sensor) row each and counted
on read, the trend averages readings from which repeats were dropped, the latest reading is the
greatest by a total order. A ``watermark`` bounds the trend's state and gives up rows that are
later than it; without one (the default) nothing is dropped, as a replay of old data needs. Event
time must be TIMESTAMP (not TIMESTAMP_NTZ) for ``withWatermark``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake import config
from sensorlake.functions import pollution_level
from sensorlake.operators.reshape import unpivot_metrics
from sensorlake.plans.silver import clean_readings
from sensorlake.streaming.sinks import start_append

PM = (config.PM10, config.PM25)


def live_readings(live_bronze: DataFrame, settings: config.Settings | None = None) -> DataFrame:
    """Stateless: bronze live rows -> typed long readings (no dedup; see ``dedup_stream``)."""
    s = settings or config.Settings()
    long = unpivot_metrics(live_bronze, config.READING_ID_COLUMNS, s.metrics)
    return clean_readings(long, s.drop_infinite)


def dedup_stream(readings: DataFrame, watermark: str | None = "1 hour") -> DataFrame:
    """Drop repeats of (sensor, time, metric): within the watermark's delay, later rows than that
    being dropped too; without a watermark over the whole stream, with a key of state for each."""
    key = ["sensor_id", "event_ts_utc", "value_type"]
    if watermark is None:
        return readings.dropDuplicates(key)
    return readings.withWatermark("event_ts_utc", watermark).dropDuplicatesWithinWatermark(key)


def stream_active_sensors(readings: DataFrame, window: str = "5 minutes") -> DataFrame:
    """(window, sensor) pairs for a keyed upsert table; no state, so nothing is ever late."""
    w = F.window("event_ts_utc", window)
    return (readings.where(F.col("sensor_id").isNotNull() & F.col("event_ts_utc").isNotNull())
            .select(w.alias("w"), "sensor_id")
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "sensor_id"))


def count_active_sensors(pairs: DataFrame) -> DataFrame:
    """The exact number of active sensors per window, from the upsert table."""
    return pairs.groupBy("window_start", "window_end").agg(
        F.count_distinct("sensor_id").alias("active_sensors"))


def stream_pm_trend(readings: DataFrame, window: str = "5 minutes",
                    watermark: str | None = None) -> DataFrame:
    """Window averages of PM readings; a redelivered message counts once."""
    pm = readings.where(F.col("value_type").isin(*PM) & F.col("event_ts_utc").isNotNull())
    return (dedup_stream(pm, watermark)
            .groupBy(F.window("event_ts_utc", window).alias("w"), "value_type")
            .agg(F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n_readings"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "value_type", "avg_value", "n_readings"))


def stream_latest_by_sensor(readings: DataFrame) -> DataFrame:
    """Latest PM reading per (sensor, metric) as a continuously updated table (update mode): the
    greatest by time, value, latitude and longitude, whatever order rows arrive in. A reading
    without a time is the earliest."""
    latest = (readings.where(F.col("value_type").isin(*PM))
              .groupBy("sensor_id", "value_type")
              .agg(F.max(F.struct("event_ts_utc", "value", "latitude", "longitude")).alias("r"))
              .select("sensor_id", "value_type", "r.*"))
    return latest.withColumn("level", pollution_level("value_type", "value"))


def start_silver_stream(spark, bronze_live_path: str, silver_path: str, checkpoint: str,
                        watermark: str = "1 hour", settings: config.Settings | None = None,
                        available_now: bool = False, trigger: str | None = None):
    """Near-real-time silver: new live bronze files -> typed long readings, repeats within the
    watermark dropped, appended to ``silver_path`` partitioned by event date.

    Rows later than the watermark are dropped, as are rows without a time; the batch rebuild
    (``plans.incremental``) is the exact table.
    """
    schema = spark.read.option("mergeSchema", True).parquet(bronze_live_path).schema
    bronze = spark.readStream.schema(schema).parquet(bronze_live_path)
    timed = live_readings(bronze, settings).where(F.col("event_ts_utc").isNotNull())
    readings = dedup_stream(timed, watermark)
    out = readings.withColumn("event_date", F.to_date("event_ts_utc"))
    return start_append(out, silver_path, checkpoint, available_now=available_now,
                        trigger=trigger, partition_by=["event_date"])
