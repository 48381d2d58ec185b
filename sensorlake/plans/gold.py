"""Gold products over silver readings and devices (PIP-8 .. PIP-11).

Plan shape. Readings are the fact (billions of rows), devices a dimension filtered to outdoor
sensors before the join. The products join first and then aggregate by country and time bucket:
where the planner broadcasts the dimension, that is one exchange of partial aggregates, and a hot
sensor is absorbed map-side. Jobs that need several products store per-sensor statistics once and
roll them up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake import config
from sensorlake.functions import anomaly_flag, outdoor


def _outdoor_devices(devices: DataFrame) -> DataFrame:
    return devices.where(outdoor("indoor")).select("sensor_id", "country")


def _by_country(readings: DataFrame, devices: DataFrame, name: str, bucket: F.Column):
    return (readings.select("sensor_id", bucket.alias(name), "value_type", "value")
            .join(_outdoor_devices(devices), "sensor_id").groupBy("country", name, "value_type"))


def air_quality_hourly(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """AVG/MIN/MAX/COUNT by device country, hour and metric, outdoor sensors only (AGG-1)."""
    return _by_country(readings, devices, "hour", F.date_trunc("hour", "event_ts_utc")).agg(
        F.avg("value").alias("avg_value"), F.min("value").alias("min_value"),
        F.max("value").alias("max_value"), F.count(F.lit(1)).alias("n_readings"))


def air_quality_daily(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """AVG/COUNT by device country, day and metric, outdoor sensors only (AGG-2)."""
    return _by_country(readings, devices, "day", F.to_date("event_ts_utc")).agg(
        F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n_readings"))


def sensor_metric_last_seen(readings: DataFrame) -> DataFrame:
    """One row per (sensor, metric) with its latest event time: the bounded state behind the
    network-health view (rows = sensors x metrics, however many readings there are)."""
    return (readings.groupBy("sensor_id", "value_type")
                    .agg(F.max("event_ts_utc").alias("last_seen")))


def merge_last_seen(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Fold newer (sensor, metric) last-seen rows into the current table (latest wins)."""
    both = current.unionByName(updates)
    return both.groupBy("sensor_id", "value_type").agg(F.max("last_seen").alias("last_seen"))


def health_from_last_seen(last_seen: DataFrame, devices: DataFrame) -> DataFrame:
    dev = devices.select("sensor_id", "country")
    return (last_seen.join(dev, "sensor_id")
            .groupBy("country")
            .agg(F.count_distinct("sensor_id").alias("active_sensors"),
                 F.max("last_seen").alias("last_seen"),
                 F.count_distinct("value_type").alias("distinct_metrics_seen")))


def sensor_network_health(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """Distinct sensors, freshness and distinct metrics per device country (AGG-3).

    No indoor filter. Readings are first reduced to one row per (sensor, metric); the two
    distinct counts then run over that bounded set instead of expanding the fact twice.
    """
    return health_from_last_seen(sensor_metric_last_seen(readings), devices)


def sensor_hourly(readings: DataFrame) -> DataFrame:
    """Per (sensor, hour, metric) partial statistics: sum, count, min, max and latest time.

    The one reduction of the fact that hourly, daily and network health can all be rolled up
    from (sums and counts recombine exactly into averages); a job materializes it once instead
    of scanning the readings for each product.
    """
    return (readings.groupBy("sensor_id", F.date_trunc("hour", "event_ts_utc").alias("hour"),
                             "value_type")
                    .agg(F.sum("value").alias("_sum"), F.count(F.lit(1)).alias("_n"),
                         F.min("value").alias("_min"), F.max("value").alias("_max"),
                         F.max("event_ts_utc").alias("_last")))


def hourly_from_sensor_hourly(sh: DataFrame, devices: DataFrame) -> DataFrame:
    return (sh.join(_outdoor_devices(devices), "sensor_id")
              .groupBy("country", "hour", "value_type")
              .agg((F.sum("_sum") / F.sum("_n")).alias("avg_value"),
                   F.min("_min").alias("min_value"),
                   F.max("_max").alias("max_value"),
                   F.sum("_n").alias("n_readings")))


def daily_from_sensor_hourly(sh: DataFrame, devices: DataFrame) -> DataFrame:
    return (sh.withColumn("day", F.to_date("hour"))
              .join(_outdoor_devices(devices), "sensor_id")
              .groupBy("country", "day", "value_type")
              .agg((F.sum("_sum") / F.sum("_n")).alias("avg_value"),
                   F.sum("_n").alias("n_readings")))


def last_seen_from_sensor_hourly(sh: DataFrame) -> DataFrame:
    return sh.groupBy("sensor_id", "value_type").agg(F.max("_last").alias("last_seen"))


def anomalies(readings: DataFrame, devices: DataFrame,
              thresholds: config.Thresholds | None = None) -> DataFrame:
    """Every outdoor PM reading with its breach flag, NULL when within limits (PIP-11).

    Left join: an unregistered sensor keeps its event country. The indoor test sits above the
    outer join, where a missing device reads as unknown, hence outdoor.
    """
    pm = (readings.where(F.col("value_type").isin(config.PM10, config.PM25)
                         & F.col("value").isNotNull())
                  .select("sensor_id", "event_ts_utc", "value_type", "value", "location_id",
                          F.col("country").alias("_event_country")))
    dev = devices.select("sensor_id", F.col("country").alias("_device_country"), "indoor")
    return (pm.join(dev, "sensor_id", "left")
              .where(outdoor("indoor"))
              .select("sensor_id", "event_ts_utc", "value_type", "value", "location_id",
                      F.coalesce("_device_country", "_event_country").alias("country"),
                      anomaly_flag("value_type", "value", thresholds).alias("anomaly_flag")))


def anomaly_breaches(readings: DataFrame, devices: DataFrame,
                     thresholds: config.Thresholds | None = None) -> DataFrame:
    """Only the readings that breach a threshold (DSH-8)."""
    return (anomalies(readings, devices, thresholds)
            .where(F.col("anomaly_flag").isNotNull()))
