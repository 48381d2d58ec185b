"""Job entry points: each reads tables, runs one product and writes its result.

The run order follows the pipeline this library reproduces: device registry -> archive and live
bronze loads -> silver readings -> silver devices -> gold. Every job appends one row to the run
log when a ``run_log`` path is given; row counts come from observed metrics of the writing job
or from a count of the written parquet table (metadata only).
Paths may be any Hadoop-compatible location shared by the cluster. Readings and gold tables are
published: ``tables.read_published`` reads them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import config, schemas, tables
from sensorlake.plans import bronze, gold, incremental, manifest, ops, silver
from sensorlake.plans.registry import build_registry
from sensorlake.session import scratch_path
from sensorlake.sources.bus import read_api_records


def _logged(spark: SparkSession, job: str, run_log: str | None, body: Callable[[], tuple]) -> tuple:
    started = dt.datetime.now(dt.timezone.utc)
    try:
        rows_in, rows_out = body()
    except Exception as e:
        if run_log:
            ops.append_run_log(ops.run_log_row(spark, job, started, "failed", None, None,
                                               str(e)), run_log)
        raise
    if run_log:
        ops.append_run_log(ops.run_log_row(spark, job, started, "succeeded", rows_in, rows_out),
                           run_log)
    return rows_in, rows_out


def registry_job(spark: SparkSession, api_path: str, registry_path: str,
                 settings: config.Settings | None = None, run_log: str | None = None) -> tuple:
    """API response files -> first allowed record per sensor -> upsert into the registry."""
    s = settings or config.Settings()

    def body():
        recs, seen = ops.with_counters(read_api_records(spark, api_path), "records")
        updates = build_registry(recs, s.allowed_sensor_types)
        tables.upsert_path(spark, updates, registry_path, ["sensor_id"], schemas.REGISTRY_RAW)
        return seen.get["rows"], tables.read_upserted(spark, registry_path).count()

    return _logged(spark, "device_registry", run_log, body)


def archive_job(spark: SparkSession, landing: str, target: str, checkpoint: str,
                schema_location: str, settings: config.Settings | None = None,
                run_log: str | None = None, **options) -> tuple:
    """New archive files -> bronze (``bronze.load_archive``); logs data lines read and rows
    written over all micro-batches."""
    def body():
        counts = {"in": 0, "out": 0}
        bronze.load_archive(spark, landing, target, checkpoint, schema_location, settings,
                            counts=counts, **options)
        return counts["in"], counts["out"]

    return _logged(spark, bronze.ARCHIVE, run_log, body)


def live_job(spark: SparkSession, fmt: str, options: dict[str, str], target: str, checkpoint: str,
             path: str | None = None, settings: config.Settings | None = None,
             run_log: str | None = None, available_now: bool = False) -> None:
    """The live load until it ends: drained with ``available_now``, else when it is stopped or
    fails. Its run-log row is written at its end either way."""
    log = ops.StreamLog(spark, run_log, {bronze.LIVE}) if run_log else None
    if log:
        spark.streams.addListener(log)
    try:
        q = bronze.load_live(spark, fmt, options, target, checkpoint, path, settings, available_now)
        try:
            q.awaitTermination()
        finally:
            if log:
                log.wait(q)
    finally:
        if log:
            spark.streams.removeListener(log)


def silver_readings_job(spark: SparkSession, live_path: str, archive_path: str,
                        readings_path: str, settings: config.Settings | None = None,
                        dates: DataFrame | None = None, run_log: str | None = None) -> tuple:
    """Bronze live + archive -> silver readings, partitioned by event date.

    Without ``dates`` a new version of the whole table is published, so nothing of an older one remains. With the
    distinct event dates that new rows touch (``incremental.touched_dates``), their partitions are
    emptied of rows that no longer exist and rebuilt; the others stay as they are.
    """
    s = settings or config.Settings()

    def body():
        live = bronze.read_table(spark, live_path)
        arch = bronze.read_table(spark, archive_path)
        if dates is None:
            out, n = ops.with_counters(incremental.full_readings(live, arch, s), "readings")
            tables.publish(spark, out.hint("rebalance", incremental.DATE_COL), readings_path,
                           [incremental.DATE_COL])
        else:
            out, n = ops.with_counters(incremental.readings_for_dates(live, arch, dates, s),
                                       "readings")
            tables.replace_days(spark, out, tables.published_at(spark, readings_path),
                                incremental.DATE_COL, dates)
        return None, n.get["rows"]

    return _logged(spark, "silver_readings", run_log, body)


def silver_devices_job(spark: SparkSession, registry_path: str, live_path: str,
                       devices_path: str, run_log: str | None = None,
                       positions_path: str | None = None,
                       new_live: DataFrame | None = None) -> tuple:
    """Registry resolved with the latest live position -> upsert into the device dimension.

    ``positions_path`` keeps the newest live row per sensor between runs; with ``new_live`` (the
    rows that arrived since) only those are read and merged into it instead of all live bronze.
    """

    def body():
        reg = tables.read_upserted(spark, registry_path)
        if positions_path is None:
            updates = silver.resolve_devices(reg, bronze.read_table(spark, live_path))
        else:
            if new_live is None or not tables.path_exists(spark, positions_path):
                positions = silver.live_positions(bronze.read_table(spark, live_path))
            else:
                positions = silver.merge_positions(tables.read_published(spark, positions_path),
                                                   silver.live_positions(new_live))
            tables.publish(spark, positions, positions_path)
            updates = silver.devices_at(reg, tables.read_published(spark, positions_path))
        tables.upsert_path(spark, updates, devices_path, ["sensor_id"], schemas.DEVICES)
        return reg.count(), tables.read_upserted(spark, devices_path).count()

    return _logged(spark, "silver_devices", run_log, body)


SENSOR_HOURLY = "_sensor_hourly"
LAST_SEEN = "_sensor_metric_last_seen"


def gold_job(spark: SparkSession, readings_path: str, devices_path: str, gold_root: str,
             settings: config.Settings | None = None, run_log: str | None = None,
             dates: DataFrame | None = None) -> dict:
    """Gold tables from silver (readings partitioned by ``event_date``).

    The readings are reduced once to per-(sensor, hour, metric) statistics, kept as a table
    partitioned by ``day``; hourly, daily and the per-(sensor, metric) last-seen state are rolled
    up from it, anomalies (row level) read the readings. Without ``dates`` everything is
    recomputed and replaced (staged swap). With ``dates`` (a distributed column of event dates;
    NULL stands for readings without a time) only those ``day`` partitions are recomputed, reading
    only those silver partitions. Dates must include every day of the sensors whose device changed
    (``device_dates``). Network health is always exact: the last-seen state is merged with the new
    statistics and joined with the current devices.
    """
    s = settings or config.Settings()
    readings = tables.read_published(spark, readings_path)
    if dates is not None:
        readings = incremental.on_dates(readings, incremental.DATE_COL, dates)
    readings = readings.drop(incremental.DATE_COL)
    devices = tables.read_upserted(spark, devices_path)

    def write_days(df: DataFrame, path: str) -> None:
        if dates is None or not tables.path_exists(spark, path):
            tables.publish(spark, df.hint("rebalance", "day"), path, ["day"])
            return
        # A day may lose all its rows (its sensors moved indoors): take the days out of the old
        # table and put the new ones in, as one replacement of the folders concerned.
        tables.replace_days(spark, df, tables.published_at(spark, path), "day", dates)

    sh_path = f"{gold_root}/{SENSOR_HOURLY}"
    write_days(gold.sensor_hourly(readings).withColumn("day", F.to_date("hour")), sh_path)
    sh = tables.read_published(spark, sh_path)
    if dates is not None:
        sh = incremental.on_dates(sh, "day", dates)
    sh = sh.drop("day")

    def product(name: str, make: Callable[[], DataFrame]):
        def body():
            df, n = ops.with_counters(make(), name)
            write_days(df, f"{gold_root}/{name}")
            return None, n.get["rows"]
        return _logged(spark, f"gold.{name}", run_log, body)[1]

    out = {
        "air_quality_hourly": product("air_quality_hourly", lambda: gold.hourly_from_sensor_hourly(
            sh, devices).withColumn("day", F.to_date("hour"))),
        "air_quality_daily_by_country": product(
            "air_quality_daily_by_country", lambda: gold.daily_from_sensor_hourly(sh, devices)),
        "anomalies": product("anomalies", lambda: gold.anomalies(
            readings, devices, s.thresholds).withColumn("day", F.to_date("event_ts_utc"))),
    }

    def health():
        last_path = f"{gold_root}/{LAST_SEEN}"
        fresh = gold.last_seen_from_sensor_hourly(sh)
        if dates is not None and tables.path_exists(spark, last_path):
            fresh = gold.merge_last_seen(tables.read_published(spark, last_path), fresh)
        tables.publish(spark, fresh, last_path)
        df, n = ops.with_counters(
            gold.health_from_last_seen(tables.read_published(spark, last_path), devices),
            "sensor_network_health")
        tables.publish(spark, df, f"{gold_root}/sensor_network_health")
        return None, n.get["rows"]
    out["sensor_network_health"] = _logged(spark, "gold.sensor_network_health", run_log, health)[1]
    return out


def device_dates(spark: SparkSession, before: DataFrame, after: DataFrame,
                 gold_root: str) -> DataFrame:
    """Days whose gold rows rest on a device that is new or whose country or indoor flag differs,
    from the stored per-sensor statistics."""
    a, b = (d.select("sensor_id", F.struct("country", "indoor").alias(n))
            for d, n in ((before, "_before"), (after, "_after")))
    changed = (a.join(b, "sensor_id", "full_outer")
               .where(~F.col("_before").eqNullSafe(F.col("_after"))).select("sensor_id"))
    hourly = tables.read_published(spark, f"{gold_root}/{SENSOR_HOURLY}")
    return (hourly.join(changed, "sensor_id", "left_semi")
            .select(F.col("day").alias(incremental.DATE_COL)).distinct())


def incremental_update(spark: SparkSession, live_path: str, archive_path: str,
                       readings_path: str, devices_path: str, gold_root: str,
                       new_live: DataFrame | None, new_archive: DataFrame | None,
                       settings: config.Settings | None = None, run_log: str | None = None,
                       registry_path: str | None = None,
                       positions_path: str | None = None) -> DataFrame:
    """After new bronze rows landed: rebuild the silver dates they touch, refresh the devices (with
    ``registry_path``) and rebuild the gold days that either concerns.

    Returns the rebuilt gold dates, a stored distributed column.
    """
    s = settings or config.Settings()
    live = bronze.read_table(spark, live_path)
    arch = bronze.read_table(spark, archive_path)
    nl = new_live if new_live is not None else live.limit(0)
    na = new_archive if new_archive is not None else arch.limit(0)
    scratch = scratch_path(spark, "touched")
    incremental.touched_dates(nl, na).write.parquet(f"{scratch}/silver")
    dates = spark.read.parquet(f"{scratch}/silver")
    silver_readings_job(spark, live_path, archive_path, readings_path, s, dates, run_log)
    if registry_path is not None:
        tables.read_upserted(spark, devices_path).write.parquet(f"{scratch}/devices")
        silver_devices_job(spark, registry_path, live_path, devices_path, run_log,
                           positions_path, nl if positions_path else None)
        moved = device_dates(spark, spark.read.parquet(f"{scratch}/devices"),
                             tables.read_upserted(spark, devices_path), gold_root)
        dates.unionByName(moved).distinct().write.parquet(f"{scratch}/gold")
        dates = spark.read.parquet(f"{scratch}/gold")
    gold_job(spark, readings_path, devices_path, gold_root, s, run_log, dates)
    return dates


def manifest_job(spark: SparkSession, listings: DataFrame, registry_path: str, landed: DataFrame,
                 start: str, end: str, out_path: str, settings: config.Settings | None = None,
                 run_log: str | None = None) -> tuple:
    """Archive files to fetch for a range of days (PIP-5), at most ``files_per_day_cap`` a day if
    the settings name a limit."""
    s = settings or config.Settings()

    def body():
        chosen = manifest.select_files(listings, tables.read_upserted(spark, registry_path), landed, start,
                                       end, cap=s.files_per_day_cap)
        tables.replace_path(spark, chosen, out_path)
        return None, spark.read.parquet(out_path).count()

    return _logged(spark, "manifest", run_log, body)
