"""

Every query reads the generated tables of ``sf_dir`` in full (see ``sensorlake/plans/adapters.py``
for how they are shaped into the pipeline's bronze inputs) and returns a DataFrame. Most are
lazy plans; the load, stream and incremental queries (``bronze_*``, ``*_stream``,
``*_incremental``) first run their jobs into a fresh scratch folder below the session's
``spark.checkpoint.dir`` and return a DataFrame over what they wrote.
Floating averages are rounded to 6 decimals in both engines only here, for comparison: a sum of
doubles depends on the order of addition, which differs between engines and partitionings
(see ``_round``).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_queries  # noqa: E402
from sensorlake import config, jobs, schemas, tables  # noqa: E402
from sensorlake.functions import event_date  # noqa: E402
from sensorlake.operators.messages import parse_events, publish, to_messages  # noqa: E402
from sensorlake.operators.reshape import unpivot_metrics  # noqa: E402
from sensorlake.plans import (  # noqa: E402
    adapters,
    bronze,
    dashboard,
    gold,
    incremental,
    manifest,
    ops,
    silver,
)
from sensorlake.plans.registry import build_registry, live_events  # noqa: E402
from sensorlake.session import scratch_path  # noqa: E402
from sensorlake.sources.bus import read_api_records  # noqa: E402
from sensorlake.streaming import live as live_stream  # noqa: E402
from sensorlake.streaming.sinks import start_upsert  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _round(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Comparison rounding. The tiny shift keeps exact decimal ties (an average of two-decimal
    values over 32 readings ends in ...5 at the 7th place) away from the rounding point, where
    engines whose sums differ in the last bit would round apart."""
    return df.withColumns({c: F.round(F.col(c) + F.lit(1e-9), places) for c in cols})


def _silver(spark: SparkSession, sf_dir: str) -> dict:
    return adapters.silver(spark, sf_dir)


def _gold(product, spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    return product(s["readings"], s["devices"])


def q_air_quality_daily(spark, sf_dir):
    return _round(_gold(gold.air_quality_daily, spark, sf_dir), "avg_value")


def q_air_quality_hourly(spark, sf_dir):
    return _round(_gold(gold.air_quality_hourly, spark, sf_dir), "avg_value")


def q_sensor_network_health(spark, sf_dir):
    return _gold(gold.sensor_network_health, spark, sf_dir)


def q_anomalies(spark, sf_dir):
    return _gold(gold.anomalies, spark, sf_dir)


def q_anomaly_breaches(spark, sf_dir):
    return _gold(gold.anomaly_breaches, spark, sf_dir)


def q_silver_readings(spark, sf_dir):
    return _silver(spark, sf_dir)["readings"]


def q_silver_devices(spark, sf_dir):
    return _silver(spark, sf_dir)["devices"]


def q_latest_live_per_sensor(spark, sf_dir):
    return silver.latest_live(adapters.live_raw(adapters.load(spark, sf_dir, "events")))


def q_registry_first_wins(spark, sf_dir):
    """SRC-10: two API responses as JSON files, read in the order of their arrival. The one written
    first has the odd records, under the path that sorts last; both know most sensors."""
    recs = adapters.api_records(adapters.load(spark, sf_dir, "customer"),
                                adapters.load(spark, sf_dir, "nation"))
    path = scratch_path(spark, "api")
    for poll, odd in (("poll-b", 1), ("poll-a", 0)):
        adapters.write_api_files(recs.where(F.col("api_pos") % 2 == odd), f"{path}/{poll}")
    return build_registry(read_api_records(spark, f"{path}/*"),
                          ingested_at=F.lit(adapters.REGISTRY_INGESTED_AT).cast("timestamp"))


def q_union_live_archive(spark, sf_dir):
    events = adapters.load(spark, sf_dir, "events")
    return silver.long_readings(adapters.live_raw(events), adapters.archive_raw(events))


def q_unpivot_metrics(spark, sf_dir):
    li = adapters.load(spark, sf_dir, "lineitem")
    # `l_weight` is not a column: only metrics present are unpivoted.
    return unpivot_metrics(li, ["l_orderkey", "l_linenumber"],
                           ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_weight"])


def q_dedup_readings(spark, sf_dir):
    lineitem = adapters.load(spark, sf_dir, "lineitem")
    return silver.dedup_readings(adapters.lineitem_readings(lineitem))


def q_upsert_devices(spark, sf_dir):
    """The device table upserted in place: only the key buckets of the updates are rewritten."""
    path = f"{scratch_path(spark, 'upsert')}/devices"
    s = _silver(spark, sf_dir)
    recs = adapters.supplier_records(adapters.load(spark, sf_dir, "supplier"),
                                     adapters.load(spark, sf_dir, "nation"))
    reg = build_registry(recs, position="api_pos",
                         ingested_at=F.lit(adapters.REGISTRY_INGESTED_AT).cast("timestamp"))
    updates = silver.resolve_devices(reg, s["live_raw"])
    for rows in (s["devices"], updates):
        tables.upsert_path(spark, rows, path, ["sensor_id"], s["devices"].schema)
    return tables.read_upserted(spark, path)


def q_devices_by_type(spark, sf_dir):
    """SQL over a temporary view (SRC-11), kept as a table of a database that is made for it
    (SNK-8) and read by its name."""
    root = scratch_path(spark, "database")
    name = f"sensorlake_{os.path.basename(root).rsplit('-', 1)[-1]}"
    tables.ensure_database(spark, name, root)
    found = tables.sql_over(spark, """
        SELECT sensor_type, country, count(*) AS devices,
               count(*) FILTER (WHERE indoor IS NOT TRUE) AS outdoors, max(lat) AS northmost
        FROM devices GROUP BY sensor_type, country""", devices=_silver(spark, sf_dir)["devices"])
    found.write.option("path", f"{root}/devices_by_type").saveAsTable(f"{name}.devices_by_type")
    return spark.table(f"{name}.devices_by_type")


def q_normalize_records(spark, sf_dir):
    return live_events(adapters.event_records(adapters.load(spark, sf_dir, "events")))


def q_publish_events(spark, sf_dir):
    """Messages published to the bus's file double and read back; all that were sent arrive."""
    path = f"{scratch_path(spark, 'published')}/messages"
    sent = publish(to_messages(q_normalize_records(spark, sf_dir)), "json", {}, path)
    arrived = spark.read.schema("key string, value string").json(path)
    if arrived.count() != sent:
        raise RuntimeError(f"{sent} messages were sent, {arrived.count()} arrived")
    return arrived


def q_parse_events(spark, sf_dir):
    env = adapters.bus_envelope(adapters.load(spark, sf_dir, "events"))
    return parse_events(env, schemas.active_schema("SDS011")).drop("_ingested_at")


def _manifest(spark, sf_dir, cap):
    events = adapters.load(spark, sf_dir, "events")
    registry = adapters.registry_raw(adapters.load(spark, sf_dir, "customer"),
                                     adapters.load(spark, sf_dir, "nation"))
    return manifest.select_files(adapters.archive_listings(events), registry,
                                 adapters.landed_files(events), "2024-01-04", "2024-01-25",
                                 cap=cap)


def q_file_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir, None)


def q_file_manifest_capped(spark, sf_dir):
    return _manifest(spark, sf_dir, 25)


def q_top10_locations(spark, sf_dir):
    return _round(dashboard.top_polluted(_silver(spark, sf_dir)["readings"], 10),
                  "avg_pm10", "avg_pm25")


def q_active_by_region(spark, sf_dir):
    health = _gold(gold.sensor_network_health, spark, sf_dir)
    return dashboard.active_by_region(health, adapters.load(spark, sf_dir, "nation"),
                                      adapters.load(spark, sf_dir, "region"))


def q_pm_hourly(spark, sf_dir):
    return _round(dashboard.pm_hourly(_gold(gold.air_quality_hourly, spark, sf_dir)), "avg_value")


def q_metric_first_seen(spark, sf_dir):
    live = adapters.live_raw(adapters.load(spark, sf_dir, "events"))
    live_long = unpivot_metrics(live, config.READING_ID_COLUMNS, config.METRICS)
    return dashboard.metric_first_seen(silver.clean_readings(live_long))


def q_live_active_sensors(spark, sf_dir):
    return dashboard.active_sensors(_silver(spark, sf_dir)["readings"], "1 hour")


def q_live_pm_trend(spark, sf_dir):
    return _round(dashboard.pm_trend(_silver(spark, sf_dir)["readings"], "1 hour"), "avg_value")


def q_latest_by_sensor(spark, sf_dir):
    return dashboard.latest_by_sensor(_silver(spark, sf_dir)["readings"])


def q_stage_counts(spark, sf_dir):
    """Counts of every stage, observed by the two jobs that write readings and devices."""
    out = scratch_path(spark, "stages")
    b, at = adapters.bronze(spark, sf_dir), (counters := ops.Counters()).at
    long = at("long_readings", silver.long_readings(at("live_raw", b["live_raw"]),
                                                    at("archive_raw", b["archive_raw"])))
    clean = at("clean_readings", silver.clean_readings(long))
    at("readings", silver.dedup_readings(clean)).write.parquet(f"{out}/readings")
    devices = silver.silver_devices(b["registry_raw"], b["live_raw"])
    at("devices", devices).write.parquet(f"{out}/devices")
    return counters.table(spark)


def _phases(spark, sf_dir):
    events = adapters.load(spark, sf_dir, "events")
    cut = F.lit(adapters.LIVE_PHASE_B_FROM).cast("timestamp_ntz")
    return events, events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)


def q_bronze_archive_stream(spark, sf_dir):
    """Archive files (two header sets, one of them quoted, one with a column more in the second
    phase) -> two loads with checkpoints of their own into one bronze table, each rerun once, which
    must add nothing. Splits are small, so that files are read by several tasks. Run-time columns
    are dropped."""
    root = scratch_path(spark, "bronze-archive")
    for i, part in enumerate(_phases(spark, sf_dir)[1:]):
        adapters.write_archive_landing(part, f"{root}/landing-{i}", late=bool(i))
        for _ in range(2):
            bronze.load_archive(spark, f"{root}/landing-{i}", f"{root}/bronze",
                                f"{root}/checkpoint-{i}", f"{root}/schema", split_bytes=16 << 10)
    cols = dict.fromkeys([*adapters.PARTICLE_COLUMNS, *adapters.CLIMATE_COLUMNS,
                          adapters.LATE_COLUMN])
    return (bronze.read_table(spark, f"{root}/bronze")
            .select(*cols, F.col("date").cast("string").alias("date"), "_source",
                    F.regexp_extract("_source_file_name", "date=([0-9-]+)/", 1)
                    .alias("source_day")))


def _two_phase_live_load(spark, sf_dir):
    """Bus file double: phase A events loaded with the base schema, then phase B events with the
    wider schema on the same checkpoint. Returns the bronze path."""
    root = scratch_path(spark, "bronze-live")
    bus, target, ckpt = f"{root}/bus", f"{root}/bronze", f"{root}/checkpoint"
    events = adapters.load(spark, sf_dir, "events")
    for phase_b, flt in ((False, "SDS011"), (True, "SDS011,BME280")):
        adapters.write_bus_files(events, bus, phase_b)
        bronze.load_live(spark, "json", {}, target, ckpt, path=bus,
                         settings=config.Settings(sensor_filter=flt), available_now=True)
    return target


def q_bronze_live_stream(spark, sf_dir):
    """The bronze table of the two-phase live load (run-time column dropped)."""
    return bronze.read_table(spark, _two_phase_live_load(spark, sf_dir)).drop("_ingested_at")


def q_schema_evolution_timeline(spark, sf_dir):
    """DSH-9: when each metric first appeared in the live bronze table of the two-phase load;
    the climate metrics appear only once the wider schema is in use."""
    live = bronze.read_table(spark, _two_phase_live_load(spark, sf_dir))
    first = dashboard.metric_first_seen(live_stream.live_readings(live))
    return first.drop("first_ingested_at")


def _dated(df: DataFrame) -> DataFrame:
    """Bronze rows with the date column by which the loads partition their tables."""
    return df.withColumn(bronze.EVENT_DATE, event_date("timestamp"))


def _write_bronze(events: DataFrame, live: str, archive: str) -> None:
    for df, path in ((adapters.live_raw(events), live), (adapters.archive_raw(events), archive)):
        _dated(df).write.mode("append").partitionBy(bronze.EVENT_DATE).parquet(path)


def q_readings_incremental(spark, sf_dir):
    """Silver readings built in two arrival batches: the first fully, the second by rebuilding
    only the event dates it touches. Must equal a full rebuild."""
    root = scratch_path(spark, "readings-incremental")
    live, archive, path = (f"{root}/{n}" for n in ("live", "archive", "readings"))
    _, early, late = _phases(spark, sf_dir)
    _write_bronze(early, live, archive)
    jobs.silver_readings_job(spark, live, archive, path)
    _write_bronze(late, live, archive)
    incremental.touched_dates(_dated(adapters.live_raw(late)), _dated(adapters.archive_raw(late))) \
        .write.parquet(f"{root}/dates")
    jobs.silver_readings_job(spark, live, archive, path, dates=spark.read.parquet(f"{root}/dates"))
    return tables.read_published(spark, path)


def q_readings_full_rerun(spark, sf_dir):
    """A full build over an older, larger table: only what the new inputs give remains."""
    root = scratch_path(spark, "readings-rerun")
    events, early, _ = _phases(spark, sf_dir)
    for name, part in (("all", events), ("early", early)):
        _write_bronze(part, f"{root}/live-{name}", f"{root}/archive-{name}")
        jobs.silver_readings_job(spark, f"{root}/live-{name}", f"{root}/archive-{name}",
                                 f"{root}/readings")
    return tables.read_published(spark, f"{root}/readings")


def _live_bronze_stream(spark, sf_dir, root):
    """Live bronze rows of the test data landed as parquet files, read back as a file stream."""
    src = f"{root}/bronze-live"
    adapters.live_raw(adapters.load(spark, sf_dir, "events")).write.parquet(src)
    return spark.readStream.schema(spark.read.parquet(src).schema) \
        .option("maxFilesPerTrigger", 2).parquet(src)


def q_live_pm_trend_stream(spark, sf_dir):
    """DSH-2 on Structured Streaming: hourly PM averages over the live stream, kept current in
    a result table by a keyed upsert sink. Without a watermark a replay loses no row."""
    root = scratch_path(spark, "live-pm-trend")
    readings = live_stream.live_readings(_live_bronze_stream(spark, sf_dir, root))
    trend = live_stream.stream_pm_trend(readings, "1 hour")
    q = start_upsert(trend, f"{root}/result", ["window_start", "value_type"],
                     f"{root}/checkpoint", available_now=True,
                     state_partitions=spark.sparkContext.defaultParallelism,
                     by=F.to_date("window_start"))
    q.awaitTermination()
    return _round(tables.read_upserted(spark, f"{root}/result"), "avg_value")


def q_latest_by_sensor_stream(spark, sf_dir):
    """DSH-3 on Structured Streaming: latest PM reading per sensor and metric."""
    root = scratch_path(spark, "latest-by-sensor")
    readings = live_stream.live_readings(_live_bronze_stream(spark, sf_dir, root))
    latest = live_stream.stream_latest_by_sensor(readings)
    q = start_upsert(latest, f"{root}/result", ["sensor_id", "value_type"],
                     f"{root}/checkpoint", available_now=True,
                     state_partitions=spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    return tables.read_upserted(spark, f"{root}/result")


def q_live_active_sensors_stream(spark, sf_dir):
    """DSH-1 on Structured Streaming: (hour, sensor) pairs in a keyed upsert table, counted on
    read, so the number of active sensors is exact."""
    root = scratch_path(spark, "live-active")
    readings = live_stream.live_readings(_live_bronze_stream(spark, sf_dir, root))
    pairs = live_stream.stream_active_sensors(readings, "1 hour")
    q = start_upsert(pairs, f"{root}/result", ["window_start", "sensor_id"],
                     f"{root}/checkpoint", available_now=True, by=F.to_date("window_start"))
    q.awaitTermination()
    return live_stream.count_active_sensors(tables.read_upserted(spark, f"{root}/result"))


def _gold_in_two_phases(spark, sf_dir) -> str:
    """Silver, devices and gold built from the events before a cut; then the later events arrive
    and an incremental run rebuilds the days that they, or a device that they move, concern.
    Returns the gold folder; its tables must equal those built from everything at once."""
    root = scratch_path(spark, "gold-incremental")
    p = {k: f"{root}/{k}" for k in ("registry", "live", "archive", "readings", "devices",
                                    "positions", "gold")}
    adapters.registry_raw(adapters.load(spark, sf_dir, "customer"),
                          adapters.load(spark, sf_dir, "nation")).write.parquet(p["registry"])
    _, early, late = _phases(spark, sf_dir)
    _write_bronze(early, p["live"], p["archive"])
    jobs.silver_readings_job(spark, p["live"], p["archive"], p["readings"])
    jobs.silver_devices_job(spark, p["registry"], p["live"], p["devices"],
                            positions_path=p["positions"])
    jobs.gold_job(spark, p["readings"], p["devices"], p["gold"])
    _write_bronze(late, p["live"], p["archive"])
    jobs.incremental_update(spark, p["live"], p["archive"], p["readings"], p["devices"], p["gold"],
                            _dated(adapters.live_raw(late)), _dated(adapters.archive_raw(late)),
                            registry_path=p["registry"], positions_path=p["positions"])
    return p["gold"]


def q_air_quality_daily_incremental(spark, sf_dir):
    gold_dir = _gold_in_two_phases(spark, sf_dir)
    daily = tables.read_published(spark, f"{gold_dir}/air_quality_daily_by_country")
    return _round(daily, "avg_value")


def q_anomalies_incremental(spark, sf_dir):
    gold_dir = _gold_in_two_phases(spark, sf_dir)
    return tables.read_published(spark, f"{gold_dir}/anomalies").drop("day")


def q_run_log(spark, sf_dir):
    """OPS-1: the append-only run log of an archive load, a live load and two silver jobs (clock
    times and run ids dropped; statuses and row counts kept)."""
    root = scratch_path(spark, "run-log")
    log = f"{root}/log"
    events = adapters.load(spark, sf_dir, "events")
    adapters.write_archive_landing(events, f"{root}/landing", late=False)
    jobs.archive_job(spark, f"{root}/landing", f"{root}/archive-bronze", f"{root}/archive-checkpoint",
                     f"{root}/schema", run_log=log)
    adapters.write_bus_files(events, f"{root}/bus", phase_b=True)
    jobs.live_job(spark, "json", {}, f"{root}/live-bronze", f"{root}/live-checkpoint",
                  path=f"{root}/bus", run_log=log, available_now=True)
    b = {"live": adapters.live_raw(events), "archive": adapters.archive_raw(events),
         "registry": adapters.registry_raw(adapters.load(spark, sf_dir, "customer"),
                                           adapters.load(spark, sf_dir, "nation"))}
    for name, df in b.items():
        df.write.parquet(f"{root}/{name}")
    jobs.silver_readings_job(spark, f"{root}/live", f"{root}/archive", f"{root}/readings",
                             run_log=log)
    jobs.silver_devices_job(spark, f"{root}/registry", f"{root}/live", f"{root}/devices",
                            run_log=log)
    return spark.read.parquet(log).drop("run_id", "started_at", "ended_at")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "air_quality_daily": q_air_quality_daily,
    "air_quality_hourly": q_air_quality_hourly,
    "sensor_network_health": q_sensor_network_health,
    "anomalies": q_anomalies,
    "anomaly_breaches": q_anomaly_breaches,
    "silver_readings": q_silver_readings,
    "silver_devices": q_silver_devices,
    "latest_live_per_sensor": q_latest_live_per_sensor,
    "registry_first_wins": q_registry_first_wins,
    "union_live_archive": q_union_live_archive,
    "unpivot_metrics": q_unpivot_metrics,
    "dedup_readings": q_dedup_readings,
    "upsert_devices": q_upsert_devices,
    "devices_by_type": q_devices_by_type,
    "normalize_records": q_normalize_records,
    "publish_events": q_publish_events,
    "parse_events": q_parse_events,
    "file_manifest": q_file_manifest,
    "file_manifest_capped": q_file_manifest_capped,
    "top10_locations": q_top10_locations,
    "active_by_region": q_active_by_region,
    "pm_hourly": q_pm_hourly,
    "metric_first_seen": q_metric_first_seen,
    "live_active_sensors": q_live_active_sensors,
    "live_pm_trend": q_live_pm_trend,
    "latest_by_sensor": q_latest_by_sensor,
    "stage_counts": q_stage_counts,
    "bronze_archive_stream": q_bronze_archive_stream,
    "bronze_live_stream": q_bronze_live_stream,
    "readings_incremental": q_readings_incremental,
    "readings_full_rerun": q_readings_full_rerun,
    "live_pm_trend_stream": q_live_pm_trend_stream,
    "latest_by_sensor_stream": q_latest_by_sensor_stream,
    "live_active_sensors_stream": q_live_active_sensors_stream,
    "air_quality_daily_incremental": q_air_quality_daily_incremental,
    "anomalies_incremental": q_anomalies_incremental,
    "schema_evolution_timeline": q_schema_evolution_timeline,
    "run_log": q_run_log,
}

# The text operators live in a subpackage of their own, which may be absent.
try:
    import corpus_pipeline
    from sensorlake.llm import queries as _llm
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "sensorlake.llm"):
        raise
    _LLM_QUERIES, _LLM_SQL = {}, {}
else:
    _LLM_QUERIES = {**_llm.QUERIES, "pipeline": corpus_pipeline.run}
    _LLM_SQL = dict(_llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        _LLM_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily air quality by country on sf0.001."""
    return q_air_quality_daily(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    sql = oracle_queries.all_sql()
    own = {k: v for k, v in sql.items() if k in _QUERIES}
    return {**own, **_LLM_SQL}
