"""End-to-end jobs on directories: registry -> silver -> gold equals the registered queries."""

import json
import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from sensorlake import jobs, tables
from sensorlake.plans import adapters, incremental


def _api_file(spark, path):
    recs = adapters.api_records(adapters.load(spark, SF_SMALL, "customer"),
                                adapters.load(spark, SF_SMALL, "nation")).orderBy("api_pos")
    body = [json.loads(r[0]) for r in recs.select(F.to_json(F.struct(
        "id", "timestamp", "sensor", "location", "sensordatavalues"),
        {"ignoreNullFields": "false"})).collect()]          # 150 fixture records
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "response.json"), "w") as f:
        json.dump(body, f)


def test_jobs_end_to_end_match_queries(spark, scratch):
    p = {k: os.path.join(scratch, k) for k in
         ("api", "registry", "live", "archive", "readings", "devices", "gold", "log")}
    _api_file(spark, p["api"])
    events = adapters.load(spark, SF_SMALL, "events")
    adapters.live_raw(events).write.parquet(p["live"])
    adapters.archive_raw(events).write.parquet(p["archive"])

    n_in, n_reg = jobs.registry_job(spark, p["api"], p["registry"], run_log=p["log"])
    assert n_in == 150 and n_reg == adapters.registry_raw(
        adapters.load(spark, SF_SMALL, "customer"), adapters.load(spark, SF_SMALL, "nation")).count()
    jobs.registry_job(spark, p["api"], p["registry"], run_log=p["log"])        # idempotent rerun
    assert spark.read.parquet(p["registry"]).count() == n_reg

    jobs.silver_readings_job(spark, p["live"], p["archive"], p["readings"], run_log=p["log"])
    jobs.silver_devices_job(spark, p["registry"], p["live"], p["devices"], run_log=p["log"])
    counts = jobs.gold_job(spark, p["readings"], p["devices"], p["gold"], run_log=p["log"])

    want = E.queries()["air_quality_daily"](spark, SF_SMALL)
    got = tables.read_published(spark, os.path.join(p["gold"], "air_quality_daily_by_country")) \
        .withColumn("avg_value", F.round("avg_value", 6))
    assert got.count() == want.count() == counts["air_quality_daily_by_country"]
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    an = tables.read_published(spark, os.path.join(p["gold"], "anomalies"))
    assert an.count() == E.queries()["anomalies"](spark, SF_SMALL).count()

    log = spark.read.parquet(p["log"])
    assert log.where(F.col("status") == "succeeded").count() == log.count() == 8


def test_silver_readings_job_incremental_equals_full(spark, scratch):
    events = adapters.load(spark, SF_SMALL, "events")
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    early, late = events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)
    live, arch, out = (os.path.join(scratch, x) for x in ("live", "archive", "readings"))
    adapters.live_raw(early).write.parquet(live)
    adapters.archive_raw(early).write.parquet(arch)
    jobs.silver_readings_job(spark, live, arch, out)
    new_live, new_arch = adapters.live_raw(late), adapters.archive_raw(late)
    new_live.write.mode("append").parquet(live)          # bronze is append-only
    new_arch.write.mode("append").parquet(arch)
    dates = incremental.touched_dates(new_live, new_arch)
    jobs.silver_readings_job(spark, live, arch, out, dates=dates)
    got = tables.read_published(spark, out)
    want = E.queries()["silver_readings"](spark, SF_SMALL)
    assert got.count() == want.count()
    assert got.drop("event_date").exceptAll(want).count() == 0


def test_cli_and_settings_file(spark, scratch):
    from sensorlake import config
    from sensorlake.__main__ import main
    cfg = os.path.join(scratch, "cfg.json")
    with open(cfg, "w") as f:
        json.dump({"dev": {"streaming": {"sensor_type_filter": "SDS011,BME280",
                                         "max_offsets_per_trigger": 20000},
                           "batch": {"csv_delimiter": ";", "file_limit": 7},
                           "gold": {"pm10_threshold": 45}}}, f)
    s = config.load_settings(cfg + "#dev")
    assert (s.sensor_filter, s.max_offsets_per_trigger, s.files_per_day_cap) == ("SDS011,BME280", 20000, 7)
    assert s.thresholds.pm10 == 45.0 and s.thresholds.pm25 == 25.0
    events = adapters.load(spark, SF_SMALL, "events")
    live, arch, out = (os.path.join(scratch, x) for x in ("live", "archive", "readings"))
    adapters.live_raw(events).write.parquet(live)
    adapters.archive_raw(events).write.parquet(arch)
    main(["readings", "--live", live, "--archive", arch, "--readings", out,
          "--config", cfg + "#dev"], spark=spark)
    assert tables.read_published(spark, out).count() == E.queries()["silver_readings"](spark, SF_SMALL).count()


def test_full_silver_run_leaves_nothing_of_an_older_table(spark, scratch):
    events = adapters.load(spark, SF_SMALL, "events")
    early = events.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    out = os.path.join(scratch, "readings")
    for name, part in (("all", events), ("early", early)):
        live, arch = (os.path.join(scratch, f"{k}-{name}") for k in ("live", "archive"))
        adapters.live_raw(part).write.parquet(live)
        adapters.archive_raw(part).write.parquet(arch)
        _, n = jobs.silver_readings_job(spark, live, arch, out)
    assert tables.read_published(spark, out).count() == n < events.count()


def _equal_gold(spark, one, other):
    for name in ("air_quality_hourly", "air_quality_daily_by_country", "anomalies",
                 "sensor_network_health"):
        a, b = (tables.read_published(spark, os.path.join(p, name)) for p in (one, other))
        rnd = [c for c, t in a.dtypes if t == "double"]
        a, b = (x.select(*[F.round(c, 6).alias(c) if c in rnd else F.col(c) for c in a.columns])
                for x in (a, b))
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, name


def test_incremental_gold_equals_full_with_devices_of_arrived_rows(spark, scratch):
    """Devices know only the rows that have arrived; late rows move some to another country, and one
    device turns indoor, so that days without new readings change and one day loses all its rows."""
    events = adapters.load(spark, SF_SMALL, "events")
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    early, late = events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)
    p = {k: os.path.join(scratch, k) for k in
         ("api", "registry", "live", "archive", "readings", "devices", "positions", "gold",
          "gold_full", "devices_full")}
    _api_file(spark, p["api"])
    jobs.registry_job(spark, p["api"], p["registry"])
    only = adapters.live_raw(early.limit(1)).withColumns({
        "sensor_id": F.lit("only"), "timestamp": F.lit("2023-05-05 10:00:00"), "P1": F.lit("60"),
        "P2": F.lit(None).cast("string"), "latitude": F.lit("1"), "longitude": F.lit("1")})
    adapters.live_raw(early).unionByName(only).write.parquet(p["live"])
    adapters.archive_raw(early).write.parquet(p["archive"])
    registry = spark.read.parquet(p["registry"])
    device = registry.limit(1).withColumns({"sensor_id": F.lit("only"), "indoor": F.lit("0")})
    tables.replace_path(spark, registry.unionByName(device), p["registry"])
    jobs.silver_readings_job(spark, p["live"], p["archive"], p["readings"])
    jobs.silver_devices_job(spark, p["registry"], p["live"], p["devices"],
                            positions_path=p["positions"])
    jobs.gold_job(spark, p["readings"], p["devices"], p["gold"])
    daily = tables.read_published(spark, os.path.join(p["gold"], "air_quality_daily_by_country"))
    assert daily.where("day = '2023-05-05'").count() > 0
    tables.replace_path(spark, spark.read.parquet(p["registry"]).withColumn(
        "indoor", F.when(F.col("sensor_id") == "only", "1").otherwise(F.col("indoor"))),
        p["registry"])
    new_live, new_arch = adapters.live_raw(late), adapters.archive_raw(late)
    new_live.write.mode("append").parquet(p["live"])
    new_arch.write.mode("append").parquet(p["archive"])
    jobs.incremental_update(spark, p["live"], p["archive"], p["readings"], p["devices"], p["gold"],
                            new_live, new_arch, registry_path=p["registry"],
                            positions_path=p["positions"])
    jobs.silver_devices_job(spark, p["registry"], p["live"], p["devices_full"])
    jobs.gold_job(spark, p["readings"], p["devices_full"], p["gold_full"])
    a, b = (spark.read.parquet(p[k]) for k in ("devices", "devices_full"))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    _equal_gold(spark, p["gold"], p["gold_full"])
    daily = tables.read_published(spark, os.path.join(p["gold"], "air_quality_daily_by_country"))
    assert daily.where("day = '2023-05-05'").count() == 0


def test_manifest_job_takes_the_limit_of_the_settings(spark, scratch):
    from sensorlake import config
    events = adapters.load(spark, SF_SMALL, "events")
    registry, out = os.path.join(scratch, "registry"), os.path.join(scratch, "manifest")
    adapters.registry_raw(adapters.load(spark, SF_SMALL, "customer"),
                          adapters.load(spark, SF_SMALL, "nation")).write.parquet(registry)
    args = (spark, adapters.archive_listings(events), registry, adapters.landed_files(events),
            "2024-01-02", "2024-01-05", out)
    jobs.manifest_job(*args)
    free = spark.read.parquet(out).groupBy("day").count().collect()
    jobs.manifest_job(*args, settings=config.Settings(files_per_day_cap=2))
    capped = spark.read.parquet(out).groupBy("day").count().collect()
    assert len(free) == len(capped) == 4
    assert max(r["count"] for r in free) > 2 == max(r["count"] for r in capped)
