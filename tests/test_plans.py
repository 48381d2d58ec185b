"""Plan assertions: the scale properties the README claims, checked on physical plans."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from sensorlake.plans import gold, silver


def _plan(df):
    df.write.format("noop").mode("overwrite").save()       # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_aggregates_partially_before_its_shuffle(spark):
    p = _plan(E.queries()["dedup_readings"](spark, SF_SMALL))
    assert "partial_max" in p
    assert "Window" not in p                                 # no row_number sort of a whole key


def test_gold_joins_first_and_aggregates_map_side(spark):
    """The planner broadcasts the small side by its size; the partial aggregate by country stands
    above the join, so one exchange of partial aggregates follows it."""
    p = _plan(E.queries()["air_quality_daily"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and p.index("partial_avg") < p.index("BroadcastHashJoin")


def test_day_cap_limits_partially_before_shuffle(spark):
    p = _plan(E.queries()["file_manifest_capped"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_hot_sensor_shuffle_join_matches_broadcast(spark):
    base = dt.datetime(2024, 1, 1)
    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string"))
         .alias("sensor_id"),
        (F.lit(base) + F.make_interval(mins=F.col("id").cast("int"))).alias("event_ts_utc"),
        F.lit("P1").alias("value_type"),
        (F.col("id") % 97).cast("double").alias("value"),
        F.lit("L").alias("location_id"), F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"), F.lit(None).cast("string").alias("country"),
        F.lit("x").alias("_source"), F.lit(base).alias("_ingested_at"))
    readings = silver.dedup_readings(rows)
    devices = spark.createDataFrame([("hot", "DE", False)] + [(str(i), "PL", None) for i in range(50)],
                                    "sensor_id string, country string, indoor boolean")
    key = lambda df: sorted((r["country"], r["day"], round(r["avg_value"], 9), r["n_readings"])
                            for r in df.collect())
    got = {}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (threshold, "-1"):     # broadcast join and shuffle join
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            daily = gold.air_quality_daily(readings, devices)
            got[limit] = (key(daily), gold.anomalies(readings, devices).count())
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got[threshold] == got["-1"]
    assert sum(r[3] for r in got["-1"][0]) == n == got["-1"][1]


def test_incremental_rebuild_prunes_bronze_partitions(spark, tmp_path):
    import json
    from sensorlake import config
    from sensorlake.plans import bronze, incremental
    bus = tmp_path / "bus"
    bus.mkdir()
    with open(bus / "m.json", "w") as f:
        for i in range(1, 5):
            body = {"id": str(i), "timestamp": f"2024-01-0{i} 10:00:00", "sensor_id": "7", "P1": i}
            f.write(json.dumps({"partition": 0, "offset": i, "value": json.dumps(body)}) + "\n")
    target = str(tmp_path / "live")
    bronze.load_live(spark, "json", {}, target, str(tmp_path / "ck"), path=str(bus),
                     settings=config.Settings(), available_now=True)
    live = bronze.read_table(spark, target)
    empty_arch = spark.createDataFrame([], "sensor_id string, timestamp string, P1 string")
    dates = spark.createDataFrame([(dt.date(2024, 1, 2),)], "event_date date")
    out = incremental.readings_for_dates(live, empty_arch, dates)
    assert "dynamicpruning" in _plan(out) or "PartitionFilters: [isnotnull(_event_date" in _plan(out)
    assert [r["value"] for r in out.collect()] == [2.0]
    undated = spark.createDataFrame([(None,), (dt.date(2024, 1, 3),)], "event_date date")
    assert [r["value"] for r in incremental.readings_for_dates(live, empty_arch, undated).collect()] \
        == [3.0]
    unpruned = incremental.readings_for_dates(live.drop("_event_date"), empty_arch, dates)
    assert sorted(map(tuple, unpruned.collect())) == sorted(map(tuple, out.collect()))
