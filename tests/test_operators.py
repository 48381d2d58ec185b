"""Operator semantics on tiny hand-written frames."""

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake import config, schemas
from sensorlake.functions import anomaly_flag, outdoor, parse_event_ts, pollution_level
from sensorlake.operators.dedup import first_wins, keep_greatest
from sensorlake.operators.joins import unique_by, upsert
from sensorlake.operators.messages import parse_events, to_messages
from sensorlake.operators.reshape import normalize_records, unpivot_metrics
from sensorlake.plans import gold, silver
from sensorlake.plans.registry import build_registry

TS = dt.datetime(2024, 1, 1, 10, 0, 0)
READ_SCHEMA = "sensor_id string, event_ts_utc timestamp, value_type string, value double, " \
    "location_id string, latitude double, longitude double, country string, _source string, " \
    "_ingested_at timestamp"
DEV_SCHEMA = "sensor_id string, country string, indoor boolean"


def test_unpivot_only_present_metrics_and_drops_bad(spark):
    df = spark.createDataFrame([("s1", "1.5", None, "unknown"), ("s2", None, "2", "3")],
                               "sensor_id string, P1 string, P2 string, pressure string")
    out = unpivot_metrics(df, ["sensor_id", "timestamp"], config.METRICS)
    assert out.columns == ["sensor_id", "value_type", "value"]
    assert sorted(map(tuple, out.collect())) == [("s1", "P1", 1.5), ("s2", "P2", 2.0),
                                                ("s2", "pressure", 3.0)]


def test_unpivot_no_metric_columns_gives_empty_frame(spark):
    df = spark.createDataFrame([("s1",)], "sensor_id string")
    out = unpivot_metrics(df, ["sensor_id"], config.METRICS)
    assert out.count() == 0 and out.columns == ["sensor_id", "value_type", "value"]


def test_unpivot_mixed_types(spark):
    df = spark.createDataFrame([("s1", 1.25, "7")], "sensor_id string, P1 double, P2 string")
    out = unpivot_metrics(df, ["sensor_id"], ["P1", "P2"])
    assert sorted(r["value"] for r in out.collect()) == [1.25, 7.0]


def test_parse_ts_strips_quotes_and_tolerates_garbage(spark):
    df = spark.createDataFrame([("'2024-01-01 10:00:00'",), ('"2024-01-01T10:00:00"',),
                                ("bad",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_event_ts("t")).collect()]
    assert got == [TS, TS, None, None]


def test_try_casts_survive_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("None", "None"), ("inf", "1"), ("x", "0")], "a string, b string")
    got = df.select(F.col("a").try_cast("double"), F.col("b").try_cast("boolean")).collect()
    assert got[0][0] is None and got[0][1] is None
    assert got[1][0] == float("inf") and got[1][1] is True and got[2][1] is False


def _long(spark, rows):
    return spark.createDataFrame(rows, "sensor_id string, timestamp string, value_type string, "
                                       "value double, location_id string, latitude string, "
                                       "longitude string, country string, _source string, "
                                       "_ingested_at timestamp")


def test_filter_before_dedup_keeps_good_copy(spark):
    t1, t2 = TS, TS + dt.timedelta(hours=1)
    rows = [("s", "2024-01-01 10:00:00", "P1", 5.0, "l", "1", "2", "de", "live", t1),
            ("s", "2024-01-01 10:00:00", "P1", float("nan"), "l", "1", "2", None, "archive", t2)]
    out = silver.dedup_readings(silver.clean_readings(_long(spark, rows))).collect()
    assert len(out) == 1 and out[0]["value"] == 5.0 and out[0]["country"] == "DE"


def test_nan_coordinates_dropped_null_kept_infinity_kept(spark):
    rows = [("a", "2024-01-01 10:00:00", "P1", 1.0, "l", "NaN", "2", None, "x", TS),
            ("b", "2024-01-01 10:00:00", "P1", 1.0, "l", None, None, None, "x", TS),
            ("c", "2024-01-01 10:00:00", "P1", float("inf"), "l", "1", "2", None, "x", TS)]
    out = silver.clean_readings(_long(spark, rows))
    assert sorted(r["sensor_id"] for r in out.collect()) == ["b", "c"]
    finite = silver.clean_readings(_long(spark, rows), drop_infinite=True)
    assert sorted(r["sensor_id"] for r in finite.collect()) == ["b"]


def test_null_timestamps_collapse_to_one_key(spark):
    rows = [("s", "bad", "P1", 1.0, "l", "1", "2", None, "x", TS),
            ("s", "worse", "P1", 2.0, "l", "1", "2", None, "x", TS)]
    out = silver.dedup_readings(silver.clean_readings(_long(spark, rows))).collect()
    assert len(out) == 1 and out[0]["event_ts_utc"] is None and out[0]["value"] == 2.0


@settings(max_examples=15, deadline=None)
@given(st.permutations(list(range(6))))
def test_dedup_survivor_independent_of_row_order(spark, perm):
    base = [("s", TS, "P1", float(v), "l", 1.0, 2.0, None, "src", TS) for v in range(6)]
    rows = [base[i] for i in perm]
    df = spark.createDataFrame(rows, READ_SCHEMA).repartition(3)
    out = silver.dedup_readings(df).collect()
    assert [r["value"] for r in out] == [5.0]


def test_keep_greatest_is_idempotent(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)],
                               "k string, o int, p string")
    once = keep_greatest(df, ["k"], ["o"])
    twice = keep_greatest(once, ["k"], ["o"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert sorted(map(tuple, once.collect())) == [("a", 2, "y"), ("b", 1, None)]


def test_first_wins_by_position(spark):
    df = spark.createDataFrame([("s", 3, "c"), ("s", 1, "a"), ("s", 2, "b")], "k string, pos int, v string")
    assert first_wins(df, "k", "pos").collect()[0]["v"] == "a"


def test_latest_live_orders_raw_text_then_offset(spark):
    live = spark.createDataFrame([
        ("0", "5", "s", "2024-01-01 10:00:00", "1", "2", "de"),
        ("0", "10", "s", "2024-01-01 10:00:00", "3", "4", "pl"),   # same time, larger offset
        ("0", "7", "s", "2023-12-31 23:00:00", "5", "6", "ua"),
        ("0", "1", None, "2025-01-01 00:00:00", "7", "8", "at")],  # no sensor: ignored
        "_source_partition string, _source_offset string, sensor_id string, timestamp string, "
        "latitude string, longitude string, country string")
    out = silver.latest_live(live).collect()
    assert [(r["sensor_id"], r["latitude"], r["country"]) for r in out] == [("s", "3", "pl")]


def _registry(spark, rows):
    return spark.createDataFrame(rows, schemas.REGISTRY_RAW)


def test_devices_live_wins_and_live_only_not_added(spark):
    reg = _registry(spark, [("1", "SDS011", "L1", "10.5", "20.5", "de", "0", "api", "f", TS),
                            ("2", "BME280", "L2", "None", "1", "pl", "None", "api", "f", TS)])
    live = spark.createDataFrame([
        ("0", "1", "1", "2024-01-01", "50", "60", "ua"),
        ("0", "2", "9", "2024-01-01", "1", "1", "de")],
        "_source_partition string, _source_offset string, sensor_id string, timestamp string, "
        "latitude string, longitude string, country string")
    out = {r["sensor_id"]: r for r in silver.silver_devices(reg, live).collect()}
    assert set(out) == {"1", "2"}
    assert (out["1"]["lat"], out["1"]["country"], out["1"]["indoor"]) == (50.0, "UA", False)
    assert out["2"]["lat"] is None and out["2"]["indoor"] is None and out["2"]["country"] == "PL"


def test_upsert_semantics_and_idempotence(spark):
    t = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "n")], "k string, v string")
    u = spark.createDataFrame([("2", "B"), ("3", "C")], "k string, v string")
    once = upsert(t, u, ["k"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(
        [("1", "a"), ("2", "B"), ("3", "C"), (None, "n")], key=str)
    twice = upsert(once, u, ["k"])
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    with pytest.raises(Exception, match="duplicate key"):
        unique_by(u.unionByName(u), ["k"]).collect()
    assert unique_by(u, ["k"]).count() == 2


def test_outdoor_three_valued(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "indoor boolean")
    assert [r[0] for r in df.select(outdoor("indoor")).collect()] == [False, True, True]


def test_anomaly_thresholds_strict(spark):
    df = spark.createDataFrame([("P1", 50.0), ("P1", 50.01), ("P2", 25.0), ("P2", 25.01),
                                ("temperature", 99.0)], "value_type string, value double")
    got = [r[0] for r in df.select(anomaly_flag()).collect()]
    assert got == [None, config.PM10_FLAG, None, config.PM25_FLAG, None]
    lv = [r[0] for r in df.select(pollution_level()).collect()]
    assert lv == ["moderate", "poor", "moderate", "poor", None]


def _gold_inputs(spark):
    readings = spark.createDataFrame([
        ("1", TS, "P1", 60.0, "L", None, None, None, "x", TS),
        ("1", TS + dt.timedelta(minutes=5), "P1", 40.0, "L", None, None, None, "x", TS),
        ("2", TS, "P2", 30.0, "L", None, None, None, "x", TS),       # indoor: excluded
        ("3", TS, "P2", 26.0, "L", None, None, "UA", "x", TS),       # unregistered
        ("4", None, "P1", 1.0, "L", None, None, None, "x", TS)],     # NULL time, unknown indoor
        READ_SCHEMA)
    devices = spark.createDataFrame([("1", "DE", False), ("2", "DE", True), ("4", "PL", None)],
                                    DEV_SCHEMA)
    return readings, devices


def test_gold_hourly_daily_health(spark):
    r, d = _gold_inputs(spark)
    hourly = {(x["country"], x["hour"], x["value_type"]): x
              for x in gold.air_quality_hourly(r, d).collect()}
    h = hourly[("DE", TS, "P1")]
    assert (h["avg_value"], h["min_value"], h["max_value"], h["n_readings"]) == (50.0, 40.0, 60.0, 2)
    assert ("PL", None, "P1") in hourly                  # NULL hour kept
    assert all(k[0] != "UA" for k in hourly)             # inner join drops unregistered
    daily = gold.air_quality_daily(r, d).collect()
    assert {x["country"] for x in daily} == {"DE", "PL"}
    health = {x["country"]: x for x in gold.sensor_network_health(r, d).collect()}
    assert health["DE"]["active_sensors"] == 2 and health["DE"]["distinct_metrics_seen"] == 2


def test_gold_anomalies_left_join_and_breaches(spark):
    r, d = _gold_inputs(spark)
    an = {(x["sensor_id"], x["value"]): x for x in gold.anomalies(r, d).collect()}
    assert set(an) == {("1", 60.0), ("1", 40.0), ("3", 26.0), ("4", 1.0)}
    assert an[("3", 26.0)]["country"] == "UA" and an[("3", 26.0)]["anomaly_flag"] == config.PM25_FLAG
    assert an[("1", 40.0)]["anomaly_flag"] is None
    br = gold.anomaly_breaches(r, d).collect()
    assert sorted(x["sensor_id"] for x in br) == ["1", "3"]


def test_joins_carry_no_hint(spark):
    r, d = _gold_inputs(spark)
    for product in (gold.air_quality_daily, gold.air_quality_hourly, gold.anomalies,
                    gold.sensor_network_health):
        plan = product(r, d)._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in plan


def test_normalize_records_rules(spark):
    schema = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("timestamp", T.StringType()),
        T.StructField("sensor", T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("sensor_type", T.StructType([T.StructField("name", T.StringType())]))])),
        T.StructField("location", T.StructType([
            T.StructField("id", T.StringType()), T.StructField("latitude", T.StringType()),
            T.StructField("longitude", T.StringType()), T.StructField("country", T.StringType())])),
        T.StructField("sensordatavalues", T.ArrayType(T.StructType([
            T.StructField("value_type", T.StringType()), T.StructField("value", T.StringType())])))])
    recs = spark.createDataFrame([
        ("1", "t", ("7", ("SDS011",)), ("L", "1", "2", "DE"),
         [("P1", "1"), ("", "junk"), (None, "x"), ("P1", "9"), ("P2", "3"), ("extra", "5")]),
        ("2", "t", None, None, None)], schema)
    out = {r["id"]: r for r in normalize_records(recs, config.METRICS).collect()}
    assert (out["1"]["P1"], out["1"]["P2"], out["1"]["temperature"]) == ("9", "3", None)
    assert out["1"]["sensor_id"] == "7" and out["2"]["sensor_id"] is None
    assert out["1"]["_other"] == '{"extra":"5"}' and out["2"]["_other"] is None
    sent = {json.loads(r["value"])["id"]: json.loads(r["value"])
            for r in to_messages(normalize_records(recs, config.METRICS)).collect()}
    assert sent["1"]["extra"] == "5" and sent["1"]["P1"] == "9" and "_other" not in sent["2"]
    envelope = to_messages(normalize_records(recs, config.METRICS)).selectExpr(
        "0 AS partition", "0L AS offset", "value")
    rescued = [r["_rescued_data"] for r in parse_events(envelope, schemas.PHASE_B).collect()]
    assert '{"extra":"5"}' in rescued


def test_registry_first_allowed_record_wins(spark):
    recs = spark.createDataFrame([
        (0, ("5", ("DHT22",)), ("A", "1", "1", "DE", "0")),
        (1, ("5", ("SDS011",)), ("B", "2", "2", "DE", None)),
        (2, ("5", ("BME280",)), ("C", "3", "3", "DE", "1")),
        (3, (None, ("SDS011",)), ("D", "4", "4", "DE", "0"))],
        "api_pos int, sensor struct<id:string,sensor_type:struct<name:string>>, "
        "location struct<id:string,latitude:string,longitude:string,country:string,indoor:string>")
    out = build_registry(recs).collect()
    assert len(out) == 1 and out[0]["location_id"] == "B" and out[0]["indoor"] is None


def test_parse_events_rescue_and_corrupt(spark):
    env = spark.createDataFrame([
        (0, 1, '{"id": "a", "sensor_id": "7", "P1": 12.5, "temperature": "20", "x": {"y": 1}}'),
        (0, 2, "not json"),
        (1, 3, '{"id": "b", "P2": "3"}')], "partition int, offset long, value string")
    out = {r["_source_offset"]: r for r in parse_events(env, schemas.PHASE_A).collect()}
    assert out["1"]["P1"] == "12.5" and out["1"]["sensor_id"] == "7"
    assert out["1"]["_rescued_data"] == '{"temperature":"20","x":"{\\"y\\":1}"}'
    assert out["2"]["id"] is None and out["2"]["_corrupt_record"] == "not json"
    assert out["3"]["_rescued_data"] is None and out["3"]["_source_partition"] == "1"
    wide = parse_events(env, schemas.PHASE_B).collect()
    assert {r["temperature"] for r in wide} == {"20", None}


def test_active_schema_phases():
    assert [f.name for f in schemas.active_schema("SDS011").fields][-2:] == ["P1", "P2"]
    assert schemas.active_schema("sds011,bme280").fieldNames()[-1] == "pressure"


def test_to_messages_round_trip(spark):
    ev = spark.createDataFrame([("1", "7", None)], "id string, sensor_id string, P1 string")
    msg = to_messages(ev).collect()[0]
    assert msg["key"] == "7" and msg["value"] == '{"id":"1","sensor_id":"7","P1":null}'
    back = spark.createDataFrame([msg]).select(F.from_json("value", "id string, P1 string").alias("j"))
    assert back.collect()[0]["j"]["id"] == "1"


def test_window_and_dedup_plans_use_no_python(spark):
    from sensorlake.plans import adapters
    s = adapters.silver(spark, "/root/testdata/sf0.001")
    plan = gold.air_quality_daily(s["readings"], s["devices"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", ["events", "customer"])
def test_scans_prune_columns(spark, name):
    from sensorlake.plans import adapters
    df = adapters.load(spark, "/root/testdata/sf0.001", name)
    col = df.columns[0]
    plan = df.select(col)._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: struct<{col}:" in plan and "," not in plan.split("ReadSchema: struct<")[1].split(">")[0]


def test_publish_file_double_counts(spark, scratch):
    import os
    from sensorlake.operators.messages import publish
    ev = spark.createDataFrame([("1", "7"), ("2", "8")], "id string, sensor_id string")
    path = os.path.join(scratch, "bus")
    assert publish(to_messages(ev), "json", {}, path) == 2
    assert spark.read.json(path).count() == 2


def test_api_records_fixture_cases(spark, scratch):
    import json
    import os
    from sensorlake.plans.registry import live_events
    from sensorlake.sources.bus import read_api_records
    recs = [
        {"id": 1, "timestamp": "2024-01-01 00:00:00",
         "sensor": {"id": 10, "sensor_type": {"name": "DHT22"}},
         "location": {"id": 5, "latitude": "50.1", "longitude": "30.2", "country": "ua"},
         "sensordatavalues": [{"value_type": "P1", "value": "1"}]},
        {"id": 2, "timestamp": "2024-01-01 00:01:00",
         "sensor": {"id": 10, "sensor_type": {"name": "SDS011"}},
         "location": {"id": 6, "latitude": 50.5, "longitude": 30.5, "country": "ua"},
         "sensordatavalues": [{"value_type": "P1", "value": "1"}, {"value_type": "P1", "value": "2"},
                              {"value_type": "", "value": "9"}, {"value": "8"},
                              {"value_type": "noise", "value": "7"}]},
        {"id": 3, "timestamp": "2024-01-01 00:02:00",
         "sensor": {"id": 11, "sensor_type": {"name": "BME280"}},
         "location": {"id": 7, "latitude": "1", "longitude": "2", "country": "PL", "indoor": None},
         "sensordatavalues": []},
        {"id": 4, "timestamp": "2024-01-01 00:03:00", "sensor": None,
         "location": {"id": 8, "country": "DE", "indoor": 1}},
    ]
    path = os.path.join(scratch, "api")
    os.makedirs(path)
    with open(os.path.join(path, "r.json"), "w") as f:
        json.dump(recs, f)
    records = read_api_records(spark, path)
    reg = {r["sensor_id"]: r for r in build_registry(records).collect()}
    assert set(reg) == {"10", "11"}
    assert reg["10"]["location_id"] == "6" and reg["10"]["indoor"] == "0"      # absent -> "0"
    assert reg["10"]["lat"] == "50.5"                                           # number as text
    assert reg["11"]["indoor"] is None                                          # null stays NULL
    flat = {r["id"]: r for r in live_events(records).collect()}
    assert flat["2"]["P1"] == "2" and flat["2"]["P2"] is None                  # last wins
    assert flat["4"]["sensor_id"] is None and flat["4"]["country"] == "DE"    # no sensor object
