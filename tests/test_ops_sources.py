"""API responses by arrival, one parse per message, counters, run log of loads, SQL over views."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake import config, jobs, schemas, tables
from sensorlake.operators.messages import parse_events
from sensorlake.plans import ops
from sensorlake.plans.registry import build_registry
from sensorlake.sources.bus import read_api_records


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def record(sensor, place, **location):
    return {"id": f"{sensor}-{place}", "timestamp": "t", "sensor": {
        "id": sensor, "sensor_type": {"name": "SDS011"}}, "location": {"id": place, **location}}


# ---------------------------------------------------------------- API responses

def test_api_files_count_by_arrival_then_path_then_place(spark, scratch):
    files = {"z.json": (100, [record("1", "a"), record("1", "b"), record("2", "c")]),
             "a.json": (200, [record("1", "d"), record("3", "e", indoor=None)]),
             "b.json": (200, [record("3", "f"), record("4", "g")])}
    for name, (time, records) in files.items():
        put(f"{scratch}/api/{name}", json.dumps(records, indent=2))
        os.utime(f"{scratch}/api/{name}", (time, time))
    put(f"{scratch}/api/single.json", json.dumps(record("5", "h", indoor="1")))
    put(f"{scratch}/api/empty.json", "\n")
    recs = read_api_records(spark, f"{scratch}/api")
    places = {r["id"]: r["api_pos"]["place"] for r in recs.collect()}
    assert places == {"1-a": 0, "1-b": 1, "2-c": 2, "1-d": 0, "3-e": 1, "3-f": 0, "4-g": 1, "5-h": 0}
    got = {r["sensor_id"]: (r["location_id"], r["indoor"]) for r in build_registry(recs).collect()}
    assert got == {"1": ("a", "0"), "2": ("c", "0"), "3": ("e", None), "4": ("g", "0"),
                   "5": ("h", "1")}


def test_a_broken_response_fails_the_read(spark, scratch):
    put(f"{scratch}/api/good.json", json.dumps([record("1", "a")]))
    put(f"{scratch}/api/cut.json", json.dumps([record("2", "b")])[:40])
    with pytest.raises(Exception, match="cut.json"):
        read_api_records(spark, f"{scratch}/api").collect()


# ---------------------------------------------------------------- one parse

BODIES = ['{"id": "1", "P1": 12.50, "extra": [1, {"a": "b"}], "none": null}',
          '{"id": 2, "P1": {"x": 1}, "P1": "last"}', '{"P1": null, "id": "3"}', "{}", "",
          "not json {", "[1, 2]", '"text"', "null", None, '{"id": "4", "P1": 1e3, "p1": "lower"}',
          '{"id": "5", "P1": true, "long": "' + "x" * 100_000 + '"}', '{"id": "6"']


def test_fields_and_rescue_come_from_one_parse(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("P1", T.StringType()),
                           T.StructField("none", T.StringType())])
    env = spark.createDataFrame([(0, i, b) for i, b in enumerate(BODIES)], schemas.ENVELOPE)
    df = parse_events(env, schema)
    rows = sorted(df.collect(), key=lambda r: int(r["_source_offset"]))
    fields = [(r["id"], r["P1"]) for r in rows]
    assert fields[:4] == [("1", "12.5"), ("2", "last"), ("3", None), (None, None)]
    assert fields[11] == ("5", "true")
    # The same texts as a parse with the declared schema gives.
    plain = env.where("offset IN (0, 1, 2, 3, 10, 11)").select(
        "offset", F.from_json("value", schema).alias("j")).orderBy("offset").select("j.id", "j.P1")
    assert [tuple(r) for r in plain.collect()] == [fields[i] for i in (0, 1, 2, 3, 10, 11)]
    assert json.loads(rows[0]["_rescued_data"]) == {"extra": '[1,{"a":"b"}]'}
    assert json.loads(rows[10]["_rescued_data"]) == {"p1": "lower"}
    assert len(rows[11]["_rescued_data"]) > 100_000
    corrupt = [i for i, r in enumerate(rows) if r["_corrupt_record"] is not None]
    assert set(corrupt) >= {5, 6, 7, 12} and not set(corrupt) & {0, 1, 2, 3, 9, 10, 11}
    for i in corrupt:
        assert fields[i] == (None, None) and rows[i]["_rescued_data"] is None
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_declared_types_other_than_text_are_cast(spark):
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.LongType())])
    env = spark.createDataFrame([(0, 0, '{"a": "1.5", "b": "x"}')], schemas.ENVELOPE)
    row = parse_events(env, schema).first()
    assert (row["a"], row["b"]) == (1.5, None)


# ---------------------------------------------------------------- counters and run log

def test_counters_of_one_job(spark, scratch):
    c = ops.Counters()
    df = c.at("read", spark.range(100))
    c.at("kept", c.at("even", df.where("id % 2 = 0")).where("id < 50")).write.parquet(f"{scratch}/o")
    assert {r["stage"]: r["n_rows"] for r in c.table(spark).collect()} == {
        "read": 100, "even": 50, "kept": 25}


def _log(spark, path):
    return sorted((r["job"], r["status"], r["rows_in"], r["rows_out"])
                  for r in spark.read.parquet(path).collect())


def test_loads_log_their_rows(spark, scratch):
    log = f"{scratch}/log"
    put(f"{scratch}/in/date=2024-01-01/a_sds011_sensor_1.csv", "a;b\n1;2\n\n3;4\n")
    put(f"{scratch}/in/date=2024-01-01/b_sds011_sensor_2.csv", "b\n5\n")
    for _ in range(2):  # the second finds nothing new
        jobs.archive_job(spark, f"{scratch}/in", f"{scratch}/archive", f"{scratch}/ck-a",
                         f"{scratch}/schema", run_log=log, max_files_per_trigger=1)
    assert _log(spark, log) == [("sensor_archive_raw", "succeeded", 0, 0),
                                ("sensor_archive_raw", "succeeded", 3, 3)]
    log = f"{scratch}/log-live"
    for i in range(3):
        put(f"{scratch}/bus/{i}.json", "".join(json.dumps(
            {"partition": 0, "offset": 10 * i + j, "value": "{}"}) + "\n" for j in range(4)))
    jobs.live_job(spark, "json", {}, f"{scratch}/live", f"{scratch}/ck-l", f"{scratch}/bus",
                  config.Settings(max_offsets_per_trigger=1), log, available_now=True)
    assert _log(spark, log) == [("sensor_live_raw", "succeeded", 12, 12)]


def test_a_failing_stream_is_logged(spark, scratch):
    log = f"{scratch}/log"
    put(f"{scratch}/bus/a.json", json.dumps({"partition": 0, "offset": 1, "value": "{}"}) + "\n")
    put(f"{scratch}/live", "a file where the table should be")
    with pytest.raises(Exception):
        jobs.live_job(spark, "json", {}, f"{scratch}/live", f"{scratch}/ck", f"{scratch}/bus",
                      run_log=log, available_now=True)
    rows = spark.read.parquet(log).collect() if os.path.exists(log) else []
    assert [r["status"] for r in rows] in ([], ["failed"])  # refused at start, or ended by it


# ---------------------------------------------------------------- SQL

def test_sql_over_views_and_databases(spark, scratch):
    df = spark.range(10).select("id", (F.col("id") % 3).alias("k"))
    got = tables.sql_over(spark, "SELECT k, count(*) AS n FROM numbers JOIN others USING (k) GROUP BY k",
                          numbers=df, others=df.select("k").distinct())
    assert not spark.catalog.tableExists("numbers")
    assert dict(map(tuple, got.collect())) == {0: 4, 1: 3, 2: 3}
    df.createOrReplaceTempView("taken")
    with pytest.raises(ValueError):
        tables.sql_over(spark, "SELECT 1", taken=df)
    assert spark.catalog.tableExists("taken")
    spark.catalog.dropTempView("taken")
    for _ in range(2):
        tables.ensure_database(spark, "made_for_a_test", f"{scratch}/it's")
    got.write.mode("overwrite").saveAsTable("made_for_a_test.t")
    assert spark.table("made_for_a_test.t").count() == 3
    assert any(n.endswith(".parquet") for n in os.listdir(f"{scratch}/it's/t"))
    spark.sql("DROP DATABASE made_for_a_test CASCADE")
