"""Property tests (Hypothesis) for reshaping, upsert and dedup."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorlake.operators.dedup import keep_greatest
from sensorlake.operators.joins import upsert
from sensorlake.operators.reshape import unpivot_metrics

CELL = st.one_of(st.none(), st.sampled_from(["1", "2.5", "-3", "unknown", "", "NaN", "1e3", "x1"]))
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _parses(v):
    if v is None:
        return False
    try:
        float(v)
        return True
    except ValueError:
        return False


@SETTINGS
@given(st.lists(st.tuples(CELL, CELL, CELL), min_size=0, max_size=12))
def test_unpivot_count_is_parsable_cells(spark, rows):
    data = [(str(i), *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "sensor_id string, P1 string, P2 string, pressure string")
    out = unpivot_metrics(df, ["sensor_id"], ["P1", "P2", "pressure", "humidity"])
    assert out.count() == sum(_parses(v) for r in rows for v in r)


KEYS = st.sampled_from(["a", "b", "c", "d"])


@SETTINGS
@given(st.lists(st.tuples(KEYS, st.integers(0, 9)), max_size=8),
       st.dictionaries(KEYS, st.integers(0, 9), max_size=4))
def test_upsert_idempotent_and_keys_unique_when_target_unique(spark, target, updates):
    t_rows = list({k: v for k, v in target}.items())          # a dimension: unique keys
    t = spark.createDataFrame(t_rows, "k string, v int")
    u = spark.createDataFrame(list(updates.items()), "k string, v int")
    once = sorted(map(tuple, upsert(t, u, ["k"]).collect()))
    twice = sorted(map(tuple, upsert(upsert(t, u, ["k"]), u, ["k"]).collect()))
    assert once == twice
    assert dict(once) == {**dict(t_rows), **updates}


@SETTINGS
@given(st.lists(st.tuples(KEYS, st.integers(0, 5), st.sampled_from(["x", "y", None])),
                min_size=1, max_size=12))
def test_keep_greatest_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "k string, o int, p string")
    got = sorted(map(tuple, keep_greatest(df, ["k"], ["o"]).collect()))
    best = {}
    for k, o, p in rows:
        cand = (o, (p is not None, p or ""))
        if k not in best or cand > best[k][0]:
            best[k] = (cand, (k, o, p))
    assert got == sorted(v[1] for v in best.values())


VTYPE = st.sampled_from(["P1", "P2", "temperature", "", None, "noise"])


@SETTINGS
@given(st.lists(st.lists(st.tuples(VTYPE, st.sampled_from(["1", "2", "3", None])), max_size=6),
                min_size=1, max_size=6))
def test_normalize_matches_python_model(spark, records):
    from sensorlake import config
    from sensorlake.operators.reshape import normalize_records
    rows = [(str(i), {"id": "s", "sensor_type": {"name": "SDS011"}}, entries)
            for i, entries in enumerate(records)]
    df = spark.createDataFrame(
        rows, "id string, sensor struct<id:string,sensor_type:struct<name:string>>, "
              "sensordatavalues array<struct<value_type:string,value:string>>")
    df = df.withColumn("timestamp", F.lit(None).cast("string")) \
           .withColumn("location", F.lit(None).cast(
               "struct<id:string,latitude:string,longitude:string,country:string>"))
    got = {r["id"]: r.asDict() for r in normalize_records(df, config.METRICS).collect()}
    for i, entries in enumerate(records):
        model = {}
        for vt, v in entries:
            if vt:                        # empty or missing type: skipped; later entries win
                model[vt] = v
        for m in config.METRICS:
            assert got[str(i)][m] == model.get(m)
        other = {k: v for k, v in model.items() if k not in config.METRICS}
        assert json.loads(got[str(i)]["_other"] or "{}") == other


FNAME = st.sampled_from(["a_sds011_sensor_1.csv", "b_SDS011_sensor_2.csv", "c_bme280_sensor_3.csv",
                         "d_dht22_sensor_1.csv", "e_sds011_index.csv", "f_sds011_sensor_9.csv",
                         "g_bme280_sensor_2.txt"])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([1, 2]), st.lists(FNAME, min_size=1, max_size=3)),
                min_size=1, max_size=8),
       st.sets(st.sampled_from(["a_sds011_sensor_1.csv", "c_bme280_sensor_3.csv"])),
       st.one_of(st.none(), st.integers(1, 3)))
def test_manifest_matches_python_model(spark, pages, landed_names, cap):
    import datetime as dt
    import re
    from sensorlake.plans import manifest
    days = {1: dt.date(2024, 1, 1), 2: dt.date(2024, 1, 2)}
    listings = spark.createDataFrame(
        [(days[d], pos, "".join(f'<a href="{f}">x</a>' for f in files))
         for pos, (d, files) in enumerate(pages)], "day date, pos long, html string")
    registry = spark.createDataFrame([("1",), ("2",), ("3",)], "sensor_id string")
    landed = spark.createDataFrame([(days[1], n, 10) for n in landed_names],
                                   "day date, file_name string, length long")
    got = sorted((r["day"], r["file_name"], r["status"]) for r in manifest.select_files(
        listings, registry, landed, "2024-01-01", "2024-01-02", cap=cap).collect())
    want, seen, per_day = [], set(), {}
    for pos, (d, files) in enumerate(pages):
        for f in files:
            if not f.endswith(".csv") or not any(f"_{t}_" in f.lower() for t in ("sds011", "bme280")):
                continue
            m = re.search(r"_sensor_(\d+)\.csv", f)
            if not m or m.group(1) not in {"1", "2", "3"} or (d, f) in seen:
                continue
            seen.add((d, f))
            per_day[d] = per_day.get(d, 0) + 1
            if cap is not None and per_day[d] > cap:
                continue
            status = "skip" if d == 1 and f in landed_names else "download"
            want.append((days[d], f, status))
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["s1", "s2", None]),
                          st.sampled_from(["2024-01-01 10:00", "2024-01-01 9:00", "'2024", None]),
                          st.sampled_from(["0", "1"]), st.integers(0, 20),
                          st.sampled_from(["de", "pl", None])), min_size=1, max_size=10,
                unique_by=lambda r: (r[2], r[3])))
def test_latest_live_matches_python_model(spark, rows):
    from sensorlake.plans.silver import latest_live
    df = spark.createDataFrame(
        [(p, str(o), s, t, "1", "2", c) for s, t, p, o, c in rows],
        "_source_partition string, _source_offset string, sensor_id string, timestamp string, "
        "latitude string, longitude string, country string")
    got = {r["sensor_id"]: r["country"] for r in latest_live(df).collect()}
    want = {}
    for s, t, p, o, c in rows:
        if s is None:
            continue
        key = ((t is not None, t or ""), p, o)            # NULL text sorts lowest
        if s not in want or key > want[s][0]:
            want[s] = (key, c)
    assert got == {s: v[1] for s, v in want.items()}


KEY = st.sampled_from(["id", "sensor_id", "P1", "temperature", "extra", "k"])
SCALAR = st.one_of(st.integers(-5, 5), st.sampled_from(["a", "b"]))


@SETTINGS
@given(st.lists(st.one_of(st.dictionaries(KEY, SCALAR, max_size=4),
                          st.sampled_from(["{broken", "[1, 2]"])), min_size=1, max_size=8))
def test_parse_events_matches_json_model(spark, bodies):
    import json
    from sensorlake import schemas
    from sensorlake.operators.messages import parse_events
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    env = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)],
                                "partition int, offset long, value string")
    got = {int(r["_source_offset"]): r for r in parse_events(env, schemas.PHASE_A).collect()}
    known = set(schemas.PHASE_A.fieldNames())
    for i, b in enumerate(bodies):
        r = got[i]
        if not isinstance(b, dict):                      # not a JSON object
            assert r["id"] is None and r["P1"] is None
            assert r["_rescued_data"] is None
            continue
        assert r["_corrupt_record"] is None
        for f in ("id", "sensor_id", "P1"):
            assert r[f] == (None if f not in b else str(b[f]))
        extra = {k: str(v) for k, v in b.items() if k not in known}
        assert (json.loads(r["_rescued_data"]) if r["_rescued_data"] else {}) == extra


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["s1", "s2"]),
                          st.sampled_from(["2024-01-01 10:00:00", "'2024-01-01 10:00:00'", "bad"]),
                          st.sampled_from([1.0, 2.0, float("nan")]),
                          st.sampled_from(["1.5", "NaN", None]),
                          st.sampled_from(["live", "archive"]),
                          st.integers(0, 3)), min_size=1, max_size=10))
def test_clean_then_dedup_matches_python_model(spark, rows):
    import datetime as dt
    import math
    from sensorlake.plans.silver import clean_readings, dedup_readings
    base = dt.datetime(2024, 1, 1)
    data = [(s, t, "P1", v, "L", lat, None, None, src, base + dt.timedelta(hours=h))
            for s, t, v, lat, src, h in rows]
    df = spark.createDataFrame(data, "sensor_id string, timestamp string, value_type string, "
                                     "value double, location_id string, latitude string, "
                                     "longitude string, country string, _source string, "
                                     "_ingested_at timestamp")
    safe = lambda x: (x[0], x[1] is not None, x[1] or base, x[2], x[3])
    got = sorted(((r["sensor_id"], r["event_ts_utc"], r["value"], r["_source"])
                  for r in dedup_readings(clean_readings(df)).collect()), key=safe)
    best = {}
    for s, t, v, lat, src, h in rows:
        if math.isnan(v) or lat == "NaN":                 # invalid copies never compete
            continue
        ts = None if t == "bad" else dt.datetime(2024, 1, 1, 10)
        lat_v = None if lat is None else float(lat)
        # greatest (_ingested_at, _source, value, location_id, latitude, ...); NULL lowest
        rank = (h, src, v, "L", (lat_v is not None, lat_v or 0.0))
        k = (s, ts)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (s, ts, v, src))
    assert got == sorted((v[1] for v in best.values()), key=safe)
