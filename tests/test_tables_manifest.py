"""File manifest rules, staged table writes, upsert tables and incremental readings."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sensorlake import schemas, tables
from sensorlake.plans import adapters, incremental, manifest, ops

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _listing(spark):
    return spark.createDataFrame([
        (D1, 1, '<a href="x_SDS011_sensor_1.csv">a</a><a href="x_bme280_sensor_2.csv">b</a>'),
        (D1, 2, '<a href="x_dht22_sensor_1.csv">c</a><a href="x_SDS011_sensor_1.csv">dup</a>'),
        (D1, 3, '<a href="x_sds011_index.csv">d</a><a href="x_sds011_sensor_9.csv">e</a>'),
        (D2, 1, '<a href="y_sds011_sensor_1.csv">f</a><a href="y_sds011_sensor_2.txt">g</a>')],
        "day date, pos long, html string")


def test_manifest_rules(spark):
    reg = spark.createDataFrame([("1",), ("2",)], "sensor_id string")
    landed = spark.createDataFrame([(D1, "x_bme280_sensor_2.csv", 10),
                                    (D2, "y_sds011_sensor_1.csv", 0)],
                                   "day date, file_name string, length long")
    out = manifest.select_files(_listing(spark), reg, landed, "2024-01-01", "2024-01-02")
    got = sorted((r["day"], r["file_name"], r["status"]) for r in out.collect())
    assert got == [(D1, "x_SDS011_sensor_1.csv", "download"),
                   (D1, "x_bme280_sensor_2.csv", "skip"),
                   (D2, "y_sds011_sensor_1.csv", "download")]
    capped = manifest.select_files(_listing(spark), reg, landed, "2024-01-01", "2024-01-02", cap=1)
    assert sorted(r["file_name"] for r in capped.collect()) == ["x_SDS011_sensor_1.csv",
                                                                 "y_sds011_sensor_1.csv"]
    one_day = manifest.select_files(_listing(spark), reg, landed, "2024-01-02", "2024-01-02")
    assert one_day.count() == 1
    counts = {(r["day"], r["status"]): r["n_files"] for r in manifest.manifest_counts(out).collect()}
    assert counts[(D1, "skip")] == 1


def test_manifest_rejects_reversed_range(spark):
    reg = spark.createDataFrame([("1",)], "sensor_id string")
    with pytest.raises(ValueError):
        manifest.select_files(_listing(spark), reg, reg, "2024-01-02", "2024-01-01")


def test_replace_path_while_reading_it(spark, scratch):
    path = os.path.join(scratch, "t")
    spark.range(5).write.parquet(path)
    cur = spark.read.parquet(path)
    tables.replace_path(spark, cur.withColumn("id", F.col("id") + 10), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [10, 11, 12, 13, 14]
    assert not [p for p in os.listdir(scratch) if ".staging-" in p or ".old-" in p]


def test_upsert_path_creates_then_merges(spark, scratch):
    path = os.path.join(scratch, "devices")
    ts = dt.datetime(2024, 1, 1)
    u1 = spark.createDataFrame([("1", "SDS011", "L", "DE", 1.0, 2.0, False, "api", ts)],
                               schemas.DEVICES)
    tables.upsert_path(spark, u1, path, ["sensor_id"], schemas.DEVICES)
    u2 = spark.createDataFrame([("1", "SDS011", "L2", "DE", 1.0, 2.0, True, "api", ts),
                                ("2", "BME280", "M", "PL", 3.0, 4.0, None, "api", ts)],
                               schemas.DEVICES)
    tables.upsert_path(spark, u2, path, ["sensor_id"], schemas.DEVICES)
    tables.upsert_path(spark, u2, path, ["sensor_id"], schemas.DEVICES)   # idempotent
    got = {r["sensor_id"]: r["location_id"] for r in tables.read_upserted(spark, path).collect()}
    assert got == {"1": "L2", "2": "M"}


def test_a_failing_rename_keeps_the_old_table(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    spark.range(3).write.parquet(path)
    real = tables._fs

    class Stuck:
        """A file system whose n-th rename fails."""
        def __init__(self, fs, fail):
            self.fs, self.fail, self.n = fs, fail, 0

        def rename(self, a, b):
            self.n += 1
            return self.n != self.fail and self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    for fail in (1, 2):
        def stuck(spark, p, fail=fail):
            fs, target, jvm = real(spark, p)
            return Stuck(fs, fail), target, jvm
        monkeypatch.setattr(tables, "_fs", stuck)
        with pytest.raises(OSError):
            tables.replace_path(spark, spark.range(10), path)
        monkeypatch.setattr(tables, "_fs", real)
        assert spark.read.parquet(path).count() == 3
    tables.replace_path(spark, spark.range(10), path)
    assert spark.read.parquet(path).count() == 10


def test_upsert_refuses_two_updates_of_one_key(spark, scratch):
    path = os.path.join(scratch, "u")
    old = spark.createDataFrame([("1", 1), ("2", 2)], "k string, v int")
    tables.upsert_path(spark, old, path, ["k"], old.schema)
    twice = spark.createDataFrame([("1", 5), ("1", 6)], "k string, v int")
    with pytest.raises(Exception, match="duplicate key"):
        tables.upsert_path(spark, twice, path, ["k"], old.schema)
    assert sorted(map(tuple, tables.read_upserted(spark, path).collect())) == [("1", 1), ("2", 2)]


def test_incremental_equals_full(spark, scratch):
    ev = adapters.load(spark, "/root/testdata/sf0.001", "events")
    live, arch = adapters.live_raw(ev), adapters.archive_raw(ev)
    first_half = ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    second_half = ev.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    path = os.path.join(scratch, "readings")
    l1, a1 = adapters.live_raw(first_half), adapters.archive_raw(first_half)
    tables.replace_partitions(incremental.full_readings(l1, a1), path, ["event_date"])
    l2, a2 = adapters.live_raw(second_half), adapters.archive_raw(second_half)
    dates = incremental.touched_dates(l2, a2)
    part = incremental.readings_for_dates(live, arch, dates)
    tables.replace_partitions(part, path, ["event_date"])
    inc = spark.read.parquet(path).drop("event_date")
    full = incremental.full_readings(live, arch).drop("event_date")
    assert inc.count() == full.count()
    assert inc.exceptAll(full.select(*inc.columns)).count() == 0


def test_run_log_and_counters(spark, scratch):
    df, obs = ops.with_counters(spark.range(7), "n")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 7
    row = ops.run_log_row(spark, "silver_readings", dt.datetime(2024, 1, 1), "ok", 7, 7)
    ops.append_run_log(row, os.path.join(scratch, "log"))
    ops.append_run_log(row, os.path.join(scratch, "log"))
    assert spark.read.parquet(os.path.join(scratch, "log")).count() == 2


def test_cut_lineage_uses_shared_checkpoint(spark):
    df = tables.cut_lineage(spark.range(3))
    assert df.count() == 3
    assert spark.conf.get("spark.checkpoint.dir")


def test_day_range_defaults_to_yesterday():
    s, e = manifest.day_range()
    assert s == e == (dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=1)).date()
    assert manifest.day_range("2024-01-01", "2024-01-03") == (D1, dt.date(2024, 1, 3))


def test_manifest_rejects_empty_registry(spark):
    reg = spark.createDataFrame([], "sensor_id string")
    landed = spark.createDataFrame([], "day date, file_name string, length long")
    with pytest.raises(ValueError, match="registry"):
        manifest.select_files(_listing(spark), reg, landed, "2024-01-01", "2024-01-02")


def test_ensure_database_is_idempotent(spark):
    tables.ensure_database(spark, "sensorlake_silver_t")
    tables.ensure_database(spark, "sensorlake_silver_t")
    assert spark.catalog.databaseExists("sensorlake_silver_t")


def test_session_without_checkpoint_dir_gets_scratch_folder(tmp_path):
    """A session whose configuration names no checkpoint folder (fresh JVM, empty conf dir)."""
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from sensorlake.session import build_session, scratch_path\n"
            "from sensorlake import tables\n"
            "s = build_session('local[1]')\n"
            "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
            "a, b = scratch_path(s, 'a'), scratch_path(s, 'b')\n"
            "assert a.rsplit('/', 1)[0] == b.rsplit('/', 1)[0]\n"
            "assert tables.cut_lineage(s.range(3)).count() == 3\n"
            "print('OK')\n") % repo
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True,
                         timeout=300)
    assert "OK" in out.stdout, out.stderr[-2000:]


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names
            if f.endswith(".parquet")}


def test_an_upsert_of_one_key_leaves_other_files_as_they_are(spark, scratch):
    path = os.path.join(scratch, "t")
    old = spark.range(500).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    tables.upsert_path(spark, old, path, ["k"], old.schema)
    before = _files(path)
    assert len(before) == tables.BUCKETS
    new = spark.createDataFrame([(7, "new"), (1000, "new")], old.schema)
    one = new.where("k = 7")
    tables.upsert_path(spark, one, path, ["k"], old.schema)
    after = _files(path)
    assert len(before - after) == 1 and len(after - before) == 1
    tables.upsert_path(spark, new, path, ["k"], old.schema)
    got = dict(map(tuple, tables.read_upserted(spark, path).collect()))
    assert len(got) == 501 and got.pop(7) == got.pop(1000) == "new" and set(got.values()) == {"old"}
    assert not [n for n in os.listdir(scratch) if "staging" in n]
    assert not [n for n in os.listdir(path) if n.startswith(".old")]


def test_an_upsert_by_day_rewrites_the_days_it_touches(spark, scratch):
    path = os.path.join(scratch, "t")
    day = F.to_date("w")

    def rows(*data):
        return spark.createDataFrame(data, "w timestamp, s string, n int")

    t = [dt.datetime(2024, 1, d, h) for d in (1, 2, 3) for h in (0, 5)]
    first = rows(*((x, s, 1) for x in t for s in "ab"), (None, "a", 1))
    tables.upsert_path(spark, first, path, ["w", "s"], first.schema, by=day)
    before = _files(path)
    update = rows((t[0], "a", 2), (t[1], "c", 2), (None, "b", 2))
    tables.upsert_path(spark, update, path, ["w", "s"], first.schema, by=day)
    kept = before & _files(path)
    assert {os.path.basename(os.path.dirname(f)) for f in kept} == {
        f"{tables.PART}=2024-01-02", f"{tables.PART}=2024-01-03"}
    got = {(r["w"], r["s"]): r["n"] for r in tables.read_upserted(spark, path).collect()}
    assert len(got) == 15 and got[t[0], "a"] == got[t[1], "c"] == got[None, "b"] == 2
    assert sum(got.values()) == 18


def test_a_table_of_another_layout_is_rewritten_once(spark, scratch):
    path = os.path.join(scratch, "t")
    old = spark.range(50).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    old.write.parquet(path)
    one = spark.createDataFrame([(3, 9)], old.schema)
    for buckets in (4, 4, 8):
        tables.upsert_path(spark, one, path, ["k"], old.schema, buckets=buckets)
        assert len([n for n in os.listdir(path) if n.startswith(tables.PART)]) == buckets
        got = dict(map(tuple, tables.read_upserted(spark, path).collect()))
        assert len(got) == 50 and got[3] == 9


def test_an_upsert_of_nothing_makes_an_empty_table(spark, scratch):
    path = os.path.join(scratch, "t")
    none = spark.createDataFrame([], "k long, v string")
    for _ in range(2):
        tables.upsert_path(spark, none, path, ["k"], none.schema)
        assert tables.read_upserted(spark, path).columns == ["k", "v"]
    tables.upsert_path(spark, spark.createDataFrame([(1, "a")], none.schema), path, ["k"], none.schema)
    assert tables.read_upserted(spark, path).count() == 1


def test_replaced_days_are_computed_once(spark, scratch):
    path = os.path.join(scratch, "t")
    data = [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, None), (4, dt.date(2024, 1, 4))]
    spark.createDataFrame(data, "v int, day date").write.partitionBy("day").parquet(path)
    kept = {f for f in _files(path) if "2024-01-04" in f}
    times = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            times.add(b.num_rows)
            yield b

    new = spark.createDataFrame([(20, dt.date(2024, 1, 2)), (30, None)], "v int, day date") \
        .mapInArrow(seen, "v int, day date")
    days = spark.createDataFrame([(d,) for d in (dt.date(2024, 1, 1), dt.date(2024, 1, 2), None,
                                                 dt.date(2030, 1, 1))], "day date")
    tables.replace_days(spark, new, path, "day", days)
    assert times.value == 2
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [4, 20, 30]
    assert kept <= _files(path)


def test_a_failing_rename_of_a_partition_keeps_the_old_one(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    old = spark.range(20).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    tables.upsert_path(spark, old, path, ["k"], old.schema, buckets=2)
    real = tables.swap_in

    def failing(spark, staging, target, *more):
        return real(spark, staging + "-gone", target, *more)

    monkeypatch.setattr(tables, "swap_in", failing)
    with pytest.raises(Exception):
        tables.upsert_path(spark, spark.createDataFrame([(1, 5)], old.schema), path, ["k"],
                           old.schema, buckets=2)
    got = dict(map(tuple, tables.read_upserted(spark, path).collect()))
    assert len(got) == 20 and set(got.values()) == {0}


def test_readers_of_a_published_table_see_one_version_or_the_next(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    spark.range(3).write.parquet(path)  # a table that was never published
    assert tables.published_at(spark, path) == path
    real, seen = tables._fs, []

    def count():
        return tables.read_published(spark, path).count()

    class Watched:
        def __init__(self, fs):
            self.fs = fs

        def createNewFile(self, p):
            monkeypatch.setattr(tables, "_fs", real)
            seen.append(count())
            made = self.fs.createNewFile(p)
            seen.append(count())
            return made

        def __getattr__(self, name):
            return getattr(self.fs, name)

    def watched(spark, p):
        fs, target, jvm = real(spark, p)
        return Watched(fs), target, jvm

    for n in (5, 7, 9):
        monkeypatch.setattr(tables, "_fs", watched)
        tables.publish(spark, spark.range(n), path)
    assert seen == [3, 5, 5, 7, 7, 9]
    assert [d for d in sorted(os.listdir(scratch)) if ".v" in d] == ["t.v000002", "t.v000003"]
    assert sorted(f for f in os.listdir(f"{path}/_current") if f[0] != ".") == ["000002", "000003"]
    reader = tables.read_published(spark, path)
    tables.publish(spark, reader.where("id < 4"), path)  # a table may replace what it reads
    assert (count(), reader.count()) == (4, 9)


def test_a_version_without_a_pointer_does_not_count(spark, scratch):
    path = os.path.join(scratch, "t")
    tables.publish(spark, spark.range(3), path)
    spark.range(100).write.parquet(tables._version(path, 2))  # left by a job that failed
    assert tables.read_published(spark, path).count() == 3
    tables.publish(spark, spark.range(4), path)
    assert tables.read_published(spark, path).count() == 4
