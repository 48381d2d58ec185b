"""Archive files read by line in splits: every line keeps its own file's header."""

import csv
import io
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.plans import adapters, bronze
from sensorlake.session import with_conf
from sensorlake.sources import archive

SPLIT = "spark.sql.files.maxPartitionBytes"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def landing(root, files=6, lines=400):
    """Files of several header sets in one folder, of which the first is by far the largest."""
    rng = np.random.default_rng(2)
    want = []
    for i in range(files):
        names = [str(n) for n in rng.permutation(["a", "b", "c d", "e", "f"])[:3 + i % 3]]
        out = io.StringIO()
        w = csv.writer(out, delimiter=";", quoting=csv.QUOTE_ALL if i % 2 else csv.QUOTE_MINIMAL,
                       lineterminator="\r\n" if i % 3 else "\n")
        w.writerow(names)
        for j in range(lines * (10 if i == 0 else 1)):
            cells = [["", f"{i}-{j}-{n}", 'x;"y"', "é", str(j)][rng.integers(0, 5)] for n in names]
            w.writerow(cells)
            if any(cells):
                want.append(tuple(dict(zip(names, cells, strict=True)).get(n) or None
                                  for n in ("a", "b", "c d", "e", "f")))
            else:
                want.append((None,) * 5)
        put(f"{root}/date=2024-01-0{1 + i % 2}/x_sds011_sensor_{i}.csv", out.getvalue())
    return want


def key(row):
    return tuple((v is None, v or "") for v in row)


COLUMNS = ["a", "b", "c d", "e", "f"]


@pytest.mark.parametrize("split", ["200", "5000", "128m"])
def test_lines_of_any_split_meet_their_own_header(spark, scratch, split):
    want = landing(f"{scratch}/in")
    with with_conf(spark, {SPLIT: split}):
        if split == "5000":
            text = archive.archive_text(spark, f"{scratch}/in")
            assert text.rdd.getNumPartitions() > 10
        rows = archive.read_archive(spark, f"{scratch}/in", COLUMNS).select(*COLUMNS).collect()
        assert archive.discover_columns(spark, f"{scratch}/in", known=["f"]) == [
            "f", "a", "b", "c d", "e"]
    # A line of empty cells alone is all NULL; it is not an empty line, as it has separators.
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_load_in_splits_equals_the_files(spark, scratch):
    want = landing(f"{scratch}/in")
    for _ in range(2):
        q = bronze.load_archive(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck",
                                f"{scratch}/schema", max_files_per_trigger=4, split_bytes=2000)
        assert q.exception() is None
    rows = bronze.read_table(spark, f"{scratch}/out").select(*COLUMNS).collect()
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert spark.conf.get(SPLIT) != "2000"


def test_odd_files(spark, scratch):
    """No line, a header alone, empty lines, short and long lines, a repeated header line."""
    files = {"none": "", "head": "a;b\n", "gaps": "a;b\n\n1;2\r\n\r\n3\n4;5;6",
             "twice": "b;a\nb;a\n7;8\n", "mark": "\ufeffa;b\n9;\n", "wide": "a\n" + "z" * 100_000}
    for name, text in files.items():
        put(f"{scratch}/in/date=2024-01-01/{name}_sds011_sensor_1.csv", text)
    with with_conf(spark, {SPLIT: "64"}):
        rows = archive.read_archive(spark, f"{scratch}/in", ["a", "b", "c"]).collect()
    got = sorted((os.path.basename(r["_source_file_name"]).split("_")[0], r["a"], r["b"], r["c"])
                 for r in rows)
    assert got == [("gaps", "1", "2", None), ("gaps", "3", None, None), ("gaps", "4", "5", None),
                   ("mark", "9", None, None), ("twice", "8", "7", None), ("twice", "a", "b", None),
                   ("wide", "z" * 100_000, None, None)]


def test_the_plan_reads_lines_in_splits_and_looks_names_up_once_per_file(spark, scratch):
    landing(f"{scratch}/in", 2, 10)
    df = archive.read_archive(spark, f"{scratch}/in", COLUMNS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "wholetext" not in plan.lower()
    join = plan.index("Join")
    assert "array_position" not in plan[:join] and "array_position" in plan[join:]


def test_a_long_quoted_cell_and_plain_lines_are_cut_alike(spark):
    long = "x" * 20_000 + '\\"y' * 2_000 + ";" + '""' * 2_000
    lines = [f'"{long}";b', "", "a;;b", ";", None, 'a;"";"b;c"', '"a"b";c']
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, value string").select(
        "i", archive._split(F.col("value"), ";").alias("c")).orderBy("i").collect()
    assert [r["c"] for r in rows] == [
        ["x" * 20_000 + '"y' * 2_000 + ";" + '"' * 2_000, "b"], [""], ["a", "", "b"], ["", ""], None,
        ["a", "", "b;c"], ['a"b', "c"]]


def test_the_json_of_an_event_is_parsed_once_a_row(spark):
    events = spark.createDataFrame(
        [], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
            "props string")
    for shaped in (adapters.live_raw, adapters.archive_raw, adapters.bus_envelope,
                   adapters.event_records):
        plan = shaped(events)._jdf.queryExecution().analyzed().toString()
        assert plan.count("get_json_object") == 1, shaped.__name__
