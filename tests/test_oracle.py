"""Every registered query against its DuckDB oracle (same check as the driver, small scale)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sensorlake.plans import adapters, dashboard
from sensorlake.streaming.live import live_readings

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_rows, df.columns) == _rows(d_rows, d_cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["country", "day", "value_type", "avg_value", "n_readings"]


def test_stream_of_active_sensors_equals_the_batch(spark):
    """The stream reads live rows alone, so the batch does too."""
    live = live_readings(adapters.live_raw(adapters.load(spark, SF_SMALL, "events")))
    got, want = ({r["window_start"]: r["active_sensors"] for r in df.collect()} for df in (
        E.queries()["live_active_sensors_stream"](spark, SF_SMALL),
        dashboard.active_sensors(live, "1 hour")))
    assert got == want
