"""Wide-to-long and nested-to-flat reshaping (RSH-1, RSH-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions import try_double

# Column of the measurements that have no column of their own.
OTHER = "_other"


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str],
                    variable: str = "value_type", value: str = "value") -> DataFrame:
    """One row per (id columns, metric) that holds a number, from one column per metric.

    Of both lists only the columns that exist are used, matched case-sensitively (PRJ-7). Cells
    become numbers where they stand, so that metric columns of different types (inferred CSV, JSON)
    agree before they share a column; a cell that is empty or no number gives no row, so "unknown"
    never becomes a reading.

    ``unpivot`` is a narrow Expand: no shuffle, and the pruned scan reads only the listed
    columns.
    """
    kept, held = ([c for c in names if c in df.columns] for names in (ids, metrics))
    numbers = df.select(*kept, *(try_double(F.col(m).cast("string")).alias(m) for m in held))
    if not held:  # ``unpivot`` takes no empty list
        none = {variable: F.lit(None).cast("string"), value: F.lit(None).cast("double")}
        return numbers.withColumns(none).limit(0)
    return numbers.unpivot(kept, held, variable, value).where(F.col(value).isNotNull())


def measurement(values: str | Column, metric: str) -> Column:
    """Value of ``metric`` in an array<struct<value_type, value>>; the last occurrence wins."""
    arr = F.col(values) if isinstance(values, str) else values
    hits = F.filter(arr, lambda x: x["value_type"] == F.lit(metric))
    return F.when(F.size(hits) > 0, F.element_at(hits, -1)["value"])


def other_measurements(values: Column, metrics: Sequence[str]) -> Column:
    """JSON object of the measurements not in ``metrics``, in order of first appearance; NULL if
    there is none. Types without a name are skipped and the last of a repeated type wins."""
    named = F.filter(values, lambda x: x["value_type"].isNotNull() & (x["value_type"] != "")
                     & ~x["value_type"].isin(*metrics))
    types = F.array_distinct(F.transform(named, lambda x: x["value_type"]))
    last = F.transform(types, lambda t: F.element_at(
        F.filter(named, lambda x: x["value_type"] == t), -1)["value"])
    return F.when(F.size(types) > 0, F.to_json(F.map_from_arrays(types, last),
                                                {"ignoreNullFields": "false"}))


def normalize_records(records: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Nested API record -> flat event with one text column per configured metric (RSH-2) and
    ``_other``, a JSON object of all further measurements.

    Missing ``sensor``/``location`` structs give NULL fields instead of failing. Entries with
    an empty or NULL ``value_type`` are skipped and, for a repeated type, the last one wins.
    """
    s = F.col("sensor")
    loc = F.col("location")
    fixed = [
        F.col("id").cast("string").alias("id"),
        F.col("timestamp").cast("string").alias("timestamp"),
        s["id"].cast("string").alias("sensor_id"),
        s["sensor_type"]["name"].cast("string").alias("sensor_type"),
        loc["id"].cast("string").alias("location_id"),
        loc["latitude"].cast("string").alias("latitude"),
        loc["longitude"].cast("string").alias("longitude"),
        loc["country"].cast("string").alias("country"),
    ]
    vals = F.coalesce(F.col("sensordatavalues"),
                      F.array().cast(T.ArrayType(T.StructType([
                          T.StructField("value_type", T.StringType()),
                          T.StructField("value", T.StringType())]))))
    return records.select(*fixed, *[measurement(vals, m).cast("string").alias(m) for m in metrics],
                          other_measurements(vals, metrics).alias(OTHER))
