"""Scalar expressions shared by the silver, gold and live products.

All of them are JVM built-ins, so they stay inside whole-stage code generation. Text coming from
bronze is always converted with ``try_*`` casts: under ANSI mode a plain cast of ``'None'`` or of a
malformed timestamp fails the whole job, while the pipeline wants a NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorlake import config


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_quotes(col: str | Column) -> Column:
    """Remove every single and double quote character (STR-1)."""
    return F.translate(_c(col), "'\"", "")


def parse_event_ts(col: str | Column) -> Column:
    """Quote-stripped text to TIMESTAMP; unparsable text gives NULL (DT-3)."""
    return F.try_to_timestamp(strip_quotes(col))


def event_date(col: str | Column = "timestamp") -> Column:
    """Event date of a raw timestamp text, parsed exactly as silver parses it. Bronze tables are
    partitioned by it so that a rebuild of some event dates reads only their partitions."""
    return F.to_date(parse_event_ts(col))


def try_double(col: str | Column) -> Column:
    return _c(col).try_cast("double")


def try_boolean(col: str | Column) -> Column:
    return _c(col).try_cast("boolean")


def outdoor(indoor: str | Column = "indoor") -> Column:
    """Three-valued "outdoor": FALSE or unknown indoor flag counts as outdoor (FLT-4)."""
    c = _c(indoor)
    return (c == F.lit(False)) | c.isNull()


def not_nan_or_null(col: str | Column) -> Column:
    """NULL passes, NaN does not (FLT-3)."""
    c = _c(col)
    return c.isNull() | ~F.isnan(c)


def is_finite_or_null(col: str | Column) -> Column:
    c = _c(col)
    return c.isNull() | (~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))


def anomaly_flag(value_type: str | Column = "value_type", value: str | Column = "value",
                 thresholds: config.Thresholds | None = None) -> Column:
    """Strict single-reading threshold breach, NULL when no breach (CND-1)."""
    t = thresholds or config.Thresholds()
    vt, v = _c(value_type), _c(value)
    return (F.when((vt == config.PM10) & (v > F.lit(t.pm10)), F.lit(config.PM10_FLAG))
             .when((vt == config.PM25) & (v > F.lit(t.pm25)), F.lit(config.PM25_FLAG)))


def pollution_level(value_type: str | Column = "value_type",
                    value: str | Column = "value") -> Column:
    """Colour band of a PM reading for the live map; NULL for other metrics."""
    vt, v = _c(value_type), _c(value)

    def bands(levels):
        expr = None
        for upper, name in levels:
            cond = v <= F.lit(upper)
            expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
        return expr.otherwise(F.lit(config.WORST_LEVEL))

    return (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(vt == config.PM10, bands(config.PM10_LEVELS))
             .when(vt == config.PM25, bands(config.PM25_LEVELS)))
