"""Column-level helpers: every one returns a ``Column`` built from Spark built-ins."""

from sensorlake.functions.columns import (  # noqa: F401
    anomaly_flag,
    event_date,
    is_finite_or_null,
    not_nan_or_null,
    outdoor,
    parse_event_ts,
    pollution_level,
    strip_quotes,
    try_boolean,
    try_double,
)
