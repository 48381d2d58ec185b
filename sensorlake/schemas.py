"""Declared schemas of the bronze/silver/gold tables and of the live message body (SCH-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from sensorlake import config

S, D, B, TS = T.StringType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _strings(names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(n, S) for n in names]


def live_body_schema(fields: Sequence[str]) -> T.StructType:
    return T.StructType(_strings(config.LIVE_COMMON_FIELDS) + _strings(fields))


PHASE_A = live_body_schema(config.BASE_MEASUREMENT_FIELDS)
PHASE_B = live_body_schema(config.BASE_MEASUREMENT_FIELDS + config.PHASE_B_EXTRA_FIELDS)


def active_schema(sensor_filter: str, settings: config.Settings | None = None) -> T.StructType:
    """Phase B (climate fields added) as soon as the sensor filter names the climate sensor."""
    s = settings or config.Settings()
    fields = tuple(s.base_fields)
    if config.PHASE_B_SENSOR_TYPE in (sensor_filter or "").upper():
        fields += tuple(s.phase_b_fields)
    return live_body_schema(fields)


ENVELOPE = T.StructType([T.StructField("partition", T.IntegerType()),
                         T.StructField("offset", T.LongType()),
                         T.StructField("value", S)])

API_RECORD = T.StructType([
    T.StructField("id", S),
    T.StructField("timestamp", S),
    T.StructField("sensor", T.StructType([
        T.StructField("id", S),
        T.StructField("sensor_type", T.StructType([T.StructField("name", S)])),
    ])),
    # Read as a map so that an absent `indoor` key can be told apart from an explicit null.
    T.StructField("location", T.MapType(S, S)),
    T.StructField("sensordatavalues", T.ArrayType(T.StructType([
        T.StructField("value_type", S), T.StructField("value", S)]))),
])

REGISTRY_RAW = T.StructType(_strings(("sensor_id", "sensor_type", "location_id", "lat", "lon",
                                      "country", "indoor", "_source", "_source_file_name"))
                            + [T.StructField("_ingested_at", TS)])

DEVICES = T.StructType(_strings(("sensor_id", "sensor_type", "location_id", "country"))
                       + [T.StructField("lat", D), T.StructField("lon", D),
                          T.StructField("indoor", B), T.StructField("_source", S),
                          T.StructField("_ingested_at", TS)])

READINGS = T.StructType([
    T.StructField("sensor_id", S), T.StructField("event_ts_utc", TS),
    T.StructField("value_type", S), T.StructField("value", D),
    T.StructField("location_id", S), T.StructField("latitude", D),
    T.StructField("longitude", D), T.StructField("country", S),
    T.StructField("_source", S), T.StructField("_ingested_at", TS),
])

RUN_LOG = T.StructType([
    T.StructField("job", S), T.StructField("run_id", S),
    T.StructField("started_at", TS), T.StructField("ended_at", TS),
    T.StructField("status", S), T.StructField("rows_in", T.LongType()),
    T.StructField("rows_out", T.LongType()), T.StructField("message", S),
])
