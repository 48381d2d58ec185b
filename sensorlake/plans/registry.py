"""Device registry from nested API records (PIP-3) and the live-event normalizer (PIP-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import config
from sensorlake.operators.dedup import first_wins
from sensorlake.operators.reshape import normalize_records

REGISTRY_COLUMNS = ("sensor_id", "sensor_type", "location_id", "lat", "lon", "country", "indoor",
                    "_source", "_source_file_name", "_ingested_at")


def build_registry(records: DataFrame, allowed_types: Sequence[str] = config.ALLOWED_SENSOR_TYPES,
                   position: str = "api_pos", ingested_at: Column | None = None,
                   source: str = config.REGISTRY_SOURCE,
                   source_file: str = config.REGISTRY_SOURCE_FILE) -> DataFrame:
    """First record *of an allowed type* per sensor id, in API order (DED-2, FLT-5).

    Records without a sensor id are dropped; absent values stay NULL (never the text "None").
    An ``indoor`` of NULL stays NULL (unknown); the reader maps an absent key to "0".
    """
    flat = records.select(
        F.col(position).alias("_pos"),
        F.col("sensor.id").cast("string").alias("sensor_id"),
        F.col("sensor.sensor_type.name").cast("string").alias("sensor_type"),
        F.col("location.id").cast("string").alias("location_id"),
        F.col("location.latitude").cast("string").alias("lat"),
        F.col("location.longitude").cast("string").alias("lon"),
        F.col("location.country").cast("string").alias("country"),
        F.col("location.indoor").cast("string").alias("indoor"),
    )
    allowed = flat.where(F.col("sensor_id").isNotNull()
                         & F.col("sensor_type").isin(*allowed_types))
    first = first_wins(allowed, "sensor_id", "_pos")
    return first.select(
        "sensor_id", "sensor_type", "location_id", "lat", "lon", "country", "indoor",
        F.lit(source).alias("_source"),
        F.lit(source_file).alias("_source_file_name"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("_ingested_at"),
    )


def live_events(records: DataFrame, metrics: Sequence[str] = config.METRICS) -> DataFrame:
    """API records -> flat live events, one text column per configured metric (PIP-4)."""
    return normalize_records(records, metrics)

