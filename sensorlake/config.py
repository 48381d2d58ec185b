"""Pipeline parameters.

Everything a job needs is a plain value here; jobs take a ``Settings`` and never read files or
environment variables on their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must keep these exact values for results to agree with
# the pipeline this library reproduces (metric names, sensor types, countries,
# thresholds and flag texts).
# ---------------------------------------------------------------------------
METRICS = ("P1", "P2", "temperature", "humidity", "pressure")
BASE_MEASUREMENT_FIELDS = ("P1", "P2")
PHASE_B_EXTRA_FIELDS = ("temperature", "humidity", "pressure")
LIVE_COMMON_FIELDS = (
    "id", "timestamp", "sensor_id", "sensor_type",
    "location_id", "latitude", "longitude", "country",
)
READING_ID_COLUMNS = (
    "sensor_id", "timestamp", "location_id",
    "latitude", "longitude", "country", "_source", "_ingested_at",
)
ALLOWED_SENSOR_TYPES = ("SDS011", "BME280")
PHASE_B_SENSOR_TYPE = "BME280"
PM10 = "P1"
PM25 = "P2"
PM10_THRESHOLD = 50.0
PM25_THRESHOLD = 25.0
PM10_FLAG = "PM10_EXCEEDS_WHO_DAILY"
PM25_FLAG = "PM2_5_EXCEEDS_WHO_DAILY"
ARCHIVE_SEPARATOR = ";"
DEFAULT_SENSOR_FILTER = "SDS011"
MAX_OFFSETS_PER_TRIGGER = 5000
LIVE_TRIGGER_INTERVAL = "30 seconds"
ARCHIVE_FILE_PATTERN = r"_sensor_(\d+)\.csv"
LISTING_LINK_PATTERN = r'href="([^"]+\.csv)"'
ARCHIVE_SOURCE = "sensor_archive"
REGISTRY_SOURCE_FILE = "api_response"
# ---------------------------------------------------------------------------

# Provenance labels written into `_source` (our own names).
LIVE_SOURCE = "sensor_live"
REGISTRY_SOURCE = "registry_api"

# Pollution levels for the live map (our own bands; the upper edge of each band is inclusive).
PM10_LEVELS = ((20.0, "good"), (50.0, "moderate"), (100.0, "poor"))
PM25_LEVELS = ((10.0, "good"), (25.0, "moderate"), (50.0, "poor"))
WORST_LEVEL = "very_poor"


@dataclass(frozen=True)
class Thresholds:
    pm10: float = PM10_THRESHOLD
    pm25: float = PM25_THRESHOLD


@dataclass(frozen=True)
class Settings:
    metrics: tuple[str, ...] = METRICS
    base_fields: tuple[str, ...] = BASE_MEASUREMENT_FIELDS
    phase_b_fields: tuple[str, ...] = PHASE_B_EXTRA_FIELDS
    allowed_sensor_types: tuple[str, ...] = ALLOWED_SENSOR_TYPES
    sensor_filter: str = DEFAULT_SENSOR_FILTER
    thresholds: Thresholds = field(default_factory=Thresholds)
    archive_separator: str = ARCHIVE_SEPARATOR
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER
    live_trigger_interval: str = LIVE_TRIGGER_INTERVAL
    files_per_day_cap: int | None = None
    drop_infinite: bool = False


def settings_from_mapping(cfg: dict) -> Settings:
    """Settings from a nested configuration mapping (e.g. a parsed YAML file).

    Recognised keys (all optional): ``streaming.sensor_type_filter``,
    ``streaming.max_offsets_per_trigger``, ``streaming.base_measurement_fields``,
    ``streaming.phase_b_extra_fields``, ``streaming.trigger_interval``, ``batch.csv_delimiter``,
    ``batch.file_limit``, ``batch.target_metrics``, ``batch.registry.allowed_sensors``,
    ``gold.pm10_threshold``, ``gold.pm25_threshold``, ``gold.drop_infinite``.
    """
    def get(path: str, default=None):
        node = cfg
        for part in path.split("."):
            if not isinstance(node, dict) or part not in node:
                return default
            node = node[part]
        return node

    d = Settings()
    return Settings(
        metrics=tuple(get("batch.target_metrics", d.metrics)),
        base_fields=tuple(get("streaming.base_measurement_fields", d.base_fields)),
        phase_b_fields=tuple(get("streaming.phase_b_extra_fields", d.phase_b_fields)),
        allowed_sensor_types=tuple(get("batch.registry.allowed_sensors", d.allowed_sensor_types)),
        sensor_filter=get("streaming.sensor_type_filter", d.sensor_filter),
        thresholds=Thresholds(float(get("gold.pm10_threshold", d.thresholds.pm10)),
                              float(get("gold.pm25_threshold", d.thresholds.pm25))),
        archive_separator=get("batch.csv_delimiter", d.archive_separator),
        max_offsets_per_trigger=int(get("streaming.max_offsets_per_trigger",
                                        d.max_offsets_per_trigger)),
        live_trigger_interval=get("streaming.trigger_interval", d.live_trigger_interval),
        files_per_day_cap=get("batch.file_limit", d.files_per_day_cap),
        drop_infinite=bool(get("gold.drop_infinite", d.drop_infinite)),
    )


def load_settings(path: str | None) -> Settings:
    """Settings from a YAML or JSON file (a top-level environment key may be selected with
    ``path#env``); defaults when ``path`` is None."""
    if not path:
        return Settings()
    file, _, env = path.partition("#")
    with open(file, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml  # optional dependency
        cfg = yaml.safe_load(text)
    except ImportError:
        import json
        cfg = json.loads(text)
    return settings_from_mapping(cfg[env] if env else cfg)
