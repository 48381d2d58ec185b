"""Archive file selection as a distributed job (PIP-5).

The archive publishes one listing page per day. From each page we take the linked CSV files,
keep the allowed sensor types and the sensors the registry knows, optionally cap the count per
day in listing order, and mark files that already landed with a non-empty size as skipped.
Known sensors and landed files are joined, never collected to the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake import config
from sensorlake.operators.dedup import keep_least


def day_range(start: str | None = None, end: str | None = None) -> tuple[dt.date, dt.date]:
    """Inclusive range of days, both defaulting to yesterday (UTC); an end before the start is
    an error (FLT-8, DT-5)."""
    yesterday = (dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=1)).date()
    s = dt.date.fromisoformat(start) if start else yesterday
    e = dt.date.fromisoformat(end) if end else yesterday
    if e < s:
        raise ValueError("end date cannot be before start date")
    return s, e


def archive_links(listings: DataFrame) -> DataFrame:
    """listing pages (day, pos, html) -> one row per CSV link with its place on the page."""
    return (listings
            .select("day", "pos", F.posexplode(F.regexp_extract_all(
                "html", F.lit(config.LISTING_LINK_PATTERN), 1)).alias("link_idx", "file_name")))


def select_files(listings: DataFrame, registry: DataFrame, landed: DataFrame,
                 start: str | None = None, end: str | None = None,
                 sensor_types: Sequence[str] = config.ALLOWED_SENSOR_TYPES,
                 cap: int | None = None) -> DataFrame:
    """Manifest of archive files to fetch: (day, file_name, sensor_id, dest_path, status).

    * ``listings``: (day date, pos bigint, html string), ``pos`` = order of the page fragment.
    * ``registry``: any frame with ``sensor_id``; ``landed``: (day, file_name, length).
    * ``cap``: at most this many files per day, in listing order, before landed files are
      skipped (the cap counts skipped files too).
    * An empty registry is an error, raised before any selection (Q30).

    A file listed more than once on a day appears once, at its first position.
    """
    s, e = day_range(start, end)
    if cap is not None and cap < 1:
        raise ValueError("cap must be positive")
    in_range = listings.where(F.col("day").between(F.lit(s), F.lit(e)))
    type_hit = None
    for t in sensor_types:
        hit = F.lower("file_name").contains(f"_{t.lower()}_")
        type_hit = hit if type_hit is None else (type_hit | hit)
    links = (archive_links(in_range)
             .where(type_hit)
             .withColumn("sensor_id", F.regexp_extract("file_name", config.ARCHIVE_FILE_PATTERN, 1))
             .where(F.col("sensor_id") != ""))
    known = registry.select("sensor_id").where(F.col("sensor_id").isNotNull())
    if known.isEmpty():  # reads at most one row
        raise ValueError("the device registry holds no sensor; build it before selecting files")
    links = links.join(known, "sensor_id", "left_semi")
    files = keep_least(links.select("day", "file_name", "pos", "link_idx", "sensor_id"),
                       ["day", "file_name"], ["pos", "link_idx"])
    if cap is not None:
        w = Window.partitionBy("day").orderBy("pos", "link_idx", "file_name")
        files = files.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= cap).drop("_n")
    landed_ok = (landed.where(F.col("length") > 0)
                       .select("day", "file_name").distinct()
                       .withColumn("_landed", F.lit(True)))
    return (files.join(landed_ok, ["day", "file_name"], "left")
                 .select("day", "file_name", "sensor_id",
                         F.concat(F.lit("archive/date="), F.col("day").cast("string"), F.lit("/"),
                                  F.col("file_name")).alias("dest_path"),
                         F.when(F.col("_landed"), "skip").otherwise("download").alias("status")))


def manifest_counts(manifest: DataFrame) -> DataFrame:
    """Per day and status: how many files (AGG-6)."""
    return manifest.groupBy("day", "status").agg(F.count(F.lit(1)).alias("n_files"))
