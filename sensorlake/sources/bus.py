"""Message-bus source (SRC-6 .. SRC-8) and the API response reader (SRC-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake import config, schemas


def read_bus(spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None,
             *, streaming: bool = True,
             max_per_trigger: int | None = config.MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Envelope frame ``(partition int, offset long, value string)``.

    ``fmt="kafka"`` reads a Kafka-protocol bus (connection and security options are passed
    through; ``startingOffsets`` defaults to earliest and ``maxOffsetsPerTrigger`` bounds each
    micro-batch). Any other format is a file double with the same envelope, e.g. ``"json"``
    files holding ``partition, offset, value``; there ``max_per_trigger`` bounds files.
    The Kafka connector is not bundled with plain PySpark and is not exercised here.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        opts = {"startingOffsets": "earliest", **options}
        if streaming and max_per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger))
        raw = reader.format("kafka").options(**opts).load()
        return raw.select(F.col("partition").cast("int"), F.col("offset").cast("long"),
                          F.col("value").cast("string"))
    r = reader.format(fmt).schema(schemas.ENVELOPE).options(**options)
    if streaming and max_per_trigger and "maxFilesPerTrigger" not in options:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    return r.load(path).select("partition", "offset", F.col("value").cast("string"))


def read_api_records(spark: SparkSession, path: str) -> DataFrame:
    """API response files (JSON arrays of nested records) -> records with their place of arrival
    ``api_pos``: time of the file, its path, place in the array.

    A file is one response and is read whole by one task; files are as many tasks as they are. One
    that holds no JSON array (or object, one record) fails the job, rather than losing a response;
    an empty file has no records. ``location`` is read as a map so an absent ``indoor`` key can
    default to "0" while an explicit null stays NULL.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("file"), "value")
    records = F.from_json("value", T.ArrayType(schemas.API_RECORD))
    broken = F.raise_error(F.concat(F.lit("no JSON records in "), F.col("file")))
    whole = files.where(F.col("value").rlike(r"\S")).withColumn("records", records)
    rows = whole.select("time", "file", F.posexplode(
        F.when(F.col("records").isNull(), broken).otherwise(F.col("records")))
        .alias("place", "record"))
    loc = F.col("record.location")
    return rows.select(
        F.struct("time", "file", "place").alias("api_pos"),
        "record.id", "record.timestamp", "record.sensor",
        F.struct(loc["id"].alias("id"), loc["latitude"].alias("latitude"),
                 loc["longitude"].alias("longitude"), loc["country"].alias("country"),
                 F.when(F.map_contains_key(loc, "indoor"), loc["indoor"])
                  .when(loc.isNotNull(), F.lit("0")).alias("indoor")).alias("location"),
        "record.sensordatavalues")
