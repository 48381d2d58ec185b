"""Bronze loads: archive files (PIP-1) and the live message stream (PIP-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlake import config, schemas
from sensorlake.functions import event_date
from sensorlake.operators.messages import parse_events
from sensorlake.plans import ops
from sensorlake.session import with_conf
from sensorlake.sources.archive import (
    archive_text,
    cells_to_columns,
    data_lines,
    header_names,
    headers,
    in_order,
    load_schema_columns,
    save_schema_columns,
)
from sensorlake.sources.bus import read_bus
from sensorlake.streaming.sinks import run_available_now, start_append


# Bronze partition column: the event date parsed from the raw timestamp text (NULL when it
# does not parse), so that rebuilding some event dates prunes bronze to their partitions.
EVENT_DATE = "_event_date"
# Names of the loads in the run log.
LIVE, ARCHIVE = "sensor_live_raw", "sensor_archive_raw"


def live_stream(spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None,
                settings: config.Settings | None = None) -> DataFrame:
    """Bus envelope -> parsed live bronze rows for the configured sensor filter's phase."""
    s = settings or config.Settings()
    env = read_bus(spark, fmt, options, path, streaming=True,
                   max_per_trigger=s.max_offsets_per_trigger)
    return parse_events(env, schemas.active_schema(s.sensor_filter, s))


def load_live(spark: SparkSession, fmt: str, options: dict[str, str], target: str,
              checkpoint: str, path: str | None = None, settings: config.Settings | None = None,
              available_now: bool = False) -> StreamingQuery:
    """Continuous (every ``live_trigger_interval``) or drain-and-stop append of live bronze. An
    ``ops.StreamLog`` on the session logs its run."""
    s = settings or config.Settings()
    df = live_stream(spark, fmt, options, path, s).withColumn(EVENT_DATE, event_date("timestamp"))
    df = ops.count_written(df)
    if available_now:
        return run_available_now(df, target, checkpoint, name=LIVE, partition_by=[EVENT_DATE])
    return start_append(df, target, checkpoint, trigger=s.live_trigger_interval,
                        name=LIVE, partition_by=[EVENT_DATE])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a bronze/silver directory, merging the schemas of files written over time."""
    return spark.read.option("mergeSchema", True).parquet(path)


def add_provenance(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"_source": F.lit(source), "_ingested_at": F.current_timestamp()})


def _load_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's own id, which its checkpoint keeps over restarts."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def load_archive(spark: SparkSession, landing: str, target: str, checkpoint: str,
                 schema_location: str, settings: config.Settings | None = None,
                 max_files_per_trigger: int | None = 1000,
                 split_bytes: int | None = None,
                 counts: dict[str, int] | None = None) -> StreamingQuery:
    """Take every new archive file once into the bronze directory and stop; a rerun without new
    files appends nothing.

    Files are read by line in splits (of ``split_bytes``, else the session's setting), so the size of
    a file does not matter. Each micro-batch of lines is cached; its headers, a row a file, extend
    the remembered column list by their distinct names (bounded by the schema width), join the
    lines by path, and the batch is written with every remembered column to
    ``target/load_batch=<stream id>-<batch id>``. Rewriting that folder on a retried batch keeps
    the load idempotent, the checkpoint keeps every file taken exactly once, and a load with
    another checkpoint has folders of its own. Headers come from the very files of the batch, so
    no column of a file can be missed; readers merge schemas. ``counts`` gets the lines read (without
    headers and empty ones) and the rows written, as the writing jobs count them.
    """
    s = settings or config.Settings()
    sep = s.archive_separator
    text = archive_text(spark, landing, streaming=True, max_files_per_trigger=max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        lines = in_order(batch).persist()
        try:
            heads = headers(lines, sep)
            known = load_schema_columns(spark, schema_location)
            cols = known + [c for c in header_names(heads) if c not in set(known)]
            if cols != known:
                save_schema_columns(spark, schema_location, cols)
            data, read = ops.with_counters(data_lines(lines, heads, cols), "read")
            out = add_provenance(cells_to_columns(data, cols, sep), config.ARCHIVE_SOURCE)
            out = out.withColumn(EVENT_DATE, event_date("timestamp") if "timestamp" in cols
                                 else F.lit(None).cast("date"))
            load = f"{_load_id(spark, checkpoint)}-{batch_id}"
            out, written = ops.with_counters(out, "written")
            out.write.mode("overwrite").partitionBy(EVENT_DATE).parquet(
                f"{target.rstrip('/')}/load_batch={load}")
            if counts is not None:
                for name, seen in (("in", read), ("out", written)):
                    counts[name] = counts.get(name, 0) + seen.get["rows"]
        finally:
            lines.unpersist()

    conf = {"spark.sql.files.maxPartitionBytes": str(split_bytes)} if split_bytes else {}
    with with_conf(spark, conf):  # a stream keeps the settings that it starts with
        q = (text.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
