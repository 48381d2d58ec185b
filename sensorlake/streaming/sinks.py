"""Starting append streams into table directories (SNK-1 .. SNK-4, STM-1 .. STM-3, STM-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from sensorlake import tables
from sensorlake.session import with_conf


def start_append(df: DataFrame, path: str, checkpoint: str, *, trigger: str | None = None,
                 available_now: bool = False, name: str | None = None,
                 fmt: str = "parquet", partition_by: list[str] | None = None) -> StreamingQuery:
    """Append a stream to ``path`` with exactly-once progress kept in ``checkpoint``.

    ``available_now=True`` drains what is there and stops (batch-like rerunnable load);
    ``trigger="30 seconds"`` runs micro-batches on a fixed interval. Restarting on the same
    checkpoint with a wider frame is allowed for this stateless append: new files carry the
    new columns and readers merge schemas (``read_table``).
    """
    w = (df.writeStream.format(fmt).outputMode("append")
           .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def run_available_now(df: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Drain-and-stop append; returns the finished query (its progress has the row counts)."""
    q = start_append(df, path, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    return q


def start_upsert(df: DataFrame, path: str, keys: list[str], checkpoint: str, *,
                 trigger: str | None = None, available_now: bool = False,
                 name: str | None = None, state_partitions: int | None = None,
                 by: Column | None = None) -> StreamingQuery:
    """Keep a result table current from an ``update``-mode aggregation stream.

    Each micro-batch carries the new values of the keys it changed; they are upserted into the
    parquet table at ``path`` by ``keys``, which rewrites the partitions they fall into: those of
    ``by``, an expression over key columns such as the day of a window, or else of key buckets.
    Replaying a batch after a failure upserts the same values again, so the table stays exact.
    ``tables.read_upserted`` reads it.

    ``state_partitions`` sizes the aggregation state (one state store per shuffle partition) to
    the state instead of the session-wide shuffle setting. A query copies the session settings
    when it starts and keeps its state partitioning in the checkpoint, so the setting is applied
    only around ``start()``.
    """
    spark = df.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.dropDuplicates(keys).persist()  # read more than once by the upsert
        try:
            tables.upsert_path(spark, batch, path, keys, batch.schema, by)
        finally:
            batch.unpersist()

    w = (df.writeStream.outputMode("update").foreachBatch(write_batch)
           .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    conf = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    with with_conf(spark, conf):
        return w.start()
