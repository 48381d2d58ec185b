"""Run counters and the append-only run log of jobs, loads and streams (AGG-6, OPS-1)."""

from __future__ import annotations

import datetime as dt
import threading
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sensorlake import schemas


def with_counters(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled as a side effect of the next action on ``df``.

    Observed metrics ride along with the job that writes the data, so counting costs no extra
    pass over it.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


class Counters:
    """Row counts of several stages of the jobs that compute them anyway: ``at`` marks a frame, and
    once every frame that rests on it has been written, ``table`` has its count. A frame that two
    jobs read is marked for the one whose reading counts."""

    def __init__(self) -> None:
        self._points: dict[str, Observation] = {}

    def at(self, name: str, df: DataFrame) -> DataFrame:
        counted, self._points[name] = with_counters(df, name)
        return counted

    def table(self, spark: SparkSession) -> DataFrame:
        """``stage, n_rows``; waits for jobs that have not ended."""
        return spark.createDataFrame([(k, v.get["rows"]) for k, v in self._points.items()],
                                     "stage string, n_rows long")


def run_log_row(spark: SparkSession, job: str, started_at: dt.datetime, status: str,
                rows_in: int | None, rows_out: int | None, message: str | None = None,
                run_id: str | None = None) -> DataFrame:
    """One run-log row; the values are a handful of scalars known to the driver."""
    row = (job, run_id or uuid.uuid4().hex, started_at, dt.datetime.now(dt.timezone.utc),
           status, rows_in, rows_out, message)
    return spark.createDataFrame([row], schemas.RUN_LOG)


def append_run_log(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


#: Observed metric of streams that a StreamLog watches.
WRITTEN = "rows_written"


def count_written(df: DataFrame) -> DataFrame:
    """A stream whose progress tells the rows that each micro-batch hands to the sink."""
    return df.observe(WRITTEN, F.count(F.lit(1)).alias("rows"))


class StreamLog(StreamingQueryListener):
    """Appends a row to the run log whenever a stream of the session ends, with the rows that it
    read and wrote (``count_written``) over all its micro-batches. Unlike a query's recent progress,
    which Spark keeps for its last hundred batches, sums are kept as batches end.

    ``names`` restricts it to streams of those names. Add it once per session with
    ``spark.streams.addListener``; ``wait`` returns when the row of a query is written.
    """

    def __init__(self, spark: SparkSession, run_log: str, names: set[str] | None = None) -> None:
        self._spark, self._path, self._names = spark, run_log, names
        self._runs: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        if self._names is None or event.name in self._names:
            self._runs[str(event.runId)] = {"job": event.name or str(event.id), "in": 0, "out": 0,
                                            "began": dt.datetime.now(dt.timezone.utc),
                                            "done": threading.Event()}

    def onQueryProgress(self, event) -> None:
        run = self._runs.get(str(event.progress.runId))
        if run:
            run["in"] += event.progress.numInputRows
            seen = event.progress.observedMetrics.get(WRITTEN)
            run["out"] += seen["rows"] if seen else 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = self._runs.get(str(event.runId))
        if not run:
            return
        try:
            failed = event.exception
            append_run_log(run_log_row(
                self._spark, run["job"], run["began"], "failed" if failed else "succeeded",
                run["in"], run["out"], failed, str(event.runId)), self._path)
        finally:
            run["done"].set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the row of ``query``, which has ended, is written."""
        run = self._runs.get(str(query.runId))
        if run and not run["done"].wait(seconds):
            raise TimeoutError(f"no end of stream {run['job']} after {seconds} s")
