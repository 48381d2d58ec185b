"""Shared folder, tables and Arrow helpers of the text operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared checkpoint folder and read it back: it is computed
    once, and losing executors later loses nothing."""
    return stored_at(df, scratch_path(df.sparkSession, name))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """As ``stored``, in a folder that the caller deletes when nothing reads it any more."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bitmap(rows: DataFrame, column: str, bits: int) -> bytes:
    """Bitmap of a long column's values modulo ``bits``, merged by Spark into at most bits / 64
    words: its size does not depend on the input. For skipping rows that cannot matter; a false
    hit must do no harm."""
    slot = f"pmod(`{column}`, {bits}L)"
    words = (rows.select(F.expr(f"int({slot} div 64)").alias("w"),
                         F.expr(f"shiftleft(1L, int({slot} % 64))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(bits // 64, np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column("w").to_numpy()] = batch.column("b").to_numpy()
    return out.tobytes()


#: Rows of an Arrow batch, in place of Spark's default of 10,000: whole texts are wide rows.
BATCH_ROWS = "2000"


def ship_code(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session (once), so that they find it
    whatever their own path is, and keep their batches small unless the session says otherwise."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)
    sc = spark.sparkContext
    if getattr(sc, "_sensorlake_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="sensorlake-code-")) / "sensorlake_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted((root / "sensorlake").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(str(archive))
    sc._sensorlake_shipped = True
