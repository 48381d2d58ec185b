"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings every job of the library assumes. AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splitting covers hot sensors when a dimension is too large
# to broadcast. UTC makes `event_ts_utc` mean what its name says.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "sensorlake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def with_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block; what was set before is set again after it."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SCRATCH_KEY = "spark.sensorlake.scratchDir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the one the cluster names in
    ``spark.checkpoint.dir``, else the context's checkpoint folder. Only a local master, whose
    executors are this very machine, gets a fresh folder of its own when neither is set
    (remembered under ``spark.sensorlake.scratchDir``); a cluster without one is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_KEY, None)
    if not path:
        path = sc.getCheckpointDir()  # a folder of the context below the one that was set
        if path is None:
            if sc.master.split("[")[0] != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            path = tempfile.mkdtemp(prefix="sensorlake-ckpt-")
        spark.conf.set(SCRATCH_KEY, path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
