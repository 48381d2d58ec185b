"""Table writes on plain parquet directories (SNK-5 .. SNK-9).

No table format is assumed. Products that are replaced whole are published: versions in folders of
their own, and a pointer created last, so readers see one version or the next. Other tables are
staged next to the target and swapped in by directory renames, so a job can replace a table it reads
from (a direct overwrite of a path being read fails). Replacing days and upserting touch only
the partitions concerned: their new rows are written once, next to the table, and each staged
folder takes the place of the old one by the same checked swap; all other files stay as they are.

Upserted tables are partitioned by ``PART``, a function of the key: a bucket of the key's hash, or
what the caller names (the day of a window). A key never changes its partition, so an upsert reads and
rewrites the partitions that its updates fall into and nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.operators.joins import upsert

#: Partition column of upserted tables, and the number of key buckets where the caller names none.
PART, BUCKETS = "_part", 16
#: Folder of a published table that holds a file per version.
POINTERS = "_current"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def replace_path(spark: SparkSession, df: DataFrame, path: str,
                 partition_by: Sequence[str] | None = None) -> None:
    """Write ``df`` to a staging directory, then swap it in for ``path``."""
    token = uuid.uuid4().hex[:12]
    staging = f"{path.rstrip('/')}.staging-{token}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(staging)
    swap_in(spark, staging, path, token)


def swap_in(spark: SparkSession, staging: str, path: str, token: str,
            aside: str | None = None) -> None:
    """Put ``staging`` in the place of ``path``. The old table is set ``aside`` first and deleted
    only once the new one is in place; a rename that fails puts it back and raises."""
    fs, target, jvm = _fs(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(staging)
    old = jvm.org.apache.hadoop.fs.Path(aside or f"{path.rstrip('/')}.old-{token}")
    had = fs.exists(target)
    if had and not _renamed(fs, target, old):
        raise OSError(f"cannot set {path} aside; it is unchanged, the new table is in {staging}")
    if not _renamed(fs, new, target):
        if had and not _renamed(fs, old, target):
            raise OSError(f"cannot move {staging} to {path}; the old table is in {old}")
        raise OSError(f"cannot move {staging} to {path}; the old table is back in place")
    if had:
        fs.delete(old, True)


def _renamed(fs, source, target) -> bool:
    """File systems tell of a failed rename by False or by an error."""
    try:
        return bool(fs.rename(source, target))
    except Py4JJavaError:
        return False


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions of a published table that its pointer files name."""
    fs, _, jvm = _fs(spark, path)
    pointers = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{POINTERS}")
    if not fs.exists(pointers):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(pointers)
                  if f.getPath().getName().isdigit())


def _version(path: str, number: int) -> str:
    return f"{path.rstrip('/')}.v{number:06d}"


def published_at(spark: SparkSession, path: str) -> str:
    """The folder that holds the table ``path`` now: its newest version, or ``path`` itself where
    it was never published."""
    numbers = _numbers(spark, path)
    return _version(path, numbers[-1]) if numbers else path


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(published_at(spark, path))


def publish(spark: SparkSession, df: DataFrame, path: str,
            partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table ``path`` with no moment without one. ``df`` is written to a folder of
    its own next to ``path``; the table becomes that version when its pointer, an empty file
    ``path/_current/<number>``, is created, which happens once or not at all. Readers take the
    greatest number (``read_published``). The version before stays for those who read it; older
    ones, and the files of a table that was not published so far, are deleted. Of two jobs that
    publish at once the later one fails."""
    fs, root, jvm = _fs(spark, path.rstrip("/"))
    numbers = _numbers(spark, path)
    number = numbers[-1] + 1 if numbers else 1
    w = df.write.mode("overwrite")  # what a failed job left there has no pointer
    (w.partitionBy(*partition_by) if partition_by else w).parquet(_version(path, number))
    here = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(here(f"{root}/{POINTERS}"))
    if not fs.createNewFile(here(f"{root}/{POINTERS}/{number:06d}")):
        raise OSError(f"another job has published version {number} of {path}")
    for old in numbers[:-1]:
        fs.delete(here(f"{root}/{POINTERS}/{old:06d}"), False)
        fs.delete(here(_version(path, old)), True)
    for left in fs.listStatus(root):
        if left.getPath().getName() != POINTERS:
            fs.delete(left.getPath(), True)


def replace_parts(spark: SparkSession, df: DataFrame, path: str, column: str,
                  touched: Iterable[str]) -> None:
    """Replace the partitions ``touched`` (values of ``column`` as folders name them) by the rows
    of ``df``; one without rows there is removed. ``df`` is computed once, into a staging folder
    next to the table; then its folders are swapped in one by one."""
    token, root = uuid.uuid4().hex[:12], path.rstrip("/")
    staging = f"{root}.staging-{token}"
    df.hint("rebalance", column).write.partitionBy(column).parquet(staging)
    fs, _, jvm = _fs(spark, root)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(root))
    for value in touched:
        name = f"{column}={value}"
        if path_exists(spark, f"{staging}/{name}"):
            # Readers skip names that begin with a dot.
            swap_in(spark, f"{staging}/{name}", f"{root}/{name}", token,
                    f"{root}/.old-{token}-{name}")
        else:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"), True)
    fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       rebalance: bool = True) -> None:
    """Overwrite only the partitions present in ``df`` (others stay untouched).

    ``rebalance`` groups rows of a partition value into few, advisory-sized files (AQE splits a
    hot value over several tasks) instead of one small file per upstream task and value.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def replace_days(spark: SparkSession, df: DataFrame, path: str, column: str,
                 days: DataFrame) -> None:
    """Overwrite the partitions of ``days`` (one column of dates, NULL is one); a day without rows
    in ``df`` is left empty. Only folders of those days are touched."""
    names = (NULL_FOLDER if r[0] is None else str(r[0]) for r in days.toLocalIterator())
    replace_parts(spark, df, path, column, names)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty frame of ``schema`` when it does not exist yet."""
    if path_exists(spark, path):
        return spark.read.option("mergeSchema", True).parquet(path)
    return spark.createDataFrame([], schema)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The upserted table at ``path`` without its partition column."""
    return spark.read.option("mergeSchema", True).parquet(path).drop(PART)


def key_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    """The bucket of a key, named with the number of buckets: a table keeps to one number."""
    return F.format_string(f"%d-of-{buckets}", F.pmod(F.xxhash64(*keys), F.lit(buckets)))


def upsert_path(spark: SparkSession, updates: DataFrame, path: str, keys: Sequence[str],
                schema: T.StructType, by: Column | None = None, buckets: int = BUCKETS) -> None:
    """MERGE-like upsert into the parquet table at ``path`` (created when absent), which keeps its
    schema. Only the partitions that hold a key of ``updates`` are read and written.

    ``by`` (an expression over key columns) names the partition of a key, in place of a hash
    bucket. A table of another layout, or of another number of buckets, is rewritten once.
    ``updates`` is read twice, for the partitions it touches and for its rows.
    """
    part = (key_bucket(keys, buckets) if by is None else by.cast("string"))
    found = path_exists(spark, path)
    current = spark.read.option("mergeSchema", True).parquet(path) if found \
        else spark.createDataFrame([], schema).withColumn(PART, F.lit(""))
    columns = [c for c in current.columns if c != PART]
    parted = updates.select(*columns, part.alias(PART))
    # As many names as updates have buckets, or days.
    touched = [r[0] for r in parted.select(PART).distinct().collect()]
    if not touched:
        if not found:
            replace_path(spark, current.select(*columns), path)  # empty, with its schema
        return
    if found and (PART not in current.columns or (by is None and not current.where(
            ~F.col(PART).endswith(f"-of-{buckets}")).isEmpty())):
        merged = upsert(current.select(*columns), updates.select(*columns), keys)
        replace_path(spark, merged.withColumn(PART, part), path, [PART])
        return
    null = F.col(PART).isNull() if None in touched else F.lit(False)
    held = current.where(F.col(PART).isin([t for t in touched if t is not None]) | null)
    merged = upsert(held.select(*columns, F.col(PART).cast("string").alias(PART)), parted, keys)
    replace_parts(spark, merged, path, PART,
                  [NULL_FOLDER if t is None else t for t in touched])


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database unless it exists (SNK-8), at ``location`` or in the warehouse."""
    at = "" if location is None else " LOCATION '{}'".format(location.replace("'", "\\'"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{at}")


def sql_over(spark: SparkSession, statement: str, **views: DataFrame) -> DataFrame:
    """The result of ``statement`` over frames as temporary views (SRC-11). The views last until the
    statement is resolved; a view of the session that has one of the names is refused."""
    for name in views:
        if spark.catalog.tableExists(name):
            raise ValueError(f"there is a table or view {name} already")
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return spark.sql(statement)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder (reliable checkpoint): later stages
    re-read it instead of recomputing the whole lineage after an executor loss."""
    return df.checkpoint(eager=True)


def compact(spark: SparkSession, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite a partitioned table into files of about the advisory partition size (many small
    landed CSVs otherwise become many small bronze files).

    The REBALANCE hint lets AQE split an oversized partition value (a hot day) into several
    files written by several tasks and merge small ones; the rewrite goes through the staged
    swap. Only for batch-written tables: a streaming sink directory is refused.
    """
    if path_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        # A streaming file sink lists its files in this log; a rewrite would orphan it and the
        # next micro-batch would start a new log that hides the rewritten files from readers.
        raise ValueError("refusing to compact a streaming sink directory; compact a copy")
    df = spark.read.option("mergeSchema", True).parquet(path)
    replace_path(spark, df.hint("rebalance", *partition_by), path, partition_by)
