"""Archive CSV landing zone: header-keyed parse, batch or incremental stream (SRC-1 .. SRC-5).

Files of different sensor types share one ``date=YYYY-MM-DD`` directory but carry different
header lines (different order and width). A CSV reader with one schema maps every file by
position and silently misplaces columns, so every data line is matched to *its own* file's header:
the value of column ``c`` is the cell at the position of ``c`` in that file's first line.

Files are read by line in Spark's splits, so a file of any size is shared by many tasks. A split
knows its file and where in it it begins; the first line of the split at place 0 is the header of
the file, and joins the file's lines by path: a row a file on one side, so a file that holds a
third of all lines is split by adaptive execution or, headers being small, not shuffled at all.

``read_archive_by_type`` uses Spark's CSV reader once per header group (file-name glob) instead,
for landing zones whose groups are known, and refuses files with another header.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake import config
from sensorlake.tables import path_exists

HEADER = "_header"
FILE = "_source_file_name"
BLOCK, ROW, TITLE = "_block", "_row", "_title_row"


def archive_text(spark: SparkSession, path: str, glob: str = "*.csv", streaming: bool = False,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the landing files (``value`` and partition columns) with their file and the place
    where their split begins; as a stream, each file is taken once per checkpoint."""
    r = (spark.readStream if streaming else spark.read).format("text")
    r = r.option("lineSep", "\n").option("pathGlobFilter", glob)
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select("*", F.col("_metadata.file_path").alias(FILE),
                               F.col("_metadata.file_block_start").alias(BLOCK))


def in_order(lines: DataFrame) -> DataFrame:
    """Lines without their carriage return, with a number that grows along each split."""
    return lines.withColumns({"value": F.regexp_replace("value", "\r$", ""),
                              ROW: F.monotonically_increasing_id()})


def _split(c: Column, sep: str) -> Column:
    """Cells of one CSV line. A cell may be quoted: it may then hold separators, and quotes that
    are doubled or escaped by a backslash. The separator put in front makes every cell, an empty
    first one too, a match of its own. No step back into a quoted cell could end it elsewhere, so
    its repeats are possessive; a line without quotes is cut at its separators."""
    s = re.escape(sep)
    cell = rf'{s}("(?:[^"\\]++|\\.|"")*+"(?={s}|$)|[^{s}]*)'
    cells = F.regexp_extract_all(F.concat(F.lit(sep), c), F.lit(cell), F.lit(1))
    quoted = F.transform(cells, lambda x: F.when(
        x.rlike('(?s)^".*"$') & (F.length(x) > 1),
        F.replace(F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('\\"'), F.lit('"')),
                  F.lit('""'), F.lit('"'))).otherwise(x))
    plain = ~F.contains(c, F.lit('"')) if len(sep) == 1 else F.lit(False)
    return F.when(plain, F.split(c, s, -1)).otherwise(quoted)


def _names(line: Column, sep: str) -> Column:
    """Column names of a header line, without byte-order mark, quotes and outer blanks."""
    return F.transform(_split(F.regexp_replace(line, "^\ufeff", ""), sep), lambda h: F.trim(h))


def headers(lines: DataFrame, sep: str) -> DataFrame:
    """File, number of its header line and the names in it, from lines ``in_order``. Only lines of
    first splits are looked at; the number is found by a hash aggregate, its text by a join."""
    first = lines.where(F.col(BLOCK) == 0)
    titles = first.groupBy(FILE).agg(F.min(ROW).alias(TITLE))
    at = [F.col(f"t.{FILE}") == F.col(f"l.{FILE}"), F.col(f"t.{TITLE}") == F.col(f"l.{ROW}")]
    return titles.alias("t").join(first.alias("l"), at).select(
        f"t.{FILE}", TITLE, _names(F.col("value"), sep).alias(HEADER))


def header_names(heads: DataFrame) -> list[str]:
    """The distinct names in headers: the schema's width reaches the driver, not the data."""
    names = heads.select(F.explode(HEADER).alias("c")).where(F.length("c") > 0).distinct()
    return sorted(r["c"] for r in names.collect())


def data_lines(lines: DataFrame, heads: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lines that are neither headers nor empty, with the places (``_places``) of ``columns`` in
    their file, which are looked up once per file."""
    places = F.array(*(F.array_position(HEADER, F.lit(c)).cast("int") for c in columns))
    return (lines.join(heads.select(FILE, TITLE, places.alias("_places")), FILE)
            .where((F.col(ROW) != F.col(TITLE)) & (F.length("value") > 0))
            .drop(BLOCK, ROW, TITLE))


def cells_to_columns(data: DataFrame, columns: Sequence[str], sep: str) -> DataFrame:
    """``data_lines`` -> one string column per requested name (NULL if absent or empty), then the
    lines' own further columns."""
    extra = [c for c in data.columns if c not in ("value", "_places")]
    cells = data.select(*extra, "_places", _split(F.col("value"), sep).alias("_cells"))

    def cell(i: int) -> Column:
        place = F.col("_places")[i]
        return F.nullif(F.when(place > 0, F.try_element_at("_cells", place)), F.lit(""))

    return cells.select(*(cell(i).alias(c) for i, c in enumerate(columns)), *extra)


def read_archive(spark: SparkSession, path: str, columns: Sequence[str],
                 sep: str = config.ARCHIVE_SEPARATOR, *, glob: str = "*.csv",
                 source: str = config.ARCHIVE_SOURCE) -> DataFrame:
    """Landing zone -> bronze archive rows (+ ``date`` partition, provenance columns), as a batch;
    ``plans.bronze.load_archive`` is the incremental load."""
    lines = in_order(archive_text(spark, path, glob))
    parsed = cells_to_columns(data_lines(lines, headers(lines, sep), columns), columns, sep)
    return parsed.withColumns({"_source": F.lit(source), "_ingested_at": F.current_timestamp()})


def discover_columns(spark: SparkSession, path: str, sep: str = config.ARCHIVE_SEPARATOR,
                     glob: str = "*.csv", known: Sequence[str] = ()) -> list[str]:
    """Column names found in the header lines of the landing zone, after ``known`` ones."""
    found = header_names(headers(in_order(archive_text(spark, path, glob)), sep))
    return list(known) + [c for c in found if c not in set(known)]


def load_schema_columns(spark: SparkSession, schema_location: str) -> list[str]:
    """The remembered columns: the newest of the appended versions, none before the first."""
    if not path_exists(spark, schema_location):
        return []
    newest = (spark.read.schema("version long, columns string").json(schema_location)
              .orderBy(F.desc("version")).first())
    return json.loads(newest["columns"]) if newest else []


def save_schema_columns(spark: SparkSession, schema_location: str, columns: Sequence[str]) -> None:
    """Append a version; columns are only ever added, so their number orders the versions."""
    (spark.createDataFrame([(len(columns), json.dumps(list(columns)))],
                           "version long, columns string")
          .coalesce(1).write.mode("append").json(schema_location))


def group_header(spark: SparkSession, path: str, glob: str,
                 sep: str = config.ARCHIVE_SEPARATOR) -> list[str]:
    """Header of a file group: the first line of the first file matching ``glob``.

    A file split always starts at a file's first byte, so the first line of the first split is
    a header line. One row reaches the driver.
    """
    first = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", False)
             .text(path).limit(1).collect())
    if not first:
        return []
    return [h.strip() for h in first[0]["value"].rstrip("\r").split(sep)]


def read_archive_by_type(spark: SparkSession, path: str, groups: dict[str, Sequence[str] | None],
                         sep: str = config.ARCHIVE_SEPARATOR, *, streaming: bool = False,
                         max_files_per_trigger: int | None = None,
                         source: str = config.ARCHIVE_SOURCE) -> DataFrame:
    """Spark's CSV reader, one read per header group.

    ``groups`` maps a file-name glob (e.g. ``"*_sds011_*.csv"``) to its header columns, or to
    None to take them from the group's first file. ``enforceSchema=false`` checks every file's
    header against the group's columns, so a file with another header fails the job instead
    of being read by position. The groups are unioned by name (columns a group lacks are NULL).
    """
    out = None
    for glob, cols in groups.items():
        cols = list(cols) if cols else group_header(spark, path, glob, sep)
        if not cols:
            continue
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
        r = (spark.readStream if streaming else spark.read).format("csv").schema(schema)
        r = (r.option("header", True).option("sep", sep).option("enforceSchema", False)
              .option("pathGlobFilter", glob).option("mode", "PERMISSIVE"))
        if streaming and max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.load(path).withColumn("_source_file_name", F.col("_metadata.file_path"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no archive file matches the given groups")
    return out.withColumns({"_source": F.lit(source), "_ingested_at": F.current_timestamp()})
