"""Keyed upsert (JN-6, SNK-9). Dimension joins carry no hints: the planner and adaptive execution
choose between broadcast and a skew-splitting shuffle join from measured bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unique_by(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``updates``, failing the job if a key occurs twice, as a MERGE does."""
    n, cols = "_rows_of_key", updates.columns
    counted = updates.withColumn(n, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    twice = F.raise_error(F.concat(F.lit("duplicate key among the updates: "),
                                   F.to_json(F.struct(*keys))))
    return counted.where(F.when(F.col(n) > 1, twice.cast("boolean")).otherwise(True)).select(*cols)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE semantics without a table format: matched keys take every column of the update,
    unmatched updates are inserted, target rows without an update are kept, nothing is deleted.
    Two updates of one key fail the job. Columns are aligned by name.
    """
    keys = list(keys)
    kept = target.join(updates.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(unique_by(updates.select(*target.columns), keys))
