"""Deterministic one-row-per-key selection, built on aggregation rather than windows.

A window with ``row_number`` sorts every row of a key inside one task, so a hot key (one sensor,
or one group of copies holding a third of the data) lands in a single task. ``max(struct(...))``
is an ordinary aggregate: each map task keeps one candidate per key before the shuffle (partial
aggregation), so a hot key costs one row per map task, never the whole group in one place.

Struct ordering compares fields left to right and treats NULL as the smallest value, so the
maximum prefers non-NULL values and the minimum prefers NULL ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_W = "_winner"


def _payload(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> list[Column]:
    """Order fields first, then every other non-key column once.

    A plain column name in ``order`` is carried under its own name; an expression gets an
    ``_oN`` field. So the struct holds each column once and the buffers stay as narrow as the
    row itself.
    """
    named = [o for o in order if isinstance(o, str)]
    order_cols = [F.col(o) if isinstance(o, str) else o.alias(f"_o{i}")
                  for i, o in enumerate(order)]
    rest = [F.col(c) for c in df.columns if c not in keys and c not in named]
    return order_cols + rest


def keep_greatest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep, per key, the row that is greatest by ``order`` then by all remaining columns.

    NULL keys are equal to each other, as in ``dropDuplicates``. The tie-break over every other
    column makes the survivor independent of input order; rows that tie on everything are
    identical, so which one is kept does not matter.
    """
    keys = list(keys)
    payload = _payload(df, keys, order)
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
              .agg(F.max(F.struct(*payload)).alias(_W))
              .select(*keys, *[F.col(f"{_W}.{c}").alias(c) for c in rest])
              .select(*df.columns))


def keep_least(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Like :func:`keep_greatest` but keeps the least row (e.g. first in arrival order)."""
    keys = list(keys)
    payload = _payload(df, keys, order)
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
              .agg(F.min(F.struct(*payload)).alias(_W))
              .select(*keys, *[F.col(f"{_W}.{c}").alias(c) for c in rest])
              .select(*df.columns))


def first_wins(df: DataFrame, key: str | Sequence[str], position: str,
               keep_position: bool = False) -> DataFrame:
    """First row per key in ``position`` order (DED-2), e.g. API order of records."""
    keys = [key] if isinstance(key, str) else list(key)
    out = keep_least(df, keys, [position])
    return out if keep_position else out.drop(position)
