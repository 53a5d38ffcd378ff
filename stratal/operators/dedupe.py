"""Deduplication with a deterministic survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_keep(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key combination (null keys compare equal).

    Where ``dropDuplicates(keys)`` keeps an arbitrary row, this keeps the
    smallest row by ``order_by`` then by every remaining column, ascending
    with nulls first, so the survivor is the same on every run and every
    retry. It is a grouped ``min`` over a struct: partial aggregation runs
    map-side, so a key holding a large share of the rows is reduced before
    the shuffle instead of landing in one task.
    """
    keys = list(keys)
    order = list(order_by or [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    payload = order + rest
    if not payload:
        return df.select(*keys).distinct()
    best = F.min(F.struct(*[F.col(c) for c in payload])).alias("__best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col("__best").getField(c).alias(c) for c in payload]).select(*df.columns)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedupe (hash aggregate with map-side combine)."""
    return df.distinct()
