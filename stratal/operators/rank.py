"""Exact global dense rank, rank and row number, computed in parallel.

``dense_rank() OVER (ORDER BY a, b)`` with no partition clause moves every
row into a single task. Here the distinct keys are range-partitioned on the
sort order (the range boundaries split even a value of ``a`` that holds a
large share of the keys across several tasks), sorted inside each partition
and numbered there; each partition's offset is the number of keys in the
partitions before it. The offsets table has one row per partition, so its
size is bounded by the partition count, not by the data, and it is
broadcast.

Partition ids and in-partition positions come from a range shuffle whose
boundaries are sampled. They are materialised once as a table in the
session's shared checkpoint folder, so that the per-partition counts and
the numbered rows are read from the same copy, also when executors are lost
and tasks are retried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratal.session import materialize

_PID = "__rank_pid"
_POS = "__rank_pos"
_OFF = "__rank_off"
_TIE = "__rank_tie"
_AT = "__rank_at"
BLOCK = 1 << 20  # keys whose counts one task sums up
_ROW_BITS = 33  # monotonically_increasing_id: partition id above bit 33


def _numbered(rows: DataFrame, order: list[Column], number_col: str, num_partitions: int | None) -> DataFrame:
    """``rows`` with their positions 1..n in ``order``; no two rows may be
    equal in it (equal ones would share a range)."""
    # Without an explicit count, adaptive execution sizes the range shuffle
    # (it only merges neighbouring ranges, so partition order is kept).
    ranged = rows.repartitionByRange(num_partitions, *order) if num_partitions else rows.repartitionByRange(*order)
    numbered = materialize(
        ranged
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias(_PID),
                F.monotonically_increasing_id().alias(_POS)),
        "ranked-keys")
    within = F.col(_POS) - F.shiftleft(F.col(_PID).cast("long"), _ROW_BITS)
    counts = numbered.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_OFF))
    return (
        numbered.join(F.broadcast(offsets), _PID)
        .withColumn(number_col, (F.col(_OFF) + within + 1).cast("long"))
        .drop(_PID, _POS, _OFF)
    )


def rank_distinct(keys: DataFrame, order_cols: Sequence[str], rank_col: str = "rank",
                  num_partitions: int | None = None) -> DataFrame:
    """Number distinct key rows 1..n in ascending order, nulls first.

    ``keys`` must hold each key combination once (dense rank = row number
    then). Nulls take part in the order and receive numbers like any value.
    ``num_partitions`` fixes the number of ranges; by default adaptive
    execution chooses it from the data size.
    """
    return _numbered(keys, [F.col(c).asc_nulls_first() for c in order_cols], rank_col, num_partitions)


def number_rows(df: DataFrame, order_cols: Sequence[str], number_col: str = "row_number",
                num_partitions: int | None = None) -> DataFrame:
    """Every row of ``df`` with its position 1..n in ascending order, nulls
    first, as ``row_number()`` over an unpartitioned window would give.

    Rows may repeat keys: ties follow a hash of all columns, so the numbers
    are the same on every run (equal rows are interchangeable). The rows are
    stored once, which fixes their places; the place is the last sort column, so
    a key, or one row repeated, that holds a large share of the table is
    cut over several ranges like any other stretch of it.
    """
    cols = df.columns
    hashed = [c for c, kind in df.dtypes if "map<" not in kind]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in hashed]) if hashed else F.lit(0)
    stored = materialize(df.withColumn(_TIE, tie), "rows-to-number")
    placed = stored.withColumn(_AT, F.monotonically_increasing_id())
    order = [F.col(f"`{c}`").asc_nulls_first() for c in order_cols] + [F.col(_TIE).asc(), F.col(_AT).asc()]
    return _numbered(placed, order, number_col, num_partitions).select(*[F.col(f"`{c}`") for c in cols], number_col)


def rank_global(df: DataFrame, order_cols: Sequence[str], rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Every row of ``df`` with the position of the first row of its key, as
    ``rank()`` over an unpartitioned window would give (ascending, nulls
    first): 1 + the number of rows with smaller keys.

    Keys are counted with a map-side combine; the distinct keys are range-partitioned
    and their counts summed up inside each range, the sums of the ranges
    before are added, and the ranks are joined back. One row per key moves, and no
    task sees more than one range of keys.
    """
    cols = list(order_cols)
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    numbered = _numbered(counted, [F.col(c).asc_nulls_first() for c in cols], _AT, num_partitions)
    # keys in blocks of consecutive numbers: sums inside a block, offsets of whole blocks
    block = F.floor((F.col(_AT) - 1) / BLOCK)
    stored = materialize(numbered.withColumn(_PID, block), "key-counts")
    inside = Window.partitionBy(_PID).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    totals = stored.groupBy(_PID).agg(F.sum("__n").alias("__n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_PID, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_OFF))
    ranked = (stored.withColumn("__in", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(offsets, _PID)
              .select(*cols, (F.col(_OFF) + F.col("__in") + 1).cast("long").alias(rank_col)))
    return _join_back(df, ranked, cols, rank_col)


def _join_back(df: DataFrame, ranked: DataFrame, cols: list[str], rank_col: str) -> DataFrame:
    """``df`` with the rank of its key, matched null-safely."""
    r = ranked.select(*[F.col(c).alias(f"__r_{c}") for c in cols], rank_col)
    cond = None
    for c in cols:
        term = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        cond = term if cond is None else cond & term
    return df.join(r, cond, "left").drop(*[f"__r_{c}" for c in cols])


def dense_rank_global(df: DataFrame, order_cols: Sequence[str], rank_col: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    """Every row of ``df`` with the dense rank of its key, as an unpartitioned
    window would give (ascending, nulls first). Keys are deduplicated with a
    map-side combine, ranked in parallel and joined back null-safely."""
    cols = list(order_cols)
    ranked = rank_distinct(df.select(*cols).distinct(), cols, rank_col, num_partitions)
    return _join_back(df, ranked, cols, rank_col)
