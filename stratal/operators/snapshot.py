"""Latest-snapshot selection on versioned dimension tables.

A versioned dimension appends a full copy of itself at every load, stamped
with a version column. Readers keep only the newest copy. The maximum is
taken as a scalar subquery inside the same plan: no driver round trip, no
timestamp text re-parsed in another zone, and identical subqueries over the
same table are computed once per query.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratal.sources.tables import footer_relation


class EmptySnapshotError(ValueError):
    pass


def max_scalar(df: DataFrame, col: str) -> Column:
    """``(SELECT max(col) FROM df)`` as a column expression."""
    return df.agg(F.max(col)).scalar()


#: Types whose footer statistics hold the exact maximum. Floating point is left out: a file
#: with NaN has no statistics, and the engine then fails instead of scanning.
FOOTER_TYPES = ("tinyint", "smallint", "int", "bigint", "date", "boolean")


def footer_max(spark: SparkSession, path: str, col: str) -> Column:
    """``(SELECT max(col) FROM path)`` answered from the Parquet footers: one
    footer per file is read instead of the column.

    Types without exact statistics (text, timestamps, floating point) are
    scanned as usual, and so is a column that holds a null or whose files
    lack statistics (a row group of nulls only has no maximum, at which the
    engine fails instead of scanning); that is found out beforehand by a count, also from the footers.
    """
    files = footer_relation(spark, path)
    if dict(files.dtypes)[col] in FOOTER_TYPES and _whole(files, col):
        return max_scalar(files, col)
    return max_scalar(spark.read.parquet(path), col)


def _whole(files: DataFrame, col: str) -> bool:
    try:
        rows, values = files.agg(F.count("*"), F.count(col)).first()
    except Exception as e:
        if "aggregatePushdown" in str(e):  # a footer without statistics
            return False
        raise
    return rows == values


def latest_snapshot(df: DataFrame, version_cols: str | Sequence[str] = "process_timestamp",
                    require_nonempty: bool = False, maxima: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows whose version columns each equal that column's table-wide maximum.

    With several version columns the maxima are independent: a row is kept
    only if it carries the newest value of every column. If no row does, the
    snapshot is empty and every lookup against it yields null. ``maxima``
    gives a column's maximum where it is known otherwise (``footer_max``).
    """
    cols = [version_cols] if isinstance(version_cols, str) else list(version_cols)
    if not cols:
        return df
    if require_nonempty and df.limit(1).count() == 0:
        raise EmptySnapshotError("snapshot table has no rows")
    cond = None
    for c in cols:
        term = F.col(c) == (maxima[c] if maxima and c in maxima else max_scalar(df, c))
        cond = term if cond is None else cond & term
    return df.where(cond)
