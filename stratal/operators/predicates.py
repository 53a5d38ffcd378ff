"""Reusable row predicates."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _date(value: dt.date | str | Column | None) -> Column:
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def active_products(df: DataFrame, valid_after: dt.date | str, sku_below: float,
                    valid_to: str = "ffin_vreg", deleted_flag: str = "suprimido",
                    deleted_on: str = "fech_supr", sku: str = "sku") -> DataFrame:
    """Products still valid, not flagged deleted and below a sku bound.

    ``<> 'S'`` drops rows whose flag is null as well (SQL three-valued
    logic), which is the source behaviour and is kept. Numeric sku columns
    are compared in their own type, so the bound reaches the scan; text goes
    through ``try_cast`` to double, so malformed sku text is dropped instead
    of failing the query under ANSI mode.
    """
    kind = df.schema[sku].dataType
    if isinstance(kind, T.IntegralType):
        below = F.col(sku) < F.lit(math.ceil(sku_below)).cast("bigint")  # x < 2.5 is x < 3 for integers
    elif isinstance(kind, T.NumericType):
        below = F.col(sku) < F.lit(float(sku_below))
    else:
        below = F.col(sku).try_cast("double") < F.lit(float(sku_below))
    return df.where(
        (F.col(valid_to) > _date(valid_after))
        & (F.col(deleted_flag) != F.lit("S"))
        & F.col(deleted_on).isNull()
        & below
    )


def in_list(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def recent_window(df: DataFrame, col: str, months: int, as_of: dt.date | str | Column | None = None) -> DataFrame:
    """``col`` within [as_of - months, as_of], both ends inclusive.

    Month arithmetic clamps to the month end (May 31 - 3 months = Feb 28).
    ``as_of=None`` means today in the session zone, folded to a constant.
    """
    end = _date(as_of)
    return df.where(F.col(col).between(F.add_months(end, -months), end))


def like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Case-sensitive SQL LIKE; null values never match."""
    return df.where(F.col(col).like(pattern))
