"""Load stamps: one instant per run, rendered as timestamp, date or text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _instant(as_of: dt.datetime | Column | None) -> Column:
    if as_of is None:
        # One instant per call, fixed as a literal: every action, retry and
        # recomputation of the stamped frame sees the same value, unlike
        # current_timestamp(), which is fixed per query only.
        return F.lit(dt.datetime.now(dt.timezone.utc))
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is None:
        raise ValueError("as_of must be timezone-aware (an instant)")
    return F.lit(as_of)


def stamp_load(df: DataFrame, as_of: dt.datetime | Column | None = None, tz: str | None = None,
               ts_col: str = "raw_timestamp", date_col: str = "date_raw_partition") -> DataFrame:
    """Add the load instant and the partition date derived from it.

    ``tz=None`` takes the date in the session zone, as the landing job does
    (an evening load at UTC-4 lands in the next day's partition under a UTC
    session). ``tz='-04:00'`` or a region id gives the local calendar date,
    independent of the session zone.
    """
    stamp = _instant(as_of)
    if tz is None:
        day = F.to_date(stamp)
    else:
        day = F.convert_timezone(None, F.lit(tz), stamp).cast("date")
    return df.withColumns({ts_col: stamp, date_col: day})


def load_stamps(as_of: dt.datetime | Column | None = None, tz: str | None = None) -> dict[str, Column]:
    """Text stamps of the family table: 'yyyy-MM-dd HH:mm:ss' and 'yyyy-MM-dd'.

    Both come from one instant so they can never straddle midnight.
    """
    stamp = _instant(as_of)
    if tz is not None:
        stamp = F.convert_timezone(None, F.lit(tz), stamp)
    return {
        "process_timestamp": F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"),
        "fecha": F.date_format(stamp, "yyyy-MM-dd"),
    }
