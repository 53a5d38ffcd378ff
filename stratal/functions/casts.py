"""Casts that keep null-on-failure behaviour under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str
# What the legacy cast trims around a number: control characters and the space.
_BLANKS = "".join(map(chr, range(33)))


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c: ColumnOrName, target: str = "int") -> Column:
    """Integer cast that returns null instead of failing.

    Spark 4 runs with ANSI on, where ``cast('A12' as int)`` raises. A bare
    ``try_cast`` is stricter than the legacy cast on decimal text ('12.7'
    becomes null instead of 12), so the integer part of text is cut out
    before the cast: a fraction of any length truncates toward zero and never
    rounds, '.5' is 0, '5.' is 5, blanks around the number are ignored, junk,
    exponents and overflow become null. Numbers are cast directly, which
    truncates. ``target='bigint'`` widens the result instead of losing large
    ids. The type test folds to a constant during optimization.

    One difference from the legacy cast, on purpose: numbers that overflow
    the target become null (the legacy cast wraps a bigint and saturates a
    double).
    """
    text = F.trim(_col(c).cast("string"), F.lit(_BLANKS))
    whole = F.regexp_replace(text, r"^([+-]?)([0-9]*)(\.[0-9]*)?$", "$10$2")
    from_text = F.when(text.rlike(r"^[+-]?([0-9]+|\.|[0-9]+\.[0-9]*|\.[0-9]+)$"), whole).try_cast(target)
    return F.when(F.typeof(_col(c)).startswith("string"), from_text).otherwise(_col(c).try_cast(target))


def ts_ntz(value: str) -> Column:
    """A ``timestamp_ntz`` literal from 'yyyy-MM-dd[ HH:mm:ss[.ffffff]]' text.

    Parsing text straight to the zone-less type keeps the literal independent
    of the session zone.
    """
    return F.lit(value).cast("timestamp_ntz")
