"""Typed column mapping: keep, rename, cast; drop everything else."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mapping:
    source: str
    source_type: str
    target: str
    target_type: str


class MissingColumnsError(ValueError):
    pass


def mappings_from_tuples(rows: Iterable[Sequence[str]]) -> list[Mapping]:
    return [Mapping(*r) for r in rows]


def apply_mapping(df: DataFrame, mappings: Sequence[Mapping], strict: bool = True) -> DataFrame:
    """One projection: ``cast(source as target_type) as target`` per entry.

    Unmapped source columns are dropped. A mapped column absent from the
    input raises when ``strict``; otherwise it becomes a typed null column.
    Type names are anything Spark's DDL parser accepts.
    """
    present = set(df.columns)
    missing = [m.source for m in mappings if m.source not in present]
    if missing and strict:
        raise MissingColumnsError(f"columns not in input: {missing}")
    cols = []
    for m in mappings:
        src = F.col(f"`{m.source}`") if m.source in present else F.lit(None)
        cols.append(src.cast(m.target_type).alias(m.target))
    return df.select(*cols)
