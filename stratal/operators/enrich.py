"""Star lookups: a chain of left joins from one master table to dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratal.operators.snapshot import latest_snapshot


@dataclass(frozen=True)
class DimSpec:
    """One lookup of a master table into a dimension.

    ``table``          the dimension (all versions; the newest is selected)
    ``left_key``       key column(s) of the master
    ``right_key``      key column(s) of the dimension, default = ``left_key``
    ``columns``        dimension columns to bring over
    ``snapshot_cols``  version columns, each filtered to its own maximum;
                       empty for an unversioned dimension
    ``key_cast``       cast the dimension key before comparing (text vs
                       number keys: '01' must not match 1)
    ``how``            join type, ``left`` for a lookup
    ``hint``           optional join hint; by default adaptive execution picks
                       broadcast only when the runtime size is under the
                       session's broadcast threshold, else a shuffle join
    """

    table: DataFrame
    left_key: str | Sequence[str]
    columns: Sequence[str]
    right_key: str | Sequence[str] | None = None
    snapshot_cols: Sequence[str] = field(default=("process_timestamp",))
    key_cast: str | None = None
    how: str = "left"
    hint: str | None = None


def _as_list(v: str | Sequence[str]) -> list[str]:
    return [v] if isinstance(v, str) else list(v)


def lookup(master: DataFrame, spec: DimSpec) -> DataFrame:
    """Apply one lookup.

    The dimension is cut to its newest snapshot and projected to key plus
    requested columns *before* the join, which is the same result as putting
    the snapshot predicates in the join's ON clause and lets the scan prune
    columns. Join keys are renamed on the dimension side so the master keeps
    its own key columns untouched.
    """
    lkeys = _as_list(spec.left_key)
    rkeys = _as_list(spec.right_key) if spec.right_key is not None else lkeys
    if len(lkeys) != len(rkeys):
        raise ValueError("left and right key lists differ in length")
    dim = latest_snapshot(spec.table, spec.snapshot_cols)
    tmp = [f"__k{i}_{r}" for i, r in enumerate(rkeys)]
    keys = [F.col(r).cast(spec.key_cast) if spec.key_cast else F.col(r) for r in rkeys]
    dim = dim.select(*[k.alias(t) for k, t in zip(keys, tmp)], *spec.columns)
    if spec.hint:
        dim = dim.hint(spec.hint)
    clash = set(spec.columns) & set(master.columns)
    if clash:
        raise ValueError(f"lookup columns already in the master: {sorted(clash)}")
    # Names are unique on each side, so plain column names resolve without
    # ambiguity even when master and dimension come from the same scan.
    cond = None
    for lk, t in zip(lkeys, tmp):
        term = F.col(lk) == F.col(t)
        cond = term if cond is None else cond & term
    return master.join(dim, cond, spec.how).drop(*tmp)


def enrich(master: DataFrame, specs: Sequence[DimSpec]) -> DataFrame:
    """Fold a list of lookups over the master table, in order."""
    out = master
    for spec in specs:
        out = lookup(out, spec)
    return out
