"""Relational operators of the curation pipelines."""

from stratal.operators.changes import (changed_items, content_hash, detect_changes, file_hashes, load_manifest,
                                       save_manifest)
from stratal.operators.dedupe import dedupe_keep, dedupe_rows
from stratal.operators.enrich import DimSpec, enrich, lookup
from stratal.operators.mapping import Mapping, MissingColumnsError, apply_mapping
from stratal.operators.predicates import active_products, in_list, like, recent_window
from stratal.operators.rank import dense_rank_global, number_rows, rank_distinct, rank_global
from stratal.operators.snapshot import EmptySnapshotError, footer_max, latest_snapshot, max_scalar

__all__ = [
    "changed_items", "content_hash", "detect_changes", "file_hashes", "load_manifest", "save_manifest", "dedupe_keep", "dedupe_rows",
    "DimSpec", "enrich", "lookup", "Mapping", "MissingColumnsError", "apply_mapping",
    "active_products", "in_list", "like", "recent_window", "dense_rank_global",
    "rank_distinct", "rank_global", "number_rows", "EmptySnapshotError", "footer_max", "latest_snapshot", "max_scalar",
]
