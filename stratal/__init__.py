"""stratal: snapshot-versioned warehouse curation on the Spark DataFrame API.

Every public function takes and returns DataFrames and stays lazy; only the
writers in :mod:`stratal.sinks`, the streaming runner and the two lineage
cuts of the family pipeline trigger Spark jobs.
"""

from stratal.session import build_session, materialize, scale_settings, scratch_path, shared_checkpoint_dir
from stratal.operators import (DimSpec, Mapping, apply_mapping, content_hash, dedupe_keep, dedupe_rows,
                               dense_rank_global, detect_changes, enrich, file_hashes, latest_snapshot,
                               lookup, rank_distinct)
from stratal.plans import (FamilyParams, assign_families, build_family, family_relation, family_table, land,
                           land_table, product_master, recent_sales, run_family)
from stratal.sinks import jdbc_options, write_jdbc, write_partitioned
from stratal.streaming import batch_folder_writer, run_available_now

__all__ = [
    "build_session", "materialize", "scale_settings", "scratch_path", "shared_checkpoint_dir",
    "DimSpec", "Mapping", "apply_mapping", "content_hash", "dedupe_keep", "dedupe_rows", "dense_rank_global",
    "detect_changes", "enrich", "file_hashes", "latest_snapshot", "lookup", "rank_distinct",
    "FamilyParams", "assign_families", "build_family", "family_relation", "family_table", "land", "land_table",
    "product_master", "recent_sales", "run_family",
    "jdbc_options", "write_jdbc", "write_partitioned", "batch_folder_writer", "run_available_now",
]
