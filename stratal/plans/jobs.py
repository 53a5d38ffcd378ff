"""M6 and M7: the end-to-end jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratal.functions.stamps import stamp_load
from stratal.operators.mapping import Mapping as ColumnMapping
from stratal.operators.mapping import apply_mapping
from stratal.plans.family import assign_families, family_relation, family_table
from stratal.plans.products import product_master
from stratal.plans.sales import recent_sales
from stratal.session import scratch_scope
from stratal.sinks.writers import refresh_jdbc, write_jdbc, write_partitioned
from stratal.streaming.incremental import land_batch_writer, run_available_now
from stratal.streaming.ledger import FILES_PER_BATCH, run_changed_files


@dataclass(frozen=True)
class FamilyParams:
    """Every constant of the family job, as a parameter.

    ``as_of`` ends the sales window (None = today in the session zone);
    ``stamp`` is the load instant written to the family table (None = now).
    """

    plant_map: Mapping[str, int]
    tx_types: Sequence[int]
    valid_after: dt.date | str
    sku_below: float
    category: str
    months: int = 3
    as_of: dt.date | str | None = None
    stamp: dt.datetime | None = None
    stamp_tz: str | None = None
    rank_partitions: int | None = None
    id_type: str = "int"


def build_family(tables: Mapping[str, DataFrame], p: FamilyParams,
                 overflow: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """M1-M5: (family table, family relation)."""
    products = product_master(tables, p.valid_after, p.sku_below, with_flavour=False)
    sales = recent_sales(tables, p.as_of, p.months, p.tx_types, p.plant_map, p.valid_after, p.sku_below)
    assigned = assign_families(sales, products, p.category, p.rank_partitions, p.id_type, overflow)
    families = family_table(assigned, p.stamp, p.stamp_tz, p.id_type)
    return families, family_relation(families)


def run_family(tables: Mapping[str, DataFrame], p: FamilyParams, families_path: str,
               relation_sink: Callable[[DataFrame], None] | Mapping[str, str] | None = None,
               max_files: int | None = None, compression: str = "uncompressed", staged: bool = False,
               rebalance: bool = False) -> dict[str, int]:
    """M6: build families, write them as Parquet partitioned by ``fecha``
    (replacing only that day's folder), then refresh the relation.

    The family table is persisted for the two writes and released after;
    row counts, and the number of rows whose family id overflowed, are
    observed during the writes instead of extra passes.
    ``relation_sink`` is JDBC options (full refresh with truncate; with
    ``staged`` through a staging table and one transaction, so readers never
    see the target empty) or a callable taking the relation frame; it gets
    the pairs unordered. ``rebalance`` sizes the family files by data. Scratch
    tables of the run are removed when it ends.
    """
    spark = next(iter(tables.values())).sparkSession
    with scratch_scope(spark, "family-run"):
        return _run_family(tables, p, families_path, relation_sink, max_files, compression, staged, rebalance)


def _run_family(tables, p, families_path, relation_sink, max_files, compression, staged, rebalance) -> dict[str, int]:
    overflow = Observation("family-id-overflow")
    families, _ = build_family(tables, p, overflow)
    families = families.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fam_obs = Observation("families")
        write_partitioned(families.observe(fam_obs, F.count(F.lit(1)).alias("rows")), families_path,
                          "fecha", "parquet", compression, max_files=max_files, rebalance=rebalance)
        counts = {"families": fam_obs.get["rows"], "id_overflow": overflow.get["id_overflow"]}
        if relation_sink is not None:
            rel_obs = Observation("relation")
            relation = family_relation(families, ordered=False).observe(rel_obs, F.count(F.lit(1)).alias("rows"))
            if callable(relation_sink):
                relation_sink(relation)
            else:
                (refresh_jdbc if staged else write_jdbc)(relation, relation_sink)
            counts["relation"] = rel_obs.get["rows"]
        return counts
    finally:
        families.unpersist()


def land(df: DataFrame, mappings: Sequence[ColumnMapping], as_of: dt.datetime | None = None,
         tz: str | None = None, strict: bool = True, ts_col: str = "raw_timestamp",
         partition_col: str = "date_raw_partition") -> DataFrame:
    """Mapped and stamped rows of the landing job (lazy)."""
    return stamp_load(apply_mapping(df, mappings, strict), as_of, tz, ts_col, partition_col)


def land_table(df: DataFrame, mappings: Sequence[ColumnMapping], path: str,
               as_of: dt.datetime | None = None, tz: str | None = None, fmt: str = "json",
               compression: str = "gzip", strict: bool = True,
               partition_col: str = "date_raw_partition", max_files: int | None = None) -> int:
    """M7: map, stamp, and write date-partitioned files, replacing only the
    load day's partition. Returns the number of rows written."""
    obs = Observation("landing")
    out = land(df, mappings, as_of, tz, strict, partition_col=partition_col)
    write_partitioned(out.observe(obs, F.count(F.lit(1)).alias("rows")), path, partition_col, fmt,
                      compression, max_files=max_files)
    return obs.get["rows"]


def land_incremental(spark: SparkSession, source: str, schema: StructType | None, mappings: Sequence[ColumnMapping],
                     path: str, checkpoint: str, as_of: dt.datetime | None = None, tz: str | None = None,
                     source_format: str = "parquet", fmt: str = "json", compression: str = "gzip", strict: bool = True,
                     partition_col: str = "date_raw_partition", max_files_per_batch: int | None = None,
                     timeout_s: float | None = None, replaced: bool = False) -> int:
    """M7 with S3: land only the files that arrived since the last run.

    ``source`` is a folder (with its ``schema``) or the name of a file-based
    catalog table (``schema`` None: schema, format and location come from the
    catalog). By default ``checkpoint`` is a stream checkpoint, which knows
    files by name. With ``replaced`` it is a file ledger: files rewritten
    under their name are landed once more, in a batch of their own run
    (``timeout_s`` does not apply).

    Rows go to ``path/<partition_col>=<day>/batch_id=<n>/``: the day stays
    the top folder, later runs on one day add to it, and a batch that is
    replayed after a failure replaces its own folders (also those of an
    earlier day), so nothing is landed twice. Returns the batches written.
    """
    writer = land_batch_writer(path, partition_col, fmt, compression)
    done: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(land(batch, mappings, as_of, tz, strict, partition_col=partition_col), batch_id)
        done.append(batch_id)

    write.output = path
    if replaced:
        run_changed_files(spark, source, checkpoint, write, schema, source_format, max_files_per_batch or FILES_PER_BATCH)
    else:
        run_available_now(spark, source, schema, checkpoint, write, source_format, max_files_per_batch,
                          timeout_s=timeout_s)
    return len(done)
