"""Command-line runner for the two jobs.

  python -m stratal.plans.cli family --database db --out PATH [--jdbc-url URL --jdbc-table T ...]
  python -m stratal.plans.cli landing --source db.table --mapping mapping.json --out PATH

Every constant of the source jobs is an argument. Tables are catalog names
(``db.d_prod`` ...) read with ``spark.table``; the session comes from
``spark-submit`` and its cluster settings.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from stratal.operators.mapping import mappings_from_tuples
from stratal.plans.jobs import FamilyParams, land_incremental, land_table, run_family
from stratal.plans.presets import article_mapping, source_family_params
from stratal.session import shared_checkpoint_dir
from stratal.sinks.writers import jdbc_options
from stratal.sources.tables import is_table_name

FAMILY_TABLES = ("d_prod", "d_marca", "d_tamano", "d_tipo_empaque", "d_sabor", "d_categoria",
                 "d_tipo_consum", "d_localidad", "h_ventas")


def _family(spark: SparkSession, a: argparse.Namespace) -> dict:
    prefix = f"{a.database}." if a.database else ""
    tables = {n: spark.table(f"{prefix}{n}") for n in FAMILY_TABLES}
    given = dict(plant_map=json.loads(a.plant_map) if a.plant_map else None,
                 tx_types=[int(x) for x in a.tx_types.split(",")] if a.tx_types else None,
                 valid_after=a.valid_after, sku_below=a.sku_below, category=a.category)
    if a.preset == "source":
        base = source_family_params()
        given = {k: (v if v is not None else getattr(base, k)) for k, v in given.items()}
    missing = [k for k, v in given.items() if v is None]
    if missing:
        raise SystemExit(f"missing settings (or use --preset source): {missing}")
    params = FamilyParams(**given, months=a.months, as_of=a.as_of,
                          stamp=dt.datetime.fromisoformat(a.stamp) if a.stamp else None, stamp_tz=a.stamp_tz,
                          id_type=a.id_type, rank_partitions=a.rank_partitions)
    sink = None
    if a.jdbc_url:
        sink = jdbc_options(a.jdbc_url, a.jdbc_table, os.environ.get(a.jdbc_user_env),
                            os.environ.get(a.jdbc_password_env), a.jdbc_driver,
                            num_partitions=a.jdbc_partitions, batch_size=a.jdbc_batch)
    return run_family(tables, params, a.out, sink, a.max_files, a.compression, a.jdbc_staged, a.rebalance)


def _landing(spark: SparkSession, a: argparse.Namespace) -> dict:
    if a.mapping == "article":
        maps = article_mapping()
    else:
        with open(a.mapping, encoding="utf-8") as fh:
            maps = mappings_from_tuples(json.load(fh))
    stamp = dt.datetime.fromisoformat(a.stamp) if a.stamp else None
    if a.checkpoint:
        if not a.schema and not is_table_name(a.source):
            raise SystemExit("an incremental landing of a folder needs --schema (DDL of the source files)")
        schema = StructType.fromDDL(a.schema) if a.schema else None
        batches = land_incremental(spark, a.source, schema, maps, a.out, a.checkpoint, stamp, a.tz,
                                   a.source_format, a.format, a.compression, strict=not a.lenient,
                                   max_files_per_batch=a.max_files_per_batch, replaced=a.replaced)
        return {"batches": batches}
    rows = land_table(spark.table(a.source), maps, a.out, stamp, a.tz, a.format, a.compression,
                      strict=not a.lenient, max_files=a.max_files)
    return {"landed": rows}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="stratal")
    sub = p.add_subparsers(dest="job", required=True)
    f = sub.add_parser("family")
    f.add_argument("--database", default="", help="catalog database; empty = temporary views")
    f.add_argument("--out", required=True)
    f.add_argument("--preset", choices=["source"], default=None,
                   help="take unset settings from the source job's values")
    f.add_argument("--plant-map", default=None, help='JSON object, e.g. {"CITY": 1}')
    f.add_argument("--tx-types", default=None, help="comma-separated ints")
    f.add_argument("--valid-after", default=None)
    f.add_argument("--sku-below", type=float, default=None)
    f.add_argument("--category", default=None)
    f.add_argument("--months", type=int, default=3)
    f.add_argument("--as-of", default=None)
    f.add_argument("--stamp", default=None, help="ISO instant with offset; default now")
    f.add_argument("--stamp-tz", default=None)
    f.add_argument("--id-type", choices=["int", "bigint"], default="int", help="type of the family id")
    f.add_argument("--rank-partitions", type=int, default=None, help="ranges of the global rank; default: by size")
    f.add_argument("--max-files", type=int, default=None)
    f.add_argument("--compression", default="uncompressed")
    f.add_argument("--rebalance", action="store_true", help="size the family files by data")
    f.add_argument("--jdbc-staged", action="store_true", help="load a staging table, then swap in one transaction")
    f.add_argument("--jdbc-url")
    f.add_argument("--jdbc-table")
    f.add_argument("--jdbc-driver")
    f.add_argument("--jdbc-user-env", default="JDBC_USER")
    f.add_argument("--jdbc-password-env", default="JDBC_PASSWORD")
    f.add_argument("--jdbc-partitions", type=int, default=None)
    f.add_argument("--jdbc-batch", type=int, default=None)
    g = sub.add_parser("landing")
    g.add_argument("--source", required=True, help="catalog table, or with --checkpoint also a folder of files")
    g.add_argument("--checkpoint", default=None, help="land only files that arrived since the last run")
    g.add_argument("--replaced", action="store_true",
                   help="also land files rewritten under their name; --checkpoint is then a file ledger")
    g.add_argument("--schema", default=None, help="DDL of the source files (incremental, folder)")
    g.add_argument("--source-format", default="parquet")
    g.add_argument("--max-files-per-batch", type=int, default=None)
    g.add_argument("--mapping", required=True,
                   help="'article' for the landing job's mapping, or a JSON file of [src, src_type, dst, dst_type]")
    g.add_argument("--out", required=True)
    g.add_argument("--stamp", default=None)
    g.add_argument("--tz", default=None)
    g.add_argument("--format", default="json")
    g.add_argument("--compression", default="gzip")
    g.add_argument("--max-files", type=int, default=None)
    g.add_argument("--lenient", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"stratal-{a.job}").getOrCreate()
    shared_checkpoint_dir(spark)
    result = _family(spark, a) if a.job == "family" else _landing(spark, a)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
