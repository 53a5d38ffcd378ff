"""Named queries: one per operator or pipeline, each over whole test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. The sink and
streaming entries write to a fresh folder under the session's shared
checkpoint folder and return the data read back from it.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from collections.abc import Mapping as TableMap

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratal.functions.casts import lenient_int
from stratal.functions.stamps import stamp_load
from stratal.operators.changes import (content_hash, detect_changes, drop_manifest, file_hashes, load_manifest,
                                       save_manifest)
from stratal.operators.dedupe import dedupe_keep, dedupe_rows
from stratal.operators.enrich import DimSpec, enrich, lookup
from stratal.operators.mapping import Mapping, apply_mapping
from stratal.operators.predicates import in_list, like, recent_window
from stratal.operators.rank import dense_rank_global, number_rows, rank_global
from stratal.operators.snapshot import footer_max, latest_snapshot
from stratal.plans.family import (assign_families, attach_ranks, distinct_groups, family_id,
                                  family_relation, family_table, rank_groups, sales_products)
from stratal.plans.jobs import build_family, land, land_incremental, land_table, run_family
from stratal.plans.products import TWO_VERSIONS, current_products, product_master, product_specs
from stratal.plans.sales import recent_sales
from stratal.session import glob_paths, remove_path, rename_path, scratch_path
from stratal.sinks.writers import write_partitioned
from stratal.sources.standins import (AS_OF, CATEGORY, MONTHS, PLANT_MAP, SKU_BELOW, TX_TYPES,
                                      VALID_AFTER, d_tipo_empaque_disjoint, family_params,
                                      standin_tables)
from stratal.sources.tables import load_tables, read_table, register_views
from stratal.streaming.incremental import batch_folder_writer, run_available_now
from stratal.streaming.ledger import run_changed_files

# Fixed values of the suite (shared with the SQL oracle).
LOAD_INSTANT = dt.datetime(2025, 3, 1, 21, 30, 15, 123456, tzinfo=dt.timezone(dt.timedelta(hours=-4)))
FAMILY_STAMP = dt.datetime(2000, 6, 30, 12, 0, 0, tzinfo=dt.timezone.utc)
CUSTOMER_MAPPING = [
    Mapping("c_custkey", "bigint", "id", "int"),
    Mapping("c_name", "string", "name", "string"),
    Mapping("c_acctbal", "double", "bal", "string"),
]
PART_MAPPING = [
    Mapping("p_partkey", "bigint", "articulokey", "int"),
    Mapping("p_name", "string", "nombrearticulo", "string"),
    Mapping("p_brand", "string", "marca", "string"),
    Mapping("p_type", "string", "categoriamkt", "string"),
    Mapping("p_size", "int", "tamaño", "string"),
]

WIDE_PLANTS = 300_000

Query = Callable[[SparkSession, str], DataFrame]


def _base(spark: SparkSession, sf_dir: str) -> TableMap[str, DataFrame]:
    return load_tables(spark, sf_dir)


def _fixtures(spark: SparkSession, sf_dir: str) -> tuple[TableMap[str, DataFrame], TableMap[str, DataFrame]]:
    base = _base(spark, sf_dir)
    return base, standin_tables(base)


def _products(t):
    return product_master(t, VALID_AFTER, SKU_BELOW)


def _family_products(t):
    """The product master as the family pipeline needs it (no flavour lookup)."""
    return product_master(t, VALID_AFTER, SKU_BELOW, with_flavour=False)


def _sales(t):
    return recent_sales(t, AS_OF, MONTHS, TX_TYPES, PLANT_MAP, VALID_AFTER, SKU_BELOW)


def _assigned(t):
    return assign_families(_sales(t), _family_products(t), CATEGORY)


def _families(t):
    return family_table(_assigned(t), FAMILY_STAMP, "UTC")


def _utc(c: str) -> F.Column:
    """An instant as zone-less UTC wall time, independent of the session zone."""
    return F.convert_timezone(None, F.lit("UTC"), F.col(c)).alias(c)


# -- snapshots -----------------------------------------------------------------

def snapshot_latest(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return latest_snapshot(t["d_prod"])


def snapshot_two_columns(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return latest_snapshot(t["d_tipo_empaque"], TWO_VERSIONS)


def snapshot_two_columns_disjoint(spark, sf_dir):
    base, t = _fixtures(spark, sf_dir)
    prods = latest_snapshot(t["d_prod"]).select("id_prod", "id_tipo_empaque")
    spec = DimSpec(d_tipo_empaque_disjoint(base["part"]), "id_tipo_empaque",
                   ["desc_tipo_empaque", "desc_tipo_empaque_gen"], snapshot_cols=TWO_VERSIONS)
    return lookup(prods, spec)


def max_scalar(spark, sf_dir):
    orders = _base(spark, sf_dir)["orders"]
    return orders.agg(F.max("o_orderdate").alias("max_orderdate"), F.max("o_totalprice").alias("max_totalprice"))


def max_scalar_footers(spark, sf_dir):
    """Maxima answered from the file footers (whole-number and date columns)."""
    path = f"{sf_dir}/lineitem.parquet"
    cols = ["l_orderkey", "l_partkey", "l_suppkey"]
    return spark.range(1).select(*[footer_max(spark, path, c).alias(f"max_{c}") for c in cols])


# -- projections and filters ---------------------------------------------------

def mapping_typed(spark, sf_dir):
    return apply_mapping(_base(spark, sf_dir)["customer"], CUSTOMER_MAPPING)


def active_products(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return current_products(t["d_prod"], VALID_AFTER, SKU_BELOW)


def filter_in_list(spark, sf_dir):
    return in_list(_base(spark, sf_dir)["lineitem"], "l_linenumber", TX_TYPES)


def filter_like(spark, sf_dir):
    return like(_base(spark, sf_dir)["part"], "p_name", "%ring%")


def window_recent_default(spark, sf_dir):
    """The window ending today: order lines dated back by a bounded number of days."""
    li = _base(spark, sf_dir)["lineitem"].select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 400).cast("int").alias("age"))
    dated = li.withColumn("day", F.date_sub(F.current_date(), F.col("age")))
    return recent_window(dated, "day", MONTHS).drop("day")


def window_recent_months(spark, sf_dir):
    li = _base(spark, sf_dir)["lineitem"].withColumn("l_shipday", F.to_date("l_shipdate"))
    return recent_window(li, "l_shipday", MONTHS, AS_OF)


def catalog_read(spark, sf_dir):
    """A table read by its catalog name."""
    register_views({"stratal_orders": _base(spark, sf_dir)["orders"]})
    return read_table(spark, "stratal_orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


# -- joins ---------------------------------------------------------------------

def _current_ids(t, *cols):
    return latest_snapshot(t["d_prod"]).select("id_prod", *cols)


def lookup_left(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return lookup(_current_ids(t, "id_tamano"), DimSpec(t["d_tamano"], "id_tamano", ["desc_tamano"]))


def lookup_left_cast_key(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    spec = DimSpec(t["d_marca"], "id_marca", ["desc_marca"], key_cast="string")
    return lookup(_current_ids(t, "id_marca"), spec)


def lookup_left_two_snapshots(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    spec = DimSpec(t["d_tipo_empaque"], "id_tipo_empaque", ["desc_tipo_empaque", "desc_tipo_empaque_gen"],
                   snapshot_cols=TWO_VERSIONS)
    return lookup(_current_ids(t, "id_tipo_empaque"), spec)


def filter_join(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    keys = current_products(t["d_prod"], VALID_AFTER, SKU_BELOW).select("id_prod")
    return t["h_ventas"].join(keys, "id_prod", "inner")


def dim_join_inner(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    places = latest_snapshot(t["d_localidad"]).select("id_localidad", "agru_local")
    return t["h_ventas"].join(places, "id_localidad", "inner")


def join_shared_name(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return _sales(t).join(_products(t), "id_prod", "inner")


def join_back_null_keys(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    rows = sales_products(_sales(t), _family_products(t), CATEGORY)
    return attach_ranks(rows, rank_groups(rows)).select(
        "idplanta", "name_concat_general", "id_prod", "sku", "n_grupo")


def star_lookup(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    prods = current_products(t["d_prod"], VALID_AFTER, SKU_BELOW).select(
        "id_prod", "id_marca", "id_tamano", "id_tipo_empaque", "id_sabor", "id_catego", "id_tipo_consum")
    return enrich(prods, product_specs(t))


# -- pipelines and aggregates --------------------------------------------------

def product_master_q(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return _products(t)


def sales_grouped(spark, sf_dir):
    li = _base(spark, sf_dir)["lineitem"]
    return li.groupBy("l_suppkey", "l_linestatus", "l_partkey").agg(
        F.sum("l_quantity").alias("sum_qty"), F.max(F.to_date("l_shipdate")).alias("last_ship"))


def recent_sales_q(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return _sales(t)


def distinct_groups_q(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return distinct_groups(sales_products(_sales(t), _family_products(t), CATEGORY))


def _rank_input(part: DataFrame) -> DataFrame:
    return part.select(
        "p_partkey",
        F.when(F.col("p_size") % 9 == 0, F.lit(None)).otherwise(F.col("p_size") % 4).alias("g_a"),
        F.when(F.col("p_partkey") % 13 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("g_b"))


def dense_rank_global_q(spark, sf_dir):
    return dense_rank_global(_rank_input(_base(spark, sf_dir)["part"]), ["g_a", "g_b"], "rank")


def family_id_q(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    rows = sales_products(_sales(t), _family_products(t), CATEGORY)
    return rank_groups(rows).withColumn("familyid", family_id("idplanta", "n_grupo"))


def family_id_overflow(spark, sf_dir):
    part = _base(spark, sf_dir)["part"]
    ranks = part.select(
        "p_partkey", (F.col("p_size") % 8).alias("plant"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None)).otherwise(F.col("p_partkey") * 60).alias("rnk"))
    return ranks.withColumn("familyid", family_id("plant", "rnk"))


def dedupe_subset(spark, sf_dir):
    orders = _base(spark, sf_dir)["orders"]
    return dedupe_keep(orders, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"])


def dedupe_rows_q(spark, sf_dir):
    orders = _base(spark, sf_dir)["orders"]
    return dedupe_rows(orders.select("o_custkey", "o_orderstatus", "o_orderpriority"))


def family_assign(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return _assigned(t)


def family_table_q(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return _families(t)


def family_relation_q(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    return family_relation(_families(t))


def relation_order(spark, sf_dir):
    """The relation with, per family id, the position of its first row."""
    _, t = _fixtures(spark, sf_dir)
    relation = family_relation(_families(t), ordered=False)
    return rank_global(relation, ["family_id"], "first_at").withColumn("first_at", F.col("first_at").cast("int"))


def row_numbers(spark, sf_dir):
    """Line items numbered by ship date and quantity; of the rows of a tie, only the span of their numbers is determined."""
    lines = _base(spark, sf_dir)["lineitem"].select("l_shipdate", "l_quantity")
    numbered = number_rows(lines, ["l_shipdate", "l_quantity"], "at")
    return numbered.groupBy("l_shipdate", "l_quantity").agg(
        F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.count("*").alias("n"))


def row_counts(spark, sf_dir):
    """Row counts of the family job, observed during its writes."""
    _, t = _fixtures(spark, sf_dir)
    params = family_params(stamp=FAMILY_STAMP, stamp_tz="UTC")
    relation = scratch_path(spark, "relation-out")
    counts = run_family(t, params, scratch_path(spark, "family-out"),
                        relation_sink=lambda rel: write_partitioned(rel, relation, None, "parquet"))
    return spark.createDataFrame(sorted(counts.items()), "what string, n long")


def family_table_wide_ids(spark, sf_dir):
    """Plant numbers so large that every family id overflows an int."""
    _, t = _fixtures(spark, sf_dir)
    wide = {place: WIDE_PLANTS * plant for place, plant in PLANT_MAP.items()}
    return build_family(t, family_params(plant_map=wide, stamp=FAMILY_STAMP, stamp_tz="UTC", id_type="bigint"))[0]


def lenient_int_edges(spark, sf_dir):
    """Number text with long fractions, signs, bare fractions, blanks and junk."""
    part = _base(spark, sf_dir)["part"].select("p_partkey", "p_size", "p_retailprice")
    key = F.col("p_partkey").cast("string")
    texts = [F.concat(key, F.lit(".99999999999999")), F.concat(F.lit("-"), key, F.lit(".5")),
             F.concat(F.lit("."), key), F.concat(key, F.lit(".")), F.concat(F.lit("  +"), key, F.lit(" ")),
             F.concat(key, F.lit("e1")), F.concat(key, F.lit("0000000000"))]
    pick = F.element_at(F.array(*texts), (F.col("p_size") % 7 + 1).cast("int"))
    return part.withColumn("txt", pick).select("p_partkey", "txt", lenient_int("txt").alias("as_int"),
                                               lenient_int("txt", "bigint").alias("as_bigint"),
                                               lenient_int("p_retailprice").alias("price_int"))


# -- stamps --------------------------------------------------------------------

def _stamped_events(spark, sf_dir, tz):
    events = _base(spark, sf_dir)["events"]
    out = stamp_load(events, LOAD_INSTANT, tz)
    return out.select(*events.columns, _utc("raw_timestamp"), "date_raw_partition")


def stamp_load_utc(spark, sf_dir):
    return _stamped_events(spark, sf_dir, "UTC")


def stamp_load_offset(spark, sf_dir):
    return _stamped_events(spark, sf_dir, "-04:00")


# -- sinks ---------------------------------------------------------------------

FAMILY_SCHEMA = ("idplanta int, articulokey int, categoriamkt string, marcamkt string, formato string, "
                 "formatomkt string, cantsubunidades int, familyid int, sku int, parentid int, "
                 "process_timestamp string, planta string, fecha string")


def sink_parquet_partitioned(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    path = scratch_path(spark, "families")
    write_partitioned(_families(t), path, "fecha", "parquet", "uncompressed", max_files=2)
    return spark.read.schema(FAMILY_SCHEMA).parquet(path)


def sink_json_partitioned(spark, sf_dir):
    customer = _base(spark, sf_dir)["customer"]
    path = scratch_path(spark, "landing-customer")
    write_partitioned(land(customer, CUSTOMER_MAPPING, LOAD_INSTANT, "UTC"), path, "date_raw_partition",
                      "json", "gzip")
    back = spark.read.schema("id int, name string, bal string, raw_timestamp timestamp, "
                             "date_raw_partition date").json(path)
    return back.select("id", "name", "bal", _utc("raw_timestamp"), "date_raw_partition")


def dynamic_overwrite(spark, sf_dir):
    """A second write replaces one partition and leaves the others."""
    orders = _base(spark, sf_dir)["orders"].select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch_path(spark, "overwrite")
    write_partitioned(orders.withColumn("run", F.lit(1)), path, "o_orderstatus")
    write_partitioned(orders.where(F.col("o_orderstatus") == "F").withColumn("run", F.lit(2)), path, "o_orderstatus")
    return spark.read.schema("o_orderkey long, o_custkey long, run int, o_orderstatus string").parquet(path)


def sink_rebalanced(spark, sf_dir):
    """Orders by status, the sizes of the files chosen from the data."""
    orders = _base(spark, sf_dir)["orders"].select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch_path(spark, "rebalanced")
    write_partitioned(orders, path, "o_orderstatus", rebalance=True)
    return spark.read.schema("o_orderkey long, o_custkey long, o_orderstatus string").parquet(path)


@contextlib.contextmanager
def _catalog_table(spark: SparkSession, schema: str, path: str) -> Iterator[str]:
    """A catalog table over a folder, dropped at the end (its files stay)."""
    name = f"stratal_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet LOCATION '{path}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes)


def landing_catalog_incremental(spark, sf_dir):
    """A catalog table, landed by name in two runs; each row comes once, in the batch of its arrival."""
    part = _base(spark, sf_dir)["part"]
    root = scratch_path(spark, "landing-catalog")
    with _catalog_table(spark, _ddl(part), f"{root}/table") as name:
        for drop in (0, 1):
            part.where(F.col("p_partkey") % 2 == drop).write.insertInto(name)
            for _ in range(2):  # the second run finds nothing new
                land_incremental(spark, name, None, PART_MAPPING, f"{root}/out", f"{root}/checkpoint", LOAD_INSTANT, "UTC")
    back = spark.read.schema("articulokey int, nombrearticulo string, batch_id int").json(f"{root}/out")
    return back.select("articulokey", "nombrearticulo", "batch_id")


def _replace_files(df: DataFrame, folder: str) -> None:
    """Write ``df`` under the names that the files of ``folder`` have."""
    spark = df.sparkSession
    fresh = scratch_path(spark, "replacement")
    df.write.parquet(fresh)
    names = [p.rsplit("/", 1)[-1] for p in glob_paths(spark, f"{folder}/part-*")]
    for k, path in enumerate(glob_paths(spark, f"{fresh}/part-*")):
        target = f"{folder}/{names[k] if k < len(names) else path.rsplit('/', 1)[-1]}"
        remove_path(spark, target)
        rename_path(spark, path, target)


def landing_replaced_files(spark, sf_dir):
    """Files rewritten under their names are landed once more, the others are not."""
    part = _base(spark, sf_dir)["part"]
    root = scratch_path(spark, "landing-replaced")
    drops = [part.where(F.col("p_partkey") % 2 == drop) for drop in (0, 1)]
    for k, drop in enumerate(drops):
        drop.write.parquet(f"{root}/source/drop{k}")

    def run():
        land_incremental(spark, f"{root}/source", part.schema, PART_MAPPING, f"{root}/out", f"{root}/ledger", LOAD_INSTANT,
                         "UTC", replaced=True)

    run()
    _replace_files(drops[1].withColumn("p_name", F.concat("p_name", F.lit(" (rev)"))), f"{root}/source/drop1")
    run()
    run()
    back = spark.read.schema("articulokey int, nombrearticulo string, batch_id int").json(f"{root}/out")
    return back.select("articulokey", "nombrearticulo", "batch_id")


def replaced_files_latest(spark, sf_dir):
    """The newest version of every file, kept by its name, from three runs over a changing folder."""
    events = _base(spark, sf_dir)["events"]
    root = scratch_path(spark, "latest")
    writer = batch_folder_writer(f"{root}/out")
    drops = [events.where(F.col("event_id") % 3 == drop) for drop in range(3)]
    for k in range(3):
        if k < 2:
            drops[k].write.parquet(f"{root}/source/drop{k}")
        else:
            drops[2].write.parquet(f"{root}/source/drop2")
            _replace_files(drops[0].withColumn("event_id", -F.col("event_id")), f"{root}/source/drop0")
        run_changed_files(spark, f"{root}/source", f"{root}/ledger", writer, events.schema, file_column="file")
    landed = spark.read.schema(f"{_ddl(events)}, file string, batch_id int").parquet(f"{root}/out")
    last = landed.groupBy("file").agg(F.max("batch_id").alias("batch_id"))
    return landed.join(last, ["file", "batch_id"], "left_semi").select(*events.columns)


def landing_incremental(spark, sf_dir):
    """Two runs on one day, each landing the files that arrived before it."""
    part = _base(spark, sf_dir)["part"]
    root = scratch_path(spark, "landing-incremental")
    for drop, mode in ((0, "overwrite"), (1, "append")):
        part.where(F.col("p_partkey") % 2 == drop).write.mode(mode).parquet(f"{root}/source")
        land_incremental(spark, f"{root}/source", part.schema, PART_MAPPING, f"{root}/out", f"{root}/checkpoint",
                         LOAD_INSTANT, "UTC")
    return _landed_parts(spark, f"{root}/out")


def _landed_parts(spark, path):
    back = spark.read.schema("articulokey int, nombrearticulo string, marca string, categoriamkt string, "
                             "`tamaño` string, raw_timestamp timestamp, date_raw_partition date").json(path)
    return back.select("articulokey", "nombrearticulo", "marca", "categoriamkt", "tamaño",
                       _utc("raw_timestamp"), "date_raw_partition")


def landing_job(spark, sf_dir):
    part = _base(spark, sf_dir)["part"]
    path = scratch_path(spark, "landing-part")
    land_table(part, PART_MAPPING, path, LOAD_INSTANT, "UTC")
    return _landed_parts(spark, path)


def family_job(spark, sf_dir):
    _, t = _fixtures(spark, sf_dir)
    fam_path, rel_path = scratch_path(spark, "family-out"), scratch_path(spark, "relation-out")
    params = family_params(stamp=FAMILY_STAMP, stamp_tz="UTC")
    run_family(t, params, fam_path, relation_sink=lambda rel: write_partitioned(rel, rel_path, None, "parquet"))
    return spark.read.schema("family_id int, parentid int").parquet(rel_path)


# -- change detection ----------------------------------------------------------

def _manifests(spark, sf_dir):
    docs = _base(spark, sf_dir)["documents"]
    current = content_hash(docs.where(F.col("doc_id") % 11 != 0), "doc_id", "text")
    edited = F.when(F.col("doc_id") % 7 == 0, F.concat(F.col("text"), F.lit(" (rev)"))).otherwise(F.col("text"))
    previous = content_hash(docs.where(F.col("doc_id") % 10 != 0).withColumn("text", edited), "doc_id", "text")
    return current, previous


def content_hash_q(spark, sf_dir):
    return content_hash(_base(spark, sf_dir)["documents"], "doc_id", "text")


def file_manifest(spark, sf_dir):
    return file_hashes(spark, sf_dir, "*.parquet", key="name")


def detect_changes_q(spark, sf_dir):
    current, previous = _manifests(spark, sf_dir)
    return detect_changes(current, previous)


def detect_changes_first_run(spark, sf_dir):
    """Without a saved manifest everything is new."""
    docs = _base(spark, sf_dir)["documents"]
    saved = load_manifest(spark, scratch_path(spark, "no-manifest"), key_type="long")
    return detect_changes(content_hash(docs, "doc_id", "text"), saved)


def manifest_refresh(spark, sf_dir):
    """An older manifest, other texts and keys, replaced by the current one."""
    docs = _base(spark, sf_dir)["documents"]
    older = docs.withColumn("doc_id", F.col("doc_id") + 1).withColumn("text", F.concat(F.col("text"), F.lit(" (rev)")))
    path = scratch_path(spark, "manifest")
    save_manifest(content_hash(older, "doc_id", "text"), path)
    save_manifest(content_hash(docs, "doc_id", "text"), path)
    return load_manifest(spark, path)


def manifest_refresh_table(spark, sf_dir):
    """A manifest kept as bucketed tables behind a view: refreshed twice, then compared with."""
    current, older = _manifests(spark, sf_dir)
    root, name = scratch_path(spark, "manifest-table"), f"stratal_manifest_{uuid.uuid4().hex[:12]}"
    save_manifest(current, name, buckets=4, location=root)
    save_manifest(older, name, buckets=4, location=root)
    changes = detect_changes(current, load_manifest(spark, name, bucketed=True), include_deleted=True)
    found = changes.groupBy("status").agg(F.count("*").alias("n"), F.max("key").alias("last_key"))
    path = scratch_path(spark, "manifest-changes")
    found.write.parquet(path)
    drop_manifest(spark, name)
    return spark.read.parquet(path)


# -- incremental ---------------------------------------------------------------

def incremental_read(spark, sf_dir):
    events = _base(spark, sf_dir)["events"]
    root = scratch_path(spark, "incremental")
    src, out, ckpt = f"{root}/source", f"{root}/out", f"{root}/checkpoint"
    writer = batch_folder_writer(out)
    for drop, mode in ((0, "overwrite"), (1, "append")):
        events.where(F.col("event_id") % 2 == drop).write.mode(mode).parquet(src)
        run_available_now(spark, src, events.schema, ckpt, writer)
    return spark.read.schema(events.schema).parquet(out).select(*events.columns)


QUERIES: dict[str, Query] = {
    "snapshot_latest": snapshot_latest,
    "snapshot_two_columns": snapshot_two_columns,
    "snapshot_two_columns_disjoint": snapshot_two_columns_disjoint,
    "max_scalar": max_scalar,
    "mapping_typed": mapping_typed,
    "active_products": active_products,
    "filter_in_list": filter_in_list,
    "filter_like": filter_like,
    "window_recent_months": window_recent_months,
    "lookup_left": lookup_left,
    "lookup_left_cast_key": lookup_left_cast_key,
    "lookup_left_two_snapshots": lookup_left_two_snapshots,
    "filter_join": filter_join,
    "dim_join_inner": dim_join_inner,
    "join_shared_name": join_shared_name,
    "join_back_null_keys": join_back_null_keys,
    "star_lookup": star_lookup,
    "product_master": product_master_q,
    "sales_grouped": sales_grouped,
    "recent_sales": recent_sales_q,
    "distinct_groups": distinct_groups_q,
    "dense_rank_global": dense_rank_global_q,
    "family_id": family_id_q,
    "family_id_overflow": family_id_overflow,
    "dedupe_subset": dedupe_subset,
    "dedupe_rows": dedupe_rows_q,
    "family_assign": family_assign,
    "family_table": family_table_q,
    "family_relation": family_relation_q,
    "row_counts": row_counts,
    "relation_order": relation_order,
    "family_table_wide_ids": family_table_wide_ids,
    "lenient_int_edges": lenient_int_edges,
    "window_recent_default": window_recent_default,
    "catalog_read": catalog_read,
    "dynamic_overwrite": dynamic_overwrite,
    "landing_incremental": landing_incremental,
    "landing_catalog_incremental": landing_catalog_incremental,
    "landing_replaced_files": landing_replaced_files,
    "replaced_files_latest": replaced_files_latest,
    "manifest_refresh_table": manifest_refresh_table,
    "row_numbers": row_numbers,
    "max_scalar_footers": max_scalar_footers,
    "sink_rebalanced": sink_rebalanced,
    "detect_changes_first_run": detect_changes_first_run,
    "stamp_load_utc": stamp_load_utc,
    "stamp_load_offset": stamp_load_offset,
    "sink_parquet_partitioned": sink_parquet_partitioned,
    "sink_json_partitioned": sink_json_partitioned,
    "landing_job": landing_job,
    "family_job": family_job,
    "content_hash": content_hash_q,
    "file_manifest": file_manifest,
    "detect_changes": detect_changes_q,
    "manifest_refresh": manifest_refresh,
    "incremental_read": incremental_read,
}
