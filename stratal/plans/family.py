"""M3-M5: families of products per plant, the family table and the relation.

Family semantics kept from the source job:

* the family number is a dense rank of (plant, general name) over all
  plants together, ascending with nulls first;
* groups with a null plant or null name use up a number, but the join back
  uses plain equality, so their rows get a null rank and a null family id;
* family id = plant, the text '000', then the rank, read as an int; ids
  that overflow an int become null;
* one row is kept per (plant, product, sku, family id); the survivor is
  made deterministic (smallest by the other selected columns, nulls first).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratal.functions.casts import lenient_int
from stratal.functions.stamps import load_stamps
from stratal.operators.dedupe import dedupe_keep
from stratal.operators.rank import rank_distinct
from stratal.session import materialize

# Column and key names of the published tables.
GROUP_KEYS = ["idplanta", "name_concat_general"]
DEDUPE_KEYS = ["idplanta", "id_prod", "sku", "familyid"]
# Every other selected column, in output order, so the survivor is total.
TIE_BREAK = ["agru_local", "categoria", "marcamkt", "formato", "formatomkt", "cantsubunidades", "sku_padre"]
ASSIGNED_COLUMNS = DEDUPE_KEYS + TIE_BREAK
ROW_KEYS = DEDUPE_KEYS[:3] + ["name_concat_general"]
# Fixed value: the text placed between plant and rank in a family id.
FAMILY_ID_SEPARATOR = "000"

FAMILY_COLUMNS = [
    "idplanta", "articulokey", "categoriamkt", "marcamkt", "formato", "formatomkt",
    "cantsubunidades", "familyid", "sku", "parentid", "process_timestamp", "planta", "fecha",
]
INT_COLUMNS = ["articulokey", "cantsubunidades", "idplanta", "familyid", "sku", "parentid"]


def family_id(plant: Column | str, rank: Column | str, target: str = "int") -> Column:
    """plant || '000' || rank as an integer; null when any part is null or
    the number overflows ``target``."""
    p = F.col(plant) if isinstance(plant, str) else plant
    r = F.col(rank) if isinstance(rank, str) else rank
    return lenient_int(F.concat(p.cast("string"), F.lit(FAMILY_ID_SEPARATOR), r.cast("string")), target)


def sales_products(sales: DataFrame, products: DataFrame, category: str) -> DataFrame:
    """Sales joined to the product master on the shared key, one category.

    The equality filter rejects null categories, so the category lookup of
    the product master becomes an inner join under the optimizer.
    """
    joined = sales.join(products, "id_prod", "inner").where(F.col("categoria") == F.lit(category))
    return joined.select(*DEDUPE_KEYS[:3], *TIE_BREAK, "name_concat_general")


def distinct_groups(rows: DataFrame) -> DataFrame:
    return rows.select(*GROUP_KEYS).distinct()


def rank_groups(rows: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Distinct (plant, name) groups with their global dense rank ``n_grupo``."""
    return rank_distinct(distinct_groups(rows), GROUP_KEYS, "n_grupo", num_partitions)


def attach_ranks(rows: DataFrame, ranked: DataFrame) -> DataFrame:
    """Join ranks back with plain equality: a null key never matches.

    Rows with a null plant or name cannot match, so they bypass the join
    and get a null rank directly. In a shuffle join they would all hash to
    one partition (unlisted cities can be a large share of the rows); here
    they never enter the exchange.
    """
    keyed = F.col(GROUP_KEYS[0]).isNotNull() & F.col(GROUP_KEYS[1]).isNotNull()
    matched = rows.where(keyed).join(ranked.where(keyed), GROUP_KEYS, "left")
    bypass = rows.where(~keyed).withColumn("n_grupo", F.lit(None).cast(ranked.schema["n_grupo"].dataType))
    return matched.unionByName(bypass)


def assign_families(sales: DataFrame, products: DataFrame, category: str,
                    num_partitions: int | None = None, id_type: str = "int",
                    overflow: Observation | None = None) -> DataFrame:
    """Family id for each (plant, product) sold in the window.

    ``overflow``, an ``Observation``, receives ``id_overflow``: the number
    of rows whose id overflowed ``id_type`` (counted while the result is
    computed, no extra pass).

    The sales-product branch feeds both the group ranking and the rows the
    ranks are attached to. It is materialised once as a table in the shared
    checkpoint folder, so the fact scan and aggregation run a single time
    and a lost executor re-reads that table instead of the fact table.
    """
    # The id depends on (plant, name) only, so the survivor of each (plant, product, sku, name) decides; what
    # is stored, joined and deduplicated afterwards is one row per such key, not one per location.
    rows = materialize(dedupe_keep(sales_products(sales, products, category), ROW_KEYS, TIE_BREAK), "family-rows")
    ranked = rank_groups(rows, num_partitions)
    with_ids = attach_ranks(rows, ranked).withColumn("familyid", family_id("idplanta", "n_grupo", id_type))
    if overflow is not None:
        # rows whose plant and rank exist but whose id does not fit ``id_type``
        lost = F.col("idplanta").isNotNull() & F.col("n_grupo").isNotNull() & F.col("familyid").isNull()
        with_ids = with_ids.observe(overflow, F.count_if(lost).alias("id_overflow"))
    return dedupe_keep(with_ids.select(*ASSIGNED_COLUMNS), DEDUPE_KEYS, TIE_BREAK)


def family_table(assigned: DataFrame, as_of: dt.datetime | Column | None = None,
                 tz: str | None = None, id_type: str = "int") -> DataFrame:
    """The published family table; ``id_type`` is the type of ``familyid``
    (the one ``assign_families`` was given, so no id is lost here).

    ``process_timestamp`` and ``fecha`` are text stamps of one instant.
    Whole-row dedupe runs before the int casts, as in the source job, so two
    text keys that cast to the same int may leave equal rows. After
    ``assign_families`` the rows are already unique; the dedupe then runs
    inside the same stage (the keyed partitioning satisfies it), no shuffle.
    """
    stamped = assigned.withColumns(load_stamps(as_of, tz))
    fam = stamped.select(
        "idplanta", F.col("id_prod").alias("articulokey"), F.col("categoria").alias("categoriamkt"),
        "marcamkt", "formato", "formatomkt", "cantsubunidades", "familyid", "sku",
        F.col("sku_padre").alias("parentid"), "process_timestamp", F.col("agru_local").alias("planta"),
        "fecha",
    ).distinct()
    return fam.withColumns({c: lenient_int(c, id_type if c == "familyid" else "int") for c in INT_COLUMNS}).select(
        *FAMILY_COLUMNS)


def family_relation(families: DataFrame, ordered: bool = True) -> DataFrame:
    """Distinct (family_id, parentid) pairs, ordered by family id (nulls
    first) unless ``ordered`` is false. The order is for files and display; a
    table target does not keep it, so the global sort is left out there."""
    pairs = families.select(F.col("familyid").alias("family_id"), "parentid").distinct()
    return pairs.orderBy(F.col("family_id").asc_nulls_first()) if ordered else pairs
