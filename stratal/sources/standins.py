"""Versioned dimension and fact tables derived from the TPC-H-like test tables.

The source job reads warehouse tables that are not available here. These
stand-ins give them the same shape (see FIXTURES.md §3): a current snapshot
stamped T2, a stale copy stamped T1 whose labels read ``STALE`` so that any
leak of an old version is visible, a brand missing from the brand dimension,
a pack id excluded by its second version column, and sizes that share a
label. Everything is a lazy projection of the given tables, so it grows
with them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratal.functions.casts import ts_ntz
from stratal.sources.tables import LazyTables

# Fixed values of the stand-ins (shared with the SQL oracle).
T2 = "2000-06-01 00:00:00"
T1 = "2000-05-01 00:00:00"
STALE = "STALE"
MISSING_BRAND = "Brand#5"
PROMO_TYPES = ("PROMO", "ECONOMY")
NULL_CATEGORY_TYPE = "SMALL"
AS_OF = "2000-06-30"
MONTHS = 3
TX_TYPES = (2, 3, 4, 5, 6)
SKU_BELOW = 1500
VALID_AFTER = "2000-01-01"
CATEGORY = "STILL"
PLANT_MAP = {"NATION_3": 1, "NATION_8": 2, "NATION_12": 3, "NATION_13": 4,
             "NATION_15": 5, "NATION_18": 6, "NATION_19": 7}


def _text(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _brand_digits() -> Column:
    return F.substr(F.col("p_brand"), F.lit(7))


def _sku() -> Column:
    """A bounded sku from the price: about half the products pass the sku
    bound at every scale, and nothing about it follows from the product key."""
    return (F.round(F.col("p_retailprice") * 100).cast("bigint") * 7) % 3000


def d_prod(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    current = part.select(
        F.col("p_partkey").alias("id_prod"),
        _brand_digits().alias("id_marca"),
        size.alias("id_tamano"),
        F.col("p_type").alias("id_catego"),
        (size % 5).alias("id_tipo_empaque"),
        (size % 6).alias("id_sabor"),
        (size % 2).alias("id_tipo_consum"),
        size.alias("bote"),
        _sku().alias("sku"),
        (F.col("p_partkey") % 50).alias("sku_padre"),
        F.when(size % 3 == 0, "SIN AZUCAR").when(size % 3 == 1, "CON AZUCAR").alias("azucar"),
        F.when(size % 7 == 0, "S").when(size % 7 == 1, F.lit(None)).otherwise("N").alias("suprimido"),
        F.when(size % 11 == 0, F.lit("2000-01-01").cast("date")).alias("fech_supr"),
        F.when(size % 13 == 0, F.lit("1999-12-31").cast("date"))
         .otherwise(F.lit("2001-12-31").cast("date")).alias("ffin_vreg"),
        ts_ntz(T2).alias("process_timestamp"),
    )
    stale = part.select(
        F.col("p_partkey").alias("id_prod"), F.lit("0").alias("id_marca"), F.lit(0).alias("id_tamano"),
        F.lit("0").alias("id_catego"), F.lit(0).alias("id_tipo_empaque"), F.lit(0).alias("id_sabor"),
        F.lit(0).alias("id_tipo_consum"), size.alias("bote"), _sku().alias("sku"),
        F.lit(-1).cast("bigint").alias("sku_padre"), F.lit(STALE).alias("azucar"),
        F.lit("N").alias("suprimido"), F.lit(None).cast("date").alias("fech_supr"),
        F.lit("2001-12-31").cast("date").alias("ffin_vreg"), ts_ntz(T1).alias("process_timestamp"),
    )
    return current.unionByName(stale)


def d_marca(part: DataFrame) -> DataFrame:
    brands = part.select("p_brand").distinct()
    key = _brand_digits().cast("int").alias("id_marca")
    current = brands.where(F.col("p_brand") != MISSING_BRAND).select(
        key, _text("M", _brand_digits()).alias("desc_marca"), ts_ntz(T2).alias("process_timestamp"))
    stale = brands.select(key, F.lit(STALE).alias("desc_marca"), ts_ntz(T1).alias("process_timestamp"))
    return current.unionByName(stale)


def d_tamano(part: DataFrame) -> DataFrame:
    sizes = part.select(F.col("p_size").alias("id_tamano")).distinct()
    current = sizes.select("id_tamano", _text("T", F.col("id_tamano") % 4).alias("desc_tamano"),
                           ts_ntz(T2).alias("process_timestamp"))
    stale = sizes.select("id_tamano", F.lit(STALE).alias("desc_tamano"), ts_ntz(T1).alias("process_timestamp"))
    return current.unionByName(stale)


def d_tipo_empaque(part: DataFrame) -> DataFrame:
    ids = part.select((F.col("p_size") % 5).alias("id_tipo_empaque")).distinct()
    k = F.col("id_tipo_empaque")
    return ids.select(
        k, _text("E", k).alias("desc_tipo_empaque"), _text("G", k).alias("desc_tipo_empaque_gen"),
        ts_ntz(T2).alias("process_timestamp"),
        F.when(k == 4, ts_ntz(T1)).otherwise(ts_ntz(T2)).alias("raw_timestamp"))


def d_tipo_empaque_disjoint(part: DataFrame) -> DataFrame:
    """Pack dimension whose two version maxima never meet on one row."""
    ids = part.select((F.col("p_size") % 5).alias("id_tipo_empaque")).distinct()
    k = F.col("id_tipo_empaque")
    even = k % 2 == 0
    return ids.select(
        k, _text("E", k).alias("desc_tipo_empaque"), _text("G", k).alias("desc_tipo_empaque_gen"),
        F.when(even, ts_ntz(T2)).otherwise(ts_ntz(T1)).alias("process_timestamp"),
        F.when(even, ts_ntz(T1)).otherwise(ts_ntz(T2)).alias("raw_timestamp"))


def _small_dim(part: DataFrame, modulus: int, key: str, desc: str, prefix: str) -> DataFrame:
    ids = part.select((F.col("p_size") % modulus).alias(key)).distinct()
    return ids.select(key, _text(prefix, F.col(key)).alias(desc), ts_ntz(T2).alias("process_timestamp"))


def d_sabor(part: DataFrame) -> DataFrame:
    return _small_dim(part, 6, "id_sabor", "desc_sabor", "S")


def d_tipo_consum(part: DataFrame) -> DataFrame:
    return _small_dim(part, 2, "id_tipo_consum", "desc_tipo_consum_corto", "C")


def d_categoria(part: DataFrame) -> DataFrame:
    types = part.select(F.col("p_type").alias("id_catego")).distinct()
    t = F.col("id_catego")
    desc = F.when(t.isin(*PROMO_TYPES), F.lit("STILL")).when(t == NULL_CATEGORY_TYPE, F.lit(None)).otherwise(t)
    return types.select("id_catego", desc.cast("string").alias("desc_catego"), ts_ntz(T2).alias("process_timestamp"))


def d_localidad(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    places = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select(
        F.col("s_suppkey").alias("id_localidad"), F.col("n_name").alias("agru_local"))
    current = places.select("id_localidad", "agru_local", ts_ntz(T2).alias("process_timestamp"))
    stale = places.select("id_localidad", F.lit(STALE).alias("agru_local"), ts_ntz(T1).alias("process_timestamp"))
    return current.unionByName(stale)


def h_ventas(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_suppkey").alias("id_localidad"), F.col("l_partkey").alias("id_prod"),
        F.col("l_quantity").alias("cajas_fisicas"), F.col("l_shipdate").cast("date").alias("fecha"),
        F.col("l_linenumber").alias("id_tipo_transaccion"))


def standin_tables(base: Mapping[str, DataFrame]) -> LazyTables:
    """All stand-ins keyed by the names the pipelines expect, each built on
    first use."""
    return LazyTables({
        "d_prod": lambda: d_prod(base["part"]),
        "d_marca": lambda: d_marca(base["part"]),
        "d_tamano": lambda: d_tamano(base["part"]),
        "d_tipo_empaque": lambda: d_tipo_empaque(base["part"]),
        "d_sabor": lambda: d_sabor(base["part"]),
        "d_categoria": lambda: d_categoria(base["part"]),
        "d_tipo_consum": lambda: d_tipo_consum(base["part"]),
        "d_localidad": lambda: d_localidad(base["supplier"], base["nation"]),
        "h_ventas": lambda: h_ventas(base["lineitem"]),
    })


def family_params(**overrides):
    """FamilyParams with the values used on the test tables."""
    from stratal.plans.jobs import FamilyParams

    values = dict(plant_map=PLANT_MAP, tx_types=TX_TYPES, valid_after=VALID_AFTER, sku_below=SKU_BELOW,
                  category=CATEGORY, months=MONTHS, as_of=AS_OF)
    values.update(overrides)
    return FamilyParams(**values)
