"""M2: recent sales per location and product, with the plant of the location."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratal.functions.labels import lookup_map
from stratal.operators.predicates import in_list, recent_window
from stratal.operators.snapshot import latest_snapshot
from stratal.plans.products import current_products

OUTPUT_COLUMNS = ["id_localidad", "agru_local", "id_prod", "cajas_fisicas", "ultima_compra", "idplanta"]


def recent_sales(tables: Mapping[str, DataFrame], as_of: dt.date | str | None, months: int,
                 tx_types: Iterable[int], plant_map: Mapping[str, int],
                 valid_after: dt.date | str, sku_below: float) -> DataFrame:
    """Sum of units and last purchase date over the last ``months`` months,
    per (location, location group, product), for sales of active products.

    The fact rows are first cut to active products by a semi join on the
    distinct product keys (a broadcast while those are small), then aggregated
    to (location, product) *before* the joins: the map-side partial aggregate
    shrinks the fact rows to one per key and task, so the shuffle carries the
    keys of active products, not sales lines, and a hot product is combined
    before it moves. The product join after it is inner (not semi) and the
    result re-aggregated on the output keys, so duplicate keys in a dimension
    snapshot multiply the sums exactly as a join-then-group would; the outer
    sum has the type of the inner one, as a single sum would.
    When both joins broadcast, the final aggregate reuses the
    (location, product) partitioning and adds no shuffle.
    """
    sales = in_list(recent_window(tables["h_ventas"], "fecha", months, as_of),
                    "id_tipo_transaccion", tx_types)
    products = current_products(tables["d_prod"], valid_after, sku_below).select("id_prod")
    per_key = (sales.join(products.distinct(), "id_prod", "left_semi").groupBy("id_localidad", "id_prod")
               .agg(F.sum("cajas_fisicas").alias("cajas_fisicas"), F.max("fecha").alias("ultima_compra")))
    units = per_key.schema["cajas_fisicas"].dataType
    places = latest_snapshot(tables["d_localidad"]).select("id_localidad", "agru_local")
    joined = per_key.join(products, "id_prod").join(places, "id_localidad")
    out = joined.groupBy("id_localidad", "agru_local", "id_prod").agg(
        F.sum("cajas_fisicas").cast(units).alias("cajas_fisicas"), F.max("ultima_compra").alias("ultima_compra"))
    return out.withColumn("idplanta", lookup_map("agru_local", plant_map).cast("int")).select(*OUTPUT_COLUMNS)
