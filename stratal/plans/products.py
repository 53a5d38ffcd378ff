"""M1: the product master (newest snapshot, active rows, six lookups, labels)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from stratal.functions.labels import product_labels
from stratal.operators.enrich import DimSpec, enrich
from stratal.operators.predicates import active_products
from stratal.operators.snapshot import latest_snapshot

TWO_VERSIONS = ("process_timestamp", "raw_timestamp")

OUTPUT_COLUMNS = [
    "id_prod", "categoria", "marcamkt", "formato", "formatomkt", "cantsubunidades",
    "sku", "sku_padre", "desc_sabor", "name_concat", "name_concat_general",
]


def product_specs(tables: Mapping[str, DataFrame], with_flavour: bool = True) -> list[DimSpec]:
    """The six lookups of the product master.

    The brand key is text on the product side and numeric on the dimension
    side, so the dimension key is cast to text: '01' does not match 1. The
    pack dimension is versioned on two columns.
    """
    specs = [
        DimSpec(tables["d_marca"], "id_marca", ["desc_marca"], key_cast="string"),
        DimSpec(tables["d_tamano"], "id_tamano", ["desc_tamano"]),
        DimSpec(tables["d_tipo_empaque"], "id_tipo_empaque",
                ["desc_tipo_empaque", "desc_tipo_empaque_gen"], snapshot_cols=TWO_VERSIONS),
        DimSpec(tables["d_sabor"], "id_sabor", ["desc_sabor"]),
        DimSpec(tables["d_categoria"], "id_catego", ["desc_catego"]),
        DimSpec(tables["d_tipo_consum"], "id_tipo_consum", ["desc_tipo_consum_corto"]),
    ]
    if not with_flavour:
        specs = [s for s in specs if "desc_sabor" not in s.columns]
    return specs


def current_products(d_prod: DataFrame, valid_after: dt.date | str, sku_below: float) -> DataFrame:
    """Newest snapshot of the product table, active rows only."""
    return active_products(latest_snapshot(d_prod), valid_after, sku_below)


def product_master(tables: Mapping[str, DataFrame], valid_after: dt.date | str,
                   sku_below: float, with_flavour: bool = True) -> DataFrame:
    """One row per active product with category and composite labels.

    The product table's version filter and validity predicates are applied
    before the lookups, so they reach the scan of the product table.

    ``with_flavour=False`` leaves out the flavour lookup and the two columns
    built from it (``desc_sabor``, ``name_concat``). The family pipeline uses
    none of them; the optimizer cannot drop an unused left join by itself
    because it cannot prove the dimension key unique, and any rows a
    duplicate flavour key would add are removed by the family dedupe.
    """
    prods = current_products(tables["d_prod"], valid_after, sku_below).select(
        "id_prod", "id_marca", "id_tamano", "id_tipo_empaque", "id_sabor", "id_catego",
        "id_tipo_consum", "bote", "sku", "sku_padre", "azucar")
    wide = enrich(prods, product_specs(tables, with_flavour))
    labels = product_labels()
    if not with_flavour:
        labels.pop("name_concat")
    cols = [c for c in OUTPUT_COLUMNS if with_flavour or c not in ("desc_sabor", "name_concat")]
    renamed = {"categoria": wide["desc_catego"].alias("categoria"),
               "cantsubunidades": wide["bote"].alias("cantsubunidades")}
    return wide.withColumns(labels).select(*[renamed.get(c, c) for c in cols])
