"""Product labels and literal lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators, the fixed word before the unit count and the
# pattern that marks a sugar-free product. They must equal the source job's
# text for the labels to match.
DASH = "-"
SPACE = " "
UNITS_PREFIX = "BOTELLAS: "
SUGAR_FREE_PATTERN = "%SIN A%"


def lookup_map(c: Column | str, mapping: Mapping) -> Column:
    """CASE-style lookup without ELSE: listed keys map to their value, the
    rest (and null) to null. Built as one literal map so the expression size
    does not grow a branch per entry."""
    col = F.col(c) if isinstance(c, str) else c
    if not mapping:
        return F.lit(None)
    pairs = []
    for key, value in mapping.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.when(col.isNotNull(), F.create_map(*pairs)[col])


def product_labels(brand: str = "desc_marca", sugar: str = "azucar",
                   size: str = "desc_tamano", pack: str = "desc_tipo_empaque",
                   pack_group: str = "desc_tipo_empaque_gen",
                   consumption: str = "desc_tipo_consum_corto",
                   flavour: str = "desc_sabor", units: str = "bote") -> dict[str, Column]:
    """The five composite labels of the product master.

    ``concat`` yields null as soon as one argument is null; that is the
    intended behaviour (a missed lookup gives a null label), so
    ``concat_ws`` must not be used here.
    """
    b, s, z, p = F.col(brand), F.col(sugar), F.col(size).cast("string"), F.col(pack)
    sep = F.lit(SPACE)
    general_plain = F.concat(b, sep, z, sep, p)
    general_sugar = F.concat(b, sep, s, sep, z, sep, p)
    return {
        "marcamkt": F.concat(b, F.lit(DASH), s),
        "formato": F.concat(F.col(pack_group), F.lit(DASH), F.col(consumption)),
        "formatomkt": F.concat(p, F.lit(DASH), z),
        "name_concat": F.concat(b, sep, F.col(flavour), sep, z, sep, p, sep,
                                F.lit(UNITS_PREFIX), F.col(units).cast("string")),
        # A null sugar flag fails the LIKE and takes the plain branch.
        "name_concat_general": F.when(s.like(SUGAR_FREE_PATTERN), general_sugar)
                                .otherwise(general_plain),
    }
