"""Settings of the source jobs, for users switching from them.

The library takes every constant as a parameter; these presets hold the
values the source jobs used, so the same runs can be reproduced.
"""

from __future__ import annotations

from stratal.operators.mapping import Mapping, mappings_from_tuples

# The family job's settings (plants by location group, sales
# transaction types, sku bound, validity date, category, months back).
SOURCE_PLANT_MAP = {
    "COCHABAMBA": 1,
    "LA PAZ": 2,
    "ORURO": 3,
    "POTOSI": 4,
    "SANTA CRUZ": 5,
    "SUCRE": 6,
    "TARIJA": 7,
}
SOURCE_TX_TYPES = (9, 10, 11, 12, 13)
SOURCE_SKU_BELOW = 3000
SOURCE_VALID_AFTER = "2025-01-01"
SOURCE_CATEGORY = "STILL"
SOURCE_MONTHS = 3

# The landing job's column mapping (source, source type,
# target, target type), in the job's order.
ARTICLE_MAPPING_ROWS = [
    ("retornabilidadmkt", "string", "retornabilidadmkt", "string"),
    ("marcamkt", "string", "marcamkt", "string"),
    ("nombrearticulo", "string", "nombrearticulo", "string"),
    ("familia", "string", "familia", "string"),
    ("tipo_articulo", "string", "tipo_articulo", "string"),
    ("consumo", "string", "consumo", "string"),
    ("retornabilidad", "string", "retornabilidad", "string"),
    ("isscom", "string", "isscom", "string"),
    ("categoriamkt", "string", "categoriamkt", "string"),
    ("endulzante", "string", "endulzante", "string"),
    ("formatomkt", "string", "formatomkt", "string"),
    ("articulokey", "int", "articulokey", "int"),
    ("dun", "string", "dun", "string"),
    ("tamaño", "string", "tamaño", "string"),
    ("cuentacontable", "string", "cuentacontable", "string"),
    ("tipo_envase", "string", "tipo_envase", "string"),
    ("subcategoriamkt", "string", "subcategoriamkt", "string"),
    ("sabor", "string", "sabor", "string"),
    ("material", "string", "material", "string"),
    ("empaquemkt", "string", "empaquemkt", "string"),
    ("formato", "string", "formato", "string"),
    ("marcatm", "string", "marcatm", "string"),
    ("ean", "string", "ean", "string"),
    ("marca", "string", "marca", "string"),
    ("familiamkt", "string", "familiamkt", "string"),
    ("diakey", "int", "diakey", "int"),
    ("articuloid", "string", "articuloid", "string"),
]
# The landing job stamps its load instant at this fixed UTC offset.
SOURCE_LOAD_OFFSET = "-04:00"


def article_mapping() -> list[Mapping]:
    return mappings_from_tuples(ARTICLE_MAPPING_ROWS)


def source_family_params(**overrides):
    """FamilyParams with the family job's values; ``as_of`` defaults to today."""
    from stratal.plans.jobs import FamilyParams

    values = dict(plant_map=SOURCE_PLANT_MAP, tx_types=SOURCE_TX_TYPES, valid_after=SOURCE_VALID_AFTER,
                  sku_below=SOURCE_SKU_BELOW, category=SOURCE_CATEGORY, months=SOURCE_MONTHS)
    values.update(overrides)
    return FamilyParams(**values)
