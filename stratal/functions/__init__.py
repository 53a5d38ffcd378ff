"""Column expressions (all JVM built-ins, no Python per row)."""

from stratal.functions.casts import lenient_int, ts_ntz
from stratal.functions.labels import lookup_map, product_labels
from stratal.functions.stamps import load_stamps, stamp_load

__all__ = ["lenient_int", "ts_ntz", "lookup_map", "product_labels",
           "load_stamps", "stamp_load"]
