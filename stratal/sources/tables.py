"""Named table reads.

A table is a catalog name (``db.table``) or a path. Reads return lazy
DataFrames; column pruning and filters reach the scan through the optimizer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet",
               schema: str | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """``spark.table`` for a catalog name, else a file read in ``fmt``."""
    if is_table_name(name_or_path):
        return spark.table(name_or_path)
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(name_or_path)


def is_table_name(source: str) -> bool:
    """Whether ``source`` is a catalog name rather than a path."""
    return "/" not in source and ":" not in source


@dataclass(frozen=True)
class TableFiles:
    """Where and how a file-based catalog table is stored."""

    name: str
    location: str
    fmt: str
    schema: StructType
    options: Mapping[str, str] = field(default_factory=dict)


#: The formats whose tables are plain files that can be listed and read by path.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def table_files(spark: SparkSession, name: str) -> TableFiles:
    """Location, format, options and schema of a file-based catalog table.

    Views and tables of other formats are refused: they have no files of
    their own to follow. Partitions stored outside the table's location are
    not seen by readers of that location.
    """
    if not spark.catalog.tableExists(name):
        raise ValueError(f"no table {name} in the catalog")
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    heads = [i for i, r in enumerate(rows) if r["col_name"] == "# Detailed Table Information"]
    details = {r["col_name"]: r["data_type"] for r in rows[heads[0] + 1:]} if heads else {}
    fmt = (details.get("Provider") or "").lower()
    if details.get("Type") == "VIEW" or fmt not in FILE_FORMATS or not details.get("Location"):
        raise ValueError(f"{name} is not a file-based table ({details.get('Type')}, {fmt or 'no format'})")
    options = {}
    for pair in (details.get("Storage Properties") or "").strip("[]").split(", "):
        key, eq, value = pair.partition("=")
        if eq and key not in ("serialization.format", "path"):
            options[key] = value
    return TableFiles(name, details["Location"], fmt, spark.table(name).schema, options)


_V1_FORMATS = "spark.sql.sources.useV1SourceList"


def footer_relation(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder opened so that MIN, MAX and COUNT of whole files can
    be answered from the file footers (with the session setting
    ``spark.sql.parquet.aggregatePushdown``; without it columns are scanned)."""
    before = spark.conf.get(_V1_FORMATS)
    try:
        spark.conf.set(_V1_FORMATS, ",".join(f for f in before.split(",") if f.strip() != "parquet"))
        return spark.read.parquet(path)
    finally:
        spark.conf.set(_V1_FORMATS, before)


class LazyTables(Mapping[str, DataFrame]):
    """A name → DataFrame mapping whose frames are built on first access.

    Building a frame is driver work: opening a file-based table lists its
    files and reads a footer, and every DataFrame call is analysed. A query
    that touches two tables of a folder should pay for those two only.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def load_tables(spark: SparkSession, base: str, names: Iterable[str] = TEST_TABLES,
                fmt: str = "parquet", suffix: str = ".parquet") -> LazyTables:
    """``{name: DataFrame}`` for ``base/<name><suffix>``, each table opened
    when first used."""
    root = base.rstrip("/")

    def opener(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.format(fmt).load(f"{root}/{name}{suffix}")

    return LazyTables({n: opener(n) for n in names})


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose each frame as a temporary view under its key."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
