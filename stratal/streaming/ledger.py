"""Incremental reads that also notice replaced files.

A file stream remembers file names, so a file rewritten under its name is
never read again. Here a ledger keeps a fingerprint (size and modification
time) of every file that was handed over. A run lists the source's files,
compares them with the ledger through ``detect_changes`` and hands over the
new and the replaced ones, in bounded batches, oldest first.

The ledger is a folder that only grows:

* ``plan/batch=<n>`` names the files of batch n; it is written before the
  batch is processed. A plan without a commit belongs to a run that broke
  off: the next run hands the same files over again under the same number, so
  a writer that keys its output by the batch number replaces what was half done.
* ``done/batch=<n>`` holds the fingerprints of the files of batch n. It is
  written after the batch function returned, and is complete once its
  ``_SUCCESS`` file exists. The latest entry of a file counts.
* after ``COMPACT_AFTER`` batches the entries are merged into one.

Files are listed and compared as DataFrames; the driver sees the names of one
batch (``max_files_per_batch``). A file replaced between the listing and the
read is handed over again by the next run (its fingerprint differs from the
one recorded); no file is passed over.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratal.operators.changes import CHANGED, NEW, detect_changes
from stratal.session import glob_paths, path_exists, qualified, remove_path, scratch_path
from stratal.sources.tables import is_table_name, table_files

FILES_PER_BATCH = 10_000  # names of one batch, held on the driver
COMPACT_AFTER = 50


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(key, hash, modified) of the data files below ``path``: the path below
    it, "<size>:<modification time in microseconds>", and that time. Reads
    file statuses, no contents; hidden files (``_`` and ``.``) are left out."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    root = qualified(spark, path).rstrip("/") + "/"
    files = reader.load(path).select("path", "length", "modificationTime")
    key = F.regexp_replace("path", "^" + re.escape(root), "")
    stamp = F.concat_ws(":", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    return files.select(key.alias("key"), stamp.alias("hash"), F.col("modificationTime").alias("modified"))


def _literal(path: str) -> str:
    """The path with the characters that readers take for patterns escaped."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _below(root: str) -> str:
    """The path part of a root URI, with a slash behind it."""
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", root) + "/"


class FileLedger:
    """What was handed over of a source, in a folder on shared storage."""

    SCHEMA = "key string, hash string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path.rstrip("/")

    def _numbers(self, part: str) -> list[int]:
        found = glob_paths(self.spark, f"{self.root}/{part}/batch=*/_SUCCESS")
        return sorted(int(p.rsplit("/", 2)[1].removeprefix("batch=")) for p in found)

    def _path(self, part: str, number: int) -> str:
        return f"{self.root}/{part}/batch={number:010d}"

    def _merged(self) -> int:
        """The last batch that a merged state covers (-1: none)."""
        return max(self._numbers("state"), default=-1)

    def entries(self) -> DataFrame:
        """(key, hash): the latest fingerprint of every file handed over."""
        merged = self._merged()
        paths = [self._path("done", n) for n in self._numbers("done") if n > merged]
        parts = [self.spark.read.schema(self.SCHEMA).parquet(self._path("state", merged)).withColumn("batch", F.lit(merged))] \
            if merged >= 0 else []
        if paths:
            number = F.regexp_extract(F.col("_metadata.file_path"), r"batch=(\d+)/", 1).cast("int")
            parts.append(self.spark.read.schema(self.SCHEMA).parquet(*paths).select("key", "hash", number.alias("batch")))
        if not parts:
            return self.spark.createDataFrame([], self.SCHEMA)
        every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return every.groupBy("key").agg(F.max_by("hash", "batch").alias("hash"))

    def pending(self) -> tuple[int, list[str]] | None:
        """(number, files) of a planned batch that was not committed."""
        left = set(self._numbers("plan")) - set(self._numbers("done"))
        left = {n for n in left if n > self._merged()}
        if not left:
            return None
        number = min(left)
        rows = self.spark.read.schema("key string").parquet(self._path("plan", number)).collect()
        return number, sorted(r["key"] for r in rows)

    def plan(self, keys: list[str]) -> int:
        """Announce the next batch; its number."""
        number = max(self._numbers("plan") + self._numbers("done") + [self._merged()], default=-1) + 1
        frame = self.spark.createDataFrame([(k,) for k in keys], "key string").coalesce(1)
        frame.write.mode("overwrite").parquet(self._path("plan", number))
        return number

    def commit(self, number: int, entries: list[tuple[str, str]]) -> None:
        frame = self.spark.createDataFrame(entries, self.SCHEMA).coalesce(1)
        frame.write.mode("overwrite").parquet(self._path("done", number))

    def compact(self, after: int = COMPACT_AFTER) -> bool:
        """Merge the entries into one state once ``after`` batches are apart
        from it; the batches and the state before go only when it is complete."""
        merged, done = self._merged(), self._numbers("done")
        fresh = [n for n in done if n > merged]
        if len(fresh) < after:
            return False
        last = fresh[-1]
        self.entries().write.mode("overwrite").parquet(self._path("state", last))
        self.tidy()
        return True

    def tidy(self) -> None:
        """Remove what the newest complete state covers."""
        merged = self._merged()
        for part in ("plan", "done", "state"):
            for n in self._numbers(part):
                if n < merged or (n == merged and part != "state"):
                    remove_path(self.spark, self._path(part, n))

    def is_new(self) -> bool:
        return not (self._numbers("done") or self._numbers("plan") or self._merged() >= 0)


def run_changed_files(spark: SparkSession, source: str, ledger: str, batch_fn: Callable[[DataFrame, int], None],
                      schema: StructType | None = None, fmt: str = "parquet", max_files_per_batch: int = FILES_PER_BATCH,
                      glob: str | None = None, options: Mapping[str, str] | None = None,
                      file_column: str | None = None) -> dict[str, int]:
    """Hand the new and the replaced files of ``source`` to ``batch_fn``.

    ``source`` is a folder, or the catalog name of a file-based table: then
    schema, format, options and location come from the catalog (an explicit
    ``schema`` is refused). Each batch is one DataFrame of whole files with
    the table's columns (partition columns included); ``file_column`` adds
    the path of a row's file below the source, by which a reader can replace
    what an earlier version of the file left. If the function raises, the
    batch stays planned and is repeated. Returns the numbers of batches and
    of new, replaced and repeated files.

    Defined cases: an empty source hands over nothing; a file that vanished
    keeps its entry (if it comes back unchanged it is not read again); a
    planned file that vanished before the repetition is left out of it; an
    output named by ``batch_fn.output`` that holds batches is refused while
    the ledger is new.
    """
    table = table_files(spark, source) if is_table_name(source) else None
    if table is not None:
        if schema is not None:
            raise ValueError(f"{source} is a catalog table; its schema comes from the catalog")
        path, schema, fmt, options = table.location, table.schema, table.fmt, {**table.options, **(options or {})}
    elif schema is None:
        raise ValueError("a folder needs an explicit schema")
    else:
        path = source
    book = FileLedger(spark, ledger)
    output = getattr(batch_fn, "output", None)
    if output is not None and book.is_new():
        refuse_batches_without_record(spark, ledger, output)
    book.tidy()
    root = qualified(spark, path).rstrip("/")
    counts = {"batches": 0, "new": 0, "replaced": 0, "repeated": 0}

    def hand_over(number: int, entries: list[tuple[str, str]]) -> None:
        if entries:
            reader = spark.read.schema(schema).format(fmt).options(**(options or {})).option("basePath", root)
            rows = reader.load([_literal(f"{root}/{key}") for key, _ in entries])
            if file_column is not None:
                plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
                rows = rows.select("*", F.regexp_replace(plain, "^.*?" + re.escape(_below(root)), "").alias(file_column))
            batch_fn(rows, number)
        book.commit(number, entries)
        counts["batches"] += 1

    left = book.pending()
    if left is not None:
        number, keys = left
        wanted = spark.createDataFrame([(k,) for k in keys], "key string")
        files = list_files(spark, path, glob).join(F.broadcast(wanted), "key", "left_semi").select("key", "hash")
        entries = sorted(tuple(r) for r in files.collect())
        hand_over(number, entries)
        counts["repeated"] += len(entries)
    # one listing and one comparison per run: files that arrive during it belong to the next
    if path_exists(spark, path):
        listed = list_files(spark, path, glob)
        status = detect_changes(listed.select("key", "hash"), book.entries())
        place = scratch_path(spark, "changed-files")
        status.where(F.col("status").isin(NEW, CHANGED)).join(listed.select("key", "modified"), "key").write.parquet(place)
        try:
            last = None
            while batch := _after(spark.read.parquet(place), last, max_files_per_batch):
                number = book.plan([r["key"] for r in batch])
                hand_over(number, [(r["key"], r["hash"]) for r in batch])
                counts["new"] += sum(r["status"] == NEW for r in batch)
                counts["replaced"] += sum(r["status"] == CHANGED for r in batch)
                last = batch[-1]
        finally:
            remove_path(spark, place)
    book.compact()
    return counts


def _after(todo: DataFrame, last: Row | None, n: int) -> list[Row]:
    """The next ``n`` files behind ``last``, oldest first."""
    if last is not None:
        same, later = F.col("modified") == F.lit(last["modified"]), F.col("modified") > F.lit(last["modified"])
        todo = todo.where(later | (same & (F.col("key") > F.lit(last["key"]))))
    return todo.orderBy("modified", "key").limit(n).collect()


def refuse_batches_without_record(spark: SparkSession, record: str, output: str) -> None:
    """A new record numbers batches from 0 again and would replace what
    earlier batches wrote."""
    root = output.rstrip("/")
    if glob_paths(spark, f"{root}/batch_id=*") or glob_paths(spark, f"{root}/*/batch_id=*"):
        raise RuntimeError(f"{output} holds batches but {record} is new; restore it or choose another output")
