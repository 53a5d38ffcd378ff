"""Incremental reads: each run processes only files that arrived since the
last successful run.

A file stream with a checkpoint location remembers which files were
committed. ``trigger(availableNow=True)`` processes everything new in
bounded micro-batches and stops, so a scheduled batch job becomes
incremental. If the batch function raises, the batch is not committed and
the next run hands the same files over again with the same batch id;
writing each batch to a folder keyed by that id (overwrite) makes the
replay idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stratal.session import glob_paths, path_exists, remove_path
from stratal.sources.tables import is_table_name, table_files

BATCH_COLUMN = "batch_id"


def batch_folder_writer(out_path: str, fmt: str = "parquet",
                        partition_by: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function writing batch ``b`` to ``out_path/batch_id=b``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite").format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{out_path.rstrip('/')}/{BATCH_COLUMN}={batch_id}")

    write.output = out_path
    return write


def land_batch_writer(out_path: str, partition_col: str, fmt: str = "json",
                      compression: str | None = "gzip") -> Callable[[DataFrame, int], None]:
    """foreachBatch function writing batch ``b`` to
    ``out_path/<partition_col>=<value>/batch_id=b``. Folders an earlier
    attempt of the batch left under any value are removed first."""
    root = out_path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        for old in glob_paths(batch.sparkSession, f"{root}/*/{BATCH_COLUMN}={batch_id}"):
            remove_path(batch.sparkSession, old)
        writer = batch.withColumn(BATCH_COLUMN, F.lit(batch_id)).write.mode("append").format(fmt)
        if compression:
            writer = writer.option("compression", compression)
        writer.partitionBy(partition_col, BATCH_COLUMN).save(root)

    write.output = out_path
    return write


def _refuse_lost_checkpoint(spark: SparkSession, checkpoint: str, output: str) -> None:
    """A new checkpoint numbers batches from 0 again and would replace what
    earlier batches wrote."""
    root = output.rstrip("/")
    if not path_exists(spark, f"{checkpoint.rstrip('/')}/offsets") and (
            glob_paths(spark, f"{root}/{BATCH_COLUMN}=*") or glob_paths(spark, f"{root}/*/{BATCH_COLUMN}=*")):
        raise RuntimeError(f"{output} holds batches but the checkpoint {checkpoint} is new; restore the checkpoint or "
                           "choose another output")


def source_stream(spark: SparkSession, source: str, schema: StructType | None = None, fmt: str = "parquet",
                  options: Mapping[str, str] | None = None) -> DataFrame:
    """A file stream over a folder (explicit schema, no inference) or over a
    file-based catalog table, whose schema, format and location come from
    the catalog."""
    reader = spark.readStream.options(**(options or {}))
    if is_table_name(source):
        if schema is not None:
            raise ValueError(f"{source} is a catalog table; its schema comes from the catalog")
        table_files(spark, source)  # refuses views and tables without files
        return reader.table(source)
    if schema is None:
        raise ValueError("a folder needs an explicit schema")
    return reader.schema(schema).format(fmt).load(source)


def run_available_now(spark: SparkSession, source_path: str, schema: StructType | None, checkpoint: str,
                      batch_fn: Callable[[DataFrame, int], None], fmt: str = "parquet",
                      max_files_per_batch: int | None = None,
                      transform: Callable[[DataFrame], DataFrame] | None = None,
                      timeout_s: float | None = None,
                      options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Process every file of ``source_path`` not yet committed in
    ``checkpoint``, then stop. The source is a folder with an explicit schema
    (no inference on a stream), or the name of a file-based catalog table
    with ``schema`` None. ``max_files_per_batch`` bounds each micro-batch; ``transform``
    is applied to the stream (e.g. the landing mapping and stamps);
    ``options`` go to the file source (``cleanSource``/``sourceArchiveDir``
    to move processed files away, ``maxFileAge`` to bound the listing).

    A run still going after ``timeout_s`` seconds is stopped and raises
    ``TimeoutError``; the next run goes on after the last committed batch. A
    batch function with an ``output`` path is refused when that holds batches
    while the checkpoint is new."""
    output = getattr(batch_fn, "output", None)
    if output is not None:
        _refuse_lost_checkpoint(spark, checkpoint, output)
    given = dict(options or {})
    if max_files_per_batch:
        given["maxFilesPerTrigger"] = str(max_files_per_batch)
    stream = source_stream(spark, source_path, schema, fmt, given)
    if transform is not None:
        stream = transform(stream)
    query = (stream.writeStream.foreachBatch(batch_fn)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"the run was stopped after {timeout_s} s; files not yet committed stay for the next run")
    if query.exception() is not None:
        raise query.exception()
    return query
