"""Session construction and the shared folder used for lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "stratal", extra: dict | None = None) -> SparkSession:
    """A session with the settings this library is tested under.

    Adaptive execution stays on (runtime broadcast choice, partition
    coalescing, skew-join splitting). The session zone is pinned to UTC so
    that date stamps do not depend on the machine clock zone.
    """
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.aggregatePushdown", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_checkpoint_dir(spark)
    return spark


def scale_settings(total_cores: int, shuffle_bytes: int | None = None,
                   target_partition_bytes: int = 256 << 20, broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Settings for a large cluster, to pass as ``extra`` or to spark-submit.

    Shuffle partitions start high (at least 3 waves of tasks, or the
    expected shuffle volume over the target partition size) and adaptive
    execution coalesces them down to the advisory size at run time, so one
    setting serves both the small and the large stages; skewed partitions
    are split. Scan splits match the target size. The broadcast threshold
    bounds what may be broadcast (dimension snapshots); larger sides are
    shuffle-joined.
    """
    partitions = 3 * total_cores
    if shuffle_bytes:
        partitions = max(partitions, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }


_NEEDS_DIR = "set spark.checkpoint.dir to a folder that the driver and all executors share"
_SCOPE: contextvars.ContextVar[str] = contextvars.ContextVar("stratal-scratch-scope", default="")


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is shared storage and is read from the session; without
    the setting a cluster run is refused, because executors on several
    machines would each write to their own disk. Only a ``local`` master
    (unit tests) gets a scratch folder, once per session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        sc = spark.sparkContext
    except Exception as e:  # sessions without a SparkContext of their own
        raise RuntimeError(_NEEDS_DIR) from e
    if not sc.getCheckpointDir():
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(_NEEDS_DIR)
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="stratal-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    return the table read back.

    This cuts the lineage like a reliable ``checkpoint()``, but the copy is
    columnar and compressed (reads prune columns), and the read-back carries
    its real size, so later joins can pick broadcast from the planner's
    estimate instead of shuffling first. A lost executor re-reads the table;
    nothing upstream is recomputed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, limit: int = 4 << 20) -> Iterator[None]:
    """Jobs run inside send Python workers Arrow batches of about ``limit`` bytes at most.

    A batch is held several times while it is sent: as Arrow vectors, as the
    stream's bytes outside the heap, and in the worker. A smaller limit of the
    session stays; the session's own is back at the end.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, f"{64 << 20}b")
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) <= limit:
        yield
        return
    spark.conf.set(key, f"{limit}b")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_root(spark: SparkSession) -> str:
    """The folder of scratch tables under the shared checkpoint folder."""
    return f"{shared_checkpoint_dir(spark).rstrip('/')}/stratal-scratch"


_UNOWNED: list[tuple[SparkSession, str]] = []  # handed out, not yet seen on the file system


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a scratch table (inside the current ``scratch_scope``, if any).

    A lazy result may read its scratch tables as long as the application
    lives, so the file system is told to delete them when the driver ends;
    scopes and jobs remove theirs earlier.
    """
    own_scratch()
    path = f"{scratch_root(spark)}/{_SCOPE.get()}{name}-{uuid.uuid4().hex}"
    if not _UNOWNED:
        atexit.unregister(_own_at_exit)
        atexit.register(_own_at_exit)
    _UNOWNED.append((spark, path))
    return path


def own_scratch() -> None:
    """Mark the scratch folders written since the last call for deletion at
    the end of the driver (a folder can be marked once it exists)."""
    for spark, path in list(_UNOWNED):
        fs, place = _hadoop(spark, path)
        if fs.deleteOnExit(place):
            _UNOWNED.remove((spark, path))


def _own_at_exit() -> None:
    try:
        own_scratch()
    except Exception:  # the driver JVM is gone already
        _UNOWNED.clear()


@contextlib.contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """Scratch folders made inside share one folder, removed at the end.

    Everything that reads them must run inside the scope. Scopes nest.
    """
    scope = f"{_SCOPE.get()}{name}-{uuid.uuid4().hex}/"
    token = _SCOPE.set(scope)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        gone = f"{scratch_root(spark)}/{scope}"
        remove_path(spark, gone)
        _UNOWNED[:] = [(s, p) for s, p in _UNOWNED if not p.startswith(gone)]


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) in the store that holds ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, place = _hadoop(spark, path)
    return bool(fs.exists(place))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, place = _hadoop(spark, path)
    fs.delete(place, True)


def rename_path(spark: SparkSession, path: str, target: str) -> None:
    fs, place = _hadoop(spark, path)
    if not fs.rename(place, _hadoop(spark, target)[1]):
        raise OSError(f"could not rename {path} to {target}")


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match a glob pattern, as full URIs."""
    fs, place = _hadoop(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(place) or []))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as the full URI that file listings report."""
    fs, place = _hadoop(spark, path)
    return fs.makeQualified(place).toString()
