"""Change detection by content hash against a saved manifest.

A manifest is a two-column table ``(key, hash)`` with the SHA-256 hex digest
of each item's content. Comparing the current set with the saved manifest
marks items as new, changed or unchanged; deleted items are not reported
unless asked for. The refreshed manifest is the current set, not a merge:
keys that vanished drop out of it.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratal.session import glob_paths, qualified, remove_path
from stratal.sources.tables import table_files

NEW, CHANGED, UNCHANGED, DELETED = "new", "changed", "unchanged", "deleted"


def sha256_hex(c: Column | str) -> Column:
    """SHA-256 hex of a string (UTF-8 bytes) or binary column."""
    return F.sha2(F.col(c) if isinstance(c, str) else c, 256)


def content_hash(df: DataFrame, key: str, content: str) -> DataFrame:
    """Manifest ``(key, hash)`` of a table: one hash per row, whole content."""
    return df.select(F.col(key).alias("key"), sha256_hex(content).alias("hash"))


def file_hashes(spark: SparkSession, path: str, glob: str | None = None,
                recursive: bool = True, key: str = "path") -> DataFrame:
    """Manifest of files under ``path``: key = full file URI, or with
    ``key='relative'`` the path below ``path`` (stays the same when the root
    moves), or with ``key='name'`` the file name only (not unique under
    recursive reads); hash = SHA-256 of the bytes.

    The binary-file source lists the files, one row each, so they are hashed
    in parallel across tasks. The bytes are not a column of these rows: the
    task streams them through the digest, so a file of any length takes a
    buffer of memory. One file is read by one task, since SHA-256 goes
    through the bytes in order. Meant for artefacts; use ``content_hash``
    for table data.

    A session that sets ``spark.sql.files.ignoreCorruptFiles`` leaves
    unreadable files out; there each file is still one value, below the
    source's 2 GiB limit and within a task's memory.
    """
    if key not in ("path", "relative", "name"):
        raise ValueError(f"key must be path, relative or name, not {key!r}")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    name = F.col("path")
    if key == "relative":
        root = qualified(spark, path).rstrip("/") + "/"
        name = F.regexp_replace("path", "^" + re.escape(root), "")
    elif key == "name":
        name = F.element_at(F.split("path", "/"), -1)
    # only the source leaves unreadable files out, and only if it reads the contents itself
    leaves_out = spark.conf.get("spark.sql.files.ignoreCorruptFiles") == "true"
    digest = sha256_hex("content") if leaves_out else _streamed_sha256(spark, F.col("path"))
    return reader.load(path).select(name.alias("key"), digest.alias("hash"))


def _streamed_sha256(spark: SparkSession, path: Column) -> Column:
    """SHA-256 hex of the files that ``path`` names, streamed from the store inside the tasks.

    ``sha2`` needs a whole file as one value. Object expressions (as typed
    Datasets use them) call Hadoop's ``open`` and commons-codec's digest of a
    stream instead; both are on Spark's own class path. The stream is closed
    at its end.
    """
    jvm = spark._jvm
    expressions, seq, none = jvm.org.apache.spark.sql.catalyst.expressions, jvm.PythonUtils.toSeq, jvm.scala.Option.empty()
    named, column = jvm.java.lang.Class.forName, jvm.org.apache.spark.sql.classic.ExpressionUtils

    def typed(name: str):
        return jvm.org.apache.spark.sql.types.ObjectType(named(name))

    def new(name: str, arg):
        return expressions.objects.NewInstance(named(name), seq([arg]), seq([]), True, typed(name), none)

    def call(target, method: str, returns: str, *args):
        return expressions.objects.Invoke(target, method, typed(returns), seq(list(args)), seq([]), True, True, True)

    def static(name: str, method: str, returns, arg):
        return expressions.objects.StaticInvoke(named(name), returns, method, seq([arg]), seq([]), True, True, True, none)

    # the session's Hadoop settings, broadcast as the file sources do
    sent = jvm.org.apache.spark.util.SerializableConfiguration.broadcast(
        spark._jsc.sc(), spark._jsparkSession.sessionState().newHadoopConf())
    held = call(expressions.Literal(sent, typed("org.apache.spark.broadcast.Broadcast")), "value",
                "org.apache.spark.util.SerializableConfiguration")
    conf = call(held, "value", "org.apache.hadoop.conf.Configuration")
    place = new("org.apache.hadoop.fs.Path", call(column.expression(path._jc), "toString", "java.lang.String"))
    fs = call(place, "getFileSystem", "org.apache.hadoop.fs.FileSystem", conf)
    stream = new("org.apache.commons.io.input.AutoCloseInputStream",
                 call(fs, "open", "org.apache.hadoop.fs.FSDataInputStream", place))
    digest = static("org.apache.commons.codec.digest.DigestUtils", "sha256Hex", typed("java.lang.String"), stream)
    out = static("org.apache.spark.unsafe.types.UTF8String", "fromString",
                 jvm.org.apache.spark.sql.types.DataTypes.StringType, digest)
    return type(path)(column.column(out))


def _unique(manifest: DataFrame) -> DataFrame:
    """The manifest, failing on a repeated key. Grouping by the join key adds
    no shuffle to a shuffled comparison."""
    grouped = manifest.groupBy("key").agg(F.min("hash").alias("hash"), F.count(F.lit(1)).alias("n"))
    message = F.concat(F.lit("manifest key occurs more than once: "), F.col("key").cast("string"))
    checked = F.when(F.col("n") > 1, F.raise_error(message).cast("string")).otherwise(F.col("hash"))
    return grouped.select("key", checked.alias("hash"))


def detect_changes(current: DataFrame, previous: DataFrame, include_deleted: bool = False) -> DataFrame:
    """``(key, hash, status)`` for each current item.

    A key missing from the saved manifest means new; a different hash
    (null-safe) means changed. With
    ``include_deleted`` the keys only in ``previous`` are added with a null
    hash and status ``deleted``. Both sides must be keyed uniquely: a
    repeated key fails the query and names the key. So the join has no hot
    keys; a small saved manifest is broadcast by adaptive execution.
    """
    current, previous = _unique(current), _unique(previous)
    prev = previous.select(F.col("key").alias("__pkey"), F.col("hash").alias("__phash"))
    joined = current.join(prev, F.col("key") == F.col("__pkey"), "left")
    status = (F.when(F.col("__pkey").isNull(), F.lit(NEW))
              .when(~F.col("__phash").eqNullSafe(F.col("hash")), F.lit(CHANGED))
              .otherwise(F.lit(UNCHANGED)))
    out = joined.select("key", "hash", status.alias("status"))
    if include_deleted:
        gone = previous.join(current, "key", "left_anti").select(
            "key", F.lit(None).cast("string").alias("hash"), F.lit(DELETED).alias("status"))
        out = out.unionByName(gone)
    return out


def save_manifest(manifest: DataFrame, target: str, buckets: int | None = None, location: str | None = None) -> None:
    """Replace the saved manifest with ``manifest`` (a refresh, not a merge).

    ``target`` is a path, or with ``buckets`` a catalog name: the manifest is
    then a table bucketed and sorted by key, so the next run's
    ``detect_changes`` reads the saved side already hash-partitioned by key
    and shuffles only the current set.
    Call it only after the work on the changed items succeeded.

    The old manifest stays until the new one is complete. A path holds
    numbered versions, of which readers take the newest finished one. A
    catalog name is a view over numbered tables: a new table is written
    whole, then the view is replaced in one catalog operation; a run that
    breaks off anywhere leaves a view, or at first save a table, that is
    complete. The version before the newest is kept. ``location`` is the
    folder of the numbered tables (default: the warehouse).
    """
    spark = manifest.sparkSession
    writer = manifest.select("key", "hash").write.mode("overwrite").format("parquet")
    if buckets:
        _save_table(spark, writer.bucketBy(buckets, "key").sortBy("key"), target, location)
        return
    numbers = _versions(spark, target)
    new = max(numbers, default=0) + 1
    writer.save(_version_path(target, new))
    for old in numbers:
        if old < new - 1:
            remove_path(spark, _version_path(target, old))


def _save_table(spark: SparkSession, writer, target: str, location: str | None) -> None:
    _adopt(spark, target)
    tables = _numbered(spark, target)
    number = max((n for n, _ in tables), default=0) + 1
    # a name of its own: what a run that broke off left in the store cannot be in the way
    name = f"{target}{_MARK}{number:010d}_{uuid.uuid4().hex[:8]}"
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{name.rsplit('.', 1)[-1]}")
    writer.saveAsTable(name)  # the catalog gets the entry only after all data is written
    spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM {name}")
    for n, old in tables:
        if n < number - 1:
            _drop(spark, old)


def drop_manifest(spark: SparkSession, target: str) -> None:
    """Remove a manifest kept in the catalog: its view and all its tables."""
    _adopt(spark, target)
    spark.sql(f"DROP VIEW IF EXISTS {target}")
    for _, name in _numbered(spark, target):
        _drop(spark, name)


def _drop(spark: SparkSession, name: str) -> None:
    """Drop a numbered table and its files (a given location is not removed with the table)."""
    place = table_files(spark, name).location
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove_path(spark, place)


def _adopt(spark: SparkSession, target: str) -> None:
    """A manifest saved as a plain table becomes number 0 of the numbered ones."""
    for name in (target, target + _NEXT):
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"ALTER TABLE {name} RENAME TO {target}{_MARK}{0:010d}_{uuid.uuid4().hex[:8]}")
            return


def _numbered(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    """(number, name) of the complete numbered tables of a catalog name, ascending."""
    database, _, plain = target.rpartition(".")
    prefix = f"{plain}{_MARK}".lower()
    scope = f" IN {database}" if database else ""
    found = []
    for r in spark.sql(f"SHOW TABLES{scope} LIKE '{prefix}*'").collect():
        match = re.fullmatch(re.escape(prefix) + r"(\d+)_[0-9a-f]+", r["tableName"])
        if match:
            found.append((int(match[1]), f"{database}.{r['tableName']}" if database else r["tableName"]))
    return sorted(found)


_NEXT = "__next"
_MARK = "__v"


def _version_path(target: str, number: int) -> str:
    return f"{target.rstrip('/')}/version={number:010d}"


def _versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the finished versions under a path."""
    done = glob_paths(spark, f"{target.rstrip('/')}/version=*/_SUCCESS")
    return sorted(int(p.rsplit("/", 2)[1].removeprefix("version=")) for p in done)


def load_manifest(spark: SparkSession, target: str, bucketed: bool = False, key_type: str = "string") -> DataFrame:
    """The saved manifest: a catalog table when ``bucketed``, else a path.

    Before the first ``save_manifest`` it is empty with keys of ``key_type``,
    so a first comparison finds everything new.
    """
    if bucketed:
        if spark.catalog.tableExists(target):
            return spark.table(target)
        # no view yet: a first save, or the move of a plain table, broke off behind a complete table
        for _, name in reversed(_numbered(spark, target)):
            return spark.table(name)
        if spark.catalog.tableExists(target + _NEXT):
            return spark.table(target + _NEXT)
    elif numbers := _versions(spark, target):
        return spark.read.parquet(_version_path(target, numbers[-1]))  # Parquet keeps the key's type
    return spark.createDataFrame([], f"key {key_type}, hash string")


def changed_items(changes: DataFrame) -> DataFrame:
    """Items to act on: new or changed."""
    return changes.where(F.col("status").isin(NEW, CHANGED))
