"""File and JDBC sinks."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def write_partitioned(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None,
                      fmt: str = "parquet", compression: str | None = None, mode: str = "overwrite",
                      dynamic: bool = True, max_files: int | None = None,
                      options: Mapping[str, str] | None = None, rebalance: bool = False) -> None:
    """Write ``df`` under ``path`` as Hive-style partition folders.

    ``dynamic=True`` replaces only the partitions present in ``df`` (set per
    write, not on the session, so other writers are unaffected).
    ``max_files=n`` round-robins the rows into ``n`` write tasks, which caps
    the files per partition folder while leaving the stages before it
    parallel; unlike ``coalesce(1)`` it does not pull the upstream work into
    one task and does not route a large partition value to a single task.

    ``rebalance=True`` sizes the files by data instead of by a number: rows
    are brought together by partition value, and adaptive execution merges
    small values into one task and cuts large ones into several of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each. A day with few rows becomes
    one file, a day with a third of all rows as many as its size asks for (and
    so does a small day that hashes to the same shuffle partition).
    It costs a shuffle of the output; rows that already come in one file per task and
    day do not need it.
    """
    if max_files and rebalance:
        raise ValueError("choose max_files or rebalance")
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
    out = df.repartition(max_files) if max_files else df.hint("rebalance", *cols) if rebalance else df
    writer = out.write.mode(mode).format(fmt)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if compression:
        writer = writer.option("compression", compression)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.save(path)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, truncate: bool = True, num_partitions: int | None = None,
                 batch_size: int | None = None, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a JDBC full refresh.

    ``truncate`` keeps the table definition (grants, indexes) on overwrite.
    ``num_partitions`` caps concurrent connections; ``batch_size`` sets rows
    per insert batch. Credentials are passed in by the caller.
    """
    opts = {"url": url, "dbtable": table, "truncate": str(truncate).lower()}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    if batch_size is not None:
        opts["batchsize"] = str(batch_size)
    opts.update(extra or {})
    return opts


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "overwrite") -> None:
    """Refresh a relational table from ``df``.

    The truncate and the inserts are separate statements, so readers of the
    target can see it empty or partly loaded (``refresh_jdbc`` avoids that);
    row order is not kept.
    """
    df.write.format("jdbc").options(**options).mode(mode).save()


def _name(name: str) -> str:
    if not re.fullmatch(r"\w+(\.\w+)*", name):
        raise ValueError(f"not a plain table or column name: {name!r}")
    return name


def swap_statements(target: str, staging: str, columns: Sequence[str], quote: str = '"') -> list[str]:
    """The statements that replace the rows of ``target`` by those of
    ``staging``, to run in one transaction. The target keeps its definition, grants and indexes."""
    named = ", ".join(f"{quote}{_name(c)}{quote}" for c in columns)
    return [f"DELETE FROM {_name(target)}", f"INSERT INTO {target} ({named}) SELECT {named} FROM {_name(staging)}"]


def run_in_transaction(connection, statements: Sequence[str]) -> list[int]:
    """Run the statements on a JDBC connection and commit; on any failure
    roll back and raise, so that readers see all of them or none. The rows
    each one touched; the connection is closed."""
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            touched = [statement.executeUpdate(s) for s in statements]
        except Exception:
            connection.rollback()
            raise
        finally:
            statement.close()
        connection.commit()
        return touched
    finally:
        connection.close()


def jdbc_connection(spark: SparkSession, options: Mapping[str, str]):
    """A connection of the driver JVM for the options of ``jdbc_options``."""
    given = spark._jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in options:
            given.setProperty(key, options[key])
    if "driver" in options:
        spark._jvm.java.lang.Class.forName(options["driver"])
    return spark._jvm.java.sql.DriverManager.getConnection(options["url"], given)


def refresh_jdbc(df: DataFrame, options: Mapping[str, str], staging: str | None = None, quote: str = '"',
                 connect: Callable[[SparkSession, Mapping[str, str]], object] = jdbc_connection,
                 load: Callable[[DataFrame, Mapping[str, str]], None] = write_jdbc) -> int:
    """Refresh a relational table without readers seeing it empty.

    The executors load a staging table in parallel (``staging``, by default
    the target's name with ``_staging``; created or truncated by the load);
    then one transaction deletes the target's rows and inserts those of the
    staging table, inside the database. A load that fails leaves the target
    as it was, and so does a swap that fails. Returns the rows inserted. Two
    refreshes of one target at a time need staging tables of their own.
    """
    target = options["dbtable"]
    place = staging or f"{target}_staging"
    statements = swap_statements(target, place, df.columns, quote)
    load(df, {**options, "dbtable": place})
    return run_in_transaction(connect(df.sparkSession, options), statements)[-1]
