import pytest
from pyspark.sql import functions as F

from stratal.operators.snapshot import footer_max, latest_snapshot
from stratal.session import glob_paths, own_scratch, scratch_path, scratch_root, scratch_scope
from stratal.sinks.writers import jdbc_options, refresh_jdbc, run_in_transaction, swap_statements, write_partitioned


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- file sizes ----------------------------------------------------------------

def files_per_day(spark, path):
    out = {}
    for p in glob_paths(spark, f"{path}/day=*/part-*"):
        day = p.split("day=")[1].split("/")[0]
        out[day] = out.get(day, 0) + 1
    return out


def test_rebalance_merges_small_days_and_cuts_large_ones(spark, tmp_out):
    """Forty days, one of which holds most rows, from sixteen tasks."""
    i = F.col("id")
    df = spark.range(200_000, numPartitions=16).select(
        "id", F.sha2(i.cast("string"), 256).alias("txt"), F.when(i % 10 != 0, F.lit(99)).otherwise(i / 10 % 40).cast("int").alias("day"))
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        write_partitioned(df, f"{tmp_out}/sized", "day", rebalance=True)
        write_partitioned(df, f"{tmp_out}/plain", "day")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sized, plain = files_per_day(spark, f"{tmp_out}/sized"), files_per_day(spark, f"{tmp_out}/plain")
    assert max(n for day, n in plain.items() if day != "99") == 16
    # a small day is one file, unless its hash meets the large day's: then it is cut with it
    assert len(sized) == 41 and 2 <= sized["99"] <= 16
    assert sum(n == 1 for n in sized.values()) >= 30 and max(sized.values()) == sized["99"]
    assert sum(sized.values()) < 0.25 * sum(plain.values())
    back = spark.read.parquet(f"{tmp_out}/sized")
    assert back.count() == 200_000 and back.select("id").distinct().count() == 200_000


def test_rebalance_without_partitions_and_with_max_files(spark, tmp_out):
    write_partitioned(spark.range(1000, numPartitions=16), tmp_out, rebalance=True)
    assert len(glob_paths(spark, f"{tmp_out}/part-*")) < 16 and spark.read.parquet(tmp_out).count() == 1000
    with pytest.raises(ValueError):
        write_partitioned(spark.range(3), f"{tmp_out}/x", max_files=1, rebalance=True)


# -- staged JDBC refresh -------------------------------------------------------

class Database:
    """Records what a JDBC connection is asked to do; fails at one statement."""

    def __init__(self, fail_at=None):
        self.log, self.fail_at = [], fail_at

    def setAutoCommit(self, on):
        self.log.append(f"autocommit {on}")

    def createStatement(self):
        return self

    def executeUpdate(self, text):
        self.log.append(text)
        if self.fail_at is not None and self.fail_at in text:
            raise RuntimeError("constraint")
        return 7

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


SWAP = ['DELETE FROM app.relation', 'INSERT INTO app.relation ("family_id", "parentid") SELECT "family_id", "parentid" FROM app.relation_staging']


def test_swap_statements():
    assert swap_statements("app.relation", "app.relation_staging", ["family_id", "parentid"]) == SWAP
    assert swap_statements("t", "s", ["a"], quote="`")[1] == "INSERT INTO t (`a`) SELECT `a` FROM s"
    for bad in ("t; DROP TABLE x", 'a"b', ""):
        with pytest.raises(ValueError):
            swap_statements(bad, "s", ["a"])
        with pytest.raises(ValueError):
            swap_statements("t", "s", [bad])


def test_refresh_loads_then_swaps_in_one_transaction(spark):
    base, loaded = Database(), []
    options = jdbc_options("jdbc:x:y", "app.relation", "me", "secret")
    df = spark.createDataFrame([(1, 2)], "family_id int, parentid int")
    n = refresh_jdbc(df, options, connect=lambda s, o: base, load=lambda d, o: loaded.append((o["dbtable"], d.count(), list(base.log))))
    assert n == 7 and loaded == [("app.relation_staging", 1, [])]
    assert base.log == ["autocommit False", *SWAP, "close", "commit", "close"]
    assert options["dbtable"] == "app.relation"


@pytest.mark.parametrize("fail_at", ["DELETE", "INSERT"])
def test_a_failed_swap_rolls_back(spark, fail_at):
    base = Database(fail_at)
    with pytest.raises(RuntimeError, match="constraint"):
        run_in_transaction(base, SWAP)
    assert "commit" not in base.log and base.log[-3:] == ["rollback", "close", "close"]


def test_a_failed_load_never_touches_the_target(spark):
    base = Database()

    def load(df, options):
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError, match="executor lost"):
        refresh_jdbc(spark.range(3), {"url": "jdbc:x:y", "dbtable": "t"}, connect=lambda s, o: base, load=load)
    assert base.log == []


# -- maxima from footers -------------------------------------------------------

def test_footer_maxima_scan_no_column(spark, tmp_out):
    df = spark.range(1000, numPartitions=4).selectExpr(
        "id", "CAST(id % 7 AS int) AS v", "date_add(DATE '2020-01-01', CAST(id % 9 AS int)) AS day", "CAST(id AS double) AS d",
        "CAST(id AS string) AS s", "CAST(NULL AS int) AS gone")
    df.write.parquet(tmp_out)
    got = spark.range(1).select(*[footer_max(spark, tmp_out, c).alias(c) for c in df.columns])
    assert got.collect() == df.selectExpr(*[f"max({c}) AS {c}" for c in df.columns]).collect()
    for c in ("id", "v", "day"):
        plan = plan_of(spark.range(1).select(footer_max(spark, tmp_out, c)))
        assert f"PushedAggregation: [MAX({c})]" in plan and f"ReadSchema: struct<max({c}):" in plan
    for c in ("d", "s"):  # no exact statistics in the footer
        assert "FileScan parquet" in plan_of(spark.range(1).select(footer_max(spark, tmp_out, c)))
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_snapshot_with_footer_maximum(spark, tmp_out):
    spark.range(100).selectExpr("id", "id % 5 AS version").write.parquet(tmp_out)
    df = spark.read.parquet(tmp_out)
    kept = latest_snapshot(df, "version", maxima={"version": footer_max(spark, tmp_out, "version")})
    assert sorted(r["id"] for r in kept.collect()) == list(range(4, 100, 5))
    assert "PushedAggregation: [MAX(version)]" in plan_of(kept)


# -- scratch tables ------------------------------------------------------------

def test_scopes_nest_and_leave_nothing(spark):
    before = set(glob_paths(spark, f"{scratch_root(spark)}/*"))
    with scratch_scope(spark, "outer"):
        spark.range(3).write.parquet(scratch_path(spark, "a"))
        with scratch_scope(spark, "inner"):
            spark.range(3).write.parquet(scratch_path(spark, "b"))
        assert len(glob_paths(spark, f"{scratch_root(spark)}/outer-*/*")) == 1
    assert set(glob_paths(spark, f"{scratch_root(spark)}/*")) == before


@pytest.mark.parametrize("query", ["family_assign", "dense_rank_global"])
def test_a_scoped_result_leaves_no_folder(spark, query):
    from stratal.suite.queries import QUERIES

    before = set(glob_paths(spark, f"{scratch_root(spark)}/*"))
    with scratch_scope(spark, "run"):
        assert QUERIES[query](spark, "/root/testdata/sf0.001").count() > 0
    assert set(glob_paths(spark, f"{scratch_root(spark)}/*")) == before


def test_scratch_of_lazy_results_goes_with_the_driver(tmp_path):
    """Two drivers of their own: what their lazy results read is gone after each."""
    import os
    import subprocess
    import sys

    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from stratal.session import build_session, materialize, scratch_path
spark = build_session("local[1]", 2, extra={{"spark.checkpoint.dir": {str(tmp_path)!r}}})
assert materialize(spark.range(5), "lazy").count() == 5
spark.range(3).write.parquet(scratch_path(spark, "last"))
import os
assert len(os.listdir({str(tmp_path)!r} + "/stratal-scratch")) == 2
if sys.argv[1] == "stop":
    spark.stop()
"""
    for how in ("stop", "exit"):
        subprocess.run([sys.executable, "-c", code, how], check=True, timeout=180, capture_output=True)
        left = os.listdir(tmp_path / "stratal-scratch") if (tmp_path / "stratal-scratch").exists() else []
        assert left == [], (how, left)


def test_marking_survives_removed_folders(spark):
    path = scratch_path(spark, "never-written")
    own_scratch()
    assert path not in glob_paths(spark, f"{scratch_root(spark)}/*")
