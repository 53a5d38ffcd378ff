import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratal.operators.enrich import DimSpec, lookup
from stratal.operators.predicates import active_products, recent_window
from stratal.operators.snapshot import EmptySnapshotError, latest_snapshot

T1 = dt.datetime(2000, 5, 1)
T2 = dt.datetime(2000, 6, 1)


def test_latest_snapshot_single_column(spark):
    df = spark.createDataFrame([(1, "old", T1), (1, "new", T2), (2, "new2", T2)],
                               "k int, v string, process_timestamp timestamp_ntz")
    assert sorted(r.v for r in latest_snapshot(df).collect()) == ["new", "new2"]


def test_two_columns_use_independent_maxima(spark):
    # row a: process newest, raw old; row b: the other way round -> empty
    df = spark.createDataFrame([(1, T2, T1), (2, T1, T2)],
                               "k int, process_timestamp timestamp_ntz, raw_timestamp timestamp_ntz")
    assert latest_snapshot(df, ["process_timestamp", "raw_timestamp"]).count() == 0
    df2 = spark.createDataFrame([(1, T2, T2), (2, T2, T1)],
                                "k int, process_timestamp timestamp_ntz, raw_timestamp timestamp_ntz")
    assert [r.k for r in latest_snapshot(df2, ["process_timestamp", "raw_timestamp"]).collect()] == [1]


def test_empty_dimension_gives_null_lookups_or_raises(spark):
    master = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([], "k int, d string, process_timestamp timestamp_ntz")
    out = lookup(master, DimSpec(dim, "k", ["d"]))
    assert sorted((r.k, r.d) for r in out.collect()) == [(1, None), (2, None)]
    with pytest.raises(EmptySnapshotError):
        latest_snapshot(dim, require_nonempty=True)


def test_text_key_does_not_match_number_key(spark):
    master = spark.createDataFrame([(10, "01"), (11, "1")], "id int, id_marca string")
    dim = spark.createDataFrame([(1, "M1", T2)], "id_marca int, desc_marca string, process_timestamp timestamp_ntz")
    out = lookup(master, DimSpec(dim, "id_marca", ["desc_marca"], key_cast="string"))
    assert dict((r.id, r.desc_marca) for r in out.collect()) == {10: None, 11: "M1"}


def test_lookup_rejects_column_clash(spark):
    master = spark.createDataFrame([(1, "x")], "k int, d string")
    dim = spark.createDataFrame([(1, "y", T2)], "k int, d string, process_timestamp timestamp_ntz")
    with pytest.raises(ValueError):
        lookup(master, DimSpec(dim, "k", ["d"]))


def test_null_flag_is_dropped_by_not_equal(spark):
    rows = [(i, flag, None, dt.date(2001, 12, 31), "10") for i, flag in enumerate(["S", "N", None])]
    df = spark.createDataFrame(rows, "id int, suprimido string, fech_supr date, ffin_vreg date, sku string")
    assert [r.suprimido for r in active_products(df, "2000-01-01", 3000).collect()] == ["N"]


def test_malformed_sku_is_dropped_not_fatal(spark):
    rows = [(1, "N", None, dt.date(2001, 12, 31), s) for s in ["12", "A12", "2999.5", "3000"]]
    df = spark.createDataFrame(rows, "id int, suprimido string, fech_supr date, ffin_vreg date, sku string")
    assert sorted(r.sku for r in active_products(df, "2000-01-01", 3000).collect()) == ["12", "2999.5"]


def test_month_window_clamps_and_is_inclusive(spark):
    days = [dt.date(2025, 2, 27), dt.date(2025, 2, 28), dt.date(2025, 5, 31), dt.date(2025, 6, 1)]
    df = spark.createDataFrame([(d,) for d in days], "fecha date")
    got = [r.fecha for r in recent_window(df, "fecha", 3, "2025-05-31").collect()]
    assert got == [dt.date(2025, 2, 28), dt.date(2025, 5, 31)]


def test_snapshot_max_stays_in_the_plan(spark, capsys):
    df = spark.createDataFrame([(1, T1), (2, T2)], "k int, process_timestamp timestamp_ntz")
    latest_snapshot(df).explain()
    assert "Subquery" in capsys.readouterr().out


def test_snapshot_prunes_partitions_of_a_partitioned_table(spark, tmp_out, capsys):
    df = spark.range(400).select(F.col("id").alias("k"),
                                 F.expr("date_add(date'2025-01-01', cast(id % 4 as int))").alias("snapshot_date"))
    df.write.partitionBy("snapshot_date").parquet(tmp_out)
    latest = latest_snapshot(spark.read.parquet(tmp_out), "snapshot_date")
    latest.explain("formatted")
    plan = capsys.readouterr().out
    assert any("PartitionFilters" in line and "Subquery" in line for line in plan.splitlines())
    assert latest.count() == 100


def test_snapshot_independent_of_session_zone(spark):
    df = spark.createDataFrame([(1, T1), (2, T2)], "k int, process_timestamp timestamp_ntz")
    df_ltz = df.withColumn("process_timestamp", F.col("process_timestamp").cast("timestamp"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/La_Paz")
        assert [r.k for r in latest_snapshot(df_ltz).collect()] == [2]
        assert [r.k for r in latest_snapshot(df).collect()] == [2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
