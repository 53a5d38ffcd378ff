import datetime as dt

from stratal.operators.enrich import DimSpec, enrich, lookup
from stratal.operators.predicates import in_list, like

T1, T2 = dt.datetime(2000, 5, 1), dt.datetime(2000, 6, 1)


def test_composite_keys_and_unversioned_dimension(spark):
    master = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "a", 12)], "k1 int, k2 string, id int")
    dim = spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], "d1 int, d2 string, label string")
    out = lookup(master, DimSpec(dim, ["k1", "k2"], ["label"], right_key=["d1", "d2"], snapshot_cols=()))
    assert {r.id: r.label for r in out.collect()} == {10: "x", 11: None, 12: "y"}
    assert out.columns == ["k1", "k2", "id", "label"]


def test_inner_lookup_and_broadcast_hint(spark, capsys):
    master = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    dim = spark.createDataFrame([(1, "old", T1), (1, "new", T2), (2, "new2", T2)],
                                "k int, label string, process_timestamp timestamp_ntz")
    out = lookup(master, DimSpec(dim, "k", ["label"], how="inner", hint="broadcast"))
    assert sorted((r.k, r.label) for r in out.collect()) == [(1, "new"), (2, "new2")]
    out.explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out


def test_enrich_applies_lookups_in_order(spark):
    master = spark.createDataFrame([(1, 5)], "a int, b int")
    da = spark.createDataFrame([(1, "A", T2)], "a int, la string, process_timestamp timestamp_ntz")
    db = spark.createDataFrame([(5, "B", T2)], "b int, lb string, process_timestamp timestamp_ntz")
    row = enrich(master, [DimSpec(da, "a", ["la"]), DimSpec(db, "b", ["lb"])]).first()
    assert (row.la, row.lb) == ("A", "B")


def test_in_list_and_like_reject_nulls(spark):
    df = spark.createDataFrame([(1, "SIN AZUCAR"), (None, None), (3, "sin azucar")], "n int, s string")
    assert [r.n for r in in_list(df, "n", [1, 3]).collect()] == [1, 3]
    assert [r.n for r in like(df, "s", "%SIN A%").collect()] == [1]
