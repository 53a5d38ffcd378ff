import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratal.operators import rank as module
from stratal.operators.rank import number_rows, rank_global


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=3000):
    """A third of all rows are equal, a third share a key, keys and values hold nulls."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, F.lit(5)).when(i % 3 == 1, F.lit(7)).when(i % 50 == 2, F.lit(None)).otherwise(i % 20).cast("int").alias("k"),
        F.when(i % 3 == 0, F.lit("same")).when(i % 97 == 0, F.lit(None)).otherwise((i % 31).cast("string")).alias("v")).repartition(6)


@pytest.mark.parametrize("partitions", [None, 5])
def test_row_numbers_equal_a_window(spark, partitions):
    df = skewed(spark)
    got = number_rows(df, ["k"], "n", partitions).collect()
    assert sorted(r["n"] for r in got) == list(range(1, 3001))
    in_order = [r["k"] for r in sorted(got, key=lambda r: r["n"])]
    assert in_order == sorted(in_order, key=lambda k: (k is not None, k))
    assert sorted(map(str, ((r["k"], r["v"]) for r in got))) == sorted(map(str, ((r["k"], r["v"]) for r in df.collect())))


def test_row_numbers_are_the_same_on_every_run(spark):
    first, second = (sorted(map(str, number_rows(skewed(spark).repartition(p), ["k"], "n", 4).collect())) for p in (2, 7))
    assert first == second


def test_a_hot_row_is_spread_over_ranges(spark):
    df = spark.range(4000).selectExpr("1 AS k", "'x' AS v").repartition(4)
    numbered = number_rows(df, ["k"], "n", 8)
    assert sorted(r["n"] for r in numbered.collect()) == list(range(1, 4001))
    store = [p for p in numbered.inputFiles() if "ranked-keys" in p]
    sizes = [spark.read.parquet(p).count() for p in set(store)]
    assert len([s for s in sizes if s]) >= 6 and max(sizes) < 1500


@pytest.mark.parametrize("block", [1 << 20, 3])
def test_rank_equals_a_window(spark, monkeypatch, block):
    monkeypatch.setattr(module, "BLOCK", block)
    df = skewed(spark)
    for cols in (["k"], ["k", "v"]):
        want = df.withColumn("r", F.rank().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in cols])))
        got = rank_global(df, cols, "r")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_empty_table_and_odd_columns(spark):
    empty = spark.createDataFrame([], "k int, v string")
    assert number_rows(empty, ["k"]).collect() == [] and rank_global(empty, ["k"]).collect() == []
    df = spark.createDataFrame([(2, {"a": 1}, 1), (1, {}, 2)], "k int, m map<string,int>, `a.b` int")
    assert [(r["k"], r["n"], r["a.b"]) for r in sorted(number_rows(df, ["k"], "n").collect())] == [(1, 1, 2), (2, 2, 1)]


def test_no_window_over_all_rows(spark):
    """The only single-partition window orders one row per range or block."""
    from stratal.suite.queries import QUERIES

    for df in (number_rows(skewed(spark), ["k"]), rank_global(skewed(spark), ["k"]),
               QUERIES["relation_order"](spark, "/root/testdata/sf0.001")):
        plan = plan_of(df)
        for part in plan.split("Window [")[1:]:
            head = part.split("\n")[0]
            assert "__rank_pid" in head, head
