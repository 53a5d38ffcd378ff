"""Property tests on random inputs (Hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratal.operators.dedupe import dedupe_keep
from stratal.operators.rank import dense_rank_global

keys = st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.one_of(st.none(), st.sampled_from(["a", "b", "ab", ""])))
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=st.lists(keys, min_size=0, max_size=60), parts=st.integers(1, 9))
def test_parallel_rank_equals_window(spark, rows, parts):
    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(rows)], "a int, b string, id int")
    mine = {r.id: r.rank for r in dense_rank_global(df, ["a", "b"], "rank", parts).collect()}
    w = Window.orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first())
    ref = {r.id: r.rank for r in df.withColumn("rank", F.dense_rank().over(w)).collect()}
    assert mine == ref


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5), st.integers(0, 5)),
                     min_size=0, max_size=60))
def test_dedupe_keeps_smallest_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, x int, y int")
    got = {r.k: (r.x, r.y) for r in dedupe_keep(df, ["k"], ["x", "y"]).collect()}
    expect = {}
    for k, x, y in rows:
        expect[k] = min(expect.get(k, (x, y)), (x, y))
    assert got == expect
