import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratal.operators.dedupe import dedupe_keep, dedupe_rows
from stratal.operators.rank import dense_rank_global, rank_distinct
from stratal.plans.family import attach_ranks, family_id, rank_groups


def _window_rank(df, cols):
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in cols])
    return df.withColumn("rank_w", F.dense_rank().over(w))


def test_null_groups_consume_ranks_but_get_no_id(spark):
    rows = spark.createDataFrame(
        [(None, "A"), (1, None), (1, "B"), (1, "B"), (2, "A"), (2, None)],
        "idplanta int, name_concat_general string")
    ranked = rank_groups(rows)
    assert sorted((r.idplanta, r.name_concat_general, r.n_grupo) for r in ranked.collect()
                  if r.idplanta is not None and r.name_concat_general is not None) == [(1, "B", 3), (2, "A", 5)]
    ids = attach_ranks(rows, ranked).withColumn("familyid", family_id("idplanta", "n_grupo"))
    got = sorted((r.idplanta, r.name_concat_general, r.familyid) for r in ids.collect()
                 if r.familyid is not None)
    assert got == [(1, "B", 10003), (1, "B", 10003), (2, "A", 20005)]
    assert ids.where(F.col("familyid").isNull()).count() == 3


def _random_keys(n, seed, hot_share=0.0):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a = 7 if rnd.random() < hot_share else rnd.choice([None, 1, 2, 3, 4, 5])
        b = None if rnd.random() < 0.05 else f"n{rnd.randrange(400):03d}"
        out.append((a, b, i))
    return out


def test_parallel_rank_equals_global_window(spark):
    for seed, hot, parts in [(1, 0.0, 8), (2, 0.34, 8), (3, 0.34, 3), (4, 0.9, 16)]:
        df = spark.createDataFrame(_random_keys(3000, seed, hot), "a int, b string, id int")
        mine = dense_rank_global(df, ["a", "b"], "rank", num_partitions=parts)
        ref = _window_rank(df, ["a", "b"])
        joined = mine.join(ref.select("id", "rank_w"), "id")
        assert joined.count() == 3000
        assert joined.where(F.col("rank") != F.col("rank_w")).count() == 0


def test_hot_plant_is_split_across_tasks(spark):
    df = spark.createDataFrame(_random_keys(4000, 5, 0.5), "a int, b string, id int")
    keys = df.select("a", "b").distinct()
    ranked = rank_distinct(keys, ["a", "b"], "r", num_partitions=8)
    per_task = ranked.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) > 1
    ranks = sorted(r.r for r in ranked.collect())
    assert ranks == list(range(1, len(ranks) + 1))


def test_dedupe_keep_is_deterministic_and_smallest(spark):
    rows = [(None, 10, 5, None, "TARIJA_X", "c"), (None, 10, 5, None, "ALPHA", "d"),
            (None, 10, 5, None, None, "z"), (1, 10, 5, 10001, "B", "a"), (1, 10, 5, 10001, "A", "b")]
    df = spark.createDataFrame(rows, "idplanta int, id_prod int, sku int, familyid int, planta string, other string")
    out = dedupe_keep(df, ["idplanta", "id_prod", "sku", "familyid"], ["planta"])
    got = sorted([tuple(r) for r in out.collect()], key=repr)
    assert got == sorted([(None, 10, 5, None, None, "z"), (1, 10, 5, 10001, "A", "b")], key=repr)
    assert out.columns == df.columns


def test_dedupe_output_unique_and_subset(spark):
    data = _random_keys(2000, 9, 0.3)
    df = spark.createDataFrame(data, "a int, b string, id int")
    out = dedupe_keep(df, ["a"], ["b", "id"])
    assert out.count() == df.select("a").distinct().count()
    assert out.exceptAll(df).count() == 0


def test_dedupe_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, None)], "x int, y string")
    assert dedupe_rows(df).count() == 2
