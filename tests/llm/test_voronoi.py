import numpy as np
import pytest
from pyspark.sql import functions as F

from stratal.llm.queries import op9_top_k
from stratal.llm.voronoi import LONG, best, bundles, chain, inner_products, needed, top_k

SF = "/root/testdata/sf0.01"


def brute(rows, is_query, k, scale=64):
    """By every pair; rows (id, vector) already distinct."""
    ok = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if not is_query(i):
            continue
        scores = [(-max(-LONG, min(LONG, sum(a * b for a, b in zip(q, x)))), j) for j, x in ok if j != i and len(x) == len(q)]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_embeddings_match_brute_force(spark):
    rows = [(i, [float(x) for x in v]) for i, v in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in op9_top_k(spark, SF).collect()) == brute(rows, lambda i: i % 20 == 0, 20)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, score int, cell int")


def test_hot_group_ties_and_small_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(150)] + [(1000 + i, [0.5] * 6) for i in range(120)]
    got = top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, 7, pivots=9, query_block=4, data_block=16).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i % 10 == 0, 7)


@pytest.mark.parametrize("k", [1, 50])
def test_hand_made_rows(spark, k):
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [1.0, 2.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 0.0]), (7, [0.0, 0.0]), (40, []), (9, []), (60, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]),
            (11, [-0.001, 0.01]), (12, [1e9, 1e9]), (80, [1e16, 3.0]), (13, [-1e16, 1.0])]
    got = top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, k).collect()
    distinct = [r for n, r in enumerate(rows) if r not in rows[:n]]
    assert sorted(tuple(r) for r in got) == brute(distinct, lambda i: i % 20 == 0, k)


def test_empty_table_and_no_queries(spark):
    assert top_k(frame(spark, []), F.col("vec_id") % 20 == 0, 3).collect() == []
    assert top_k(frame(spark, [(1, [1.0])]), F.col("vec_id") % 20 == 0, 3).collect() == []


def test_exact_products_and_ties():
    big = np.array([[2.0 ** 40, 1.0]]), np.array([[2.0 ** 20, 1.0], [2.0 ** 40, 0.0]])
    assert inner_products(*big).tolist() == [[2 ** 60 + 1, LONG]]
    rows, cols = best(np.array([[3, 3, 1, 3, 2, 3, 3, 3, 0]]), np.arange(9), 2)
    assert cols.tolist() == [0, 1]


def clustered(n=1200, centres=24, dim=8, seed=2):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim)) * 40
    return middle[rng.integers(0, centres, n)] + rng.normal(size=(n, dim))


def plan_of(vec, pivots, k, queries):
    """Units (one per cell), and the bound of each query from its own cell."""
    away = np.sqrt(((vec[:, None] - pivots[None]) ** 2).sum(2))
    cell, dist = away.argmin(1), away.min(1)
    size = np.sqrt((vec ** 2).sum(1))
    units = [(c, 0, dist[cell == c].max(), size[cell == c].max(), int((cell == c).sum())) for c in range(len(pivots)) if (cell == c).any()]
    scores = vec[queries] @ vec.T
    least = np.array([np.sort(s[cell == cell[q]])[-k] if (cell == cell[q]).sum() >= k else -LONG for q, s in zip(queries, scores)])
    return units, cell, scores, least


def test_bounds_prune_clusters_and_lose_nothing():
    vec = np.floor(clustered() * 64)
    pivots = vec[:24]
    queries = np.arange(0, 1200, 20)
    units, cell, scores, least = plan_of(vec, pivots, 5, queries)
    need = needed(vec[queries], least.astype(float), pivots, units)
    assert need.mean() < 0.5  # fewer than half of the pairs of query and cell are left
    for row, want, low in zip(need, scores, least):
        held = np.isin(cell, [u[0] for u, ok in zip(units, row) if ok])
        assert held[want >= low].all()


def test_random_vectors_lose_nothing_either():
    rng = np.random.default_rng(4)
    for scale in (1.0, 1e6, 1e140):
        vec = np.floor(rng.normal(size=(300, 5)) * scale)
        units, cell, scores, least = plan_of(vec, vec[:9], 3, np.arange(0, 300, 7))
        need = needed(vec[::7], least.astype(float), vec[:9], units)
        for row, want, low in zip(need, scores, least):
            held = np.isin(cell, [u[0] for u, ok in zip(units, row) if ok])
            assert held[want >= low].all()


@pytest.mark.parametrize("blocks", [(4, 16), (50, 64), (4096, 8192)])
def test_clustered_vectors_match_brute_force(spark, blocks):
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(500))]
    got = top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, 6, pivots=24, query_block=blocks[0], data_block=blocks[1]).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i % 20 == 0, 6)


def test_candidates_of_one_id_count_each(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(60)] + [(7, rng.normal(size=3).tolist()), (7, [5.0, 5.0, 5.0])]
    got = top_k(frame(spark, rows), F.col("vec_id") == 0, 10, pivots=5, query_block=2, data_block=8).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i == 0, 10)


def test_a_query_id_with_vectors_in_several_cells(spark):
    """Its candidates are merged; none comes twice."""
    rows = [(0, [9.0, 0.0]), (0, [-9.0, 0.0])] + [(i, [float(i), 1.0]) for i in range(1, 12)] + [(-i, [-float(i), 1.0]) for i in range(1, 12)]
    got = top_k(frame(spark, rows), F.col("vec_id") == 0, 30, pivots=4, query_block=2, data_block=4).collect()
    assert [r["rank"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 31))
    assert len({(r["vec_id"], r["score"]) for r in got}) == 30


def test_whole_number_bounds_stay_exact(spark):
    """Scores above 2 ** 53 that differ by one."""
    big = 2.0 ** 28
    rows = [(0, [big, 1.0])] + [(i, [big, float(i % 4)]) for i in range(1, 40)]
    got = top_k(frame(spark, rows), F.col("vec_id") == 0, 12, scale=1, pivots=3, query_block=2, data_block=8).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i == 0, 12, 1)


def test_bundles_and_chain():
    assert bundles([("a", 3), ("b", 3), ("c", 3), ("d", 25), ("e", 2), ("f", 2)], 8) == [
        ("a", 0, 1), ("b", 0, 1), ("c", 1, 1), ("d", 2, 4), ("e", 3, 1), ("f", 3, 1)]
    assert bundles([], 8) == []
    assert chain(np.array([[0.0], [10.0], [1.0], [11.0], [2.0]]), [0, 1, 2, 3, 4]) == [0, 2, 4, 1, 3]


def test_data_is_copied_per_group_of_queries(spark):
    """Not per cell: what the solving tasks are sent of random vectors, for which nothing can be left out."""
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(1500)]
    out = top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, 5, pivots=64)
    assert out.count() == 75 * 5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
