import numpy as np

from stratal.llm.near_vector import near_duplicate_vectors

SF = "/root/testdata/sf0.01"


def brute(rows, threshold):
    ids, links, comp = [r[0] for r in rows], [0] * len(rows), list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    def ok(v, label):
        return (v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)
                and any(x != 0 for x in v))

    unit = [None if not ok(v, lab) or i is None else np.array(v, float) / np.abs(v).max() for i, v, lab in rows]
    unit = [None if u is None else u / np.sqrt((u * u).sum()) for u in unit]
    for a in range(len(rows)):
        for b in range(a):
            if (unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2]
                    and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold):
                links[a] += 1
                links[b] += 1
                p, q = sorted((root(a), root(b)), key=lambda i: ids[i])
                comp[q] = p
    low = {}
    for i in range(len(rows)):
        if ids[i] is not None:
            low[root(i)] = min(low.get(root(i), ids[i]), ids[i])
    return sorted((i, links[k], low[root(k)], i == low[root(k)]) for k, i in enumerate(ids) if i is not None)


def check(spark, rows, threshold=0.98, **options):
    df = spark.createDataFrame([(i, v, lab, 0) for i, v, lab in rows],
                               "vec_id long, embedding array<double>, label int, n_links int")
    got = near_duplicate_vectors(df, threshold=threshold, **options).collect()
    assert sorted(tuple(r) for r in got if r[0] is not None) == brute(rows, threshold)
    return got


def test_embeddings_match_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    check(spark, rows)


def test_large_group_over_many_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.06 * rng.standard_normal(16)).tolist(), 1) for i in range(150)]
    rows += [(200 + i, rng.standard_normal(16).tolist(), i % 2) for i in range(60)]
    rows += [(300 + i, base.tolist(), 1) for i in range(30)]
    check(spark, rows, block=16)


def test_hand_made_cases(spark):
    v = [0.6, 0.8, 0.0]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
            (8, [float("nan"), 1.0, 0.0], 1), (9, [float("inf"), 1.0, 0.0], 1), (10, [None, 1.0, 0.0], 1),
            (11, [0.6, 0.8], 1), (12, [6e300, 8e300, 0.0], 1), (13, [6e-300, 8e-300, 0.0], 1), (None, v, 1),
            (14, [-0.6, -0.8, 0.0], 1), (15, [0.6, 0.8, -0.0], 1)]
    got = check(spark, rows)
    by = {r["vec_id"]: r for r in got}
    assert by[1]["n_links"] == 5 and by[12]["component_id"] == 1 and by[11]["n_links"] == 0
    assert by[None]["component_id"] is None


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert near_duplicate_vectors(df).collect() == []


def test_vectors_that_share_an_id_stay_apart(spark):
    u, v, w = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    near = [0.0, 1.0, 0.05]
    got = check(spark, [(3, near, 1), (5, u, 1), (5, v, 1), (6, w, 1), (6, u, 2), (6, u, 1), (8, v, 2)])
    by = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got)
    assert by == [(3, 1, 3), (5, 1, 3), (5, 1, 5), (6, 0, 6), (6, 0, 6), (6, 1, 5), (8, 0, 8)]
