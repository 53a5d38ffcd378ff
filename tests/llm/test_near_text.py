import random

import numpy as np
import pytest

from stratal.llm.near_text import near_duplicate_texts, shingle_hashes, sketch

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, component_id int, n string"


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    """{(id, text): (set size, component)} by comparing every pair."""
    sets = {}
    for i, t in rows:
        sets.setdefault(shingles(t, size), []).append(i)
    keys = [s for s in sets if s]
    up = {s: min(sets[s]) for s in keys}
    comp = {min(sets[s]): min(sets[s]) for s in keys}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            x, y = keys[a], keys[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = root(up[x]), root(up[y])
                    comp[max(p, q)] = min(p, q)
    return {(i, t): (len(shingles(t, size)), root(up[shingles(t, size)]) if shingles(t, size) else i) for i, t in rows}


def check(spark, rows, size=3, percent=85, **options):
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], SCHEMA)
    got = near_duplicate_texts(df, shingle=size, percent=percent, **options).collect()
    want = brute([r for r in rows if r[0] is not None], size, percent)
    expect = sorted((i, *want[i, t], i == want[i, t][1]) for i, t in rows if i is not None)
    assert sorted(tuple(r) for r in got if r[0] is not None) == expect
    return got


def near_copies(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_documents_match_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_default_is_five_words_and_080(spark):
    rows = list(enumerate(near_copies(40, 80, 6, 2)))
    check(spark, rows, 5, 80)


def test_large_group_over_many_blocks(spark):
    texts = near_copies(120, 120, 9, 3) + ["one two three four"] * 40
    random.Random(5).shuffle(texts)
    check(spark, list(enumerate(texts, 10)), block_docs=16)
    check(spark, list(enumerate(texts, 10)), block_shingles=2000)


def test_hand_made_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "a"), (5, "A"), (6, "a b"), (7, "A  b"), (8, "b a"),
            (9, "a b c"), (9, "a b c"), (10, "a b c d"), (11, "É b c"), (12, "é b c"),
            (None, "a b c"), (13, "z " * 60_000), (14, "z z z")]
    got = check(spark, rows)
    by = {r["doc_id"]: r for r in got}
    assert by[5]["component_id"] == 4 and by[7]["component_id"] == 6 and by[8]["component_id"] == 8
    assert by[2]["n_shingles"] == 0 and by[3]["kept"] and by[14]["component_id"] == 13
    assert by[None]["component_id"] is None and by[None]["kept"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicate_texts(df).collect() == []


@pytest.mark.parametrize("size", [1, 2, 7, 400])
def test_sketch_fills_every_coordinate(size):
    rng = np.random.default_rng(size)
    v = rng.integers(0, 2 ** 63, size).astype(np.uint64)
    out = sketch(v, np.zeros(size, np.int64), 1, 64)
    assert (out != np.iinfo(np.uint64).max).all()


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 2 ** 63, 600).astype(np.uint64)
    two = [v[:500], v[100:]]  # similarity 2/3
    out = sketch(np.concatenate(two), np.repeat([0, 1], 500), 2, 1024)
    assert abs((out[0] == out[1]).mean() - 400 / 600) < 0.06


def test_shingle_hash_is_distinct_and_sorted():
    h = shingle_hashes("a b c a b c a", 3)
    assert len(h) == 3 and (np.diff(h.astype(object)) > 0).all()


def test_texts_that_share_an_id_stay_apart(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    near = b + " b60"
    rows = [(3, near), (5, a), (5, b), (7, "c " + a.replace("a", "c")), (7, "d " + a.replace("a", "d"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicate_texts(df).collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 5, True), (7, 7, True), (7, 7, True)]


def test_only_wanted_texts_are_shuffled(spark, monkeypatch):
    """The texts meet the narrow id list in a broadcast join, before their exchange."""
    from stratal.llm import near_text

    seen = []
    real = near_text.block_pairs
    monkeypatch.setattr(near_text, "block_pairs", lambda df, *a: seen.append(df) or real(df, *a))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    near_text.near_duplicate_texts(docs, shingle=3, percent=85, bands=36, rows=7).count()
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("documents.parquet")
    above = plan[:scan]
    assert "BroadcastHashJoin [rep" in above and "LeftSemi" in above
    assert "Exchange hashpartitioning(rep" not in above[above.index("LeftSemi"):]


def test_texts_reach_python_in_small_arrow_batches(spark, monkeypatch):
    """Every step that sends texts or sets to Python workers runs with bounded
    Arrow batches; the session's own limit is back afterwards."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    from stratal.llm import near_text
    from stratal.session import arrow_batches

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    wide = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("word "), 400).alias("text"))
    with arrow_batches(spark, 1 << 20):
        assert max(r["n"] for r in wide.mapInArrow(sizes, "n long").collect()) < 1.1 * (1 << 20)
    assert max(r["n"] for r in wide.mapInArrow(sizes, "n long").collect()) > 10 << 20

    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}
    before = spark.conf.get(key)
    for name in ("materialize", "components"):
        def spy(df, label, real=getattr(near_text, name)):
            seen[label] = spark.conf.get(key)
            return real(df, label)
        monkeypatch.setattr(near_text, name, spy)
    rows = list(enumerate(near_copies(20, 60, 3, 4)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_text.drop_near_duplicates(df).count() >= 1
    assert {seen[x] for x in ("near-sketch", "near-links", "near-kept")} == {f"{4 << 20}b"}
    assert spark.conf.get(key) == before
    spark.conf.set(key, "1m")
    try:
        near_text.drop_near_duplicates(df)
        assert seen["near-links"] == spark.conf.get(key) == "1m"  # a smaller limit stays
    finally:
        spark.conf.set(key, before)
