import re

import pytest

from stratal.llm.mixing import PHI, mix, schedule, source_targets, sized_documents
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
COLS = "doc_id long, text string, source string, size int, taken string"


def water_fill(sizes, weights=(1, 2, 3), cap=3):
    """Targets by resharing the excess again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return {**fixed, **share}
        fixed.update({s: cap * sizes[s] for s in over})


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in rows], COLS)
    got = mix(df, **options).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    targets = water_fill(sizes)
    source = {i: s for i, _, s in rows}
    assert sorted((r[0] or -1, r["size"]) for r in got) == sorted((i or -1, size(t)) for i, t, _ in rows)
    taken = {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s], abs=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.5 + 1e-6
    return sorted(tuple(r) for r in got if r[0] is not None)


def test_documents_against_water_filling(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    first = check(spark, rows)
    assert first == check(spark, rows[::-1])  # reruns agree, whatever the order of rows


def test_capped_sources_and_hand_made_cases(spark):
    rows = [(1, "a b", "tiny"), (2, None, "tiny"), (3, "", None), (4, "x " * 500, None), (5, "y " * 90_000, "big"),
            (6, "p q r", "zé"), (7, "p q r", "Z"), (8, " \t\n", "empty"), (9, "one two", "zé"), (10, "q " * 7000, "hot")]
    rows += [(100 + i, "w " * (i % 7), "hot") for i in range(300)]
    check(spark, rows, block=64)
    check(spark, rows, block=100_000)


def test_empty_and_wordless_tables(spark):
    assert check(spark, []) == []
    assert [r[-1] for r in check(spark, [(1, None, "a"), (2, " ", None)])] == [0, 0]


def test_repeated_rows_share_what_is_taken(spark):
    rows = [(1, "a b c d", "s")] * 3 + [(2, "e f", "t"), (3, "g " * 40, "u")]
    df = spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in rows], COLS)
    got = mix(df, block=2).where("doc_id = 1").collect()
    assert len(got) == 3 and sum(r["taken"] for r in got) == round(got[0]["target"])


def test_schedule_follows_the_golden_ratio(spark):
    rows = [(i, "w " * 50, f"s{i % 3}") for i in range(300)]
    df = spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in rows], COLS)
    targets = source_targets(sized_documents(df, "doc_id", "text", "source")).orderBy("source").collect()
    plan = schedule(source_targets(sized_documents(df, "doc_id", "text", "source")), 10, chunk=8).orderBy("slot").collect()
    total = sum(t["target"] for t in targets)
    high, at = [], 0.0
    for t in targets:
        at += t["target"] / total
        high.append(at)
    inside = [p for p in plan if p["slot"] < len(plan)]
    for p in inside[:200]:
        u = p["slot"] * PHI % 1.0
        assert p["source"] == targets[next(k for k, h in enumerate(high) if u < h)]["source"]
    seen = {}
    for p in inside:  # ranks count a source's earlier slots
        assert p["rank"] == seen.get(p["source"], 0)
        seen[p["source"]] = p["rank"] + 1
