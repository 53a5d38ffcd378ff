import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratal.llm.vector_codes import (Gnat, books_text, compress_vectors, decode_vectors, encode_vectors, squared,
                                      train_codebooks)
from tests.conftest import SF_SMALL


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{row index: (codes, error)} and codebooks, in Python integers only."""
    def floor(x):
        return math.floor(x * scale) if abs(x) < 2 ** 52 else int(x) * scale

    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = next((len(v) for _, v in kept if len(v) and len(v) % parts == 0), 0)
    ints = [[floor(x) for x in v] for _, v in kept if len(v) == width and width]
    n = width // parts
    cells = [[v[p * n:(p + 1) * n] for p in range(parts)] for v in ints]
    books = [[c[p] for c in cells[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p])) for p, x in enumerate(c)]
                for c in cells]

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, g in zip(cells, got) if g[p][1] == k]
                if mine:
                    books[p][k] = [sum(col) // len(mine) for col in zip(*mine)]
    return [([k for _, k in g], sum(d for d, _ in g)) for g in assign()], books


def as_lists(books):
    return [[[int(x) for x in e] for e in b] for b in books]


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def check(spark, rows, kind="double"):
    coded, books = compress_vectors(frame(spark, rows, kind))
    got = sorted((tuple(r["codes"]), r["error"]) for r in coded.collect() if r["codes"] is not None)
    want, want_books = brute([(r[0], r[1]) for r in rows])
    assert got == sorted((tuple(c), e if e < 2 ** 63 else None) for c, e in want)
    assert as_lists(books) == [b for b in want_books]
    return coded, books


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_tree_finds_the_brute_force_entry(data):
    length = data.draw(st.integers(1, 4))
    small = st.integers(-3, 3)
    book = np.array(data.draw(st.lists(st.lists(small, min_size=length, max_size=length), min_size=1, max_size=24)))
    rows = np.array(data.draw(st.lists(st.lists(small, min_size=length, max_size=length), min_size=1, max_size=40)))
    for kind, shift in ((np.int64, 0), (object, 10 ** 40), (object, 10 ** 300)):
        b, r = book.astype(kind) * (shift or 1), rows.astype(kind) * (shift or 1)
        at, best = Gnat(b).nearest(r)
        for x, a, d in zip(r, at, best):
            assert (d, a) == min((int(squared(x[None], e)[0]), k) for k, e in enumerate(b))


def test_far_subtrees_are_not_measured():
    rng = np.random.default_rng(1)
    centres = rng.integers(-10 ** 6, 10 ** 6, (4, 8))
    book = np.concatenate([c + rng.integers(-50, 50, (16, 8)) for c in centres])
    rows = np.concatenate([c + rng.integers(-50, 50, (500, 8)) for c in centres])
    tree = Gnat(book)
    at, best = tree.nearest(rows)
    assert tree.measured < 0.5 * len(rows) * len(book)
    every = ((rows[:, None, :] - book[None]) ** 2).sum(2)
    assert (at == every.argmin(1)).all() and (best == every.min(1)).all()


def test_random_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(size=16)], int(i) % 3) for i in range(120)]
    coded, books = check(spark, rows)
    assert len({r["label_error"] for r in coded.collect()}) <= 3
    back = decode_vectors(coded, books).collect()
    assert all(len(r["vector"]) == 16 for r in back)
    r = back[0]
    first = [x / 4096 for x in as_lists(books)[0][r["codes"][0]]]
    assert r["vector"][:2] == first


def test_ties_copies_nulls_and_other_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 8)], None if i % 4 == 0 else i % 2) for i in range(60)]
    rows += [(5, rows[5][1], 1), (5, rows[6][1], 1), (None, rows[7][1], None)]
    bad = [(100, None, 1), (101, [1.0, None] * 4, 1), (102, [math.nan] * 8, 1), (103, [math.inf] + [0.0] * 7, 1)]
    odd = [(-5, [], 1), (-4, [1.0] * 7, 1), (104, [1.0] * 16, 9)]
    coded, _ = compress_vectors(frame(spark, rows + bad + odd))
    got = coded.collect()
    assert len(got) == len(rows) + len(odd)
    want, _ = brute([(r[0], r[1]) for r in rows])
    assert sorted((tuple(r["codes"]), r["error"]) for r in got if r["codes"] is not None) == sorted((tuple(c), e) for c, e in want)
    lone = [r for r in got if r["codes"] is None]
    assert sorted(r["vec_id"] for r in lone) == [-5, -4, 104] and all(r["error"] is None for r in lone)
    sums = {}
    for r in got:
        sums[r["label"]] = sums.get(r["label"], 0) + (r["error"] or 0)
    assert {r["label"]: r["label_error"] for r in got if r["label"] != 9} == {k: v for k, v in sums.items() if k != 9}
    assert next(r for r in got if r["label"] == 9)["label_error"] is None


def test_components_beyond_long_arithmetic(spark):
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate([
        [1e30] * 8, [-1e30] * 8, [1e5] * 8, [0.5] * 8, [3.0e38] * 8, [1e-40] * 8, [-0.0] * 8, [1.7e308] * 8, [-1.7e308] * 8,
        *[[float(k)] * 8 for k in range(20)]])]
    coded, _ = check(spark, rows)
    assert coded.count() == len(rows)


def test_empty_tables_and_clashing_columns(spark):
    coded, books = compress_vectors(frame(spark, []))
    assert coded.collect() == [] and all(len(b) == 0 for b in books)
    only_bad, _ = compress_vectors(frame(spark, [(1, None, 1)]))
    assert only_bad.collect() == []
    rows = frame(spark, [(i, [float(i)] * 8, 1) for i in range(5)]).selectExpr(
        "vec_id", "embedding", "label", "1 as v", "2 as id", "3 as codes", "4 as error")
    got, books = compress_vectors(rows)
    assert sorted(r["vec_id"] for r in got.collect()) == list(range(5))
    same = encode_vectors(rows, books)
    assert same.columns == ["vec_id", "label", "codes", "error"]


def test_query_digests(spark):
    from stratal.llm.queries import op12_vector_codes

    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    want, books = brute([(r[0], r[1]) for r in rows])
    text = ",".join(str(x) for b in books for e in b for x in e)
    got = op12_vector_codes(spark, SF_SMALL).collect()
    assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(text.encode()).hexdigest()}
    assert sorted((r["code"], r["error"]) for r in got) == sorted(("".join(f"{k:02x}" for k in c), e) for c, e in want)


@pytest.mark.parametrize("parts", [2, 4])
def test_other_parameters(spark, parts):
    rng = np.random.default_rng(parts)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 1) for i in range(40)]
    books = train_codebooks(frame(spark, rows), parts=parts, entries=5, rounds=3, scale=256)
    _, want = brute([(r[0], r[1]) for r in rows], parts, 5, 3, 256)
    assert as_lists(books) == want
    assert books_text(books).count(",") == parts * 5 * (8 // parts) - 1
