import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratal.llm import spelling
from stratal.llm.spelling import count_words, near_pairs, one_edit, spelling_variants


def letters(c):
    return "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ"


def brute_count(rows, min_length=5, min_count=3, thin=97):
    total = Counter()
    for doc, text in rows:
        run = ""
        for c in (text or "") + " ":
            if letters(c):
                run += c.lower() if c < "\x80" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode("utf-8"))
                if thin and h % thin == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                total[run] += 1
            run = ""
    return {w: n for w, n in total.items() if len(w) >= min_length and n >= min_count}


def near(u, v):
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return any(v[:k] + v[k + 1:] == u for k in range(len(v)))


def brute(counts, ratio=2):
    out = {}
    for w, n in counts.items():
        others = [(-counts[v], v) for v in counts if near(w, v)]
        form = None
        if others and -min(others)[0] >= ratio * n:
            form = min(others)[1]
        out[w] = [form, None, n, len(others), counts[form] if form else None]
    for w in out:
        end = w
        while out[end][0]:
            end = out[end][0]
        out[w][1] = end
    return {w: tuple(v) for w, v in out.items()}


def run(spark, counts, ratio=2):
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling_variants(rows, ratio).collect()
    assert len(got) == len({r["word"] for r in got})
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}


words = st.text(alphabet="abé", min_size=1, max_size=6)


@settings(max_examples=200, deadline=None)
@given(st.lists(words, min_size=2, max_size=14, unique=True))
def test_gram_block_equals_definition(names):
    """One block without a split: all pairs of adjacent lengths."""
    m = len(names)
    no, yes = np.zeros(m, bool), np.ones(m, bool)
    i, j = near_pairs(names, np.zeros(m, int), yes, np.zeros(m, int), no, np.zeros(m, int), no)
    assert {(names[a], names[b]) for a, b in zip(i, j)} == {
        (names[a], names[b]) for a in range(m) for b in range(a + 1, m) if near(names[a], names[b])}


def test_small_alphabet_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    counts = {}
    for _ in range(700):
        w = "".join(rng.choice(list("abcÿ"), rng.integers(1, 8)))
        counts[w] = int(3 * 2 ** rng.integers(0, 9))
    assert run(spark, counts) == brute(counts)
    # pieces of two words: every block is cut
    monkeypatch.setattr(spelling, "PIECE", 3)
    assert run(spark, counts) == brute(counts)


def test_one_huge_block(spark, monkeypatch):
    """A third of all words share their first half."""
    rng = np.random.default_rng(6)
    counts = {"prefix" + "".join(rng.choice(list("abcde"), 6)): int(rng.integers(3, 4000)) for _ in range(900)}
    counts |= {"".join(rng.choice(list("vwxyz"), 9)): 5 for _ in range(600)}
    monkeypatch.setattr(spelling, "PIECE", 100)
    assert run(spark, counts) == brute(counts)


def test_chain_ties_and_ratio(spark):
    counts = {"abcde": 3, "abcdf": 6, "abcgf": 12, "abhgf": 24, "aihgf": 48, "jihgf": 96, "zzzzz": 9, "yzzzz": 18, "xzzzz": 18}
    got = run(spark, counts)
    assert got == brute(counts)
    assert got["abcde"][1] == "jihgf" and got["zzzzz"][:2] == ("xzzzz", "xzzzz")
    assert run(spark, counts, 3) == brute(counts, 3)
    with pytest.raises(ValueError):
        spelling_variants(spark.createDataFrame([("a", 1)], "word string, n long"), 1)


def test_long_words_other_scripts_and_repeats(spark):
    long = "ab" * 20000
    counts = {long: 3, long + "a": 9, long[:-1] + "z": 20, "日本語文": 4, "日本語": 10, "日木語文": 50, "\x00ab": 3, "ab": 30}
    assert run(spark, counts) == brute(counts)
    rows = spark.createDataFrame([("abcde", 2), ("abcde", 3), (None, 4), ("", 4), ("abcdf", 10)], "word string, n long")
    got = {r["word"]: (r["n"], r["form"]) for r in spelling_variants(rows).collect()}
    assert got == {"abcde": (5, "abcdf"), "abcdf": (10, None)}


def test_one_edit_overlapping_ends():
    names = ["aaaa", "aaaaa", "abab", "babab", "abba", "abab"]
    sizes = np.array([len(x) for x in names])
    codes, ends = np.zeros((6, 5), int), np.zeros((6, 5), int)
    for k, w in enumerate(names):
        codes[k, :len(w)] = [ord(c) for c in w]
        ends[k, 5 - len(w):] = [ord(c) for c in w]
    for i in range(6):
        for j in range(6):
            if i != j:
                assert one_edit(codes, ends, sizes, np.array([i]), np.array([j]))[0] == near(names[i], names[j])


def test_counting_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    pool = ["Straße", "ÉCOLE", "école", "colour", "COLOR", "naïve", "ab", "x×y÷zzz", "tëst", "hello_world", "don't"]
    rows = [(int(k), " ".join(rng.choice(pool, 300)) + "\n") for k in range(20)]
    rows += [(None, "hello hello hello"), (7, None), (8, ""), (9, "hello" * 50000), (9, "hello" * 50000), (9, "12345 !!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as word", "2 as n", "3 as id")
    for thin in (97, 3, None):
        got = {r["word"]: r["n"] for r in count_words(docs, thin=thin).collect()}
        assert got == brute_count(rows, thin=thin)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(count_words(empty)).collect() == []
    assert run(spark, {"alone": 3}) == {"alone": (None, "alone", 3, 0, None)}
