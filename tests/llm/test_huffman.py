import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from stratal.llm.huffman import (Code, code_lengths, parts, read_token_files, token_round_trip, tokenize, write_token_files)
from stratal.llm.queries import op3_token_files
from stratal.llm.tokens import TextEncoder

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(rows, library):
    out, at = [], 0
    for i, t in sorted(rows):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_whole_table_round_trip(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in op3_token_files(spark, SF).collect()) == expected(rows, library)


def test_texts_encode_as_the_library(library):
    rng = random.Random(7)
    atoms = ["a", "word", "Word's", "it's", " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", "é", "ß", " ", " ", "　",
             "\x1c", "\x1f", "\x00", "\x85", "123", "½", "!?", "<|endoftext|>", "<|", "😀", "é", "名前", "'", "'ll", ""]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randrange(0, 14))) for _ in range(4000)]
    texts += ["", " ", "full", "\x00full", " lead", "trail ", "x " * 5000, "y" * 20_000, "a  b", "a \n b", "a\n \nb"]
    for memory in (1 << 19, 5, 0):
        enc = TextEncoder(PATH, memory)
        for part in (texts, texts[::-1]):
            ids, counts = enc.encode(part)
            want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
            assert counts.tolist() == [len(w) for w in want]
            assert ids.tolist() == [i for w in want for i in w]
        assert len(enc.codes) <= memory


def limited_cost(counts, max_bits):
    """Optimal cost by dynamic programming over the tree's levels (small n)."""
    n, counts = len(counts), sorted(counts, reverse=True)
    total = [0]
    for c in counts:
        total.append(total[-1] + c)
    best = {(0, 1): 0}  # (symbols placed, free nodes) -> cost so far
    for _ in range(max_bits):
        nxt = {}
        for (done, free), cost in best.items():
            if done == n:
                nxt[(done, free)] = min(nxt.get((done, free), 1 << 60), cost)
                continue
            deeper = cost + total[n] - total[done]
            for leaves in range(0, min(2 * free, n - done) + 1):
                key = (done + leaves, min(2 * free - leaves, n))
                nxt[key] = min(nxt.get(key, 1 << 60), deeper)
        best = nxt
    return min(c for (done, _), c in best.items() if done == n)


@pytest.mark.parametrize("max_bits", [3, 4, 6])
def test_length_limited_code_is_optimal(max_bits):
    rng = random.Random(max_bits)
    for _ in range(25):
        counts = np.array([int(2 ** (rng.random() * 12)) for _ in range(rng.randrange(2, min(8, 1 << max_bits) + 1))])
        lengths = code_lengths(counts, max_bits).astype(int)
        assert lengths.max() <= max_bits and sum(2.0 ** -x for x in lengths) <= 1
        assert int((lengths * counts).sum()) == limited_cost(counts.tolist(), max_bits)


def test_unlimited_cost_equals_huffman():
    counts = np.array([5, 9, 12, 13, 16, 45, 1, 1, 2])
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    assert int((code_lengths(counts, 16).astype(int) * counts).sum()) == cost


@pytest.mark.parametrize("n, max_bits", [(1, 16), (2, 16), (40, 6), (3000, 12), (70_000, 16)])
def test_code_round_trip(n, max_bits):
    rng = np.random.default_rng(n)
    symbols = np.sort(rng.choice(200_000, n, replace=False)).astype(np.uint32)
    code = Code.from_counts(symbols, rng.geometric(0.01, n), max_bits)
    again = Code.unpack(code.pack())
    counts = np.array([0, 1, 255, 256, 257, 0, 3000])
    ids = rng.choice(symbols, counts.sum())
    bits, sizes, marks = code.encode(ids, counts, 256)
    at = np.cumsum(sizes) - sizes
    starts, sizes_of = [], []
    for k, c in enumerate(counts):
        for j, m in enumerate([0, *marks[k]] if c else []):
            starts.append(at[k] * 8 + m)
            sizes_of.append(min(256, c - 256 * j))
    assert again.decode(bits, np.array(starts), np.array(sizes_of)).tolist() == ids.tolist()


def test_hand_made_documents_over_several_files(spark, tmp_out, library):
    rows = [(5, "five words are in here"), (1, None), (2, ""), (9, "w" * 50_000), (3, "a <|endoftext|> b"), (7, "x y " * 3000),
            (8, "same"), (8, "same"), (-4, "negative"), (None, "no id")] + [(100 + i, f"text {i} " * (i % 40)) for i in range(200)]
    df = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, start int, range string")
    tokens = tokenize(df, PATH, 2).cache()
    write_token_files(tokens, tmp_out, step=16, file_ids=4000, block_ids=700)
    got = read_token_files(spark, tmp_out).collect()
    assert spark.read.format("binaryFile").load(tmp_out).count() > 3
    want = expected([(-1 << 62 if i is None else i, t) for i, t in rows], library)
    assert sorted((-1 << 62 if r["id"] is None else r["id"], r["start"], r["n"], zlib.crc32(bytes(r["ids"]))) for r in got) == want
    tokens.unpersist()


def test_empty_table_and_damage(spark, tmp_out):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_round_trip(none, PATH, tmp_out).collect() == []
    with pytest.raises(ValueError):
        list(parts(b"HTB1" + b"\x09" + bytes(7) + b"short"))


def test_ranges_ascend_and_spread_hot_ids():
    import pyarrow as pa

    from stratal.llm.huffman import Ranges

    plan = Ranges([3, 7, 7, 7, 7, 20, (1 << 63) - 1, (1 << 63) - 1], 5)
    ids = pa.array([None] * 50 + [-9, 0, 2, 3, 6] + [7] * 50 + [8, 19, 20, 10 ** 12] + [(1 << 63) - 1] * 9, pa.int64())
    got = plan.of(ids, np.arange(len(ids)))
    assert sorted(got[:50]) == sorted([0, 1, 2, 3, 4] * 10)
    rest = got[50:]
    lows = {}
    for i, r in zip(ids.to_pylist()[50:], rest):
        lows.setdefault(i, set()).add(int(r))
    order = sorted(lows)
    assert all(max(lows[a]) <= min(lows[b]) for a, b in zip(order, order[1:]))
    assert len(lows[7]) == 4 and not lows[7] & (lows[6] | lows[8]) and len(lows[(1 << 63) - 1]) == 2
    assert max(map(max, lows.values())) < plan.total


def test_hot_ids_spread_over_files_of_bounded_size(spark, tmp_out):
    from pyspark.sql import functions as F

    from stratal.llm import huffman
    from stratal.session import glob_paths

    rng = np.random.default_rng(3)
    rows = [(None, 6, [5, 4, 3, 2, 1, 2])] * 4000 + [(7, 5, [9, 9, 8, 1, 2])] * 2000
    rows += [(int(i), int(n), [int(x) for x in rng.integers(0, 50, n)]) for i, n in zip(rng.integers(-50, 900, 1500), rng.integers(1, 9, 1500))]
    tokens = (spark.createDataFrame([(i, n, np.array(x, "<u4").tobytes()) for i, n, x in rows], "id long, n long, ids binary").repartition(6)
              .withColumn("salt", F.monotonically_increasing_id()))
    stored = huffman.materialize(tokens, "test-tokens")
    huffman.write_token_files(stored, tmp_out, file_ids=2000, block_ids=400)
    files = glob_paths(spark, f"{tmp_out}/part-*")
    read = {f: [(r["start"], r["id"], r["n"], bytes(r["ids"])) for r in huffman.read_token_files(spark, f).collect()] for f in files}
    assert max(sum(r[2] for r in x) for x in read.values()) <= 2000 + 5 * 8  # blocks end with whole rows
    assert sum(any(r[1] is None for r in x) for x in read.values()) >= 12
    got = sorted(r for x in read.values() for r in x)
    assert [r[0] for r in got] == list(np.cumsum([0] + [r[2] for r in got[:-1]]))
    ids = [r[1] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert sorted(map(str, (r[1:] for r in got))) == sorted(str((i, n, np.array(x, "<u4").tobytes())) for i, n, x in rows)


def test_ranges_are_bounded(spark, monkeypatch):
    from stratal.llm import huffman

    monkeypatch.setattr(huffman, "MAX_RANGES", 10)
    tokens = spark.range(5000).selectExpr("id", "CAST(3 AS long) AS n")
    plan = huffman.plan_ranges(tokens, 1)
    assert plan.total <= 21 and len(plan.cuts) <= 20


def test_a_word_goes_to_the_library_once_whatever_follows_it(library):
    """Punctuation and line ends are cut off, so new combinations of known words are not encoded again."""
    enc = TextEncoder(PATH)
    words = ["alpha", "beta", "garçon", "delta", "omega"]
    enc.encode([" ".join(["start", *words, *words]), "Alpha x, y. z\nAlpha\nbeta\ndelta"])
    sent = []
    real, rest = enc.encoder.flat, enc._words
    enc.encoder = type("Spy", (), {"flat": lambda _, x: sent.extend(x) or real(x), "has_special": enc.encoder.has_special, "one": enc.encoder.one,
                                 "tokenizer": enc.encoder.tokenizer})()
    enc._words = lambda x: sent.extend(x) or rest(x)
    text = " ".join(f"start {a}, {b}." for a in words for b in words) + "\nAlpha beta,\ndelta"
    ids, counts = enc.encode([text])
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and counts.tolist() == [len(ids)]
    assert all(w not in x for x in sent for w in words)
    odd = ["a.\n\nb", "a.\n b", "don't.\nIt's", "naïveā.x", "Ωmega,\nb", "x\u0301y.z", "a\u00aab,c", "a1.\nb2", "a\r\nb", "a.\n\u00a0b", " a.\n", "q\n"]
    got = np.split(*(lambda i, c: (i, np.cumsum(c)[:-1]))(*enc.encode(odd)))
    assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in odd]


def test_counts_come_with_the_tokens(spark, library):
    from stratal.llm.huffman import global_code

    rows = [(i, f"text {i % 7}, of words" * (i % 5)) for i in range(300)] + [(None, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tokens = tokenize(docs, PATH, 2, counted=True).cache()
    again = global_code(tokens.drop("counts"))
    code = global_code(tokens.drop("ids"))  # the ids themselves are not needed
    assert code.symbols.tolist() == again.symbols.tolist() and code.lengths.tolist() == again.lengths.tolist()
    tokens.unpersist()
