import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from stratal.llm.bpe import bpe_decode, bpe_encode
from stratal.llm.queries import op5_bpe

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_whole_table_against_the_library(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    got = [tuple(r) for r in op5_bpe(spark, SF).collect()]
    assert len(got) == len(rows) and set(got) == want


@pytest.mark.parametrize("hot", [0, 10, 1 << 18])
def test_odd_texts_against_the_library(spark, library, hot):
    rng = random.Random(3)
    atoms = ["a", "Word", "IT'S", "it's", " ", "  ", "\n", "\t", "\x0b", "\r\n", "é", "É", "ß", "İ", "Σ", "ς", " ", " ", "　",
             "\x1c", "\x1f", "\x00", "\x85", "123", "½", "!?", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "😀",
             "é", "́", "名前", "'", "ﬁ", "Å"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randrange(0, 12))) for _ in range(600)]
    texts += [None, "", " \t\n", "w " * 30_000, "y" * 9_000, "same text", "same text"]
    rows = [(None if i == 17 else i, t, 1, "z") for i, t in enumerate(texts)] + [(5, texts[5], 1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, word string")
    got = bpe_decode(bpe_encode(df, PATH, hot=hot), PATH).collect()
    want = []
    for i, t, _, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((-1 if i is None else i, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    have = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], np.frombuffer(bytes(r["ids"]), "<u4").tolist(), r["decoded"])
            for r in got]
    assert sorted(have) == sorted(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_decode(bpe_encode(df, PATH), PATH).collect() == []


def test_texts_with_equal_32_bit_hashes_under_one_id(spark, library):
    texts = ["word81550 end", "word145132 end", "word81550 end", "other words here"]
    rows = [(1, t) for t in texts] + [(None, t) for t in texts] * 2
    for hot in (0, 1 << 18):
        got = bpe_encode(spark.createDataFrame(rows, "doc_id long, text string"), PATH, hot=hot).collect()
        have = sorted((r["doc_id"] or 0, np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in got)
        assert have == sorted((i or 0, library.encode(t, add_special_tokens=False).ids) for i, t in rows)


def test_many_equal_rows(spark, library):
    """Copies hand over their rare words once, and come back as often as they are."""
    text = " ".join(f"rare{k}" for k in range(300))
    docs = spark.range(4000).selectExpr("CAST(NULL AS bigint) AS doc_id", f"'{text}' AS text").repartition(8)
    got = bpe_encode(docs, PATH, hot=0)
    ids = library.encode(text, add_special_tokens=False).ids
    assert got.groupBy("ids").count().collect() == [(np.array(ids, "<u4").tobytes(), 4000)]


@pytest.mark.parametrize("least, counted", [(1, 1 << 19), (2, 1 << 19), (2, 50), (10 ** 6, 1 << 19)])
def test_what_is_counted_does_not_change_results(spark, library, monkeypatch, least, counted):
    from stratal.llm import bpe

    monkeypatch.setattr(bpe, "COUNTED", counted)
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["the", "of", f"w{rng.randrange(400)}", f"Ünique{k}x{rng.randrange(9)}"]) for _ in range(40)) for k in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in bpe_encode(docs, PATH, least=least).collect()}
    assert got == {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}


def test_a_word_over_several_batches_is_encoded_once(library):
    import pyarrow as pa

    from stratal.llm.bpe import _encode_rare

    words = ["alpha"] * 30_000 + ["beta"] * 10 + ["gamma"] * 70_000
    n = len(words)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([0] * n), pa.array([0] * n, pa.int32()), pa.array(words)],
                                       names=["k1", "k2", "at", "word"])
    out = pa.Table.from_batches(list(_encode_rare(PATH)(iter([batch]))))
    ids = {w: np.array(library.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in set(words)}
    assert out.column("k1").to_pylist() == list(range(n))
    assert out.column("ids").to_pylist() == [ids[w] for w in words]


def test_counts_of_whole_texts(spark):
    from collections import Counter

    from stratal.llm.bpe import count_words

    texts = ["a b a", "c a\tb", None, "", "d d d e", "E é é"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    want = Counter(w.lower() for t in texts for w in (t or "").split())
    assert {r["word"]: r["n"] for r in count_words(docs).collect()} == want
    assert {r["word"]: r["n"] for r in count_words(docs, 2).collect()} == {w: n for w, n in want.items() if n > 1}
