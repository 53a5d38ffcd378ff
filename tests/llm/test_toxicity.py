import zlib

import numpy as np
import pytest

from stratal.llm import toxicity
from stratal.llm.toxicity import Model, Sizes, dictionary, features, fit, score_toxicity, train_on, windows

SF = "/root/testdata/sf0.1"


def invented(rng, n, bad=0):
    syllables = ["the", "er", "on", "in", "re", "at", "ed", "nd", "ha", "en", "of", "or", "ti", "ing"]
    words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n)]
    for k in rng.choice(n, min(bad, n), replace=False):
        words[k] = str(rng.choice(["blockhead", "numbskull", "vermin"]))
    return " ".join(words)


def tables(spark, rows, labels):
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_windows_cover_the_whole_text():
    assert windows(None) == windows("") == windows(" \n\t ") == []
    for n in range(1, 12):
        words = [f"w{k}" for k in range(n)]
        seen = windows("  " + "\n".join(words) + " ")
        assert set(b" ".join(seen).decode().split()) == set(words)
        assert all(len(w.split()) <= toxicity.WORDS for w in seen)
    text = "é".join(str(k) for k in range(5000))
    long = windows(text + " end")
    pieces = [p for w in long[:-1] for p in w.split()[:toxicity.STEP]] + long[-1].split()
    assert b"".join(pieces).decode() == text + "end"
    assert max(map(len, long)) <= toxicity.WORDS * (toxicity.WORD_BYTES + 1) + 2


def test_lengths_are_those_of_plain_compression():
    import zstandard

    content = b" blockhead numbskull" * 40
    items = [b" you blockhead there ", b" a b c d ", b" "]
    plain = zstandard.ZstdCompressor(level=toxicity.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
                                     dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    assert Sizes(content)(items).tolist() == [len(plain.compress(x)) for x in items]
    assert dictionary([b"abc", b"def"], 4, 16) == b"cdef"  # too few samples to train on


def test_learns_words_of_toxic_texts_only(spark):
    rng = np.random.default_rng(4)
    rows = [(k, invented(rng, 150, 12 if k % 4 == 0 else 0)) for k in range(900)]
    # labels of held-out rows are wrong on purpose: they must not be read
    labels = [(k, 1, int((k % 4 == 0) == bool(zlib.crc32(str(k).encode()) % 5))) for k in range(900)]
    docs, marks = tables(spark, rows, labels)
    model = train_on(docs, marks)
    got = {r["doc_id"]: r for r in score_toxicity(docs, model).collect()}
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 5 == 0]
    right = [(got[k]["score"] >= 0.5) == (k % 4 == 0) for k in held]
    assert len(right) > 150 and np.mean(right) > 0.97
    # by the definition, with a compressor made anew
    text = rows[held[0]][1]
    gains = np.clip(Sizes(model.ordinary)(windows(text)) - Sizes(model.toxic)(windows(text)), -toxicity.SPAN, toxicity.SPAN)
    x = (features(gains, model.weights) - model.centre) / model.scale
    assert got[held[0]]["score"] == pytest.approx(1 / (1 + np.exp(-(x @ model.factors[:-1] + model.factors[-1]))))
    assert got[held[0]]["n_windows"] == len(gains) and got[held[0]]["gain"] == gains.sum()


def test_same_text_same_score_whatever_the_row(spark):
    rng = np.random.default_rng(9)
    texts = [invented(rng, 60, 5 * (k % 2)) for k in range(40)]
    model = fit(texts[1::2] * 5, texts[::2] * 5, 0.3)
    rows = [(1, texts[0]), (None, texts[0]), (1, texts[0]), (2, texts[1]), (3, None), (4, ""), (5, " \n"), (6, texts[1] * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as lang", "0.1 as score", "1 as id")
    got = score_toxicity(docs, model).collect()
    assert len(got) == len(rows) and len({r["score"] for r in got if r["n_windows"] and r["doc_id"] in (1, None)}) == 1
    empty = [r for r in got if r["doc_id"] in (3, 4, 5)]
    assert all(r["score"] == 0.3 and r["n_windows"] == 0 for r in empty)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_with_gaps_and_empty_tables(spark):
    docs, marks = tables(spark, [(1, "a b c"), (2, "d e f")], [(1, 1, None), (None, 1, 1), (77, 0, 1)])
    model = train_on(docs, marks)
    assert not model.fitted
    assert {r["score"] for r in score_toxicity(docs, model).collect()} == {model.rate}
    none, no_marks = tables(spark, [], [])
    model = train_on(none, no_marks)
    assert model.rate == 0.0 and score_toxicity(none, model).collect() == []
    only = fit(["x y z"] * 9, [], 1.0)
    assert isinstance(only, Model) and not only.fitted


def test_held_out_accuracy(spark):
    """English texts of the table; the small table holds too few toxic texts in the other languages to learn."""
    from stratal.llm.queries import op11_toxicity

    got = op11_toxicity(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    truth = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").join(docs, "doc_id").toPandas()
    assert len(got) == 10000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    both = got.merge(truth, on="doc_id")
    both = both[both.held_out & (both.lang == "en")]
    rank = both.score.rank()
    pos = both.toxic == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.85
    assert both[~pos].predicted.mean() < 0.1 and both[pos].predicted.mean() > 0.4
