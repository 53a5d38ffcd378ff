import math
import zlib

import numpy as np

from stratal.llm.langid import UNKNOWN, identify_languages, ngrams, score_texts, train, train_on
from stratal.llm.queries import op6_language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in op6_language(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    right = total = 0
    for d in docs:
        r = got[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        if r["held_out"] and d["lang"] is not None and any(c.isalpha() for c in d["text"] or ""):
            total += 1
            right += r["lang_pred"] == d["lang"]
    assert total > 100 and right / total > 0.97


def test_scores_equal_the_definition(spark):
    rows = [("le chat est là", "fr"), ("the cat is there", "en"), ("the dog", "en"), ("un chien", "fr")]
    langs, logp = train(spark.createDataFrame(rows, "text string, lang string"), 1 << 10)
    assert langs == ["en", "fr"]
    counts = {x: np.zeros(1 << 10) for x in langs}
    for t, x in rows:
        for g in ngrams([t], 1 << 10)[0]:
            counts[x][g] += 1
    pred, post = score_texts(["the chat"], langs, logp)
    sums = []
    for x in langs:
        p = (counts[x] + 0.5) / (counts[x] + 0.5).sum()
        sums.append(sum(math.log(p[g]) for g in ngrams(["the chat"], 1 << 10)[0]) + math.log(3 / 6))
    want = math.exp(sums[0]) / sum(math.exp(s) for s in sums)
    assert abs((post[0] if pred[0] == "en" else 1 - post[0]) - want) < 1e-9


def test_grams_do_not_cross_texts():
    one = [sorted(ngrams([t], 1 << 12)[0].tolist()) for t in ("ab", "cdé", "", "1")]
    grams, owners, letters = ngrams(["ab", "cdé", "", "1", None], 1 << 12)
    assert [sorted(grams[owners == k].tolist()) for k in range(4)] == one
    assert letters.tolist() == [2, 3, 0, 0, 0]


def test_hand_made_rows(spark):
    rows = [(1, "the cat", "en", 1), (2, "the cat", "en", 1), (2, "the cat", "en", 1), (3, None, "en", 1), (4, "", None, 1),
            (5, "123 !!", "de", 1), (None, "der hund", "de", 1), (6, "the " * 100_000, None, 1), (7, "le chat", "fr", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = identify_languages(df, train_on(df)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[3]["lang_pred"] == by[4]["lang_pred"] == by[5]["lang_pred"] == UNKNOWN and by[5]["score"] == 0.0
    assert by[6]["lang_pred"] == "en"
    empty = spark.createDataFrame([], df.schema)
    assert identify_languages(empty, train_on(empty)).collect() == []
    assert {r["lang_pred"] for r in identify_languages(df, train_on(empty)).collect()} == {UNKNOWN}
