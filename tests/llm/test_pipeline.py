"""The pipeline against brute-force versions of its stages."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_near_text import brute
from test_secrets import added, base

import corpus_pipeline as P
from stratal.llm.mixing import mix

SF = "/root/testdata/sf0.001"


def redacted(text):
    marked = set()
    for _, s, e in base(text):
        marked |= set(range(s, e))
    marked |= {p for _, p in added(text)}
    edges = {s for _, s, _ in base(text)}
    out, last = [], None
    for p, ch in enumerate(text):
        if p in marked:
            if last != p - 1:
                out.append("[SECRET]")
            last = p
        else:
            out.append(ch)
    return "".join(out), edges


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    rows = docs.collect()

    one = P.language_id(spark, docs, SF)
    assert one.columns == docs.columns
    kept = one.collect()
    assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in rows if any(c.isalpha() for c in r["text"] or "")}

    two = P.near_duplicates(spark, one, SF).cache()
    assert two.columns == docs.columns
    comp = brute([(r["doc_id"], r["text"]) for r in kept], 5, 80)
    assert sorted(r["doc_id"] for r in two.collect()) == sorted({c for _, c in comp.values()})

    three = P.secrets(spark, two, SF).cache()
    assert three.columns == docs.columns
    for a, b in zip(sorted(two.collect()), sorted(three.collect())):
        assert b["text"] == redacted(a["text"])[0] and b["n_chars"] == len(b["text"])

    four = P.mixing(spark, three, SF).cache()
    assert four.columns == docs.columns
    plan = mix(three.selectExpr("xxhash64(doc_id, source, text) AS key", "text", "source"), id_col="key").collect()
    want = {r["key"]: int(np.floor(r["taken"] / r["size"] + 0.5)) for r in plan if r["size"]}
    have = Counter(r["k"] for r in four.selectExpr("xxhash64(doc_id, source, text) AS k").collect())
    assert have == Counter({k: n for k, n in want.items() if n})

    five = P.bpe(spark, four, SF).collect()
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expect = []
    for r in four.collect():
        ids = lib.encode(r["text"], add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        expect.append((r["doc_id"], len(ids), np.array(ids, "<u4").tobytes(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded_sha256"]) for r in five) == sorted(expect)

    whole = P.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded_sha256"]) for r in whole) == sorted(expect)


@pytest.mark.parametrize("rows", [[], [(None, None), (None, "ab cd"), (1, None), (2, ""), (3, "12 34"), (4, "x " * 50_000),
                                       (5, "one two three four five six"), (5, "one two three four five six"),
                                       (6, "one two three four five six"), (None, "ab cd"),
                                       (7, "key password=hunter22 to the door")]])
def test_hand_made_rows_and_clashing_columns(spark, rows):
    data = [(i, t, "en", "s" if (i or 0) % 2 else None, len(t or ""), 1, 2.0, "k", True, 5) for i, t in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, key int, score double, "
                                       "row string, kept boolean, copies int")
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns[5:] == ["key", "score", "row", "kept", "copies"], name
        got = docs.collect()
        if name == "near_duplicates" and rows:
            assert sorted((r["doc_id"] or 0) for r in got) == [0, 0, 4, 5, 7]
        if name == "secrets" and rows:
            assert [r["text"] for r in got if r["doc_id"] == 7] == ["key [SECRET] to the door"]
    last = P.bpe(spark, docs, SF)
    assert last.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert last.count() == docs.count()


def test_only_copies_go_under_a_shared_id(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(3, b + " b60"), (5, a), (5, b), (7, "other words under one more id"), (7, "and these are not the same"),
            (7, "and these are not the same"), (8, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in P.near_duplicates(spark, docs, SF).collect())
    assert got == sorted([rows[0], rows[1], rows[3], rows[4]])


def test_only_the_last_stage_is_left(spark):
    from stratal.session import glob_paths, remove_path, scratch_root

    before = set(glob_paths(spark, f"{scratch_root(spark)}/*"))
    rows = P.run(spark, SF)
    left = set(glob_paths(spark, f"{scratch_root(spark)}/*")) - before
    assert len(left) == 1 and "/pipeline-bpe-" in left.pop() and rows.count() > 0
    remove_path(spark, rows.inputFiles()[0].rsplit("/", 1)[0])
