"""Language identification: multinomial naive Bayes over hashed n-grams.

Method. Texts are lowered, everything but letters becomes a space, and the
character bigrams and trigrams that hold a letter are hashed into ``buckets``
buckets. Training counts (language, bucket) are summed by Spark over all
labelled rows, with a map-side array per language; the smoothed
log-probability matrix (languages x buckets, a bound that does not depend on
the number of documents) is broadcast, and texts are scored in numpy batches:
sums of matrix columns over each text's n-grams, then the posterior.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratal.llm.arrow import slices

BUCKETS = 1 << 15
UNKNOWN = "und"
MAX_HELD = 64  # languages a task holds counts of before it passes them on


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngrams(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every n-gram, index of its text, letters per text)."""
    lowered = [(t or "").lower() for t in texts]
    ends = np.cumsum([len(t) + 2 for t in lowered])
    codes = np.frombuffer(("  " + "  ".join(lowered) + "    ").encode("utf-32-le", "surrogatepass"), np.uint32)
    alpha = _letters()[codes]
    c = np.where(alpha, codes, np.uint32(32)).astype(np.uint32)
    n = int(ends[-1]) if len(ends) else 0
    owner = np.repeat(np.arange(len(texts)), np.diff(np.concatenate([[0], ends])))
    a0, a1, a2 = alpha[:n], alpha[1:n + 1], alpha[2:n + 2]
    two = c[:n] * np.uint32(0x9E3779B1) + c[1:n + 1] * np.uint32(0x85EBCA77)
    three = two * np.uint32(0xC2B2AE3D) + c[2:n + 2] * np.uint32(0x27D4EB2F) + np.uint32(1)
    shift = np.uint32(32 - buckets.bit_length() + 1)

    def fold(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        return ((h ^ (h >> np.uint32(12))) * np.uint32(0x297A2D39)) >> shift

    has2, has3 = a0 | a1, a1 | (a0 & a2)
    grams = np.concatenate([fold(two)[has2], fold(three)[has3]])
    owners = np.concatenate([owner[has2], owner[has3]])
    return grams, owners, np.bincount(owner[a0], minlength=len(texts))


def train(labelled: DataFrame, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [language, bucket + 1]) from rows
    (text, lang); the last column is the log-prior."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush():
            for lang, sums in held.items():
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at])],
                    names=["lang", "bucket", "n"])
            held.clear()

        for b in slices(batches, "text", 1 << 20):
            langs = b.column("lang").to_pylist()
            grams, owners, _ = ngrams(b.column("text").to_pylist(), buckets)
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])
            for k, lang in enumerate(names):
                sums = held.setdefault(lang, np.zeros(buckets + 1, np.int64))
                sums[:buckets] += np.bincount(grams[code[owners] == k], minlength=buckets)
                sums[buckets] += int((code == k).sum())
            if len(held) > MAX_HELD:
                yield from flush()
        yield from flush()

    rows = (labelled.mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(rows.column("lang").to_pylist()))
    counts = np.zeros((len(langs), buckets + 1))
    place = {x: i for i, x in enumerate(langs)}
    at = np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)
    counts[at, rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    grams = counts[:, :buckets] + 0.5
    logp = np.empty_like(counts)
    logp[:, :buckets] = np.log(grams / grams.sum(axis=1, keepdims=True))
    logp[:, buckets] = np.log((counts[:, buckets] + 1) / (counts[:, buckets] + 1).sum()) if langs else 0
    return langs, logp


def score_texts(texts: list[str | None], langs: list[str], logp: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Best language and its posterior; ``und`` and 0 without a letter."""
    buckets = logp.shape[1] - 1
    grams, owners, letters = ngrams(texts, buckets)
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    sums = np.stack([np.bincount(owners, logp[k][grams], len(texts)) + logp[k, buckets] for k in range(len(langs))])
    best = sums.argmax(axis=0)
    top = sums.max(axis=0)
    post = 1.0 / np.exp(np.minimum(sums - top, 0.0)).sum(axis=0)
    pred = [langs[b] if n else UNKNOWN for b, n in zip(best, letters)]
    return pred, np.where(letters > 0, post, 0.0)


def identify_languages(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id",
                       text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """(id_col, *keep, lang_pred, score) per row of ``docs``.

    Defined cases: a null or empty text, or one without a letter, is ``und``
    with score 0, as is every text if the model learned no language; ties go
    to the first language in code-point order; a null id stays null; repeated
    rows give repeated results; an empty table gives an empty result. Whole
    texts are scored; no shuffle.
    """
    langs, logp = model
    sent = docs.sparkSession.sparkContext.broadcast((langs, logp))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = sent.value
        for b in slices(batches, "__text", 1 << 20):
            pred, post = score_texts(b.column("__text").to_pylist(), names, table)
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(post, pa.float64())],
                                             names=[*b.schema.names[:-1], "lang_pred", "score"])

    cols = [id_col, *keep]
    plain = docs.select(*cols, F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in plain.dtypes[:-1])
    return plain.mapInArrow(run, f"{schema}, lang_pred string, score double")


def held_out(id_col: str) -> F.Column:
    """crc32 of the id as text, modulo 5, is 0 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """The model of all labelled rows that are not held out (nor null-id)."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col))
    return train(rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), buckets)
