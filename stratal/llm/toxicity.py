"""Toxicity scores by compression distance.

Method. Texts are cut into windows of ``WORDS`` words. A zstandard dictionary
trained on toxic text and one trained on ordinary text compress each window;
the bytes the toxic one saves are the window's gain. Whole texts of both kinds are
mostly alike, so the two dictionaries share a base trained on other ordinary
text, and are trained on the windows that the base compresses worst; then
dictionaries of one half of the texts choose the windows of the other half
on which the two differ. What is left in the toxic dictionary is what recurs
in toxic texts only.

Calibration. Gains of labelled windows (measured with dictionaries that did
not see them, in two folds) give a weight per gain, the logarithm of how much
more often it occurs in toxic texts; a logistic model over a text's weights
gives the score, shifted so that 0.5 is the threshold of the best F1 at the
share of toxic labels in the training rows.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS`` per
class, ``SAMPLE_CHARS`` characters per class) and broadcast (two dictionaries
of at most ``BASE + OWN`` bytes). Scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratal.llm.arrow import slices
from stratal.llm.langid import held_out

WORDS, STEP = 5, 3  # words of a window, words from one window to the next
WORD_BYTES = 48  # longer words are cut into several
BASE, OWN = 1 << 16, 1 << 12  # bytes of the common base and of each class's own part
LEVEL = 12
SEGMENT = 12  # length of the pieces a dictionary is made of
SHARE = 0.2  # of the windows, those the base compresses worst
KEEP = 3  # bytes of gain by which a window is chosen
SPAN = 10  # gains beyond this count as this
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_TEXT = 2000, 3 << 20, 1 << 16
PIECE = re.compile(rb"\S{1,%d}" % WORD_BYTES)


def windows(text: str | None) -> list[bytes]:
    """Overlapping windows of the text's words, the whole text covered."""
    words = (text or "").encode().split()
    if words and max(map(len, words)) > WORD_BYTES:
        words = PIECE.findall((text or "").encode())
    starts = range(0, max(1, len(words) - (WORDS - STEP)) if words else 0, STEP)
    return [b" " + b" ".join(words[i:i + WORDS]) + b" " for i in starts]


class Sizes:
    """Compressed lengths of windows under one raw dictionary."""

    def __init__(self, content: bytes, level: int = LEVEL):
        import zstandard

        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=level)
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=words, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False)

    def __call__(self, items: list[bytes]) -> np.ndarray:
        compress = self.compressor.compress
        return np.fromiter(map(len, map(compress, items)), np.int32, len(items))


def dictionary(samples: list[bytes], size: int, segment: int) -> bytes:
    """The content of a dictionary trained on the samples; with too few of
    them to train on, the samples themselves."""
    import zstandard

    if sum(map(len, samples)) > 8 * size and len(samples) >= 16:
        try:
            return zstandard.train_dictionary(size + 1024, samples, d=6, k=segment, split_point=1.0).as_bytes()[-size:]
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


@dataclass(frozen=True)
class Model:
    toxic: bytes  # dictionary contents
    ordinary: bytes
    weights: np.ndarray  # per gain from -SPAN to SPAN
    centre: np.ndarray  # of the features
    scale: np.ndarray
    factors: np.ndarray  # of the logistic model, the last one constant
    rate: float  # share of toxic labels in the training rows: the score of a text without words
    fitted: bool

    def score(self, gains: np.ndarray) -> float:
        if not self.fitted or not len(gains):
            return self.rate
        x = np.append((features(gains, self.weights) - self.centre) / self.scale, 1.0)
        return float(1 / (1 + np.exp(-np.clip(x @ self.factors, -30, 30))))


def features(gains: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A text's evidence: weights summed over the root of their number, mean, the three largest, length."""
    w = weights[gains + SPAN]
    n = len(w)
    return np.array([w.sum() / np.sqrt(n), w.mean(), np.sort(w)[-3:].mean(), np.log(n)])


def _pair(base: bytes, measure: Sizes, toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> tuple[bytes, bytes]:
    """The two dictionaries (own part in front of the base) of the windows of
    two sets of texts.

    First dictionaries are trained on every other text, and choose among
    the windows of the texts they did not see: what only one text says does not return in another.
    """

    def worst(items: list[bytes]) -> list[bytes]:
        if not items:
            return []
        ratio = measure(items) / np.array([len(x) for x in items])
        least = np.quantile(ratio, 1 - SHARE)
        return [x for x, r in zip(items, ratio) if r >= least]

    def trained(a: list[bytes], b: list[bytes]) -> tuple[bytes, bytes]:
        return dictionary(a, OWN, SEGMENT) + base, dictionary(b, OWN, SEGMENT) + base

    kept: tuple[list[bytes], list[bytes]] = [], []
    for half in (0, 1):
        t, o = map(Sizes, trained(worst(_flat(toxic[half::2])), worst(_flat(ordinary[half::2]))))
        for out, own, other, texts in ((kept[0], t, o, toxic), (kept[1], o, t, ordinary)):
            items = _flat(texts[1 - half::2])
            out += [x for x, g in zip(items, other(items) - own(items)) if g >= KEEP]
    return trained(kept[0] or worst(_flat(toxic)), kept[1] or worst(_flat(ordinary)))


def _flat(lists) -> list[bytes]:
    return [x for one in lists for x in one]


def _gains(pair: tuple[bytes, bytes], lists: list[list[bytes]]) -> list[np.ndarray]:
    toxic, ordinary = Sizes(pair[0]), Sizes(pair[1])
    items = _flat(lists)
    gains = np.clip(ordinary(items) - toxic(items), -SPAN, SPAN)
    return np.split(gains, np.cumsum([len(x) for x in lists])[:-1]) if lists else []


def fit(toxic: list[str], ordinary: list[str], rate: float) -> Model:
    """The model of two samples of texts; ``rate`` is the share of toxic rows.

    Without windows of either kind (or with one text of a kind) nothing is
    fitted and every score is ``rate``.
    """
    none = Model(b"", b"", np.zeros(2 * SPAN + 1), np.zeros(4), np.ones(4), np.zeros(5), rate, False)
    base_texts, ordinary = ordinary[::2], ordinary[1::2]
    tox, ord_ = ([w for w in map(windows, texts) if w] for texts in (toxic, ordinary))
    if len(tox) < 2 or len(ord_) < 2:
        return none
    base = dictionary([t.encode()[i:i + 512] for t in base_texts for i in range(0, len(t.encode()), 512)], BASE, 2 * SEGMENT)
    measure = Sizes(base)
    # two folds: gains of texts that the dictionaries did not see
    gains: list[list[np.ndarray]] = [[], []]
    for fold in (0, 1):
        pair = _pair(base, measure, tox[fold::2], ord_[fold::2])
        for k, lists in enumerate((tox, ord_)):
            gains[k] += _gains(pair, lists[1 - fold::2])
    counts = [np.bincount(np.concatenate(g) + SPAN, minlength=2 * SPAN + 1) + 1.0 for g in gains]
    weights = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    x = np.array([features(g, weights) for g in gains[0] + gains[1]])
    y = np.repeat([1.0, 0.0], [len(gains[0]), len(gains[1])])
    centre, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[(x - centre) / scale, np.ones(len(x))]
    each = np.where(y == 1, rate / y.sum(), (1 - rate) / (1 - y).sum()) * len(y)  # as frequent as in the training rows
    factors = np.zeros(a.shape[1])
    ridge = np.eye(len(factors))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ factors, -30, 30)))
        hessian = a.T @ (a * (each * p * (1 - p))[:, None]) + ridge
        factors = factors + np.linalg.solve(hessian, a.T @ (each * (y - p)) - ridge @ factors)
    # the threshold of the best F1 becomes 0.5
    value = a @ factors
    order = np.argsort(-value, kind="stable")
    hit, all_ = np.cumsum((each * y)[order]), np.cumsum(each[order])
    best = int(np.argmax(2 * hit / (all_ + (each * y).sum())))
    after = value[order[best + 1]] if best + 1 < len(order) else value[order[best]] - 1
    factors[-1] -= (value[order[best]] + after) / 2
    pair = _pair(base, measure, tox, ord_)
    return Model(*pair, weights, centre, scale, factors, rate, True)


def train_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> Model:
    """The model of the labelled rows of ``docs`` that are not held out.

    A document with several labels is toxic if one of them says so; null
    labels and labels without a document do not count. The sample takes the
    documents in the order of a hash of their id: at most ``SAMPLE_ROWS`` of
    each class with at most ``SAMPLE_TEXT`` characters (longer ones are left
    to the others), up to ``SAMPLE_CHARS`` characters in sum. Labels are
    cut to the sample before they meet the texts, so no text is shuffled.
    """
    mark = (F.col(label_col) > 0).cast("int")
    known = (labels.select(F.col(id_col).alias("id"), mark.alias("toxic")).where("id is not null and toxic is not null")
             .groupBy("id").agg(F.max("toxic").alias("toxic")).where(~held_out("id")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = counts.get(1, 0) / max(1, sum(counts.values()))
    texts: list[list[str]] = [[], []]
    for kind in (0, 1):
        chosen = known.where(F.col("toxic") == kind).select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        sample = (rows.join(F.broadcast(chosen), "id").where(F.length("text").between(1, SAMPLE_TEXT))
                  .orderBy(F.xxhash64("id"), F.xxhash64("text")).limit(SAMPLE_ROWS))
        taken = 0
        for text in sample.select("text").toArrow().column("text").to_pylist():
            if taken > SAMPLE_CHARS:
                break
            texts[kind].append(text)
            taken += len(text)
    return fit(texts[1], texts[0], rate)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score, n_windows, n_gaining, gain) per row: the score from 0
    to 1, the number of windows, of windows the toxic dictionary saves at
    least ``KEEP`` bytes on, and the sum of all gains.

    Defined cases: a null or empty text, or white space only, has no windows
    and scores the share of toxic training labels; a null id stays null;
    repeated rows give equal results; an empty table gives an empty result.
    Only the two named columns are read, so a score depends on the text alone.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        pair = (m.toxic, m.ordinary)
        for b in slices(batches, "text", 1 << 20):
            lists = [windows(t) if m.fitted else [] for t in b.column("text").to_pylist()]
            gains = _gains(pair, lists) if m.fitted else [np.zeros(0, np.int32)] * len(lists)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([m.score(g) for g in gains], pa.float64()), pa.array([len(g) for g in gains], pa.int64()),
                 pa.array([int((g >= KEEP).sum()) for g in gains], pa.int64()), pa.array([int(g.sum()) for g in gains], pa.int64())],
                names=["id", "score", "n_windows", "n_gaining", "gain"])

    kind = dict(named.dtypes)["id"]
    out = named.mapInArrow(run, f"id {kind}, score double, n_windows long, n_gaining long, gain long")
    return out.withColumnRenamed("id", id_col)
