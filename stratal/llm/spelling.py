"""Spelling variant grouping: blocked Gram matrices of letter counts.

Method. Two words that differ by one inserted, deleted or replaced code point
have letter-count vectors at squared distance 0, 1 or 2 and lengths that differ by
at most one. Length blocks are compared with themselves and with the next
one. One edit leaves one half of the shorter word whole, at the start or at
the end of both, so a length block is subdivided by shared halves: a word of
length L joins the blocks of shorter length L and L - 1, each once by its
first ``a // 2`` and once by its last ``a - a // 2`` code points. No pair is
lost, and a pair that shares both halves counts in the first. Inside a block,
numpy products of the count matrices give all squared distances; pairs at
most two are verified code point by code point. Blocks are cut into bounded
pieces that meet pairwise (``block_pairs``); only counts and the best
neighbour per word leave a task, never pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratal.llm.arrow import slices
from stratal.llm.components import block_pairs
from stratal.session import materialize

RUN = "A-Za-zÀ-ÿ"  # characters of a word
HELD = 1 << 18  # distinct words a task counts before it hands them on
PIECE = 2048  # words of one block a task multiplies at a time, at most,
PIECE_CHARS = 1 << 21  # and their code points
PACK = 512  # small blocks are multiplied together up to so many words
LETTERS = 256  # letter counts: code points modulo this (sharing a place can only lower a distance)


def thin_run(run: str, start: int, every: int) -> str:
    """The run without one code point if the CRC-32 of its bytes, continued
    from ``start``, is divisible by ``every``."""
    h = zlib.crc32(run.encode(), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
                thin: int | None = None) -> DataFrame:
    """(word, n) of the maximal letter runs of all texts, A-Z lower-cased,
    with at least ``min_length`` code points and ``min_count`` occurrences.

    With ``thin``, a code point is deleted from each run whose CRC-32 of
    "<id>:<run>" it divides (a null id reads as empty). Null texts have no
    words; repeated rows count as often as they occur.
    """
    runs = re.compile(rf"[{RUN}]{{{min_length},}}")  # greedy: shorter maximal runs never match

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                             names=["word", "n"])
            total.clear()
            return out

        for b in slices(batches, "text"):
            for doc, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                if not text:
                    continue
                found = runs.findall(text.encode().lower().decode())  # bytes.lower: A-Z only
                if not thin:
                    total.update(found)
                else:
                    start = zlib.crc32(f"{doc or ''}:".encode())
                    for word, n in Counter(found).items():
                        total[thin_run(word, start, thin)] += n
                if len(total) >= HELD:
                    yield flush()
        if total:
            yield flush()

    named = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counted = named.mapInArrow(run, "word string, n long").where(F.char_length("word") >= min_length)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def half_blocks(words: DataFrame) -> DataFrame:
    """(grp, a, side, own, word, n): the blocks of every word. ``grp`` starts
    with the length, so that blocks of one length are neighbours in order."""
    size = F.char_length("word")

    def block(a, side):
        half = F.substring(F.col("word"), F.lit(1), F.floor(a / 2).cast("int")) if side == 0 else \
            F.substring(F.col("word"), (size - (a - F.floor(a / 2)) + 1).cast("int"), (a - F.floor(a / 2)).cast("int"))
        return F.struct(a.alias("a"), F.lit(side).alias("side"), half.alias("half"))

    listed = F.array(*[block(a, side) for a in (size, size - 1) for side in (0, 1)])
    rows = words.where(size > 0).select("word", "n", size.alias("size"), F.explode(listed).alias("b")).where("b.a > 0")
    grp = F.concat_ws(":", F.lpad(F.col("b.a").cast("string"), 10, "0"), F.col("b.side").cast("string"), F.col("b.half"))
    return rows.select(grp.alias("grp"), "b.a", "b.side", (F.col("size") == F.col("b.a")).alias("own"), "word", "n")


def one_edit(codes: np.ndarray, ends: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words i and j differ by exactly one edit. ``codes`` holds the
    words left-aligned, ``ends`` right-aligned, 0 where there is none."""
    short = np.minimum(sizes[i], sizes[j])
    differ = codes[i] != codes[j]
    same = sizes[i] == sizes[j]
    head = np.where(differ.any(1), differ.argmax(1), differ.shape[1])
    tail_differ = ends[i, ::-1] != ends[j, ::-1]
    tail = np.where(tail_differ.any(1), tail_differ.argmax(1), differ.shape[1])
    return np.where(same, differ.sum(1) == 1, (np.abs(sizes[i] - sizes[j]) == 1) & (head + tail >= short))


def near_pairs(words: list[str], group: np.ndarray, own: np.ndarray, piece: np.ndarray, across: np.ndarray, half: np.ndarray,
               suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of words of one group that differ by one edit, at
    least one of them of the block's shorter length (``own``), in two pieces
    where the group is ``across`` pieces, and (in ``suffix`` blocks) without
    a common first half of length ``half``."""
    sizes = np.array([len(w) for w in words])
    m, width = len(words), int(sizes.max())
    fill = np.arange(width) < sizes[:, None]
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    codes = np.zeros((m, width), np.int32)
    codes[fill] = flat + 1
    ends = np.zeros((m, width), np.int32)
    ends[fill[:, ::-1]] = flat + 1
    counts = np.bincount(np.repeat(np.arange(m), sizes) * LETTERS + flat % LETTERS, minlength=m * LETTERS)
    counts = counts.reshape(m, LETTERS)
    counts = counts[:, counts.any(0)].astype(np.float32 if width <= 2048 else np.float64)  # sums of squares stay exact
    gram = counts @ counts.T
    square = np.diag(gram).copy()
    gram *= -2
    gram += square[:, None]
    gram += square[None, :]
    i, j = np.nonzero(np.triu(gram <= 2, 1))
    good = (group[i] == group[j]) & (own[i] | own[j]) & (~across[i] | (piece[i] != piece[j]))
    i, j = i[good], j[good]
    out = []
    step = max(1, (1 << 22) // width)
    for k in range(0, len(i), step):
        a, b = i[k:k + step], j[k:k + step]
        hit = one_edit(codes, ends, sizes, a, b)
        a, b = a[hit], b[hit]
        if len(a) and suffix[a].any():
            # the common first half: the first difference lies behind it
            differ = codes[a] != codes[b]
            hit = ~suffix[a] | (differ.argmax(1) < half[a])
            a, b = a[hit], b[hit]
        out.append((a, b))
    return (np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])) if out else (i, j)


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, group number of each): whole groups (grp, lo, hi) of sorted
    rows, small ones together."""
    held: list[pa.RecordBatch] = []

    def numbered(table: pa.Table) -> np.ndarray:
        cut = np.zeros(table.num_rows, bool)
        for name in ("grp", "lo", "hi"):
            c = table.column(name).combine_chunks()
            cut[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        return np.cumsum(cut)

    def packs(table: pa.Table, last: bool):
        """Packs of the complete groups; returns the rows of the unfinished one."""
        group = numbered(table)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [table.num_rows]])
        if not last:
            starts = starts[:-1]
        sizes = table.column("a").to_numpy()
        at = 0
        while at + 1 < len(starts):
            to = at + 1
            while to + 1 < len(starts) and starts[to + 1] - starts[at] <= PACK and \
                    (starts[to + 1] - starts[at]) * int(sizes[starts[to]]) <= PIECE_CHARS:
                to += 1
            lo, hi = int(starts[at]), int(starts[to])
            yield table.slice(lo, hi - lo), group[lo:hi]
            at = to
        return table.slice(int(starts[-1]))

    rows = 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows >= 4 * PACK:
            rest = yield from packs(pa.Table.from_batches(held), False)
            held, rows = rest.to_batches(), rest.num_rows
    if held:
        yield from packs(pa.Table.from_batches(held), True)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for the words of ``words`` (word, n; each
    word once) that have a near word; the best is the most frequent one, ties
    to the smallest."""
    keyed = half_blocks(words)
    room = F.greatest(F.lit(2), F.least(F.lit(PIECE), F.floor(F.lit(PIECE_CHARS) / F.max("a"))))
    sizes = (keyed.groupBy("grp").agg(F.ceil(F.count("*") / room).cast("int").alias("n_blocks"), F.count("*").alias("m"),
                                      F.bool_or("own").alias("some")).where("some and m > 1").select("grp", "n_blocks"))
    dealt = block_pairs(keyed.join(sizes, "grp"), "grp", "word", "n_blocks")
    columns = ["grp", "lo", "hi", "block", "a", "side", "own", "word", "n"]
    placed = dealt.select(*columns).repartition("grp", "lo", "hi").sortWithinPartitions("grp", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in _packs(batches):
            names = t.column("word").to_pylist()
            col = {c: t.column(c).to_numpy() for c in ("lo", "hi", "block", "a", "side", "own", "n")}
            i, j = near_pairs(names, group, col["own"].astype(bool), col["block"], col["lo"] != col["hi"], col["a"] // 2,
                              col["side"] == 1)
            if not len(i):
                continue
            src, dst = np.concatenate([i, j]), np.concatenate([j, i])
            rank = np.empty(len(names), np.int64)
            rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
            order = np.lexsort((rank[dst], -col["n"][dst], src))
            src, dst = src[order], dst[order]
            first = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]]))
            near = np.diff(np.append(first, len(src)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in src[first]], pa.string()), pa.array(near, pa.int64()),
                 pa.array(col["n"][dst[first]], pa.int64()), pa.array([names[k] for k in dst[first]], pa.string())],
                names=["word", "near", "best_n", "best"])

    found = placed.mapInArrow(run, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), "b.best")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the end of each word's chain.

    Pointers are doubled: a round joins every word's pointer to that pointer's
    own, so chains of length d take log2(d) rounds. Each round is written to the shared folder.
    Counts at least double along a chain, so there are few.
    """
    current = materialize(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "spelling-roots")
    while current.where("open").limit(1).count():
        onward = current.select(F.col("word").alias("__at"), F.col("root").alias("__root"))
        moved = current.join(onward, F.col("root") == F.col("__at"), "left")
        current = materialize(moved.select("word", F.coalesce("__root", "root").alias("root"),
                                           F.col("__at").isNotNull().alias("open")), "spelling-roots")
    return current.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per row of ``words`` (word, n).

    n_near counts the words at exactly one edit; form is the most frequent of
    them (ties: the smallest in code-point order) if it is at least ``ratio``
    times as frequent as the word, else null; root is the word at the end of
    the chain of forms (the word itself without a form).

    Defined cases: each word once with n > 0 (``count_words`` gives that;
    repeated words are added up, null and empty words left out); an empty
    table gives an empty result; ``ratio`` must exceed 1, which keeps chains
    free of cycles; words may hold any code points and any number of them.
    """
    if ratio <= 1:
        raise ValueError("ratio must exceed 1: chains of forms must end")
    table = words.where(F.col("word").isNotNull() & (F.col("word") != "")).groupBy("word").agg(F.sum("n").alias("n"))
    table = materialize(table, "spelling-words")
    near = near_words(table)
    wins = F.col("best_n") >= F.lit(ratio) * F.col("n")
    formed = materialize(table.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(wins, F.col("best")).alias("form"), F.when(wins, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = follow(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
