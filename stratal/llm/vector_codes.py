"""Vector code compression: product codes found through a GNAT per part.

Method. Components become integers, ``floor(scale * x)``. Vectors are cut
into equal parts; each part position has a codebook of a few entries, refined
by rounds of assignment and componentwise floored means. The entries of a
codebook are kept in a geometric near-neighbour access tree: a node holds a
few split points, the other entries lie below the split point nearest to
them, and every split point stores the range of its distances to the entries
below each split point of the node. A query measures its squared distance to
the split points as integers. A subtree goes only if its range lies strictly
beyond the best distance found (ties are never cut), with distances rounded
outwards; the answer is decided on integers, ties to the lower index. The
tree is walked by all rows of a batch at once.

Spark reads the vectors once per round. A task returns sums and counts per
(part, entry), so a round shuffles at most parts * entries rows per task and
the driver gets parts * entries rows, whatever the table's size is. Sums are
exact at any size (decimals over 32-bit limbs).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratal.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
DEGREE = 4  # split points per node
BATCH = 4096  # rows a task works on at a time
LIMB = 32  # bits per limb of a sum
LONG = 1 << 63


def finite(vectors: DataFrame, vector_col: str) -> F.Column:
    """Whether a row's vector (array<double>) is whole: not null, no null and
    no non-finite component."""
    good = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return F.col(vector_col).isNotNull() & F.coalesce(good, F.lit(False))


def quantize(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): int64 where that holds every value, else exact
    Python integers."""
    if not len(values) or np.abs(values).max() < (1 << 52) // scale:
        return np.floor(values * float(scale)).astype(np.int64)
    big = [math.floor(x * scale) if abs(x) < 1 << 52 else int(x) * scale for x in values.tolist()]
    return np.array(big + [None], object)[:-1]


def squared(rows: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distance of each row to one entry, as integers."""
    gap = rows - entry
    return (gap * gap).sum(axis=1)


def _root(squares, beyond: float) -> np.ndarray:
    """Square roots of integers; those above the range of a double count as ``beyond``."""
    squares = np.asarray(squares)
    if squares.dtype == object:
        top = 1 << 1023
        squares = np.array([float(x) if x < top else beyond for x in squares.ravel()]).reshape(squares.shape)
    return np.sqrt(squares.astype(np.float64))


def _below(squares) -> np.ndarray:
    """The square roots, rounded towards zero."""
    root = _root(squares, 1e300)
    return np.maximum(root * (1 - 1e-15) - np.spacing(root), 0.0)


def _above(squares) -> np.ndarray:
    """The square roots, rounded up."""
    root = _root(squares, math.inf)
    return np.where(np.isinf(root), root, root * (1 + 1e-15)) + np.spacing(np.minimum(root, 1e300))


@dataclass
class Node:
    splits: list[int]  # entry indexes
    low: np.ndarray  # low[i, j]: least distance of split i to split j and the entries below it, rounded down
    high: np.ndarray
    children: list["Node | None"]


class Gnat:
    """Nearest entries of one codebook (entries x part length, integers)."""

    def __init__(self, book: np.ndarray, degree: int = DEGREE):
        self.book, self.degree = book, degree
        self.measured = 0  # distances to entries computed so far
        self.root = self._build(list(range(len(book)))) if len(book) else None

    def _splits(self, members: list[int]) -> list[int]:
        """Split points far apart: greedily the entry farthest from those taken."""
        taken = [members[0]]
        while len(taken) < min(self.degree, len(members)):
            gaps = [min(int(squared(self.book[m:m + 1], self.book[t])[0]) for t in taken) for m in members]
            far = max((m for m in members if m not in taken), key=lambda m: (gaps[members.index(m)], -m))
            taken.append(far)
        return taken

    def _build(self, members: list[int]) -> Node:
        splits = self._splits(members)
        below: list[list[int]] = [[] for _ in splits]
        for m in members:
            if m not in splits:
                near = min(range(len(splits)), key=lambda i: (int(squared(self.book[m:m + 1], self.book[splits[i]])[0]), i))
                below[near].append(m)
        low, high = np.zeros((len(splits),) * 2), np.zeros((len(splits),) * 2)
        for i, s in enumerate(splits):
            for j, t in enumerate(splits):
                away = squared(self.book[[t, *below[j]]], self.book[s])
                low[i, j], high[i, j] = _below(away.min()), _above(away.max())
        return Node(splits, low, high, [self._build(b) if b else None for b in below])

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of each row."""
        n = len(rows)
        at = np.zeros(n, np.int64)
        if not n or self.root is None:
            return at, np.zeros(n, np.int64)
        at[:] = self.root.splits[0]
        best = squared(rows, self.book[self.root.splits[0]])
        self._walk(self.root, rows, np.arange(n), at, best)
        return at, best

    def _walk(self, node: Node, rows: np.ndarray, live: np.ndarray, at: np.ndarray, best: np.ndarray) -> None:
        here = rows[live]
        away = np.empty((len(node.splits), len(live)), rows.dtype)
        for i, s in enumerate(node.splits):
            away[i] = squared(here, self.book[s])
            self.measured += len(live)
            better = (away[i] < best[live]) | ((away[i] == best[live]) & (s < at[live]))
            best[live[better]], at[live[better]] = away[i][better], s
        near, far = _below(away), _above(away)
        for j, child in enumerate(node.children):
            if child is None:
                continue
            radius = _above(best[live])
            open_ = np.ones(len(live), bool)
            for i in range(len(node.splits)):  # strictly beyond the range: the subtree cannot even tie
                open_ &= ~((near[i] - radius > node.high[i, j]) | (far[i] + radius < node.low[i, j]))
            if open_.any():
                self._walk(child, rows, live[open_], at, best)


Codebooks = list[np.ndarray]  # per part: entries x part length


def _ready(books: Codebooks, rows: np.ndarray) -> tuple[Codebooks, np.ndarray]:
    """Books and rows in one integer kind that holds every sum of squares:
    int64 where it does, else Python integers."""
    most = max([int(abs(b).max()) for b in books if b.size] + [int(abs(rows).max()) if rows.size else 0])
    kind = np.int64 if most <= math.isqrt((LONG - 1) // (4 * rows.shape[1])) else object
    return [b.astype(kind) for b in books], rows.astype(kind)


class Assigner:
    """Codes of integer rows; the trees are built once per integer kind."""

    def __init__(self, books: Codebooks):
        self.books = books
        self.trees: dict[np.dtype, list[Gnat]] = {}

    def __call__(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes rows x parts, squared distance to the entries, summed)."""
        books, rows = _ready(self.books, rows)
        if rows.dtype not in self.trees:
            self.trees[rows.dtype] = [Gnat(b) for b in books]
        width = rows.shape[1] // len(books)
        found = [t.nearest(rows[:, p * width:(p + 1) * width]) for p, t in enumerate(self.trees[rows.dtype])]
        return np.stack([f[0] for f in found], 1), sum(f[1] for f in found)


def _matrix(column: pa.Array, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows have the length ``width``, their integer components)."""
    sizes = np.diff(column.offsets.to_numpy())
    good = sizes == width
    flat = column.filter(pa.array(good)).flatten().to_numpy(zero_copy_only=False)
    return good, quantize(flat, scale).reshape(-1, width)


def _batches(batches, size: int = BATCH):
    for b in batches:
        for k in range(0, b.num_rows, size):
            yield b.slice(k, size)


def _limbs(value: int) -> list[int]:
    """Digits of an integer, 32 bits each; the last one carries the sign."""
    out = []
    while not -(1 << 31) <= value < 1 << 31:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _refine(vectors: DataFrame, books: Codebooks, width: int, scale: int) -> Codebooks:
    """One round: assign all parts, replace entries by floored means."""
    parts, length = len(books), width // len(books)
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = Assigner(shared.value)
        sums = [[[0] * length for _ in b] for b in assign.books]
        counts = [np.zeros(len(b), np.int64) for b in assign.books]
        for b in _batches(batches):
            _, rows = _matrix(b.column("v"), width, scale)
            if not len(rows):
                continue
            codes, _ = assign(rows)
            for p in range(parts):
                part = rows[:, p * length:(p + 1) * length]
                counts[p] += np.bincount(codes[:, p], minlength=len(counts[p]))
                for e in np.unique(codes[:, p]):
                    mine = part[codes[:, p] == e]
                    total = (mine >> 20).sum(axis=0), (mine & ((1 << 20) - 1)).sum(axis=0)  # no overflow
                    sums[p][e] = [s + (int(h) << 20) + int(g) for s, h, g in zip(sums[p][e], *total)]
        out = [(p, e, -1, 0, int(n)) for p in range(parts) for e, n in enumerate(counts[p]) if n]
        out += [(p, e, i, k, x) for p in range(parts) for e, n in enumerate(counts[p]) if n
                for i, s in enumerate(sums[p][e]) for k, x in enumerate(_limbs(s))]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                names=["part", "entry", "at", "limb", "x"])

    partial = vectors.select("v").mapInArrow(run, "part int, entry int, at int, limb int, x long")
    total = partial.groupBy("part", "entry", "at", "limb").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("x")).collect()
    count: dict[tuple[int, int], int] = {}
    sums: dict[tuple[int, int], list[int]] = {}
    for r in total:
        key = (r["part"], r["entry"])
        if r["at"] < 0:
            count[key] = int(r["x"])
        else:
            sums.setdefault(key, [0] * length)[r["at"]] += int(r["x"]) << (LIMB * r["limb"])
    shared.unpersist()
    new = []
    for p, b in enumerate(books):
        rows = [[s // count[p, e] for s in sums[p, e]] if (p, e) in count else list(map(int, b[e])) for e in range(len(b))]
        new.append(_integers(rows, length))
    return new


def _integers(rows: list[list[int]], length: int) -> np.ndarray:
    """Rows of Python integers as int64, or as objects where they do not fit."""
    big = any(not -LONG <= x < LONG for r in rows for x in r)
    return np.array(rows, object if big else np.int64).reshape(len(rows), length)


def _usable(rows: DataFrame, id_col: str, vector_col: str, keep: dict[str, str]) -> DataFrame:
    """(id, ..., v array<double>) of the rows with whole vectors."""
    named = rows.select(F.col(id_col).alias("id"), *[F.col(c).alias(n) for c, n in keep.items()],
                        F.col(vector_col).cast("array<double>").alias("v"))
    return named.where(finite(named, "v"))


def train_codebooks(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS,
                    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """The codebooks after ``rounds`` rounds over all usable rows.

    They start as the parts of the vectors with the smallest ids (equal ids:
    smallest vector first; null ids last). The table's vector length is that
    of the first usable vector whose length is a positive multiple of
    ``parts``; vectors of other lengths take no part. Without any, the
    codebooks are empty.
    """
    vectors = _usable(rows, id_col, vector_col, {})
    fitting = vectors.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    order = [F.col("id").asc_nulls_last(), F.col("v").asc()]
    first = fitting.orderBy(*order).limit(1).select(F.size("v")).collect()
    if not first:
        return [np.zeros((0, 0), np.int64) for _ in range(parts)]
    width = first[0][0]
    length = width // parts
    start = [r["v"] for r in vectors.where(F.size("v") == width).orderBy(*order).limit(entries).select("v").collect()]
    ints = [quantize(np.array(v, np.float64), scale).tolist() for v in start]
    books = [_integers([v[p * length:(p + 1) * length] for v in ints], length) for p in range(parts)]
    for _ in range(rounds):
        books = _refine(vectors, books, width, scale)
    return books


def encode_vectors(rows: DataFrame, books: Codebooks, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """(id_col, label_col, codes array<int>, error) of every usable row: the
    nearest entry per part and the squared distances summed over the parts.

    Defined cases: rows whose vector is null or holds a null or non-finite
    component are dropped; a vector of another length than the codebooks' has
    null codes and a null error; an error beyond a long is null; repeated
    rows and ids, null ids and null labels stay as they are; an empty table
    gives an empty result. Only the three named columns are read.
    """
    named = _usable(rows, id_col, vector_col, {label_col: "label"})
    kinds = dict(named.dtypes)
    width = sum(b.shape[1] for b in books)
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = Assigner(shared.value)
        for b in _batches(batches):
            good, ints = _matrix(b.column("v"), width, scale)
            good &= width > 0
            codes, errors = np.zeros((len(good), len(books)), np.int32), np.full(len(good), LONG, object)
            if good.any():
                codes[good], errors[good] = assign(ints)
            offsets = pa.array(np.arange(len(good) + 1) * len(books), pa.int32())
            listed = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel(), pa.int32()), mask=pa.array(~good))
            fitting = pa.array([int(x) if x < LONG else None for x in errors], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), listed, fitting],
                                             names=["id", "label", "codes", "error"])

    out = named.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error long")
    return out.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "codes", "error")


def label_errors(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``coded`` with label_error: the errors summed over equal labels (nulls
    together); null where no row of the label has an error, or beyond a long.

    Errors are summed on the map side first; the sums, one row per label, are
    joined back, so no label's rows meet in one group.
    """
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy(F.col(label_col).alias("__label")).agg(total.try_cast("long").alias("label_error"))
    return coded.join(sums, F.col(label_col).eqNullSafe(F.col("__label")), "left").drop("__label")


def books_text(books: Codebooks) -> str:
    """All components in decimal, by part, entry and position, comma-joined."""
    return ",".join(str(int(x)) for b in books for entry in b for x in entry)


def compress_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                     scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """((id, label, codes, error, label_error), codebooks): trained on and
    applied to all rows; see ``train_codebooks`` and ``encode_vectors``. The
    codes are written once to the shared folder and read for both uses."""
    books = train_codebooks(rows, id_col, vector_col, parts, entries, rounds, scale)
    coded = materialize(encode_vectors(rows, books, id_col, vector_col, label_col, scale), "vector-codes")
    return label_errors(coded, label_col), books


def decode_vectors(coded: DataFrame, books: Codebooks, scale: int = SCALE, out_col: str = "vector") -> DataFrame:
    """``coded`` with the vector its codes stand for: entries put together,
    divided by ``scale`` (null codes give null)."""
    table = F.lit([[[float(x) / scale for x in e] for e in b] for b in books])
    places = F.sequence(F.lit(0), F.size("codes") - 1)
    pieces = F.transform(places, lambda p: F.get(F.get(table, p), F.get(F.col("codes"), p)))
    return coded.withColumn(out_col, F.when(F.col("codes").isNotNull(), F.flatten(pieces)))
