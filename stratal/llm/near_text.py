"""Near-duplicate texts: fast similarity sketches, banding, exact check.

Method. Every document becomes the set of its distinct word shingles
(64-bit hashes). Its sketch has ``coords`` coordinates, filled by *fast
similarity sketching*: in round r = 0, 1, ... every shingle is hashed with the
round's own function to one bin and a value that grows with r; in the rounds
after ``coords`` each shingle's bin is fixed to r - coords, so every
coordinate of a non-empty set is filled after at most 2 * coords rounds; a
bin keeps its minimum. A set is done as soon as its bins are full (later
rounds cannot lower any), which takes O(coords log coords + size) work and
keeps the similarity estimate as concentrated as coords independent minima.

Rows of the sketch are hashed in bands. Documents with equal sets collapse
to one class first, so a group of copies is one row from there on. Classes
are numbered, and the numbers are the nodes of all graphs; the smallest id of
a class is only an attribute, so texts that share an id stay apart.
Representatives that share a band are joined into candidate clusters (star
edges to the band's minimum, connected components). Inside a cluster all
pairs that share a band and are not linked yet are confirmed on the full
sets, in block pairs of bounded size (``components.block_pairs``): every
pair of a large cluster meets in some block pair, none is emitted as a row.
Verified links give the final components.

With 252 coordinates in 42 bands of 6, a pair at similarity 0.8 is missed
with probability below 4e-6; in 36 bands of 7, one at 0.85 below 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratal.llm.arrow import groups, list_column, mix64, released, slices
from stratal.llm.components import Forest, block_pairs, components
from stratal.session import arrow_batches, materialize

BANDS, ROWS = 42, 6
BLOCK_DOCS, BLOCK_SHINGLES = 256, 1 << 20
SKETCH_BYTES = 1 << 20  # text sketched at once: a round's arrays hold several numbers per word
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles: words split at
    ASCII white space, A-Z lowered; fewer than ``size`` words make one
    shingle, none make none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    n = min(size, len(h))
    width = len(h) - n + 1
    acc = np.full(width, np.uint64(n), np.uint64)
    for k in range(n):
        acc = mix64(acc * _GOLD + h[k:k + width])
    return np.unique(acc)


def sketch(values: np.ndarray, owner: np.ndarray, n: int, coords: int) -> np.ndarray:
    """Sketches (n, coords) of n sets given as flat values and set indices;
    empty sets keep all-ones."""
    empty = np.iinfo(np.uint64).max
    out = np.full(n * coords, empty, np.uint64)
    table = out.reshape(n, coords)
    alive_v, alive_o = values, owner
    open_sets = np.unique(owner)
    for r in range(2 * coords):
        if not len(alive_v):
            break
        h = mix64(alive_v ^ mix64(np.array([r + 1], np.uint64) * _GOLD))
        if r < coords:
            bins = ((h >> np.uint64(40)) * np.uint64(coords) >> np.uint64(24)).astype(np.int64)
        else:
            bins = np.full(len(h), r - coords, np.int64)
        val = (np.uint64(r) << np.uint64(40)) | (h & np.uint64((1 << 40) - 1))
        np.minimum.at(out, alive_o * coords + bins, val)
        full = (table[open_sets] != empty).all(axis=1)
        if full.any():
            still = np.zeros(n, bool)
            open_sets = open_sets[~full]
            still[open_sets] = True
            keep = still[alive_o]
            alive_v, alive_o = alive_v[keep], alive_o[keep]
    return table


def _band_hashes(sk: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band number is part of the key."""
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sk), bands)).copy()
    parts = sk.reshape(len(sk), bands, rows)
    for k in range(rows):
        acc = mix64(acc * _GOLD + parts[:, :, k])
    return acc


def _flat_sets(texts: list[str | None], size: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    sets = [shingle_hashes(t, size) for t in texts]
    counts = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), counts)
    return sets, owner, counts


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Halves of the 128-bit digest of every set."""
    both = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
    return (np.array([x >> 64 for x in both], np.uint64).view(np.int64),
            np.array([x & (1 << 64) - 1 for x in both], np.uint64).view(np.int64))


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """(id, n, d1, d2, bands): set size, 128-bit digest of the set, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(released(batches), "text", SKETCH_BYTES):
            sets, owner, counts = _flat_sets(b.column("text").to_pylist(), size)
            flat = np.concatenate(sets) if counts.sum() else np.empty(0, np.uint64)
            keys = _band_hashes(sketch(flat, owner, len(sets), bands * rows), bands, rows)
            d1, d2 = _digests(sets)
            keys = keys[counts > 0]
            offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(counts), pa.array(d1), pa.array(d2),
                 list_column(keys.ravel().view(np.int64), offsets, pa.int64())],
                names=["id", "n", "d1", "d2", "bands"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "id long, n long, d1 long, d2 long, bands array<long>")


def _solve(percent: int):
    """Links inside one block pair: a spanning forest of the confirmed pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["cluster", "lo", "hi"]):
            ids, reps = t.column("id").to_numpy(), t.column("rep").to_numpy()
            block = t.column("block").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]
            n = np.array([len(s) for s in sets])
            keys = np.stack([np.frombuffer(x, np.int64) for x in t.column("bands").to_pylist()])
            cross = t.column("lo")[0].as_py() != t.column("hi")[0].as_py()
            forest, a, b = Forest(len(ids)), [], []
            for i in range(len(ids) - 1):
                near = 100 * np.minimum(n[i], n[i + 1:]) >= percent * np.maximum(n[i], n[i + 1:])
                if cross:
                    near &= block[i + 1:] != block[i]
                js = np.flatnonzero(near) + i + 1
                if not len(js):
                    continue
                agree = (keys[js] == keys[i]).sum(axis=1)
                js, agree = js[agree > 0], agree[agree > 0]
                for j in js[np.argsort(-agree, kind="stable")]:
                    if forest.root(i) == forest.root(j):
                        continue
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (n[i] + n[j] - both):
                        forest.join(i, j)
                        a.append(i)
                        b.append(j)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (reps[a], ids[a], reps[b], ids[b])],
                                                 names=["rep_a", "a", "rep_b", "b"])

    return run


def _judged(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, bands: int, rows: int,
            block_docs: int, block_shingles: int) -> DataFrame:
    """(id, n, component, part, d1, d2) per row: part is a number of the
    component that no other component has; null where nothing can be linked."""
    with arrow_batches(docs.sparkSession):
        sk = materialize(sketches(docs, id_col, text_col, shingle, bands, rows), "near-sketch")
    full = sk.where("n > 0 AND id IS NOT NULL")
    classes = materialize(full.groupBy("d1", "d2").agg(
        F.min("id").alias("rep"), F.max("n").alias("n"), F.any_value("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "near-classes")

    # star edges from the members of every band bucket to its smallest member
    members = classes.select("node", F.explode("bands").alias("key"))
    buckets = materialize(members.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
                          .where("low < high").select("key", "low"), "near-buckets")
    stars = members.join(buckets, "key").where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    clusters = materialize(components(stars, "near-candidates")
                           .withColumnRenamed("component", "cluster"), "near-clusters")

    # full sets only for members of clusters; clusters in blocks of bounded rows and shingles
    sized = clusters.join(classes.select("node", "rep", "n", "bands", "d1", "d2"), "node")
    blocks = materialize(sized.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(block_docs)), F.ceil(F.sum("n") / F.lit(block_shingles))).cast("int").alias("nb")),
        "near-blocks")
    wanted = materialize(sized.join(blocks, "cluster").select("rep", "node", "cluster", "nb", "bands", "d1", "d2"), "near-wanted")
    # the narrow list of ids first: while it may be broadcast, only wanted texts leave the scan; beyond that size both
    # joins use one shuffle by id
    ids = materialize(wanted.select("rep").distinct(), "near-wanted-ids")
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")).join(ids, "rep", "left_semi")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(released(batches), "text"):
            sets = [shingle_hashes(t, shingle) for t in b.column("text").to_pylist()]
            digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            mine = [(x >> 64, x & (1 << 64) - 1) for x in digests]
            want = zip(b.column("d1").to_numpy().view(np.uint64).tolist(), b.column("d2").to_numpy().view(np.uint64).tolist())
            same = pa.array([x == y for x, y in zip(mine, want)], pa.bool_())
            out = pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("rep"), b.column("cluster"), b.column("nb"),
                 pa.array([x.tobytes() for x in sets], pa.binary()),
                 pa.array([np.asarray(x, np.int64).tobytes() for x in b.column("bands").to_pylist()], pa.binary())],
                names=["id", "rep", "cluster", "nb", "set", "bands"])
            yield out.filter(same)

    sets = (texts.join(wanted, "rep")
            .mapInArrow(sets_of, "id long, rep long, cluster long, nb int, set binary, bands binary"))
    dealt = (block_pairs(sets, "cluster", "id", "nb").drop("nb")
             .repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi"))
    links = dealt.mapInArrow(_solve(percent), "rep_a long, a long, rep_b long, b long")

    # ordered by the smallest id of the class, so a component's smallest node has its smallest id
    edges = links.select(F.struct(F.col("rep_a").alias("rep"), F.col("a").alias("node")).alias("a"),
                         F.struct(F.col("rep_b").alias("rep"), F.col("b").alias("node")).alias("b"))
    with arrow_batches(docs.sparkSession):
        joined = components(edges, "near-links")
    final = materialize(joined.select("node.node", F.col("component.rep").alias("component"), F.col("component.node").alias("part")),
                        "near-components")
    by_class = classes.select("d1", "d2", "rep", "node").join(final, "node", "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component"), F.coalesce("part", "node").alias("part"))
    by_class = materialize(by_class, "near-by-class")
    linked = sk.join(by_class, ["d1", "d2"], "left").select("id", "n", "component", "part", "d1", "d2")
    none = F.col("id").isNull() | (F.col("n") == 0)
    return linked.withColumn("component", F.when(~none, F.col("component"))).withColumn("part", F.when(~none, F.col("part")))


def near_duplicate_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                         percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                         block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) per row of ``docs``.

    Documents whose shingle sets have 100 * intersection >= percent * union
    are linked; component_id is the smallest id reachable.

    Defined cases: a null or empty text, or one of white space only, has no
    shingles and is linked with nothing; a row with a null id is linked with
    nothing (component_id null) and kept; repeated rows give repeated
    results; rows that share an id but not their text are judged each by its
    own text; an empty table gives an empty result. Only the id and text
    columns are read, so extra columns cannot clash.
    """
    judged = _judged(docs, id_col, text_col, shingle, percent, bands, rows, block_docs, block_shingles)
    component = F.coalesce("component", "id")
    return judged.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                         percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                         block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs``, one per component: the one with the smallest id,
    of those under that id one shingle set, and of these the smallest text.

    Defined cases: rows that share an id but not their text go only as copies
    of another row; rows without shingles go only if another row has the same
    id and none either; rows with a null id all stay.
    """
    judged = _judged(docs, id_col, text_col, shingle, percent, bands, rows, block_docs, block_shingles)
    some = judged.where("id IS NOT NULL")
    best = F.min(F.struct("id", "d1", "d2")).alias("best")
    firsts = (some.where("n > 0").groupBy("part").agg(best).select("best.*")
              .unionByName(some.where("n = 0").select("id", "d1", "d2").distinct()))
    firsts = materialize(firsts, "near-firsts")

    # narrow rows go through Python: a text is known by its id and 128 bits of its hash
    text = F.col(f"row.`{text_col}`")
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.struct("*").alias("row"))
    keyed = plain.where("id IS NOT NULL").withColumn("h1", F.xxhash64(F.lit(1), text)).withColumn("h2", F.xxhash64(F.lit(2), text))

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(released(batches), "text"):
            d1, d2 = _digests([shingle_hashes(t, shingle) for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("id", "h1", "h2")] + [pa.array(d1), pa.array(d2)],
                                             names=["id", "h1", "h2", "d1", "d2"])

    narrow = (keyed.select("id", "h1", "h2", text.alias("text"))
              .mapInArrow(classed, "id long, h1 long, h2 long, d1 long, d2 long").join(firsts, ["id", "d1", "d2"], "left_semi"))
    with arrow_batches(docs.sparkSession):
        found = materialize(narrow.groupBy("id", "d1", "d2").agg(F.count("*").alias("rows"), F.min("h1").alias("h1"), F.min("h2").alias("h2")),
                            "near-kept")
    hashes = ["id", "h1", "h2"]
    single = keyed.join(found.where("rows = 1").select(*hashes), hashes, "left_semi").select("row")
    # several rows of one id and set: the smallest text, and of equal rows one
    several = found.where("rows > 1").select("id").distinct()
    alone = found.where("rows = 1").select(*hashes)
    copies = keyed.join(several, "id", "left_semi").join(alone, hashes, "left_anti").withColumn("text", text)
    schema = f"row {dict(plain.dtypes)['row']}, id long, text string, d1 long, d2 long"

    def judged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(released(batches), "text"):
            d1, d2 = _digests([shingle_hashes(t, shingle) for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), b.column("text"), pa.array(d1), pa.array(d2)],
                                             names=["row", "id", "text", "d1", "d2"])

    nth = F.row_number().over(W.partitionBy("id", "d1", "d2").orderBy("text"))
    wanted = found.where("rows > 1").select("id", "d1", "d2")
    chosen = (copies.select("row", "id", "text").mapInArrow(judged_rows, schema).join(wanted, ["id", "d1", "d2"], "left_semi")
              .withColumn("nth", nth).where("nth = 1").select("row"))
    one = single.unionByName(chosen)
    return one.unionByName(plain.where("id IS NULL").select("row")).select("row.*")
