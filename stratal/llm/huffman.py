"""Token files: canonical length-limited Huffman coding of token ids.

Method. Ids are counted over the whole corpus; package-merge gives code
lengths of at most ``max_bits`` bits, from which the canonical code follows,
so a file only stores lengths. Documents are coded map-side into byte-aligned
bit streams, dealt to ranges of ascending document id, and written as
independent blocks: a header, the documents' ids and sizes, bit-offset
checkpoints every ``step`` ids, and the bits. Each file starts with the
code lengths. Reading decodes the segments between checkpoints of a block in
lockstep through one table of 2 ** max_bits entries.

File format (little endian; Spark's text writer adds b"\\n" after each part):
part    = magic (4 bytes), u64 length of the rest, the rest
"HTC1"  = u8 max_bits, u32 number of symbols, then zlib(u32 ids, u8 lengths)
"HTB1"  = u32 documents, u64 position of the first id, u32 step, u32 bytes of bits, then per document
          i64 id, u8 null flag, u32 ids, u32 byte offset; u32 checkpoints (bit offsets in the document's stream); bits
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratal.llm.arrow import released, slices
from stratal.llm.tokens import id_column, text_encoder
from stratal.session import arrow_batches, materialize

MAX_BITS, STEP = 16, 256
FILE_IDS, BLOCK_IDS = 8 << 20, 1 << 20
TEXT_BYTES = 8 << 20  # text per Arrow batch to the tokenizer, where each distinct piece is looked up once
MAX_RANGES = 1 << 14  # tasks that write files, and their bounds on the driver; a range is cut into files by size
DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u4"), ("at", "<u4")])
BLOCK = "<IQII"
DENSE = 1 << 22


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` bits (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.uint8)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols need more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    weight = counts[order].astype(np.float64)
    # per level: which entries of the merged list are leaves, as a count of leaves in each prefix
    level, leaves = weight, [np.arange(n + 1)]
    for _ in range(max_bits - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        sort = np.argsort(both, kind="stable")
        level = both[sort]
        leaves.append(np.concatenate([[0], np.cumsum(sort < n)]))
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for count in reversed(leaves):
        k = int(count[take])
        lengths[:k] += 1
        take = 2 * (take - k)
    out = np.empty(n, np.uint8)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol)."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    per = np.bincount(lengths)
    at = 0
    for bits in range(1, len(per)):
        code <<= bits - last
        last = bits
        here = order[at:at + per[bits]]
        codes[here] = code + np.arange(len(here), dtype=np.uint32)
        code += int(per[bits])
        at += int(per[bits])
    return codes


class Code:
    """A canonical code over the ids ``symbols`` (ascending)."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, max_bits: int):
        self.symbols, self.lengths, self.max_bits = symbols.astype(np.uint32), lengths.astype(np.uint8), max_bits
        self.codes = canonical_codes(self.lengths)
        self.direct = None  # lengths and codes by id, where a table of all ids is small
        if len(symbols) and int(self.symbols[-1]) < DENSE:
            top = int(self.symbols[-1]) + 1
            self.direct = np.zeros(top, np.uint8), np.zeros(top, np.uint32)
            self.direct[0][self.symbols], self.direct[1][self.symbols] = self.lengths, self.codes

    @classmethod
    def from_counts(cls, symbols: np.ndarray, counts: np.ndarray, max_bits: int = MAX_BITS) -> Code:
        max_bits = max(max_bits, int(len(symbols) - 1).bit_length() if len(symbols) else 1)
        if max_bits > 24:
            raise ValueError("more than 2 ** 24 distinct ids")
        order = np.argsort(symbols)
        return cls(symbols[order], code_lengths(counts[order], max_bits), max_bits)

    def pack(self) -> bytes:
        body = zlib.compress(self.symbols.astype("<u4").tobytes() + self.lengths.tobytes())
        return struct.pack("<BI", self.max_bits, len(self.symbols)) + body

    @classmethod
    def unpack(cls, data: bytes) -> Code:
        max_bits, n = struct.unpack_from("<BI", data)
        body = zlib.decompress(data[5:])
        return cls(np.frombuffer(body, "<u4", n), np.frombuffer(body, np.uint8, n, 4 * n), max_bits)

    def encode(self, ids: np.ndarray, counts: np.ndarray, step: int = STEP) -> tuple[bytes, np.ndarray, list[np.ndarray]]:
        """Byte-aligned streams of consecutive documents: (bytes, byte size
        per document, checkpoints per document)."""
        if self.direct is None:
            place = np.searchsorted(self.symbols, ids)
            lens, value = self.lengths[place].astype(np.int64), self.codes[place].astype(np.uint64)
        else:
            lens, value = self.direct[0][ids].astype(np.int64), self.direct[1][ids].astype(np.uint64)
        ends = np.concatenate([[0], np.cumsum(lens)])
        through = np.concatenate([[0], np.cumsum(counts)])
        sizes = (ends[through[1:]] - ends[through[:-1]] + 7) // 8
        byte_at = np.concatenate([[0], np.cumsum(sizes)])
        base = np.repeat(byte_at[:-1] * 8 - ends[through[:-1]], counts)
        pos = ends[:-1] + base
        out = np.zeros((int(byte_at[-1]) >> 3) + 2, np.uint64)
        if len(ids):  # disjoint bits in words of 64; a word's codes follow one another, its last one may run into the next word
            word, room = pos >> 6, 64 - (pos & 63) - lens
            first = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
            over = np.flatnonzero(room < 0)
            part = value << (room & 63).view(np.uint64)
            part[over] = value[over] >> (-room[over]).view(np.uint64)
            out[word[first]] = np.bitwise_or.reduceat(part, first)
            out[word[over] + 1] |= value[over] << (64 + room[over]).view(np.uint64)
        marks = [ends[np.arange(through[i] + step, through[i + 1], step)] - ends[through[i]] for i in range(len(counts))]
        return out.astype(">u8").tobytes()[:byte_at[-1]], sizes, marks

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length for every window of max_bits bits."""
        symbol = np.zeros(1 << self.max_bits, np.uint32)
        length = np.ones(1 << self.max_bits, np.uint8)
        order = np.lexsort((np.arange(len(self.lengths)), self.lengths))
        width = (1 << (self.max_bits - self.lengths[order].astype(np.int64)))
        n = int(width.sum())
        symbol[:n] = np.repeat(self.symbols[order], width)
        length[:n] = np.repeat(self.lengths[order], width)
        return symbol, length

    def decode(self, bits: bytes, starts: np.ndarray, counts: np.ndarray, table=None) -> np.ndarray:
        """Ids of independent segments: each starts at a bit and holds a
        count of ids; all segments advance together, one table look-up each."""
        symbol, length = table or self.table()
        raw = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
        word = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        order = np.argsort(-counts, kind="stable")
        pos, left = starts[order].astype(np.int64), counts[order]
        out = np.empty(int(counts.sum()), np.uint32)
        target = (np.cumsum(counts) - counts)[order]
        active = len(order)
        down = np.uint32(32 - self.max_bits)
        for k in range(int(left[0]) if len(left) else 0):
            active = int(np.searchsorted(-left[:active], -k, side="left"))
            p = pos[:active]
            window = (word[p >> 3] << (p & 7).astype(np.uint32)) >> down
            out[target[:active] + k] = symbol[window]
            pos[:active] += length[window]
        return out


def part(magic: bytes, body: bytes) -> bytes:
    return magic + struct.pack("<Q", len(body)) + body


def parts(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = 0
    while at < len(content):
        magic, size = content[at:at + 4], struct.unpack_from("<Q", content, at + 4)[0]
        at += 12
        if magic not in (b"HTC1", b"HTB1") or at + size > len(content):
            raise ValueError("damaged token file")
        yield magic, content[at:at + size]
        at += size + 1


def tokenize(docs: DataFrame, path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text",
             counted: bool = False) -> DataFrame:
    """(id, n, ids): ids as little-endian unsigned 32-bit integers, the end
    id included; a null text is an empty one. ``counted`` adds a column
    ``counts``: in one row of every slice the slice's (id, count) pairs, else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = text_encoder(path)
        for b in slices(released(batches), "text", TEXT_BYTES + (1 << 20)):
            ids, counts = enc.encode([t or "" for t in b.column("text").to_pylist()])
            if end_id is not None:
                through = np.cumsum(counts)
                ids = np.insert(ids, through, end_id)
                counts = counts + 1
            cols = [b.column("id"), pa.array(counts, pa.int64()), id_column(ids, counts)]
            if counted:
                sums = np.bincount(ids)
                at = np.flatnonzero(sums)
                cols.append(pa.array([np.stack([at, sums[at]], 1).astype("<u4").tobytes(), *[None] * (len(b) - 1)], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "n", "ids", "counts"][:len(cols)])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "id long, n long, ids binary" + ", counts binary" * counted)


def _ids(column: pa.Array) -> np.ndarray:
    """All ids of a slice of the binary column, one after another."""
    off = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], "<u4")[off[0] // 4:off[-1] // 4] if len(column) and column.buffers()[2] else np.empty(0, "<u4")


def global_code(tokens: DataFrame, max_bits: int = MAX_BITS) -> Code:
    """The code of the global counts: summed per task (from the column
    ``counts`` if there is one, see ``tokenize``), then by Spark; one row per
    distinct id (the vocabulary bounds them) reaches the driver."""
    counted = "counts" in tokens.columns

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if counted:
            for b in batches:
                for x in b.column("counts"):
                    both = np.frombuffer(x.as_buffer(), "<u4").reshape(-1, 2)
                    yield both[:, 0], both[:, 1]
            return
        for b in slices(batches, "ids"):
            got = np.bincount(_ids(b.column("ids")))
            yield np.arange(len(got)), got

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(0, np.int64)
        for at, got in pairs(batches):
            top = int(at[-1]) + 1 if len(at) else 0
            if top > len(sums):
                sums = np.concatenate([sums, np.zeros(top - len(sums), np.int64)])
            sums[at] += got
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["sym", "n"])

    read = tokens.select("counts").where("counts IS NOT NULL") if counted else tokens.select("ids")
    rows = read.mapInArrow(count, "sym long, n long").groupBy("sym").agg(F.sum("n").alias("n")).toArrow()
    return Code.from_counts(rows.column("sym").to_numpy(), rows.column("n").to_numpy(), max_bits)


class Ranges:
    """Ascending ranges of ids, of which there are at most about twice
    ``MAX_RANGES`` whatever the table's size is. Null ids come first. An id
    (or the null one) that fills several ranges by itself is spread over as many by salt."""

    def __init__(self, marks: list[int], nulls: int):
        """``marks``: ids at equal shares of the rows, ascending, repeated
        where an id holds several shares; ``nulls``: ranges for null ids."""
        times: dict[int, int] = {}
        for m in marks:
            times[m] = times.get(m, 0) + 1
        hot = {m: t for m, t in times.items() if t > 1}
        cuts = set(times) | {m + 1 for m in hot if m < (1 << 63) - 1}
        self.cuts = np.array(sorted(cuts), np.int64)
        # intervals: nulls, ids below the first cut, then from each cut to the next
        self.width = np.array([max(1, nulls), 1, *[hot.get(int(c), 1) for c in self.cuts]], np.int64)
        self.base = np.cumsum(self.width) - self.width

    @property
    def total(self) -> int:
        return int(self.width.sum())

    def of(self, ids: pa.Array, salt: np.ndarray) -> np.ndarray:
        known = 1 + np.searchsorted(self.cuts, ids.fill_null(0).to_numpy(), side="right")
        at = np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, known)
        return (self.base[at] + salt % self.width[at]).astype(np.int32)


def plan_ranges(tokens: DataFrame, file_ids: int) -> Ranges:
    """Ranges of about ``file_ids`` ids, or larger ones where that would be more than ``MAX_RANGES``."""
    total, docs, known = tokens.agg(F.sum("n"), F.count("*"), F.count("id")).first()
    wanted = min(MAX_RANGES, int(total or 0) // file_ids + 1)
    nulls = -(-(docs - known) * wanted // docs) if docs else 1
    marks: list[int] = []
    if wanted > 1 and known:
        shares = [k / wanted for k in range(1, wanted)]
        marks = sorted(tokens.agg(F.percentile_approx("id", shares, 10 * wanted)).first()[0])
    return Ranges(marks, nulls)


def write_token_files(tokens: DataFrame, out: str, max_bits: int = MAX_BITS, step: int = STEP,
                      file_ids: int = FILE_IDS, block_ids: int = BLOCK_IDS) -> None:
    """Write ``tokens`` (id, n, ids) as token files under ``out`` in ascending
    order of id (nulls first, repeated ids together), about ``file_ids`` ids a
    file. ``tokens`` is read several times: pass a stored table. A column
    ``salt`` spreads the rows of one id that fills several files; without it
    a hash of their ids does, which keeps equal rows together. A column
    ``counts`` (see ``tokenize``) saves counting the ids again."""
    spark = tokens.sparkSession
    code = spark.sparkContext.broadcast(global_code(tokens, max_bits).pack())
    salt = F.col("salt") if "salt" in tokens.columns else F.xxhash64("ids")
    tokens = tokens.select("id", "n", "ids", F.pmod(salt.cast("long"), F.lit(1 << 40)).alias("salt"))
    plan = plan_ranges(tokens, file_ids)
    bounds = spark.sparkContext.broadcast(plan)

    def ranges_of(b: pa.RecordBatch) -> np.ndarray:
        return bounds.value.of(b.column("id"), b.column("salt").to_numpy())

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.bincount(ranges_of(b), b.column("n").to_numpy().astype(np.float64)).astype(np.int64)
            at = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(got[at])], names=["range", "n"])

    offsets, at = {}, 0
    # one row per range
    per_range = tokens.select("id", "n", "salt").mapInArrow(sums, "range int, n long").groupBy("range").agg(F.sum("n").alias("n"))
    for r in sorted(per_range.collect()):
        offsets[r["range"]], at = at, at + r["n"]
    first = spark.sparkContext.broadcast(offsets)
    per_file = max(1, file_ids // block_ids)  # blocks, behind the code

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Code.unpack(code.value)
        for b in slices(batches, "ids"):
            counts = b.column("n").to_numpy()
            data, sizes, marks = c.encode(_ids(b.column("ids")), counts, step)
            off = np.concatenate([[0], np.cumsum(sizes)])
            bits = [data[off[i]:off[i + 1]] for i in range(len(sizes))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges_of(b)), b.column("id"), b.column("n"), pa.array(bits, pa.binary()),
                 pa.array([m.astype("<u4").tobytes() for m in marks], pa.binary())],
                names=["range", "id", "n", "bits", "marks"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(body: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], names=["value"])

        def block(rows: list, position: int) -> bytes:
            docs = np.zeros(len(rows), DOC)
            at = 0
            for k, (doc, n, bits, _) in enumerate(rows):
                docs[k] = (doc or 0, doc is None, n, at)
                at += len(bits)
            head = struct.pack(BLOCK, len(rows), position, step, at)
            return part(b"HTB1", b"".join([head, docs.tobytes(), *[r[3] for r in rows], *[r[2] for r in rows]]))

        written, rows, held, position, current = 0, [], 0, 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal written
            if written % per_file == 0:  # every file starts with the code
                yield emit(part(b"HTC1", code.value))
            written += 1
            yield emit(block(rows, position))

        for b in slices(batches, "bits"):
            cols = [b.column(c).to_pylist() for c in ("range", "id", "n", "bits", "marks")]
            for r, doc, n, bits, marks in zip(*cols):
                if rows and (r != current or held + n > block_ids):
                    yield from flush()
                    position, rows, held = position + held, [], 0
                if r != current:
                    current, position = r, first.value[r]
                rows.append((doc, n, bits, marks))
                held += n
        if rows:
            yield from flush()

    coded = tokens.mapInArrow(encode, "range int, id long, n long, bits binary, marks binary")
    (coded.repartitionById(plan.total, "range").sortWithinPartitions("range", "id", "n", "bits")
     .mapInArrow(assemble, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", "\n").option("maxRecordsPerFile", str(per_file + 1)).text(out))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n, ids) per document of the token files under ``path``:
    ``start`` counts the ids of all documents before it; ids as little-endian
    unsigned 32-bit integers. A damaged file raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                code = table = None
                for magic, body in parts(content.as_py()):
                    if magic == b"HTC1":
                        code = Code.unpack(body)
                        table = code.table()
                        continue
                    n_docs, position, step, n_bits = struct.unpack_from(BLOCK, body)
                    docs = np.frombuffer(body, DOC, n_docs, struct.calcsize(BLOCK))
                    n = docs["n"].astype(np.int64)
                    segments = -(-n // step)
                    inner = np.maximum(segments - 1, 0)
                    at = struct.calcsize(BLOCK) + docs.nbytes
                    marks = np.frombuffer(body, "<u4", int(inner.sum()), at).astype(np.int64)
                    bits = body[at + 4 * len(marks):]
                    if len(bits) != n_bits:
                        raise ValueError("damaged token file")
                    owner = np.repeat(np.arange(n_docs), segments)
                    head = np.cumsum(segments) - segments  # first segment of each document
                    nth = np.arange(len(owner)) - head[owner]
                    starts = docs["at"].astype(np.int64)[owner] * 8
                    starts[nth > 0] += marks
                    counts = np.minimum(step, n[owner] - nth * step)
                    ids = code.decode(bits, starts, counts, table)
                    off = np.concatenate([[0], np.cumsum(n) * 4])
                    data = ids.astype("<u4").tobytes()
                    out = [data[off[i]:off[i + 1]] for i in range(n_docs)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs["id"].astype(np.int64), mask=docs["null"].astype(bool)),
                         pa.array(position + np.cumsum(n) - n), pa.array(n), pa.array(out, pa.binary())],
                        names=["id", "start", "n", "ids"])

    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(run, "id long, start long, n long, ids binary"))


def token_round_trip(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 2, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Tokenize, write token files under ``out`` and read them back.

    Defined cases: a null or empty text is its end id only; a null id comes
    first; rows of equal id are ordered by length, then by their coded bits (an
    id that fills several files: inside each of them);
    an empty table writes no documents.
    """
    tokens = tokenize(docs, tokenizer_path, end_id, id_col, text_col, counted=True).withColumn("salt", F.monotonically_increasing_id())
    with arrow_batches(docs.sparkSession, TEXT_BYTES):
        tokens = materialize(tokens, "tokens")
    write_token_files(tokens, out)
    return read_token_files(docs.sparkSession, out)
