"""BPE encoding and decoding through a table of distinct words.

Method. Texts are split at ASCII white space (which the tokenizer file drops,
so words are independent). Words that repeat inside a task are counted over
all texts and encoded once; the most frequent ones (a bound in rows and
characters) are sent to all tasks, which turn texts into arrays of word codes.
Every other word is shuffled by the word with the places it stands at; the
task that holds a word encodes it once, and its ids go back and are joined by
position in the document. The counts decide only which way a word takes,
never its ids; a word that is not counted stands about once per task, so no
shuffled word is a hot key. Decoding joins ids to their pieces through the vocabulary, a table
bounded by the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratal.llm.arrow import released, slices
from stratal.llm.tokens import encoder, id_column, spread
from stratal.session import materialize

COUNTED = 1 << 19  # distinct words a task counts at a time
HOT = 1 << 20  # words sent to all tasks
HOT_CHARS = 1 << 24  # and their characters in sum, at most
SLICE = 4 << 20  # bytes of text a task works on at a time
SEEN = 1 << 18  # row keys a task remembers
RARE = 0xFFFFFF  # code of a word that is not hot


def _plain(text: str | None) -> str:
    """The text with ASCII white space as spaces, lowered where that cannot
    change its ids: in Latin-1 lowering is one character to one and nothing
    composes. Special tokens are cut out of raw text, so a text that may
    hold one is left as it is."""
    if not text:
        return ""
    if "<|" not in text:
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
    for space in "\n\t\r\x0b\x0c":
        if space in text:
            text = text.replace(space, " ")
    return text


def split_words(texts: list[str | None]) -> tuple[pa.StringArray, np.ndarray]:
    """(words of all texts, first word of each text and the end); runs of
    white space give empty words."""
    lists = pc.split_pattern(pa.array([_plain(t) for t in texts], pa.string()), " ")
    return lists.flatten(), lists.offsets.to_numpy().astype(np.int64)


def count_words(docs: DataFrame, least: int = 1) -> DataFrame:
    """(word, n) over the texts of ``docs`` (text), of the words that occur
    ``least`` times among the ``COUNTED`` distinct words a task counts at a time."""

    def added(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def handed_on(counts: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from counts.filter(pc.greater_equal(counts.column("n"), least)).to_batches(1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for b in slices(released(batches), "text", SLICE):
            words, _ = split_words(b.column("text").to_pylist())
            counts = words.value_counts()
            held.append(pa.Table.from_arrays([counts.field(0), counts.field(1)], names=["word", "n"]))
            rows += held[-1].num_rows
            if rows >= 2 * COUNTED:
                held = [added(held)]
                rows = held[0].num_rows
                if rows >= COUNTED:
                    yield from handed_on(held[0])
                    held, rows = [], 0
        if held:
            yield from handed_on(added(held))

    counted = docs.select("text").mapInArrow(run, "word string, n long").where("word <> ''")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """(word, n, ids): each distinct word encoded once; ids little-endian
    unsigned 32-bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches, "word", 1 << 18):
            ids, lens = enc.flat(b.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("n"), id_column(ids, lens)],
                                             names=["word", "n", "ids"])

    return words.mapInArrow(run, "word string, n long, ids binary")


def _hot(table: DataFrame, hot: int, hot_chars: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The most frequent words as (words, flat ids, ids per word); word 0 is
    the empty string. Counts are binned on a log scale (a bounded histogram);
    the words of the top bins that stay within both bounds are collected."""
    bin_of = F.floor(F.log2("n") * 32).cast("int")
    bins = (table.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("words"), F.sum(F.length("word")).alias("chars"))
            .orderBy(F.desc("bin")).collect())
    least, words, chars = None, 0, 0
    for r in bins:
        words, chars = words + r["words"], chars + r["chars"]
        if words > hot or chars > hot_chars:
            break
        least = r["bin"]
    taken = table.where(bin_of >= least) if least is not None else table.limit(0)
    rows = taken.select("word", "n", "ids").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    names = pa.concat_arrays([pa.array([""], pa.string()), *rows.column("word").cast(pa.string()).chunks])
    ids = np.frombuffer(b"".join(rows.column("ids").to_pylist()), "<u4")
    lens = pc.binary_length(rows.column("ids")).to_numpy().astype(np.int64) // 4
    return names, ids, np.concatenate([[0], lens])


def _encode_rare(tokenizer_path: str):
    """(k1, k2, at, ids) of rows (k1, k2, at, word) sorted by word: each word is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        last: tuple[str, bytes] = ("", b"")  # a word may go on in the next batch
        for b in slices(batches, "word", 1 << 18):
            coded = b.column("word").dictionary_encode()
            names = coded.dictionary.to_pylist()
            fresh = names[1:] if names[0] == last[0] else names
            ids, lens = enc.flat(fresh)
            cells = id_column(ids, lens)
            if len(fresh) < len(names):
                cells = pa.concat_arrays([pa.array([last[1]], pa.binary()), cells])
            last = names[-1], cells[-1].as_py()
            yield pa.RecordBatch.from_arrays([b.column("k1"), b.column("k2"), b.column("at"), cells.take(coded.indices)],
                                             names=["k1", "k2", "at", "ids"])

    return run


def bpe_encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT,
               hot_chars: int = HOT_CHARS, least: int = 2) -> DataFrame:
    """(id_col, n_tokens, ids) per row of ``docs``; ids as little-endian
    unsigned 32-bit integers, as the tokenizers library encodes the whole
    text without special tokens added, truncation or padding.

    Defined cases: a null or empty text, or white space only, has no ids; a
    null id stays null; repeated rows are encoded once and returned as often
    as they occur; special tokens inside a text become their ids, as in the
    library; an empty table gives an empty result. Only the two named columns
    are read. ``hot`` must stay below 2 ** 24 - 1. Words are counted
    from ``least`` occurrences in a task on; neither changes results.
    """
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spark = docs.sparkSession
    table = materialize(encode_words(count_words(rows, least), tokenizer_path), "bpe-words")
    names, flat, lens = _hot(table, hot, hot_chars)
    known = spark.sparkContext.broadcast(names)
    hot_ids = spark.sparkContext.broadcast((flat, lens))
    # a row's key: 128 bits of hash over id and text (the literals come first, so that the halves are independent)
    keyed = rows.select(F.xxhash64(F.lit(1), "id", "text").alias("k1"), F.xxhash64(F.lit(2), "text", "id").alias("k2"),
                        "id", "text")
    kind = kind.simpleString()

    def word_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Word codes of each text in three planes of bytes, compressed: the higher ones are mostly small numbers."""
        pack = zstandard.ZstdCompressor(level=1)
        for b in slices(released(batches), "text", SLICE):
            words, off = split_words(b.column("text").to_pylist())
            code = pc.index_in(words, value_set=known.value).fill_null(RARE).to_numpy()
            planes = np.ascontiguousarray(code.astype("<u4").view("u1").reshape(-1, 4)[:, :3].T)
            out = [pack.compress(planes[:, i:j].tobytes()) for i, j in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([b.column("k1"), b.column("k2"), b.column("id"), pa.array(out, pa.binary())],
                                             names=["k1", "k2", "id", "codes"])

    def rare_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # equal rows of a task hand over their words once
        for b in slices(released(batches), "text", SLICE):
            keys = list(zip(b.column("k1").to_pylist(), b.column("k2").to_pylist()))
            fresh = [k not in seen and not seen.add(k) for k in keys]
            if not all(fresh):
                b = b.filter(pa.array(fresh))
            if len(seen) > SEEN:
                seen.clear()
            if not b.num_rows:
                continue
            words, off = split_words(b.column("text").to_pylist())
            spots = np.flatnonzero(pc.index_in(words, value_set=known.value).is_null().to_numpy(zero_copy_only=False))
            own = np.searchsorted(off, spots, side="right") - 1
            owner = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [b.column("k1").take(owner), b.column("k2").take(owner), pa.array((spots - off[own]).astype(np.int32)),
                 words.take(pa.array(spots))], names=["k1", "k2", "at", "word"])

    keys = ["k1", "k2"]
    coded = (keyed.mapInArrow(word_codes, f"k1 long, k2 long, id {kind}, codes binary")
             .groupBy(keys).agg(F.first("id").alias("id"), F.first("codes").alias("codes"), F.count("*").alias("times")))
    spots = keyed.select("k1", "k2", "text").mapInArrow(rare_words, "k1 long, k2 long, at int, word string")
    placed = (spots.repartition("word").sortWithinPartitions("word")
              .mapInArrow(_encode_rare(tokenizer_path), "k1 long, k2 long, at int, ids binary")
              .repartition("k1", "k2")  # plain rows move, they are collected behind the exchange
              .dropDuplicates(["k1", "k2", "at"]))  # of equal rows; inside the partition
    joined = placed.groupBy(keys).agg(F.collect_list(F.struct("at", "ids")).alias("rare"))
    matched = coded.join(joined, keys, "left").select("id", "codes", "times", "rare.at", "rare.ids")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, base_lens = hot_ids.value
        base_starts = np.append(np.cumsum(base_lens) - base_lens, 0)
        base_lens = np.append(base_lens, 0)
        unpack = zstandard.ZstdDecompressor()
        for b in slices(released(batches), "codes", 1 << 19):
            planes = [np.frombuffer(unpack.decompress(p), "u1").reshape(3, -1) for p in b.column("codes").to_pylist()]
            words = np.array([p.shape[1] for p in planes])
            low, middle, high = np.concatenate(planes, axis=1).astype(np.int64)
            code = low | middle << 8 | high << 16
            rare = code == RARE
            code[rare] = len(base_lens) - 1
            starts, sizes = base_starts[code], base_lens[code]
            head = np.cumsum(words) - words
            ats, found = b.column("at"), b.column("ids").flatten()
            per = np.where(ats.is_null().to_numpy(zero_copy_only=False), 0, np.diff(ats.offsets.to_numpy()))
            spots = ats.flatten().to_numpy().astype(np.int64) + np.repeat(head, per)
            pieces = found.to_pylist()
            size = np.array([len(x) // 4 for x in pieces], np.int64)
            starts[spots], sizes[spots] = len(base) + np.cumsum(size) - size, size
            filled = np.zeros(len(code), bool)
            filled[spots] = True
            if (rare != filled).any():
                raise ValueError("a word has no ids")
            ids = spread(np.concatenate([base, np.frombuffer(b"".join(pieces), "<u4")]), starts, sizes)
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(words)])]
            n = np.diff(ends)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("times"), pa.array(n), id_column(ids, n)],
                                             names=["id", "times", "n_tokens", "ids"])

    done = matched.mapInArrow(assemble, f"id {kind}, times long, n_tokens long, ids binary")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return done.select(F.col("id").alias(id_col), "n_tokens", "ids", copies.alias("copy")).drop("copy")


def vocabulary(path: str) -> list[str | None]:
    """The piece of every id of a tokenizer file, special tokens included."""
    vocab = encoder(path).tokenizer.get_vocab(with_added_tokens=True)
    pieces: list[str | None] = [None] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        pieces[i] = piece
    return pieces


def bpe_decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded text of its ids, as the library's
    decode(ids, skip_special_tokens=False) of a file without a decoder: the
    pieces joined by spaces. Ids are joined to the vocabulary (bounded by the
    file) inside each task; unknown ids are passed over, null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(vocabulary(tokenizer_path), object)
        gaps = np.array([x is None for x in table])
        for b in slices(batches, ids_col, 1 << 20):
            texts = []
            for x in b.column(ids_col).to_pylist():
                if x is None:
                    texts.append(None)
                    continue
                ids = np.frombuffer(x, "<u4")
                ids = ids[ids < len(table)]
                texts.append(" ".join(table[ids[~gaps[ids]]]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out_col])

    fields = ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{fields}, `{out_col}` string")
