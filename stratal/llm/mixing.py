"""Mixing sources to target weights by a low-discrepancy schedule.

Method (DataFrame functions only). Each source gets a target size by weight,
capped at a multiple of its own size (water filling over the one-row-per-source
table). A source's documents are shuffled by a seeded hash and laid end to
end; that stream is cut into blocks of equal tokens. Schedule slots 0, 1, ...
are golden-ratio points frac(slot * phi), mapped through the cumulative
targets to sources; the rank of a slot within its source says which block it
takes (block = rank modulo the source's blocks, so later passes repeat), and
slots are joined to blocks on (source, block).

Ranks and stream positions are two-level sums (within a chunk, then over
chunk totals), so a source that holds most rows is never one window. Points
beyond a source's quota are dropped, and slots that the finite point set
leaves short are appended, so every source takes its target to the word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratal.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
PHI = 0.6180339887498949
CHUNK_ROWS = 1 << 16


def sized_documents(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size): size is the number of words of the whole text."""
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """(source, source_size, target) per source.

    Sources in code-point order, null last, weigh ``weights`` repeating and
    share the total size; a target stops at ``cap`` times its source's size
    and the excess is reshared by weight. In the order of size / weight the
    capped sources come first, so the level of the others follows from
    running sums over this table of one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    n = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    weighed = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), n.cast("int")))
    ceiling = F.col("source_size") * F.lit(float(cap))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    up = W.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = (weighed.withColumn("ceiling", ceiling).withColumn("ratio", F.col("ceiling") / F.col("weight"))
           .withColumn("total", F.sum("source_size").over(everything))
           .withColumn("all_weight", F.sum("weight").over(everything))
           # the level if every source before this one is capped and this one is not
           .withColumn("level", (F.col("total") - F.sum("ceiling").over(up) + F.col("ceiling"))
                       / (F.col("all_weight") - F.sum("weight").over(up) + F.col("weight"))))
    free = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)
    return (run.withColumn("free", free)
            .select("source", "source_size",
                    F.when(F.col("free").isNull() | (F.col("ratio") < F.col("free.ratio")), F.col("ceiling"))
                    .otherwise(F.col("weight") * F.col("free.level")).alias("target")))


def streams(sized: DataFrame, seed: int, chunks: int) -> DataFrame:
    """(row, source, size, at): the position of each document in its
    source's shuffled stream. Documents fall in hash chunks; positions are
    running sums inside a chunk plus the sizes of the source's earlier
    chunks. The order depends on ids and sizes only; ``row`` tells repeated
    rows apart."""
    mixed = sized.withColumn("shuffle", F.xxhash64(F.lit(seed), "id", "size"))
    mixed = mixed.withColumn("chunk", F.pmod(F.shiftright("shuffle", 17), F.lit(chunks)))
    inside = W.partitionBy("source", "chunk").orderBy("shuffle", "id", "row").rowsBetween(W.unboundedPreceding, W.currentRow)
    local = mixed.withColumn("local", F.sum("size").over(inside) - F.col("size"))
    totals = mixed.groupBy("source", "chunk").agg(F.sum("size").alias("chunk_size"))
    before = W.partitionBy("source").orderBy("chunk").rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = totals.withColumn("offset", F.sum("chunk_size").over(before) - F.col("chunk_size")).drop("chunk_size")
    near = local["source"].eqNullSafe(offsets["source"]) & (local["chunk"] == offsets["chunk"])
    return (local.join(offsets, near)
            .select("row", local["source"], local["size"], (F.col("local") + F.col("offset")).alias("at")))


def schedule(targets: DataFrame, block: int, chunk: int = 4096, tasks: int | None = None) -> DataFrame:
    """(slot, source, rank, block, words): the mix in order. ``block`` is the
    block of the source's stream the slot takes, ``words`` how many of its
    words (less than the block's length only in a source's last slot)."""
    spark = targets.sparkSession
    s = (targets.where("source_size > 0 AND target > 0")
         .withColumn("quota", F.floor(F.col("target") + 0.5))
         .withColumn("n_blocks", F.ceil(F.col("source_size") / F.lit(block)))
         .withColumn("rest", F.col("quota") % F.col("source_size"))
         .withColumn("slots", F.floor(F.col("quota") / F.col("source_size")) * F.col("n_blocks")
                     + F.ceil(F.col("rest") / F.lit(block)))
         .where("slots > 0"))
    order = W.orderBy(F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = (s.withColumn("points", F.sum("slots").over(everything))
         .withColumn("high", F.sum("slots").over(order) / F.col("points"))
         .withColumn("low", F.coalesce(F.lag("high").over(W.orderBy(F.col("source").isNull(), "source")), F.lit(0.0)))
         .withColumn("no", F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))))
    s = materialize(s, "mix-sources")
    points, n_sources = s.agg(F.max("points"), F.count("*")).first()
    points, cells = int(points or 0), max(1024, 4 * n_sources)
    slots = spark.range(0, points, 1, tasks).withColumnRenamed("id", "slot")
    u = F.col("slot") * F.lit(PHI)
    drawn = slots.withColumn("u", u - F.floor(u)).withColumn("grid", F.floor(F.col("u") * cells).cast("int"))
    # the cumulative weights as ranges, dealt over a grid of [0, 1): an equi-join with a check
    ranges = (s.select("no", "slots", "low", "high")
              .withColumn("grid", F.explode(F.sequence(F.floor(F.col("low") * cells).cast("int"),
                                                       F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)).cast("int")))))
    hits = (drawn.join(ranges, "grid").where("u >= low AND (u < high OR high >= 1.0)")
            .select("slot", "no", "slots").withColumn("chunk", F.floor(F.col("slot") / F.lit(chunk))))
    # two-level rank: inside chunks of slots, plus the counts of earlier chunks
    inside = W.partitionBy("no", "chunk").orderBy("slot")
    counts = hits.groupBy("no", "chunk").agg(F.count("*").alias("n"))
    coarse = W.partitionBy("no", "group").orderBy("chunk").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = counts.withColumn("group", F.floor(F.col("chunk") / F.lit(chunk)))
    tops = counts.groupBy("no", "group").agg(F.sum("n").alias("gn"))
    tops = tops.withColumn("base", F.sum("gn").over(W.partitionBy("no").orderBy("group")) - F.col("gn")).drop("gn")
    starts = (counts.withColumn("start", F.sum("n").over(coarse) - F.col("n")).join(tops, ["no", "group"])
              .select("no", "chunk", (F.col("start") + F.col("base")).alias("start")))
    ranked = (hits.withColumn("k", F.row_number().over(inside) - 1).join(starts, ["no", "chunk"])
              .select("slot", "no", (F.col("k") + F.col("start")).alias("rank"), "slots").where("rank < slots"))
    reached = hits.groupBy("no").agg(F.count("*").alias("n"))
    short = (s.join(reached, "no", "left").withColumn("n", F.coalesce("n", F.lit(0))).where("n < slots")
             .withColumn("rank", F.explode(F.sequence(F.col("n"), F.col("slots") - 1)))
             .select((F.lit(points) + F.col("rank")).alias("slot"), "no", "rank", "slots"))
    cycle = F.col("rank") % F.col("n_blocks")
    length = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    rest = F.when(F.col("rank") == F.col("slots") - 1,
                  F.when(F.col("rest") > 0, F.col("rest") - F.col("block") * block).otherwise(length)).otherwise(length)
    return (ranked.unionByName(short)
            .join(s.select("no", "source", "source_size", "n_blocks", "rest"), "no")
            .withColumn("block", cycle)
            .select("slot", "source", "rank", "block", rest.cast("long").alias("words")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, block: int = 1024, seed: int = 17) -> DataFrame:
    """(id_col, size, source_size, target, taken) per row of ``docs``.

    ``taken`` counts the words of the document that the schedule's slots
    take, repeats counted: at most ``cap`` times its size (cap >= 1). Each
    source takes its target rounded to a word.

    Defined cases: a null, empty or white-space text has size 0 and takes
    nothing; rows with a null source form one source, last in order; a null
    id is an id of its own; repeated rows are separate documents of the same
    shuffle key (their order inside the stream does not change what either
    source takes); an empty table gives an empty result. Only the three named
    columns are read.
    """
    sized = materialize(sized_documents(docs, id_col, text_col, source_col)
                        .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    targets = materialize(source_targets(sized, weights, cap), "mix-targets")
    laid = streams(sized, seed, chunks=sized.count() // CHUNK_ROWS + 16)
    pieces = (laid.where("size > 0")
              .withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block),
                                                        F.floor((F.col("at") + F.col("size") - 1) / block))))
              .select("row", "source", "block",
                      (F.greatest("at", F.col("block") * block) - F.col("block") * block).alias("start"),
                      (F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block)
                       - F.col("block") * block).alias("end")))
    plan = schedule(targets, block)
    # how often a block is taken, and up to which word: one row per block and length
    uses = plan.groupBy("source", "block", "words").agg(F.count("*").alias("times"))
    p, q = pieces.alias("p"), uses.alias("q")
    joined = p.join(q, F.col("p.source").eqNullSafe(F.col("q.source")) & (F.col("p.block") == F.col("q.block")))
    took = F.greatest(F.least("end", "words") - F.col("start"), F.lit(0)) * F.col("times")
    taken = joined.select("row", took.alias("took")).groupBy("row").agg(F.sum("took").alias("taken"))
    s, t = sized.alias("s"), targets.alias("t")
    return (s.join(t, F.col("s.source").eqNullSafe(F.col("t.source")))
            .join(taken, "row", "left")
            .select(F.col("id").alias(id_col), F.col("s.size").alias("size"), F.col("source_size"),
                    F.col("target"), F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
