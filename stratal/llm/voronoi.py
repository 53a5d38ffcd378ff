"""Exact top-k inner products by a Voronoi join.

Method. A bounded sample of the data gives pivots; every data vector and
every query belongs to its nearest pivot. Large cells are cut into shells by the
distance to the pivot; each shell is summarised by its reach (the largest
distance), its longest vector and its size.

Every query first meets one bounded block of its own cell: the k-th best
score found there is a bound that only better candidates beat. By
Cauchy-Schwarz, with x = p + r, q.x <= q.p + |q| |r|; by the triangle
inequality, |q - x| >= |q - p| - |r| bounds q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2
as well. A shell whose bounds stay below a query's score holds none of its
answers. Queries of neighbouring cells form groups of bounded size; a shell
is replicated only to the groups that hold a query which needs it, and a query only
to the shells it needs. Small shells share a task, large ones are cut into
blocks. A task computes exact integer products and returns, per query, at
most k candidates that reach its bound; they are merged by rank.

Where vectors have no clusters (random ones in many dimensions) the bounds
hold back nothing, and every group meets every block: the work of a plain
blocked search, with one copy of the data per group of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratal.llm.arrow import groups
from stratal.session import materialize

PIVOTS, QUERY_BLOCK, DATA_BLOCK = 64, 4096, 8192
SHELLS = 16  # per cell, at most
SLACK = 1e-9  # of the bounds, relative
LONG = 2 ** 63 - 1


def quantized(vec: Column, scale: int) -> Column:
    """floor(scale * x) of every component in doubles, or null if the vector
    is null or holds a null or non-finite component."""
    v = vec.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(v.isNotNull() & ~bad, F.transform(v, lambda x: F.floor(x * scale).cast("double")))


def inner_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products (rows of q by rows of x) as longs; sums
    beyond a long stop at its ends."""
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if largest < 2 ** 53:
        return (q @ x.T).astype(np.int64)
    a = np.array([[int(v) for v in row] for row in q], object).reshape(q.shape)
    b = np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
    return np.array([[max(-LONG, min(LONG, int((u * v).sum()))) for v in b] for u in a], np.int64).reshape(len(q), len(x))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every row's k best scores, ties to smaller ids; rows
    with fewer columns give all. Columns must be in ascending id."""
    m = scores.shape[1]
    if m > 4 * k:
        floor = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
        rows, cols = np.nonzero(scores >= floor)  # at least k a row, ties included
    else:
        rows, cols = (a.ravel() for a in np.indices(scores.shape))
    order = np.lexsort((ids[cols], -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    start = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - start < k
    return rows[keep], cols[keep]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of vectors of one length as a matrix."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks)
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def _assign(pivots: np.ndarray):
    """Nearest pivot, distance to it and length of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                x = _matrix(b.column("vec"))
                near = np.full(len(x), -1)
                dist = np.full(len(x), np.inf)
                for k, p in enumerate(pivots):  # bounded: one pass per pivot, no |x|^2 cancellation
                    d = np.sqrt(((x - p) ** 2).sum(axis=1))
                    closer = d < dist
                    near[closer], dist[closer] = k, d[closer]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(near.astype(np.int32)), pa.array(dist),
                     pa.array(np.sqrt((x * x).sum(axis=1))), b.column("vec")], names=["id", "cell", "dist", "len", "vec"])

    return run


Unit = tuple[int, int, float, float, int]  # cell, shell, reach, longest vector, rows


def needed(vec: np.ndarray, least: np.ndarray, pivots: np.ndarray, units: list[Unit]) -> np.ndarray:
    """(queries x units): whether a unit may hold a score of at least ``least``."""
    cell = np.array([u[0] for u in units], np.int64)
    reach, longest = (np.array([u[i] for u in units], np.float64) for i in (2, 3))
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.sqrt((vec * vec).sum(axis=1))
        middle = (vec @ pivots.T)[:, cell]
        away = np.stack([np.sqrt(((vec - p) ** 2).sum(axis=1)) for p in pivots], 1)[:, cell]
        spread = size[:, None] * reach
        near = np.maximum(0.0, away - reach)
        first = middle + spread + SLACK * (np.abs(middle) + spread + 1)
        second = (size[:, None] ** 2 + longest ** 2 - near ** 2) / 2
        second += SLACK * (size[:, None] ** 2 + longest ** 2 + away ** 2 + reach ** 2 + 1)
        return ~((first < least[:, None]) | (second < least[:, None]))  # a bound that is no number keeps the unit


def chain(pivots: np.ndarray, cells: list[int]) -> list[int]:
    """The cells in an order in which neighbours follow each other."""
    left, order = sorted(cells), []
    while left:
        at = left[0] if not order else min(left, key=lambda c: (float(((pivots[c] - pivots[order[-1]]) ** 2).sum()), c))
        left.remove(at)
        order.append(at)
    return order


def bundles(items: list[tuple[tuple, int]], size: int) -> list[tuple[tuple, int, int]]:
    """(key, bundle, blocks): keys in their order, small ones together up to
    ``size`` rows, a large one alone in as many blocks as it needs. Numbers of
    bundles leave room for the blocks."""
    out, bundle, filled = [], 0, 0
    for key, n in items:
        if filled and filled + n > size:
            bundle, filled = bundle + 1, 0
        blocks = -(-n // size)
        out.append((key, bundle, max(1, blocks)))
        filled += n
        if blocks > 1:
            bundle, filled = bundle + 1, 0
    return out


def top_k(vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 64, pivots: int = PIVOTS, query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every row for
    which ``queries`` holds, over all rows but the query's own id.

    Vectors are floor(scale * x) per component; the score is the integer inner
    product; ties go to the smaller id. Defined cases: null vectors, and those
    with null or non-finite components, take no part, as do rows with a null
    id; vectors of different length never meet; an empty vector scores 0;
    rows that repeat an id and vector are one candidate (of several vectors of
    one id every one counts); a query with fewer than k candidates gets all;
    an empty table gives an empty result. The pivots (``pivots`` per length)
    are a bounded sample; every row is searched.
    """
    rows = (vectors.withColumn("__q", F.coalesce(queries, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vec_col), scale).alias("vec"), "__q")
            .where("id IS NOT NULL AND vec IS NOT NULL").withColumnRenamed("__q", "is_query").distinct())
    rows = materialize(rows.withColumn("dim", F.size("vec")), "knn-rows")
    solved = [_solve_dim(rows.where(F.col("dim") == r["dim"]), int(r["n"]), k, pivots, query_block, data_block)
              for r in rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy("dim").collect()]
    if not solved:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = solved[0]
    for more in solved[1:]:
        out = out.unionByName(more)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _block(of: str, total: str) -> Column:
    return F.pmod(F.xxhash64(F.col(of), F.lit("block")), F.col(total)).cast("int")


def _tables(batches: Iterator[pa.RecordBatch], keys: list[str]):
    """(asking rows, data rows) of each task's groups as (ids, vectors, bounds); groups without either are passed over."""
    for t in groups(batches, keys):
        ask = t.column("ask").to_numpy()
        if ask.all() or not ask.any():
            continue
        ids = t.column("id").to_numpy()
        vec = _matrix(t.column("vec"))
        least = t.column("least").fill_null(0).to_numpy() if "least" in t.column_names else None  # whole numbers stay exact
        yield (t, (ids[ask], vec[ask], least[ask] if least is not None else None), (ids[~ask], vec[~ask]))


def _scores(q_ids, q_vec, d_ids, d_vec, step: int = 256):
    """(first query, scores, own): integer products of blocks of queries, a query's own id at the bottom."""
    for at in range(0, len(q_ids), step):
        scores = inner_products(q_vec[at:at + step], d_vec)
        own = q_ids[at:at + step, None] == d_ids[None, :]
        scores[own] = -LONG
        yield at, scores, own


def _first_bounds(cells: DataFrame, k: int, data_block: int) -> DataFrame:
    """(cell, id, vec, least): the k-th best score of every query in one block of
    its own cell, the least long where the block has fewer candidates."""
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / data_block).alias("blocks"))  # one row per pivot
    keyed = cells.join(F.broadcast(sizes), "cell").withColumn("db", _block("id", "blocks"))
    asks = keyed.where("is_query").select("cell", "db", F.lit(True).alias("ask"), "id", "vec")
    gives = keyed.select("cell", "db", F.lit(False).alias("ask"), "id", "vec")
    keys = ["cell", "db"]
    dealt = asks.unionByName(gives).repartition(*keys).sortWithinPartitions(*keys, "ask", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, (q, q_vec, _), (d, d_vec) in _tables(batches, keys):
            column = t.column("vec").filter(t.column("ask")).combine_chunks()
            for at, scores, own in _scores(q, q_vec, d, d_vec):
                enough = (~own).sum(axis=1) >= k
                least = np.full(len(scores), -LONG, np.int64)
                if enough.any():
                    least[enough] = -np.partition(-scores[enough], k - 1, axis=1)[:, k - 1]
                cell = pa.array(np.full(len(scores), t.column("cell")[0].as_py(), np.int32))
                yield pa.RecordBatch.from_arrays([cell, pa.array(q[at:at + len(scores)]), column.slice(at, len(scores)), pa.array(least)],
                                                 names=["cell", "id", "vec", "least"])

    return dealt.mapInArrow(run, "cell int, id long, vec array<double>, least long")


def _solve_dim(rows: DataFrame, n: int, k: int, pivots: int, query_block: int, data_block: int) -> DataFrame:
    spark = rows.sparkSession
    wanted = max(1, min(pivots, int(n ** 0.5)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(wanted).select("vec").collect()
    points = np.unique(np.array([r["vec"] for r in sample], np.float64).reshape(len(sample), -1), axis=0)
    assigned = rows.select("id", "vec").mapInArrow(_assign(points), "id long, cell int, dist double, len double, vec array<double>")
    asked = rows.where("is_query").select("id", "is_query").distinct()
    cells = materialize(assigned.join(asked, "id", "left").withColumn("is_query", F.coalesce("is_query", F.lit(False))), "knn-cells")
    # shells of the cells that fill more than a block; at most SHELLS a cell
    marks = F.percentile_approx("dist", [i / SHELLS for i in range(1, SHELLS)], 1000)
    cuts = cells.groupBy("cell").agg(F.when(F.count("*") > data_block, F.array_distinct(marks)).otherwise(F.array()).alias("cuts"))
    shelled = (cells.join(F.broadcast(cuts), "cell")
               .withColumn("shell", F.size(F.filter("cuts", lambda m: m < F.col("dist")))).drop("cuts"))
    units = [(r["cell"], r["shell"], r["reach"], r["longest"], r["n"]) for r in shelled.groupBy("cell", "shell").agg(
        F.max("dist").alias("reach"), F.max("len").alias("longest"), F.count("*").alias("n")).collect()]
    queries = {r["cell"]: r["n"] for r in cells.where("is_query").groupBy("cell").agg(F.count("*").alias("n")).collect()}
    order = {c: i for i, c in enumerate(chain(points, sorted({u[0] for u in units})))}
    units.sort(key=lambda u: (order[u[0]], u[1]))
    data_plan = bundles([((i,), u[4]) for i, u in enumerate(units)], data_block)
    query_plan = bundles([((c,), queries[c]) for c in sorted(queries, key=order.__getitem__)], query_block)
    at = {(u[0], u[1]): i for i, u in enumerate(units)}
    unit_rows = F.broadcast(spark.createDataFrame(
        [(c, sh, i, data_plan[i][1], data_plan[i][2]) for (c, sh), i in at.items()], "cell int, shell int, unit int, bundle int, dblocks int"))
    group_rows = F.broadcast(spark.createDataFrame([(c[0], g, b) for c, g, b in query_plan], "cell int, grp int, qblocks int"))

    keyed = _first_bounds(cells, k, data_block).join(group_rows, "cell").withColumn("qb", _block("id", "qblocks"))
    shared = spark.sparkContext.broadcast((points, units, data_plan))  # at most pivots * SHELLS units

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with the bundles and the units it needs."""
        pivots_, units_, bundled = shared.value
        of = np.array([b for _, b, _ in bundled], np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                b = batch.slice(start, 1024)
                vec = _matrix(b.column("vec"))
                need = needed(vec, b.column("least").to_numpy().astype(np.float64), pivots_, units_)
                lists = [np.flatnonzero(row).tolist() for row in need]
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in ("grp", "qb", "id", "vec", "least")], pa.array(lists, pa.list_(pa.int32())),
                     pa.array([np.unique(of[x]).tolist() for x in lists], pa.list_(pa.int32()))],
                    names=["grp", "qb", "id", "vec", "least", "units", "bundles"])

    planned = materialize(keyed.select("grp", "qb", "id", "vec", "least").mapInArrow(
        plan, "grp int, qb int, id long, vec array<double>, least long, units array<int>, bundles array<int>"), "knn-queries")
    wants = planned.select("grp", "qb", F.explode("units").alias("unit")).distinct()
    blocks = F.broadcast(unit_rows.select("bundle", "dblocks").distinct())
    asks = (planned.select("grp", "qb", "id", "vec", "least", F.explode("bundles").alias("bundle")).join(blocks, "bundle")
            .withColumn("db", F.explode(F.sequence(F.lit(0), F.col("dblocks") - 1))).withColumn("ask", F.lit(True)))
    gives = (shelled.join(unit_rows, ["cell", "shell"]).join(wants, "unit").withColumn("db", _block("id", "dblocks"))
             .withColumn("ask", F.lit(False)).withColumn("least", F.lit(None).cast("long")))
    keys = ["grp", "qb", "bundle", "db"]
    columns = [*keys, "ask", "id", "vec", "least"]
    dealt = asks.select(*columns).unionByName(gives.select(*columns)).repartition(*keys).sortWithinPartitions(*keys, "ask", "id")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (q, q_vec, least), (d, d_vec) in _tables(batches, keys):
            for start, scores, own in _scores(q, q_vec, d, d_vec):
                low = least[start:start + len(scores)].astype(np.int64)
                rows_, cols = best(scores, d, k)
                good = ~own[rows_, cols] & (scores[rows_, cols] >= low[rows_])
                rows_, cols = rows_[good], cols[good]
                yield pa.RecordBatch.from_arrays([pa.array(q[start + rows_]), pa.array(d[cols]), pa.array(scores[rows_, cols])],
                                                 names=["query_id", "vec_id", "score"])

    return dealt.mapInArrow(solve, "query_id long, vec_id long, score long")
