"""Connected components and block-wise work over large groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratal.session import materialize


def _canonical(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    return _canonical(both.join(low, "a").where("b > a")
                      .select(F.col("b").alias("a"), F.least("m", "a").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    return _canonical(edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(low.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame, name: str = "components", max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; the component is
    the smallest node reachable.

    Alternates large-star and small-star steps. Each round is written to the
    shared checkpoint folder (cutting the lineage) and only a row count and a
    checksum come to the driver. A node with many neighbours only meets
    grouped minima and joins that adaptive execution can split.
    """
    current = materialize(_canonical(edges.select("a", "b")), name)
    state = _state(current)
    for _ in range(max_rounds):
        if not state[0]:
            break
        current = materialize(_small_star(materialize(_large_star(current), name)), name)
        before, state = state, _state(current)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def block_pairs(members: DataFrame, group: str, member: str, n_blocks: str) -> DataFrame:
    """Deal each group's members into ``n_blocks`` blocks by hash and send
    each member to every block pair (lo, hi) that holds its block.

    All pairs of a group meet in some block pair, no task sees more than two
    blocks, and no pair is emitted as a row. Adds lo, hi, and block.
    """
    mine = F.pmod(F.xxhash64(group, member, F.lit("block")), F.col(n_blocks)).cast("int")
    return (members.withColumn("block", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(n_blocks).cast("int") - 1)))
            .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
            .drop("other"))


class Forest:
    """Union-find over the members of one block pair."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True
