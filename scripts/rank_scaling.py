"""Global dense rank: unpartitioned window vs range-partitioned offsets.

Keys are derived from lineitem: (l_orderkey, l_linenumber) repeated with a
replica number from ``explode(sequence(..))`` to reach the target count; the
``limit`` sets that count (it is the measured size, this is not a
registered query).
Prints one JSON line per size with both timings (median of runs) and
whether the two ranks agree on every key.
"""

from __future__ import annotations

import json
import math
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from stratal.operators.rank import rank_distinct  # noqa: E402
from stratal.session import build_session, materialize  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    sizes = [int(s) for s in (sys.argv[1:] or ["100000", "1000000", "10000000"])]
    spark = build_session("local[8]", 8, extra={"spark.driver.memory": "16g"})
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    base = li.distinct().count()
    order = ["l_orderkey", "l_linenumber", "rep"]
    for n in sizes:
        reps = max(1, math.ceil(n / base))
        keys = (li.select("*", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"))
                .distinct().orderBy(F.xxhash64("l_orderkey", "l_linenumber", "rep")).limit(n))
        keys = materialize(keys, "rank-scaling-keys")
        single = keys.withColumn("rank", F.dense_rank().over(Window.orderBy(*order)))
        t_single = statistics.median(_t(lambda: noop(single)) for _ in range(2))
        t_par = statistics.median(_t(lambda: noop(rank_distinct(keys, order, "rank"))) for _ in range(2))
        diff = (single.join(rank_distinct(keys, order, "rank2"), order)
                .where(F.col("rank") != F.col("rank2")).count())
        print(json.dumps({"keys": keys.count(), "single_window_sec": round(t_single, 2),
                          "range_offsets_sec": round(t_par, 2), "differing_ranks": diff}), flush=True)


def _t(fn):
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


if __name__ == "__main__":
    main()
