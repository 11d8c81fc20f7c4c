"""Connected components of an edge table, never on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import durable, release


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"), F.sum(F.expr("shiftright(xxhash64(b, a), 20)")).alias("s")).first()
    return tuple(row)


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """Label every node of ``edges(a long, b long)`` with the smallest node that links reach: (node, label).

    Alternates two star contractions until the edges no longer change: each node hands its larger neighbours,
    then its smaller ones, to its smallest neighbour. Minima are pre-aggregated before the shuffle; a hub's
    rows are split by the adaptive skew join. Each round ends in a checkpoint, so that a lost executor repeats
    one round at most, and then deletes the checkpoints before it. Nodes without edges, loops and repeated edges are allowed; null ends are dropped.
    """
    now = durable(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    for _ in range(rounds):
        if not state[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(low, both.a == low.k).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = durable(large)
        down = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        joined = large.join(down, large.a == down.k)
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct()
        before, now = now, durable(small)
        release(before)
        release(large)
        after = _state(now)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # settled: every node points straight at the smallest of its component
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
