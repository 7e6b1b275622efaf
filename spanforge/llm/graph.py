"""Distributed union-find: connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable by links, for every node of an edge (loops and repeated links
    do no harm, nulls are left out).

    A large star links each node's larger neighbours to its smallest neighbour, a small star the smaller ones; each
    round's edges are a table in the shared folder, and the edge count never grows. It ends when a round changes
    nothing: all edges then point to their component. Only DataFrame operators; a hub's neighbours are combined
    before they are shuffled, and its joins are ones that Spark can split."""
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now = materialize(now, "edges")
    mark = _mark(now)
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("k")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        others = large.join(low.withColumnRenamed("u", "k"), F.col("u") == F.col("k")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = materialize(others.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        discard(now)
        now, before, mark = new, mark, _mark(new)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())
