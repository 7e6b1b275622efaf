"""Class hierarchies: closure of a DAG, subtrees, and folds of class scores to categories."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def closure(edges: DataFrame, child: str = "child_id", parent: str = "parent_id", max_depth: int = 64) -> DataFrame:
    """(node, ancestor, depth): every ancestor of every node up to ``max_depth`` steps with its least depth, the node itself at depth 0. A
    recursive SQL query that carries (node, ancestor) pairs, not paths: each level holds a pair once, however many ways lead to it, and
    a cycle is walked up to the limit."""
    spark, view = edges.sparkSession, f"edges_{uuid.uuid4().hex}"
    edges.select(F.col(child).cast("string").alias("c"), F.col(parent).cast("string").alias("p")).distinct().createOrReplaceTempView(view)
    got = spark.sql(f"""
        WITH RECURSIVE up(node, ancestor, depth) MAX RECURSION LEVEL {max_depth + 2} AS (
          SELECT n, n, 0 FROM (SELECT c AS n FROM {view} UNION SELECT p FROM {view})
          UNION ALL
          SELECT DISTINCT node, e.p, depth + 1 FROM up JOIN {view} e ON up.ancestor = e.c WHERE depth < {max_depth})
        SELECT node, ancestor, depth FROM up""")
    return got.groupBy("node", "ancestor").agg(F.min("depth").alias("depth"))


def paths(edges: DataFrame, root: str, child: str = "child_id", parent: str = "parent_id") -> DataFrame:
    """All root-to-leaf paths."""
    spark, view = edges.sparkSession, f"edges_{uuid.uuid4().hex}"
    edges.select(F.col(child).cast("string").alias("c"), F.col(parent).cast("string").alias("p")).distinct().createOrReplaceTempView(view)
    return spark.sql(f"""
        WITH RECURSIVE down(node, path) AS (
          SELECT '{root}', array('{root}')
          UNION ALL
          SELECT e.c, array_append(path, e.c) FROM down JOIN {view} e ON down.node = e.p WHERE NOT array_contains(path, e.c))
        SELECT path FROM down WHERE node NOT IN (SELECT p FROM {view})""")


def subtree(up: DataFrame, root: str) -> DataFrame:
    return up.filter(F.col("ancestor") == root).select("node")


def include_exclude(up: DataFrame, include: str, exclude: str) -> DataFrame:
    """Nodes of one subtree that are not in another."""
    return subtree(up, include).join(subtree(up, exclude), "node", "left_anti")


def category_of(up: DataFrame, categories: dict[str, str], default: str) -> DataFrame:
    """node, category: by the first category (in the order given) that a node or one of its ancestors carries."""
    order = list(categories)
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("ancestor")).cast("int")
    hit = up.filter(F.col("ancestor").isin(*order)).groupBy("node").agg(F.min(rank).alias("rank"))
    name = F.element_at(F.array(*[F.lit(categories[c]) for c in order]), F.col("rank"))
    return up.select("node").distinct().join(hit, "node", "left").select("node", F.coalesce(F.when(F.col("rank").isNotNull(), name), F.lit(default)).alias("category"))


def fold(probs: DataFrame, mapping: DataFrame, keys: list[str], label: str = "label", category: str = "category", p: str = "p", floor: float = 0.0) -> DataFrame:
    """Class scores summed by category; scores under ``floor`` count as zero."""
    x = F.when(F.col(p) >= floor, F.col(p)).otherwise(0.0) if floor else F.col(p)
    return probs.join(mapping, label).groupBy(*keys, category).agg(F.sum(x).alias("p"))
