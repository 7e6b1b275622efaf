"""Mixing sources to target weights by the cube method.

Each source's target share of words gives every one of its documents the same expected number of copies. The whole part
is certain; the fractional part is drawn by balanced sampling: a flight phase moves the inclusion probabilities through
the null space of the constraints (words, documents) until at most two documents per shard are undecided; the
undecided ones of all shards fly again per source, and the last two are rounded (landing) to the choice whose word
total is nearest.

Scale: sizes are computed where the rows are read; only (source, doc_id, size) is shuffled. A source is dealt over
shards by a hash of doc_id, so a hot source has as many shards as its rows need (``SHARD_ROWS``); what a shard leaves (two rows at
most) flies in shards again until a source's rest is one shard. Reruns agree: a shard's order and its random numbers come from doc_id and a fixed seed.
Defined results: null text has size 0 (taken 0); a null source is a source of its own, the last; an empty table gives
no rows; repeated rows count each; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, materialize, n_words

WEIGHTS, CAP, SEED = (5, 2, 1), 3.0, 20240229
#: Expected rows of one flight.
SHARD_ROWS = 4000


def flight(p: np.ndarray, a: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Fast flight phase for two constraints. p: inclusion probabilities; a: n x 2 constraint values. Three undecided
    units at a time move along the null vector of their 2 x 3 constraint block until one of them is decided; the sums
    of both constraints are kept. Returns p with at most two entries strictly between 0 and 1."""
    p = [float(x) for x in p]
    a0, a1 = a[:, 0].tolist(), a[:, 1].tolist()
    eps, draws, used = 1e-9, rng.random(len(p) + 3), 0
    hand: list[int] = []
    for j in range(len(p)):
        if not eps < p[j] < 1 - eps:
            continue
        hand.append(j)
        if len(hand) < 3:
            continue
        i, k, m = hand
        # the cross product of the two constraint rows spans their null space
        u = [a0[k] * a1[m] - a0[m] * a1[k], a0[m] * a1[i] - a0[i] * a1[m], a0[i] * a1[k] - a0[k] * a1[i]]
        if max(map(abs, u)) < 1e-12:  # dependent rows: any vector orthogonal to the one row left
            u = [a1[k], -a1[i], 0.0] if abs(a1[i]) + abs(a1[k]) > 0 else [1.0, 0.0, 0.0]
        up = min(((1 - p[x]) / v if v > 0 else -p[x] / v) for x, v in zip(hand, u, strict=True) if v)
        down = min((p[x] / v if v > 0 else (p[x] - 1) / v) for x, v in zip(hand, u, strict=True) if v)
        step = up if draws[used] * (up + down) < down else -down
        used += 1
        for x, v in zip(hand, u, strict=True):
            p[x] += step * v
        hand = [x for x in hand if eps < p[x] < 1 - eps]
    return np.array([0.0 if x <= eps else 1.0 if x >= 1 - eps else x for x in p])


def landing(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round the last undecided units (two at most) to the outcome whose word total is nearest the expected one;
    ties go to a random one."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if not len(open_):
        return p
    want = float(p[open_] @ size[open_])
    outcomes = [np.array([(n >> b) & 1 for b in range(len(open_))], float) for n in range(1 << len(open_))]
    order = rng.permutation(len(outcomes))
    best = min(order, key=lambda n: abs(float(outcomes[n] @ size[open_]) - want))
    out = p.copy()
    out[open_] = outcomes[best]
    return out


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, source_size, target. Shares go by weight, sources in code-point order (null last); a target stops at
    ``cap`` times the source's size and the excess is shared again among the others: the level L at which
    sum(min(cap * size, L * weight)) is the total, found by one pass over the sources in the order of cap * size / weight.
    The windows run over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("k", (F.row_number().over(by_name) - 1) % len(weights))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") + 1).cast("int")))
    top = F.lit(cap) * F.col("source_size")
    by_ratio = Window.orderBy(top / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    level = F.try_divide(F.col("total") - F.coalesce(F.sum(top).over(before), F.lit(0.0)), F.sum("weight").over(after))
    per = per.withColumn("level", level)
    # the first source in this order that stays under its cap sets the level for all after it
    per = per.withColumn("open", F.when(F.col("level") * F.col("weight") <= top, F.col("level")))
    per = per.withColumn("open", F.min_by("open", F.struct(F.col("open").isNull(), top / F.col("weight"), F.coalesce("source", F.lit("")))).over(everything))
    target = F.least(top.cast("double"), F.coalesce(F.col("open") * F.col("weight"), top.cast("double")))
    return per.select("source", "source_size", target.alias("target"))


def _mix_shards(rows: DataFrame, keys: list[str], final: bool) -> DataFrame:
    """Fly each group; the last flight also lands. ``p`` keeps what is undecided."""

    def fly(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "size", "n"], kind="stable")
        rng = np.random.default_rng([SEED, int(group["seed"].min()) & 0x7FFFFFFF, int(final)])
        size = group["size"].to_numpy(float)
        p = flight(group["p"].to_numpy(float), np.column_stack([size, np.ones(len(size))]), rng)
        if final:
            p = landing(p, size, rng)
        return group.assign(p=p)

    return rows.groupBy(*keys).applyInPandas(fly, rows.schema)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (copies * size) for every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words("text").alias("size"), F.when(F.col("doc_id").isNull(), F.xxhash64(F.col("text").cast("string"))).otherwise(0).alias("n"))
    rows = materialize(rows, "mix_sizes")
    per = targets(rows, weights, cap)
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    per = per.join(counts, per.source.eqNullSafe(counts.source)).select(per.source, "source_size", "target", "n_docs")
    per = per.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("n_docs") / shard_rows)).cast("long"))
    per = per.withColumn("expected", F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0)))
    rows, per = rows.alias("r"), per.alias("s")
    rows = rows.join(per, F.expr("r.source <=> s.source")).select(
        "doc_id", F.col("r.source").alias("source"), "size", "source_size", "target",
        F.floor("expected").cast("long").alias("whole"), (F.col("expected") - F.floor("expected")).alias("p"),
        F.pmod(F.xxhash64("doc_id", "n"), F.col("shards")).alias("shard"), "n",
        F.xxhash64(F.coalesce(F.col("r.source"), F.lit("\0null"))).alias("seed"),
    )
    # n tells rows without an id apart by their texts; equal rows are equal units
    rows = rows.withColumn("seed", F.xxhash64("seed", "shard"))
    first = materialize(_mix_shards(rows, ["source", "shard"], False), "mix_flight")
    undecided = (F.col("p") > 0) & (F.col("p") < 1)
    done, rest, level = first.filter(~undecided), first.filter(undecided), 0
    name = F.coalesce("source", F.lit("\0null"))
    while (rest.groupBy("source").count().agg(F.max("count")).first()[0] or 0) > shard_rows:  # what is left flies in shards again
        level += 1
        left = rest.groupBy(F.col("source").alias("_s")).agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("long").alias("_n"))
        rest = rest.join(left, F.expr("source <=> _s")).withColumn("shard", F.pmod(F.xxhash64("doc_id", "n", F.lit(level)), F.col("_n"))).drop("_s", "_n")
        rest = materialize(_mix_shards(rest.withColumn("seed", F.xxhash64(name, "shard", F.lit(level))), ["source", "shard"], False), "mix_flight")
        done, rest = done.unionByName(rest.filter(~undecided)), rest.filter(undecided)
    last = _mix_shards(rest.withColumn("seed", F.xxhash64(name)), ["source"], True)
    done = done.unionByName(last)
    copies = (F.col("whole") + F.col("p").cast("long")).alias("copies")
    return done.select("doc_id", "source", "size", "source_size", "target", copies).withColumn("taken", F.col("copies") * F.col("size"))


def op6_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


QUERIES = {"op6_cube_mixing": op6_cube_mixing}
ORACLE: dict[str, str] = {}
