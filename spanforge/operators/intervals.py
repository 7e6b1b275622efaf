"""Gaps and islands, interval merging and interval joins, as plans of windows, aggregates and equi-joins.

Keys always lead the partitioning (recording, track, ...), so all windows of one chain share an exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def island_ids(frames: DataFrame, keys: list[str], flag: str, idx: str = "frame_idx") -> DataFrame:
    """Rows where ``flag`` holds, with ``island``: equal for consecutive indices."""
    w = Window.partitionBy(*keys).orderBy(idx)
    return frames.filter(F.col(flag)).withColumn("island", F.col(idx) - F.row_number().over(w))


def runs(frames: DataFrame, keys: list[str], flag: str, idx: str = "frame_idx", aggs: list[Column] | None = None) -> DataFrame:
    """Half-open runs [fs, fe) of true frames, with any aggregates over their rows. Indices must be dense."""
    got = island_ids(frames, keys, flag, idx).groupBy(*keys, "island").agg(F.min(idx).alias("fs"), (F.max(idx) + 1).alias("fe"), *(aggs or []))
    return got.drop("island")


def run_lengths(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Runs of an equal value: first and last position, length."""
    w = Window.partitionBy(*keys).orderBy(order)
    changed = F.coalesce((~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"), F.lit(1))
    first = F.when(F.row_number().over(w) == 1, 1).otherwise(changed)
    grp = rows.withColumn("_new", first).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grp.groupBy(*keys, "run", value).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("length"))


def merge_groups(rows: DataFrame, keys: list[str], start: str, end: str, max_gap: float, extra_order: list[str] | None = None, name: str = "grp") -> DataFrame:
    """Number the groups of intervals whose gaps are at most ``max_gap`` (0: overlap or touch)."""
    w = Window.partitionBy(*keys).orderBy(start, end, *(extra_order or []))
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col(start) - before > F.lit(max_gap)), 1).otherwise(0)
    return rows.withColumn("_new", new).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def merge(rows: DataFrame, keys: list[str], start: str, end: str, max_gap: float = 0.0, min_length: float | None = None) -> DataFrame:
    """Merged intervals with a dense ``block_id`` per key; shorter ones than ``min_length`` are dropped before numbering."""
    got = merge_groups(rows, keys, start, end, max_gap).groupBy(*keys, "grp").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("grp")
    if min_length is not None:
        got = got.filter(F.col(end) - F.col(start) >= F.lit(min_length))
    return got.withColumn("block_id", F.row_number().over(Window.partitionBy(*keys).orderBy(start)) - 1)


def overlap_seconds(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))


def overlap_ratio(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Overlap over the shorter duration; 0 if disjoint or without length."""
    short = F.least(a1 - a0, b1 - b0)
    return F.when(short > 0, overlap_seconds(a0, a1, b0, b1) / short).otherwise(0.0)


def overlap_join(a: DataFrame, b: DataFrame, keys: list[str], bucket: float, how: str = "inner", condition: Column | None = None) -> DataFrame:
    """Pairs of rows whose closed intervals meet, as an equi-join on time buckets.

    ``a`` has a0, a1 and ``b`` has b0, b1 (DOUBLE; other column names must differ except the keys). Each interval is exploded
    over the buckets it covers; a pair is emitted only in the bucket of the later start, so it appears once.
    ``condition`` narrows the overlap. how: inner, left_semi or left_anti."""
    size = F.lit(float(bucket))

    def spread(df: DataFrame, lo: str, hi: str, tag: str) -> DataFrame:
        first, last = F.floor(F.col(lo) / size), F.floor(F.col(hi) / size)
        return df.filter(F.col(lo) <= F.col(hi)).withColumn(tag, F.explode(F.sequence(first, last)))

    left, right = spread(a, "a0", "a1", "_ka"), spread(b, "b0", "b1", "_kb")
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.col("_ka") == F.col("_kb")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    meet = (F.col("a0") <= F.col("b1")) & (F.col("b0") <= F.col("a1"))
    if condition is not None:
        meet = meet & condition
    if how == "inner":
        once = F.floor(F.greatest("a0", "b0") / size) == F.col("_ka")
        return left.join(right, on & meet & once).drop("_ka", "_kb", *[f"_r_{k}" for k in keys])
    hit = left.join(right, on & meet, "left_semi").drop("_ka").distinct()
    if how == "left_semi":
        return hit
    renamed = hit.select(*[F.col(c).alias(f"_h_{c}") for c in a.columns])
    same = F.lit(True)
    for c in a.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    return a.join(renamed, same, "left_anti")


def assign_blocks(frames: DataFrame, blocks: DataFrame, keys: list[str], hop: float, window: float, bucket: float = 64.0) -> DataFrame:
    """``block_id`` of the last block that holds a frame's whole window (closed comparisons), else -1."""
    f = frames.withColumn("a0", F.col("frame_idx") * F.lit(float(hop))).withColumn("a1", F.col("frame_idx") * F.lit(float(hop)) + F.lit(float(window)))
    b = blocks.select(*keys, F.col("start_sec").cast("double").alias("b0"), F.col("end_sec").cast("double").alias("b1"), "block_id")
    inside = (F.col("a0") >= F.col("b0")) & (F.col("a1") <= F.col("b1"))
    ident = [c for c in frames.columns if c not in keys and c != "frame_idx"]
    per = overlap_join(f.select(*dict.fromkeys([*keys, *[c for c in ("recording_id", "track_id") if c in frames.columns], "frame_idx", "a0", "a1"])), b, keys, bucket, "inner", inside)
    same = [c for c in dict.fromkeys([*keys, "recording_id", "track_id", "frame_idx"]) if c in frames.columns]
    best = per.groupBy(*same).agg(F.max("block_id").alias("block_id"))
    return frames.join(best, same, "left").select(*same, *[c for c in ident if c not in same], F.coalesce("block_id", F.lit(-1)).alias("block_id"))


def coverage(frames: DataFrame, intervals: DataFrame, keys: list[str], hop: float, window: float, bucket: float = 64.0) -> DataFrame:
    """Fraction of each frame's window that intervals cover; without any, 0."""
    f = frames.withColumn("a0", F.col("frame_idx") * F.lit(float(hop))).withColumn("a1", F.col("a0") + F.lit(float(window)))
    b = intervals.select(*keys, F.col("start_sec").cast("double").alias("b0"), F.col("end_sec").cast("double").alias("b1"))
    same = list(dict.fromkeys([*keys, "frame_idx"]))
    part = overlap_join(f.select(*same, "a0", "a1"), b, keys, bucket).groupBy(*same).agg(F.sum(overlap_seconds(F.col("a0"), F.col("a1"), F.col("b0"), F.col("b1"))).alias("_s"))
    return frames.join(part, same, "left").withColumn("coverage", F.coalesce(F.col("_s"), F.lit(0.0)) / F.lit(float(window))).drop("_s")


def center_mask(frames: DataFrame, intervals: DataFrame, keys: list[str], hop: float, window: float, bucket: float = 64.0) -> DataFrame:
    """``valid``: the hop-wide cell around the frame's centre overlaps an interval (strict comparisons)."""
    mid = F.col("frame_idx") * F.lit(float(hop)) + F.lit(window / 2.0)
    same = list(dict.fromkeys([*keys, "frame_idx"]))
    f = frames.select(*same, (mid - F.lit(hop / 2.0)).alias("a0"), (mid + F.lit(hop / 2.0)).alias("a1"))
    b = intervals.select(*keys, F.col("start_sec").cast("double").alias("b0"), F.col("end_sec").cast("double").alias("b1"))
    hit = overlap_join(f, b, keys, bucket, "inner", (F.col("b0") < F.col("a1")) & (F.col("b1") > F.col("a0"))).select(*same).distinct().withColumn("_hit", F.lit(True))
    return frames.join(hit, same, "left").withColumn("valid", F.coalesce("_hit", F.lit(False))).drop("_hit")


def paint(grid: DataFrame, intervals: DataFrame, keys: list[str], hop: float, bucket: float = 64.0) -> DataFrame:
    """``painted``: a frame's start lies in an interval [start, end)."""
    same = list(dict.fromkeys([*keys, "frame_idx"]))
    f = grid.select(*same).withColumn("a0", F.col("frame_idx") * F.lit(float(hop))).withColumn("a1", F.col("a0"))
    b = intervals.select(*keys, F.col("start_sec").cast("double").alias("b0"), F.col("end_sec").cast("double").alias("b1"))
    hit = overlap_join(f, b, keys, bucket, "inner", F.col("a0") < F.col("b1")).select(*same).distinct().withColumn("_hit", F.lit(1))
    return grid.join(hit, same, "left").withColumn("painted", F.coalesce("_hit", F.lit(0))).drop("_hit")


def closing(frames: DataFrame, keys: list[str], valid: str, support: str, max_gap: int, idx: str = "frame_idx") -> DataFrame:
    """Support runs joined over holes of at most ``max_gap`` frames, never across a frame that is not valid: fs, fe (closed),
    raw_frames, bridge_frames."""
    seg = island_ids(frames, keys, valid, idx).withColumnRenamed("island", "segment")
    parts = runs(seg, [*keys, "segment"], support, idx)
    grp = merge_groups(parts, [*keys, "segment"], "fs", "fe", max_gap)
    out = grp.groupBy(*keys, "segment", "grp").agg(F.min("fs").alias("fs"), F.max("fe").alias("fe"), F.sum(F.col("fe") - F.col("fs")).alias("raw_frames"))
    return out.withColumn("bridge_frames", F.col("fe") - F.col("fs") - F.col("raw_frames")).drop("segment", "grp")
