"""Robust baselines: exact medians and MADs, global, by neighbourhood and rolling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import null_nan

MAD_SCALE, FLOOR = 1.4826, 1e-9


def global_stats(frames: DataFrame, keys: list[str], value: str = "value", interior: str | None = None) -> DataFrame:
    """keys, center (median) and scale (1.4826 * MAD, at least 1e-9) over interior frames, else over all, else (0, 1e-9). A value
    that is NaN is missing."""
    v = null_nan(F.col(value))
    inside = v if interior is None else F.when(F.col(interior), v)
    mid = frames.groupBy(*keys).agg(F.percentile(inside, 0.5).alias("m_in"), F.percentile(v, 0.5).alias("m_all"))
    both = frames.join(mid, keys).withColumn("center", F.coalesce("m_in", "m_all", F.lit(0.0)))
    use = F.when(F.col("m_in").isNull(), v).otherwise(inside)
    return both.groupBy(*keys, "center").agg(F.percentile(F.abs(use - F.col("center")), 0.5).alias("mad")).select(*keys, "center", F.greatest(F.coalesce(F.col("mad") * MAD_SCALE, F.lit(FLOOR)), F.lit(FLOOR)).alias("scale"))


def zscores(frames: DataFrame, stats: DataFrame, keys: list[str], value: str = "value", valid: str | None = None) -> DataFrame:
    """``z``; 0 on frames that are not valid or have no value (null or NaN)."""
    v = null_nan(F.col(value))
    z = (v - F.col("center")) / F.col("scale")
    ok = v.isNotNull() if valid is None else F.col(valid) & v.isNotNull()
    return frames.join(stats, keys).withColumn("z", F.when(ok, z).otherwise(F.lit(0.0)))


def neighbour_baseline(frames: DataFrame, blocks: DataFrame, keys: list[str], hop: float, window: float, radius: float, min_context: float, floor_frac: float) -> DataFrame:
    """keys, block_id, frame_idx (null for a block-wide anchor), t, n, baseline, scale.

    The context of an anchor is the frames of *other* blocks of the same track whose centre is within ``radius`` of t. A block
    no longer than the radius has one anchor at its centre; of a longer one each frame is an anchor. The self-join is an
    equi-join on buckets of ``radius`` (an anchor meets three), not a theta join. Short contexts fall back to the global statistics.

    frames: keys, frame_idx, value, block_id (-1 outside blocks); blocks: keys, block_id, start_sec, end_sec."""
    center = F.col("frame_idx") * F.lit(float(hop)) + F.lit(window / 2.0)
    inside = frames.filter((F.col("block_id") >= 0) & null_nan(F.col("value")).isNotNull()).withColumn("c", center)
    b = blocks.select(*keys, "block_id", F.col("start_sec").cast("double").alias("s"), F.col("end_sec").cast("double").alias("e"))
    short = b.filter(F.col("e") - F.col("s") <= radius).select(*keys, "block_id", F.lit(None).cast("long").alias("anchor"), ((F.col("s") + F.col("e")) / 2).alias("t"))
    long_ = inside.join(b.filter(F.col("e") - F.col("s") > radius).select(*keys, "block_id"), [*keys, "block_id"]).select(*keys, "block_id", F.col("frame_idx").cast("long").alias("anchor"), F.col("c").alias("t"))
    anchors = short.unionByName(long_)
    cell = F.floor(F.col("t") / radius)
    a = anchors.withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    other = inside.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("block_id").alias("_block"), "c", F.col("value").alias("x"), F.floor(F.col("c") / radius).alias("_cell"))
    on = (F.col("cell") == F.col("_cell")) & (F.col("block_id") != F.col("_block")) & (F.abs(F.col("c") - F.col("t")) <= radius)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    ctx = a.join(other, on)
    ident = [*keys, "block_id", "anchor", "t"]
    stats = ctx.groupBy(*ident).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    # the context of one anchor is bounded by 2 * radius / hop values, so its median and MAD are taken from its array
    mid = lambda arr: (F.get(arr, F.floor((F.size(arr) - 1) / 2).cast("int")) + F.get(arr, F.floor(F.size(arr) / 2).cast("int"))) / 2.0
    stats = stats.withColumn("m", mid(F.col("xs"))).withColumn("ds", F.sort_array(F.transform("xs", lambda x: F.abs(x - F.col("m"))))).withColumn("mad", mid(F.col("ds")))
    stats = stats.select(*ident, F.size("xs").alias("n"), "m", "mad")
    whole = global_stats(frames.withColumn("_in", F.col("block_id") >= 0), keys, "value", "_in")
    full = anchors.alias("p").join(stats.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("block_id").alias("_block"), F.col("anchor").alias("_anchor"), "n", "m", "mad"), F.expr(" and ".join([f"p.{k} = _{k}" for k in keys] + ["p.block_id = _block", "p.anchor <=> _anchor"])), "left")
    full = full.select(*[F.col(f"p.{c}").alias(c) for c in ident], "n", "m", "mad").join(whole, keys)
    enough = F.coalesce(F.col("n"), F.lit(0)) * F.lit(float(hop)) >= min_context
    n = F.coalesce("n", F.lit(0)).alias("n")
    base = F.when(enough, F.col("m")).otherwise(F.col("center")).alias("baseline")
    scale = F.when(enough, F.greatest(F.col("mad") * MAD_SCALE, F.col("scale") * floor_frac)).otherwise(F.col("scale")).alias("scale")
    return full.select(*keys, "block_id", F.col("anchor").alias("frame_idx"), "t", n, base, scale)


def with_baseline(frames: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """Each interior frame with the baseline and scale of its own anchor, or of its block's."""
    per_block = anchors.filter("frame_idx is null").select(*keys, "block_id", F.col("baseline").alias("b1"), F.col("scale").alias("s1"))
    per_frame = anchors.filter("frame_idx is not null").select(*keys, F.col("frame_idx").cast("long").alias("_f"), F.col("baseline").alias("b2"), F.col("scale").alias("s2"))
    got = frames.join(per_block, [*keys, "block_id"], "left").withColumn("_f", F.col("frame_idx").cast("long")).join(per_frame, [*keys, "_f"], "left")
    return got.withColumn("center", F.coalesce("b2", "b1")).withColumn("scale", F.coalesce("s2", "s1")).drop("b1", "s1", "b2", "s2", "_f")


def moving_median(frames: DataFrame, keys: list[str], half: int, value: str = "value", valid: str | None = None, idx: str = "frame_idx") -> DataFrame:
    """Centred moving median over the valid frames of 2 * half + 1; null if there is none."""
    w = Window.partitionBy(*keys).orderBy(idx).rowsBetween(-half, half)
    x = null_nan(F.col(value)) if valid is None else F.when(F.col(valid), null_nan(F.col(value)))
    return frames.withColumn("moving_median", F.percentile(x, 0.5).over(w))


def rolling_mad(frames: DataFrame, keys: list[str], width: int, value: str = "value", idx: str = "frame_idx") -> DataFrame:
    """Rolling median and MAD of a centred window; an even width takes -w/2 .. w/2 - 1; null under w / 2 values."""
    w = Window.partitionBy(*keys).orderBy(idx).rowsBetween(-(width // 2), (width - 1) // 2)
    some = F.count(F.col(value)).over(w) >= width // 2
    got = frames.withColumn("_xs", F.collect_list(F.col(value)).over(w)).withColumn("rolling_median", F.when(some, F.percentile(F.col(value), 0.5).over(w)))
    ds = F.sort_array(F.transform("_xs", lambda x: F.abs(x - F.col("rolling_median"))))
    mid = (F.get(F.col("_ds"), F.floor((F.size("_ds") - 1) / 2).cast("int")) + F.get(F.col("_ds"), F.floor(F.size("_ds") / 2).cast("int"))) / 2.0
    return got.withColumn("_ds", ds).withColumn("rolling_mad", F.when(F.col("rolling_median").isNotNull(), mid)).drop("_xs", "_ds")
