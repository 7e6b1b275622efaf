"""Grid changes: upsampling, padding, masks, standardising, point-in-time lookups, view ranges, batch mixing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsample(frames: DataFrame, ratio: int, idx: str = "frame_idx") -> DataFrame:
    """Each frame ``ratio`` times (nearest)."""
    return frames.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(ratio - 1)))).withColumn(idx, (F.col(idx) * ratio + F.col("_k")).cast("int")).drop("_k")


def pad_last(frames: DataFrame, keys: list[str], n: int, value: str = "value", idx: str = "frame_idx") -> DataFrame:
    """Frames 0 .. n - 1 of every track; missing ones repeat the last value before them."""
    full = frames.select(*keys).distinct().withColumn(idx, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    w = Window.partitionBy(*keys).orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    return full.join(frames.select(*keys, idx, value), [*keys, idx], "left").withColumn(value, F.last(value, ignorenulls=True).over(w))


def mask_down(frames: DataFrame, keys: list[str], k: int, mask: str = "masked", idx: str = "frame_idx") -> DataFrame:
    """A coarse frame is masked if all its ``k`` fine frames are."""
    return frames.groupBy(*keys, F.floor(F.col(idx) / k).cast("int").alias(idx)).agg(F.bool_and(mask).alias(mask))


def standardise(x: Column, mean: float, std: float) -> Column:
    return (x - F.lit(float(mean))) / F.lit(float(std))


def active_at(frames: DataFrame, keys: list[str], second: float, hop: float, flags: list[str], idx: str = "frame_idx") -> DataFrame:
    """The flags set in the frame at a time; times beyond the grid mean its first or last frame."""
    w = Window.partitionBy(*keys)
    at = F.greatest(F.lit(0), F.least(F.floor(F.lit(float(second)) / hop), F.max(idx).over(w)))
    row = frames.withColumn("_at", at).filter(F.col(idx) == F.col("_at"))
    names = F.array_compact(F.array(*[F.when(F.col(f) == 1, F.lit(f)) for f in flags]))
    return row.select(*keys, F.concat_ws(",", names).alias("active"))


def view_range(frames: DataFrame, keys: list[str], lo: int, hi: int, value: str = "value", idx: str = "frame_idx", margin: float = 0.15, least: float = 0.02) -> DataFrame:
    """y range of a view [lo, hi): finite values with a margin of a share of their span, ``least`` at least."""
    x = F.when(~F.isnan(F.col(value)) & (F.abs(F.col(value)) != float("inf")), F.col(value))
    got = frames.filter((F.col(idx) >= lo) & (F.col(idx) < hi)).groupBy(*keys).agg(F.min(x).alias("a"), F.max(x).alias("b"))
    pad = F.greatest((F.col("b") - F.col("a")) * margin, F.lit(float(least)))
    return got.select(*keys, (F.col("a") - pad).alias("y_lo"), (F.col("b") + pad).alias("y_hi"))


def mix_pairs(rows: DataFrame, idx: str, value: str, weight: float) -> DataFrame:
    """Even and odd rows of a batch mixed by weight: one row per pair."""
    pair = F.floor(F.col(idx) / 2)
    w = F.when(F.col(idx) % 2 == 0, F.lit(weight)).otherwise(F.lit(1.0 - weight))
    return rows.groupBy(pair.cast("long").alias("pair")).agg(F.sum(F.col(value) * w).alias("mixed"))


def moments_at(frames: DataFrame, weights: DataFrame, keys: list[str], layer: str = "layer", value: str = "value", weight: str = "logit") -> DataFrame:
    """Sum over layers with softmax weights."""
    top = weights.agg(F.max(weight)).first()[0] or 0.0
    e = weights.select(layer, F.exp(F.col(weight) - F.lit(float(top))).alias("_e"))
    total = e.agg(F.sum("_e")).first()[0] or 1.0
    return frames.join(e, layer).groupBy(*keys).agg((F.sum(F.col(value) * F.col("_e")) / F.lit(float(total))).alias("mixed"))
