"""Event detectors over scored frames: two-sided prominence, hysteresis regions and class support."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import null_nan
from . import intervals as iv


def first_max(value: Column, score: Column, order: Column) -> Column:
    """``value`` at the first largest ``score``."""
    return F.max_by(value, F.struct(score.alias("s"), (-order).alias("o")))


def prominence(frames: DataFrame, keys: list[str], seed: float | Column, ret: float, min_width: int, merge_gap: int, min_frames: int, z: str = "z", valid: str = "valid", idx: str = "frame_idx") -> DataFrame:
    """Two-sided prominence events: keys, direction, fs, fe, peak_frame, peak_z, n_children, children.

    Per sign, seeds are runs of at least ``min_width`` frames with z >= seed; an event extends to its island of valid frames
    with z >= ret (which holds the trace to both shoulders, as ret <= seed). Events of one track are merged in one list, ordered by
    (start, end, direction): neighbours of equal sign with a gap of at most ``merge_gap`` frames join unless an event of the
    other sign stands between. The peak is the first largest; ``min_frames`` is asked of what is left."""
    f = frames.select(*keys, F.col(idx).alias("i"), F.col(z).alias("z"), F.col(valid).alias("ok"), (seed if isinstance(seed, Column) else F.lit(float(seed))).alias("seed"))
    sides = f.withColumn("side", F.explode(F.array(F.lit("+"), F.lit("-")))).withColumn("s", F.when(F.col("side") == "+", F.col("z")).otherwise(-F.col("z")))
    low = sides.withColumn("low", F.col("ok") & (F.col("s") >= ret))
    islands = iv.island_ids(low, [*keys, "side"], "low", "i")
    span = Window.partitionBy(*keys, "side", "island")
    islands = islands.withColumn("fs", F.min("i").over(span)).withColumn("fe", F.max("i").over(span) + 1).withColumn("hot", F.col("s") >= F.col("seed"))
    seeds = _seed_runs(islands, keys)
    seeds = seeds.filter(F.col("se") - F.col("ss") >= min_width)
    order = Window.partitionBy(*keys).orderBy("fs", "fe", "side", "ss")
    turn = F.coalesce((F.col("side") != F.lag("side").over(order)).cast("int"), F.lit(0))
    seeds = seeds.withColumn("_t", turn).withColumn("stretch", F.sum("_t").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    grp = iv.merge_groups(seeds, [*keys, "side", "stretch"], "fs", "fe", merge_gap, ["ss"])
    out = grp.groupBy(*keys, "side", "stretch", "grp").agg(
        F.min("fs").alias("fs"), F.max("fe").alias("fe"), first_max(F.col("peak"), F.col("peak_z"), F.col("ss")).alias("peak_frame"), F.max("peak_z").alias("peak_z"),
        F.count(F.lit(1)).alias("n_children"), F.sort_array(F.collect_list(F.struct("ss", "se", "peak", "peak_z"))).alias("children"),
    )
    return out.filter(F.col("fe") - F.col("fs") >= min_frames).select(*keys, F.col("side").alias("direction"), "fs", "fe", "peak_frame", "peak_z", "n_children", "children")


def _seed_runs(islands: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys, "side", "fs").orderBy("i")
    hot = islands.drop("island").filter("hot").withColumn("run", F.col("i") - F.row_number().over(w))
    return hot.groupBy(*keys, "side", "fs", "fe", "run").agg(F.min("i").alias("ss"), (F.max("i") + 1).alias("se"), first_max(F.col("i"), F.col("s"), F.col("i")).alias("peak"), F.max("s").alias("peak_z")).drop("run")


def hysteresis_regions(frames: DataFrame, keys: list[str], seed: float, shoulder: float, max_gap_sec: float, hop: float, min_support: int, p: str = "p", idx: str = "frame_idx") -> DataFrame:
    """Regions [fs, fe): islands of p >= shoulder that hold a frame with p >= seed, joined over gaps of at most ``max_gap_sec``
    (compared in seconds, + 1e-12), then at least ``min_support`` frames."""
    f = frames.withColumn("_low", F.col(p) >= shoulder)
    got = iv.runs(f, keys, "_low", idx, [F.max(p).alias("top")]).filter(F.col("top") >= seed)
    w = Window.partitionBy(*keys).orderBy("fs", "fe")
    before = F.max("fe").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | ((F.col("fs") - before) * F.lit(float(hop)) > F.lit(max_gap_sec + 1e-12)), 1).otherwise(0)
    grp = got.withColumn("_n", new).withColumn("grp", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grp.groupBy(*keys, "grp").agg(F.min("fs").alias("fs"), F.max("fe").alias("fe")).drop("grp").filter(F.col("fe") - F.col("fs") >= min_support)


def in_ranges(frames: DataFrame, ranges: DataFrame, keys: list[str], idx: str = "frame_idx", bucket: int = 256) -> DataFrame:
    """Frames joined to the frame ranges [fs, fe) that hold them, as an equi-join on buckets of frames."""
    r = ranges.withColumn("_b", F.explode(F.sequence(F.floor(F.col("fs") / bucket), F.floor((F.col("fe") - 1) / bucket))))
    f = frames.withColumn("_b", F.floor(F.col(idx) / bucket))
    return f.join(r, [*keys, "_b"]).filter((F.col(idx) >= F.col("fs")) & (F.col(idx) < F.col("fe"))).drop("_b")


def class_support(frames: DataFrame, keys: list[str], thresholds: DataFrame, event_labels: tuple[str, ...], channels: tuple[str, ...], background: tuple[str, ...], margin: float, values: str = "values", valid: str = "valid", idx: str = "frame_idx") -> DataFrame:
    """keys, frame_idx, label, p, valid, support for every event label: support asks that the label is the first top class, that p
    reaches its threshold, and that it leads the best background class by ``margin``. The thresholds (keys, label, threshold) are
    one row per track and label."""
    v = F.col(values)
    top = F.array_position(v, F.array_max(v)) - 1
    back = F.array_max(F.array(*[F.get(v, channels.index(b)) for b in background]))
    rows = frames.select(*keys, F.col(idx).alias("frame_idx"), F.col(valid).alias("valid"), top.alias("top"), back.alias("background_p"), F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.lit(channels.index(x)).alias("channel"), F.get(v, channels.index(x)).alias("p")) for x in event_labels])).alias("c"))
    rows = rows.select(*keys, "frame_idx", "valid", "top", "background_p", "c.label", "c.channel", "c.p").join(thresholds, [*keys, "label"])
    test = (F.col("top") == F.col("channel")) & (null_nan(F.col("p")) >= F.col("threshold")) & (F.col("p") - null_nan(F.col("background_p")) >= margin)
    return rows.withColumn("support", F.col("valid") & F.coalesce(test, F.lit(False)))


def class_candidates(support: DataFrame, keys: list[str], max_gap: int, min_frames: int) -> DataFrame:
    """Closed runs of support with at least ``min_frames`` frames; peak and mean are over raw support frames only."""
    closed = iv.closing(support, [*keys, "label"], "valid", "support", max_gap).filter(F.col("fe") - F.col("fs") >= min_frames)
    got = in_ranges(support.filter("support").select(*keys, "label", "frame_idx", "p", "background_p"), closed, [*keys, "label"])
    return got.groupBy(*keys, "label", "fs", "fe", "raw_frames", "bridge_frames").agg(
        first_max(F.col("frame_idx"), F.col("p"), F.col("frame_idx")).alias("peak_frame"), F.max("p").alias("peak_p"), F.avg("p").alias("mean_p"),
        first_max(F.col("p") - F.col("background_p"), F.col("p"), F.col("frame_idx")).alias("margin_at_peak"),
    )
