"""Occupancy, sweeps, distribution statistics and waveform envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals as iv


def occupancy(probs: DataFrame, keys: list[str], thresholds: DataFrame | None = None, p: str = "p") -> DataFrame:
    """Per class: n, mean, p50, p90, p95, p99, max, share of frames as top class, share at or above its threshold.
    probs: keys + label, p, is_top."""
    rows = probs if thresholds is None else probs.join(thresholds, [*keys, "label"])
    q = F.percentile(F.col(p), F.array(*[F.lit(x) for x in (0.5, 0.9, 0.95, 0.99)]))
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean"), q.alias("q"), F.max(p).alias("max"), F.avg(F.col("is_top").cast("double")).alias("top1_share")]
    if thresholds is not None:
        aggs.append(F.avg((F.col(p) >= F.col("threshold")).cast("double")).alias("above_share"))
    got = rows.groupBy(*keys, "label").agg(*aggs)
    return got.select(*keys, "label", "n", "mean", *[F.col("q")[i].alias(f"p{x}") for i, x in enumerate((50, 90, 95, 99))], "max", "top1_share", *(["above_share"] if thresholds is not None else []))


def thresholds(probs: DataFrame, keys: list[str], absolute: float, quantile: float, valid: str = "valid", p: str = "p") -> DataFrame:
    """Per class the larger of an absolute threshold and a quantile (linear interpolation) over valid frames."""
    got = probs.groupBy(*keys, "label").agg(F.percentile(F.when(F.col(valid), F.col(p)), quantile).alias("q"))
    return got.select(*keys, "label", F.greatest(F.lit(float(absolute)), F.coalesce("q", F.lit(float(absolute)))).alias("threshold"))


def describe(rows: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """n, min, p5, median, p95, max, mean, population standard deviation, MAD."""
    mid = rows.groupBy(*keys).agg(F.percentile(value, 0.5).alias("median"))
    got = rows.join(mid, keys).groupBy(*keys, "median").agg(
        F.count(value).alias("n"), F.min(value).alias("min"), F.percentile(value, 0.05).alias("p5"), F.percentile(value, 0.95).alias("p95"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.percentile(F.abs(F.col(value) - F.col("median")), 0.5).alias("mad"),
    )
    return got


def gap_stats(intervals: DataFrame, keys: list[str], start: str = "start_sec", end: str = "end_sec") -> DataFrame:
    """Durations and gaps to the next interval: counts, medians, p90, maxima."""
    w = Window.partitionBy(*keys).orderBy(start)
    rows = intervals.withColumn("gap", F.lead(start).over(w) - F.col(end)).withColumn("dur", F.col(end) - F.col(start))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}_{n}") for c in ("dur", "gap") for n, f in (("median", lambda x: F.percentile(x, 0.5)), ("p90", lambda x: F.percentile(x, 0.9)), ("max", F.max))])


def correlation_pairs(frames: DataFrame, keys: list[str], track: str = "track_id", idx: str = "frame_idx", value: str = "value") -> DataFrame:
    """Pearson correlation of every two tracks over the frames both have: one self-join on the frame."""
    a = frames.select(*keys, F.col(idx).alias("_i"), F.col(track).alias("track_a"), F.col(value).alias("va"))
    b = frames.select(*keys, F.col(idx).alias("_i"), F.col(track).alias("track_b"), F.col(value).alias("vb"))
    return a.join(b, [*keys, "_i"]).filter("track_a < track_b").groupBy(*keys, "track_a", "track_b").agg(F.corr("va", "vb").alias("r"), F.count(F.lit(1)).alias("n"))


def autocorrelation(frames: DataFrame, keys: list[str], lags: list[int], value: str = "value", idx: str = "frame_idx") -> DataFrame:
    """At each lag the mean product of centred values over the n - lag pairs, by the population variance."""
    whole, w = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(idx)
    x = frames.withColumn("d", F.col(value) - F.avg(value).over(whole))
    x = x.select(*keys, "d", *[F.lead("d", lag).over(w).alias(f"l{lag}") for lag in lags])
    got = x.groupBy(*keys).agg(F.avg(F.col("d") * F.col("d")).alias("var"), *[F.avg(F.col("d") * F.col(f"l{lag}")).alias(f"c{lag}") for lag in lags])
    return got.select(*keys, F.explode(F.array(*[F.struct(F.lit(lag).alias("lag"), F.try_divide(F.col(f"c{lag}"), F.col("var")).alias("acf")) for lag in lags])).alias("s")).select(*keys, "s.lag", "s.acf")


def chunk_stats(frames: DataFrame, keys: list[str], chunks: int = 6, value: str = "value", idx: str = "frame_idx") -> DataFrame:
    """Equal chunks by position, the last takes the remainder: n, mean, population standard deviation."""
    w = Window.partitionBy(*keys)
    rows = frames.withColumn("_p", F.row_number().over(w.orderBy(idx)) - 1).withColumn("_size", F.greatest(F.floor(F.count(F.lit(1)).over(w) / chunks), F.lit(1)))
    return rows.withColumn("chunk", F.least(F.floor(F.col("_p") / F.col("_size")), F.lit(chunks - 1)).cast("int")).groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def histogram(rows: DataFrame, keys: list[str], bins: int, value: str = "value") -> DataFrame:
    """Counts of equal bins from the least to the largest value of each key; the last bin holds the largest, and a single value is
    in bin 0. Every row with a value counts."""
    span = rows.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(F.least(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    return rows.filter(F.col(value).isNotNull()).join(span, keys).groupBy(*keys, at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def envelope(samples: DataFrame, keys: list[str], n_peaks: int, idx: str = "i", value: str = "value") -> DataFrame:
    """Min and max per bin of max(1, n // n_peaks) samples; a last partial bin is filled with zeros."""
    w = Window.partitionBy(*keys)
    size = F.greatest(F.lit(1), F.floor(F.col("_n") / n_peaks))
    rows = samples.withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_size", size).withColumn("bin", F.floor(F.col(idx) / F.col("_size")).cast("int"))
    got = rows.groupBy(*keys, "bin", "_size").agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("n"))
    part = F.col("n") < F.col("_size")
    return got.select(*keys, "bin", F.when(part, F.least("lo", F.lit(0.0))).otherwise(F.col("lo")).alias("lo"), F.when(part, F.greatest("hi", F.lit(0.0))).otherwise(F.col("hi")).alias("hi"))


def sweep(frames: DataFrame, keys: list[str], grid: list[float], hop: float, value: str = "z", idx: str = "frame_idx") -> DataFrame:
    """Runs of value >= threshold for every threshold of a grid, in one plan: count, total and median duration."""
    rows = frames.withColumn("threshold", F.explode(F.array(*[F.lit(float(g)) for g in grid]))).withColumn("_on", F.col(value) >= F.col("threshold"))
    got = iv.runs(rows, [*keys, "threshold"], "_on", idx).withColumn("dur", (F.col("fe") - F.col("fs")) * F.lit(float(hop)))
    return got.groupBy(*keys, "threshold").agg(F.count(F.lit(1)).alias("n_events"), F.sum("dur").alias("total_sec"), F.percentile("dur", 0.5).alias("median_sec"))


def pool(frames: DataFrame, keys: list[str], value: Column, weight: Column | None = None, mask: Column | None = None) -> DataFrame:
    """Clip-level max, mean (over unmasked frames) and softmax-attention mean."""
    v = value if mask is None else F.when(mask, value)
    aggs = [F.max(v).alias("pool_max"), F.avg(v).alias("pool_mean")]
    if weight is not None:
        aggs.append((F.sum(F.exp(weight) * v) / F.sum(F.when(v.isNotNull(), F.exp(weight)))).alias("pool_attention"))
    return frames.groupBy(*keys).agg(*aggs)


def mix_layers(samples: DataFrame, keys: list[str], weights: DataFrame, level: float = 0.95, idx: str = "i", value: str = "value") -> DataFrame:
    """Weighted sum of layers by sample index, scaled to a peak of ``level``."""
    mixed = samples.join(weights, "layer").groupBy(*keys, idx).agg(F.sum(F.col(value) * F.col("weight")).alias("mixed"))
    peak = F.max(F.abs("mixed")).over(Window.partitionBy(*keys))
    return mixed.withColumn("mixed", F.when(peak > 0, F.col("mixed") / peak * level).otherwise(F.col("mixed")))


def nearest_code(vectors: DataFrame, codes: DataFrame, vec: str = "vec", code_id: str = "code_id", code: str = "code") -> DataFrame:
    """Index and squared distance of the nearest code of L2-normalised vectors; ties go to the lower id. The codebook is a model of
    fixed size (its rows are collected into one array literal's row and broadcast)."""

    def unit(a: Column) -> Column:
        norm = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))
        return F.transform(a, lambda x: x / F.greatest(norm, F.lit(1e-12)))

    book = codes.select(F.struct(F.col(code_id).alias("id"), unit(F.col(code)).alias("u")).alias("c")).agg(F.sort_array(F.collect_list("c")).alias("book"))
    rows = vectors.withColumn("_u", unit(F.col(vec))).join(F.broadcast(book))
    dist = lambda c: F.aggregate(F.zip_with(F.col("_u"), c["u"], lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    best = F.array_min(F.transform("book", lambda c: F.struct(dist(c).alias("d"), c["id"].alias("id"))))
    return rows.withColumn("_b", best).withColumn("code", F.col("_b")["id"]).withColumn("distance", F.col("_b")["d"]).drop("_u", "_b", "book")


def kmeans(vectors: DataFrame, codes: DataFrame, rounds: int = 10, vec: str = "vec", dims: int = 0) -> DataFrame:
    """Lloyd's rounds from given centres (code_id, code); an empty cluster keeps its centre. Centres are a model of fixed size:
    they go through the driver each round, the vectors never do."""
    spark = vectors.sparkSession
    schema = codes.schema
    centres = {r[0]: list(r[1]) for r in codes.collect()}
    for _ in range(rounds):
        book = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in centres.items()], schema)
        rows = vectors.join(F.broadcast(book.agg(F.sort_array(F.collect_list(F.struct(F.col("code_id").alias("id"), F.col("code").alias("u")))).alias("book"))))
        dist = lambda c: F.aggregate(F.zip_with(F.col(vec), c["u"], lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
        near = rows.select(vec, F.array_min(F.transform("book", lambda c: F.struct(dist(c).alias("d"), c["id"].alias("id"))))["id"].alias("id"))
        size = dims or len(next(iter(centres.values())))
        new = near.groupBy("id").agg(F.array(*[F.avg(F.col(vec)[i]) for i in range(size)]).alias("code")).collect()
        centres |= {r["id"]: r["code"] for r in new}
    return spark.createDataFrame([(k, [float(x) for x in v]) for k, v in centres.items()], schema)
