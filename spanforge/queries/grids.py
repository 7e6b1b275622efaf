"""Grid changes, conflicts and view queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import activations as act
from ..operators import grids, intervals
from ..registry import query
from .signals import GD, HOURS, Z, G, dense, events_of, events_sql, grid, scored


@query("upsample_nearest", f"WITH {G} SELECT track_id, CAST(f*3+k AS INT) AS frame_idx, v AS value FROM g, (VALUES (0),(1),(2)) t(k)")
def upsample_nearest(spark, sf):
    return grids.upsample(grid(spark, sf).select("track_id", "frame_idx", "value"), 3)


@query("pad_repeat_last", f"WITH {GD} SELECT track_id, f AS frame_idx, last_value(v IGNORE NULLS) OVER (PARTITION BY track_id ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM gd")
def pad_repeat_last(spark, sf):
    return grids.pad_last(grid(spark, sf).select("track_id", "frame_idx", "value"), ["track_id"], HOURS)


@query("padding_mask", f"WITH {GD} SELECT track_id, f//4 AS frame_idx, bool_and(v IS NULL) AS masked FROM gd GROUP BY ALL")
def padding_mask(spark, sf):
    return grids.mask_down(dense(spark, sf).withColumn("masked", F.col("value").isNull()), ["track_id"], 4)


@query("view_range", f"WITH {G} SELECT track_id, round(min(v)-greatest((max(v)-min(v))*0.15,0.02),6) AS y_lo, round(max(v)+greatest((max(v)-min(v))*0.15,0.02),6) AS y_hi FROM g WHERE f >= 100 AND f < 200 GROUP BY 1")
def view_range(spark, sf):
    return grids.view_range(grid(spark, sf), ["track_id"], 100, 200).select("track_id", F.round("y_lo", 6).alias("y_lo"), F.round("y_hi", 6).alias("y_hi"))


@query("standardised", f"WITH {G} SELECT track_id, f AS frame_idx, round((v-15.41663)/(2*6.55582),6) AS value FROM g")
def standardised(spark, sf):
    return grid(spark, sf).select("track_id", "frame_idx", F.round(grids.standardise(F.col("value"), 15.41663, 2 * 6.55582), 6).alias("value"))


@query("mixup_pairs", "WITH x AS (SELECT event_id AS i, round(value,6) AS v FROM events) SELECT i//2 AS pair, round(sum(v*CASE WHEN i%2=0 THEN 0.7 ELSE 0.3 END),4) AS mixed FROM x GROUP BY 1")
def mixup_pairs(spark, sf):
    """All rows, paired by their numbers: no window is needed."""
    rows = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("i"), F.round("value", 6).alias("v"))
    return grids.mix_pairs(rows, "i", "v", 0.7).select("pair", F.round("mixed", 4).alias("mixed"))


def _spans(spark, sf):
    return events_of(spark, sf).select("track_id", "direction", F.col("fs").cast("double").alias("s"), F.col("fe").cast("double").alias("e"))


@query("conflicting_events", f"WITH {Z}, {events_sql()} SELECT a.track_id, a.fs::DOUBLE AS s, a.fe::DOUBLE AS e FROM ev a WHERE a.direction='+' AND EXISTS (SELECT 1 FROM ev b WHERE b.track_id='error' AND a.track_id <> 'error' AND a.fs < b.fe AND b.fs < a.fe)")
def conflicting_events(spark, sf):
    """Strict overlap as a semi-join."""
    ev = _spans(spark, sf)
    a = ev.filter("direction = '+' and track_id <> 'error'").select(F.lit("all").alias("k"), "track_id", F.col("s").alias("a0"), F.col("e").alias("a1"))
    b = ev.filter("track_id = 'error'").select(F.lit("all").alias("k"), F.col("s").alias("b0"), F.col("e").alias("b1"))
    got = intervals.overlap_join(a, b, ["k"], 64.0, "left_semi", (F.col("a0") < F.col("b1")) & (F.col("b0") < F.col("a1")))
    return got.select("track_id", F.col("a0").alias("s"), F.col("a1").alias("e"))


@query("active_at_time", f"WITH {Z}, {events_sql()}, t AS (SELECT DISTINCT track_id FROM g) SELECT t.track_id, coalesce((SELECT string_agg(DISTINCT CASE direction WHEN '+' THEN 'up' ELSE 'down' END, ',' ORDER BY CASE direction WHEN '+' THEN 'up' ELSE 'down' END DESC) FROM ev WHERE ev.track_id=t.track_id AND fs <= 333 AND fe > 333),'') AS active FROM t")
def active_at_time(spark, sf):
    frames = dense(spark, sf).select("track_id", "frame_idx")
    out = frames
    for name, sign in (("up", "+"), ("down", "-")):
        part = _spans(spark, sf).filter(F.col("direction") == sign).select("track_id", F.col("s").alias("start_sec"), F.col("e").alias("end_sec"))
        out = out.join(intervals.paint(frames, part, ["track_id"], 1.0).withColumnRenamed("painted", name), ["track_id", "frame_idx"])
    return grids.active_at(out, ["track_id"], 333.0, 1.0, ["up", "down"])


@query("layer_mix", f"WITH {Z} SELECT f AS frame_idx, round(sum(z*CASE track_id WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0.5 END),5) AS mixed FROM z GROUP BY 1")
def layer_mix(spark, sf):
    z = scored(spark, sf).select(F.col("track_id").alias("layer"), "frame_idx", "z")
    w = F.when(F.col("layer") == "click", 2.0).when(F.col("layer") == "view", 1.0).otherwise(0.5)
    return z.groupBy("frame_idx").agg(F.round(F.sum(F.col("z") * w), 5).alias("mixed"))


@query("fade_envelope", "WITH s AS (SELECT user_id, list(round(value,4) ORDER BY event_id) AS l FROM events GROUP BY 1), x AS (SELECT user_id, unnest(l) AS v, unnest(range(0,len(l))) AS i, len(l) AS n FROM s) SELECT user_id, round(sum(v*least(1, (i+1)/10.0, (n-i)/10.0)),3) AS total FROM x GROUP BY 1")
def fade_envelope(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", F.round("value", 4).alias("v")))), lambda s: s["v"]).alias("l"))
    return e.select("user_id", F.round(act.total(act.fade(F.col("l"), 10)), 3).alias("total"))


