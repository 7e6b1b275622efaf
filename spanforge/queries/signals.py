"""Signal grids, activity intervals, robust statistics, deviation events and their summaries (from ``events``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import activations as act
from ..operators import detect, fuse, robust, summarize
from ..operators import intervals as iv
from ..registry import query

SEED, RETURN, GAP, MIN_FRAMES, HOURS = 1.5, 0.5, 2, 2, 720
KEY = ["track_id"]


def grid(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly cells: track_id, frame_idx, value (mean, 6 decimals), n."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    hour = F.timestamp_diff("HOUR", F.expr("timestamp_ntz'2024-01-01 00:00:00'"), F.col("ts")).cast("int")
    return events.groupBy(F.col("event_type").alias("track_id"), hour.alias("frame_idx")).agg(F.round(F.avg("value"), 6).alias("value"), F.count(F.lit(1)).alias("n"))


def dense(spark: SparkSession, sf: str) -> DataFrame:
    g = grid(spark, sf)
    cells = g.select("track_id").distinct().withColumn("frame_idx", F.explode(F.sequence(F.lit(0), F.lit(HOURS - 1))))
    return cells.join(g.select("track_id", "frame_idx", "value"), ["track_id", "frame_idx"], "left")


def activity(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of busy hours: at least the mean count, gaps of up to 1 h bridged, 2 h at least."""
    per = grid(spark, sf).groupBy("frame_idx").agg(F.sum("n").alias("n")).withColumn("recording_id", F.lit("all"))
    mean = per.groupBy("recording_id").agg(F.avg("n").alias("mean"))
    busy = per.join(mean, "recording_id").withColumn("busy", F.col("n") >= F.col("mean"))
    runs = iv.runs(busy, ["recording_id"], "busy").select("recording_id", F.col("fs").cast("double").alias("start_sec"), F.col("fe").cast("double").alias("end_sec"))
    return iv.merge(runs, ["recording_id"], "start_sec", "end_sec", 1.0, 2.0)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    g = grid(spark, sf)
    return robust.zscores(g, robust.global_stats(g, KEY), KEY).withColumn("valid", F.lit(True))


def events_of(spark: SparkSession, sf: str, seed: float = SEED) -> DataFrame:
    return detect.prominence(scored(spark, sf), KEY, seed, RETURN, 1, GAP, MIN_FRAMES)


G = "g AS (SELECT event_type AS track_id, CAST((epoch_us(ts)//3600000000)-473352 AS INT) AS f, round(avg(value),6) AS v, count(*) AS n FROM events GROUP BY ALL)"
GD = f"{G}, gd AS (SELECT c.track_id, c.f, g.v FROM (SELECT track_id, CAST(unnest(range(0,{HOURS})) AS INT) AS f FROM (SELECT DISTINCT track_id FROM g)) c LEFT JOIN g USING (track_id, f))"
K = f"""{G}, h AS (SELECT f, sum(n) AS n FROM g GROUP BY f), b AS (SELECT f, f - row_number() OVER (ORDER BY f) AS i FROM h WHERE n >= (SELECT avg(n) FROM h)),
r AS (SELECT min(f)::DOUBLE AS s, max(f)+1::DOUBLE AS e FROM b GROUP BY i), r2 AS (SELECT *, max(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM r),
r3 AS (SELECT *, sum(CASE WHEN pe IS NULL OR s-pe > 1 THEN 1 ELSE 0 END) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM r2),
k AS (SELECT *, row_number() OVER (ORDER BY s)-1 AS block_id FROM (SELECT min(s) AS s, max(e) AS e FROM r3 GROUP BY grp) WHERE e-s >= 2)"""
Z = f"""{G}, m0 AS (SELECT track_id, quantile_cont(v,0.5) AS m FROM g GROUP BY 1), st AS (SELECT track_id, m, greatest(coalesce(1.4826*quantile_cont(abs(v-m),0.5),1e-9),1e-9) AS sc FROM g JOIN m0 USING (track_id) GROUP BY ALL),
z AS (SELECT track_id, f, (v-m)/sc AS z FROM g JOIN st USING (track_id))"""


def events_sql(seed: float = SEED, name: str = "ev") -> str:
    p = name
    return f"""{p}side AS (SELECT track_id, f, d, CASE WHEN d='+' THEN z ELSE -z END AS sz FROM z, (VALUES ('+'),('-')) t(d)),
{p}low AS (SELECT *, f - row_number() OVER (PARTITION BY track_id, d ORDER BY f) AS i FROM {p}side WHERE sz >= {RETURN}::DOUBLE),
{p}isl AS (SELECT *, min(f) OVER (PARTITION BY track_id, d, i) AS fs, max(f) OVER (PARTITION BY track_id, d, i)+1 AS fe FROM {p}low),
{p}hot AS (SELECT *, f - row_number() OVER (PARTITION BY track_id, d, fs ORDER BY f) AS run FROM {p}isl WHERE sz >= {seed}::DOUBLE),
{p}seed AS (SELECT track_id, d, fs, fe, run, min(f) AS ss, (list(f ORDER BY sz DESC, f))[1] AS pk, max(sz) AS pz FROM {p}hot GROUP BY ALL),
{p}turn AS (SELECT *, CASE WHEN d <> lag(d) OVER (PARTITION BY track_id ORDER BY fs, fe, d, ss) THEN 1 ELSE 0 END AS t FROM {p}seed),
{p}str AS (SELECT *, sum(t) OVER (PARTITION BY track_id ORDER BY fs, fe, d, ss ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st FROM {p}turn),
{p}pe AS (SELECT *, max(fe) OVER (PARTITION BY track_id, d, st ORDER BY fs, fe, ss ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM {p}str),
{p}grp AS (SELECT *, sum(CASE WHEN pe IS NULL OR fs-pe > {GAP} THEN 1 ELSE 0 END) OVER (PARTITION BY track_id, d, st ORDER BY fs, fe, ss ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM {p}pe),
{p} AS (SELECT track_id, d AS direction, min(fs) AS fs, max(fe) AS fe, (list(pk ORDER BY pz DESC, ss))[1] AS peak_frame, max(pz) AS peak_z, count(*) AS n_children FROM {p}grp GROUP BY track_id, d, st, grp HAVING max(fe)-min(fs) >= {MIN_FRAMES})"""


@query("hourly_grid", f"WITH {G} SELECT track_id, f AS frame_idx, v AS value, n FROM g")
def hourly_grid(spark, sf):
    return grid(spark, sf)


@query("activity_blocks", f"WITH {K} SELECT block_id, s AS start_sec, e AS end_sec FROM k")
def activity_blocks(spark, sf):
    return activity(spark, sf).select(F.col("block_id").cast("long").alias("block_id"), "start_sec", "end_sec")


@query("interior_frames", f"WITH {K}, fr AS (SELECT CAST(unnest(range(0,{HOURS})) AS INT) AS f) SELECT fr.f AS frame_idx, coalesce(max(k.block_id),-1) AS block_id FROM fr LEFT JOIN k ON fr.f >= k.s AND fr.f+1 <= k.e GROUP BY fr.f")
def interior_frames(spark, sf):
    frames = spark.range(HOURS).select(F.lit("all").alias("recording_id"), F.col("id").cast("int").alias("frame_idx"))
    return iv.assign_blocks(frames, activity(spark, sf), ["recording_id"], 1.0, 1.0).select("frame_idx", F.col("block_id").cast("long").alias("block_id"))


@query("speech_coverage", f"WITH {K}, fr AS (SELECT CAST(unnest(range(0,{HOURS})) AS INT) AS f) SELECT fr.f AS frame_idx, round(coalesce(sum(greatest(0, least(f+3.5, e)-greatest(f, s))) FILTER (WHERE s IS NOT NULL),0)/3.5::DOUBLE, 6) AS coverage, coalesce(sum(greatest(0, least(f+3.5, e)-greatest(f, s))) FILTER (WHERE s IS NOT NULL),0)/3.5::DOUBLE >= 0.6 AS usable FROM fr LEFT JOIN k ON f <= e AND f+3.5 >= s GROUP BY f")
def speech_coverage(spark, sf):
    frames = spark.range(HOURS).select(F.lit("all").alias("recording_id"), F.col("id").cast("int").alias("frame_idx"))
    got = iv.coverage(frames, activity(spark, sf), ["recording_id"], 1.0, 3.5)
    return got.select("frame_idx", F.round("coverage", 6).alias("coverage"), (F.col("coverage") >= 0.6).alias("usable"))


@query("center_speech_mask", f"WITH {K}, fr AS (SELECT CAST(unnest(range(0,{HOURS})) AS INT) AS f) SELECT f AS frame_idx, count(k.s) > 0 AS valid FROM fr LEFT JOIN k ON k.s < f+1.5+0.5 AND k.e > f+1.5-0.5 GROUP BY f")
def center_speech_mask(spark, sf):
    frames = spark.range(HOURS).select(F.lit("all").alias("recording_id"), F.col("id").cast("int").alias("frame_idx"))
    return iv.center_mask(frames, activity(spark, sf), ["recording_id"], 1.0, 3.0).select("frame_idx", "valid")


@query("global_robust_stats", f"WITH {Z} SELECT track_id, round(m,6) AS center, round(sc,6) AS scale FROM st")
def global_robust_stats(spark, sf):
    return robust.global_stats(grid(spark, sf), KEY).select("track_id", F.round("center", 6).alias("center"), F.round("scale", 6).alias("scale"))


@query(
    "neighbour_baseline",
    f"""WITH {K}, fb AS (SELECT g.track_id, g.f, g.v, k.block_id FROM g JOIN k ON g.f >= k.s AND g.f+1 <= k.e),
tk AS (SELECT DISTINCT track_id FROM g),
an AS (SELECT track_id, block_id, NULL::BIGINT AS frame_idx, (s+e)/2 AS t FROM tk, k WHERE e-s <= 6 UNION ALL SELECT fb.track_id, fb.block_id, fb.f, fb.f+0.5 FROM fb JOIN k USING (block_id) WHERE e-s > 6),
cx AS (SELECT a.track_id, a.block_id, a.frame_idx, a.t, x.v FROM an a JOIN fb x ON x.track_id=a.track_id AND x.block_id<>a.block_id AND abs(x.f+0.5-a.t) <= 6),
c1 AS (SELECT track_id, block_id, frame_idx, t, count(*) AS n, quantile_cont(v,0.5) AS m FROM cx GROUP BY ALL),
c2 AS (SELECT cx.track_id, cx.block_id, cx.t, quantile_cont(abs(cx.v-c1.m),0.5) AS mad FROM cx JOIN c1 ON cx.track_id=c1.track_id AND cx.block_id=c1.block_id AND cx.t=c1.t GROUP BY ALL),
g1 AS (SELECT track_id, quantile_cont(v,0.5) AS gm FROM fb GROUP BY 1), g2 AS (SELECT track_id, gm, greatest(1.4826*quantile_cont(abs(v-gm),0.5),1e-9) AS gs FROM fb JOIN g1 USING (track_id) GROUP BY ALL)
SELECT an.track_id, an.block_id, an.frame_idx, an.t, coalesce(n,0) AS n, round(CASE WHEN coalesce(n,0) >= 3 THEN m ELSE gm END,6) AS baseline, round(CASE WHEN coalesce(n,0) >= 3 THEN greatest(1.4826*mad, gs*0.5) ELSE gs END,6) AS scale
FROM an LEFT JOIN c1 ON an.track_id=c1.track_id AND an.block_id=c1.block_id AND an.t=c1.t LEFT JOIN c2 ON an.track_id=c2.track_id AND an.block_id=c2.block_id AND an.t=c2.t JOIN g2 ON an.track_id=g2.track_id""",
)
def neighbour_baseline(spark, sf):
    frames = grid(spark, sf).select(F.lit("all").alias("recording_id"), "track_id", "frame_idx", "value")
    blocks = activity(spark, sf)
    placed = iv.assign_blocks(frames, blocks, ["recording_id"], 1.0, 1.0)
    per = frames.select("recording_id", "track_id").distinct().join(blocks, "recording_id")
    got = robust.neighbour_baseline(placed, per, ["recording_id", "track_id"], 1.0, 1.0, 6.0, 3.0, 0.5)
    return got.select("track_id", F.col("block_id").cast("long").alias("block_id"), "frame_idx", "t", F.col("n").cast("long").alias("n"), F.round("baseline", 6).alias("baseline"), F.round("scale", 6).alias("scale"))


_EV = "track_id, direction, fs, fe, peak_frame, round(peak_z,6) AS peak_z, n_children"


@query("prominence_events", f"WITH {Z}, {events_sql()} SELECT {_EV} FROM ev")
def prominence_events(spark, sf):
    """Flagship: two-sided prominence events of every event type's hourly signal."""
    return events_of(spark, sf).select("track_id", "direction", "fs", "fe", "peak_frame", F.round("peak_z", 6).alias("peak_z"), "n_children")


@query("event_neighbours", f"WITH {Z}, {events_sql()} SELECT ev.track_id, ev.fs, ev.fe, ev.direction, round(a.z,6) AS before_z, round(b.z,6) AS after_z, printf('affect.default.deviation.%06d', row_number() OVER (ORDER BY ev.track_id, ev.fs, ev.fe, ev.direction)-1) AS event_id FROM ev LEFT JOIN z a ON a.track_id=ev.track_id AND a.f=ev.fs-1 LEFT JOIN z b ON b.track_id=ev.track_id AND b.f=ev.fe")
def event_neighbours(spark, sf):
    """z just outside each event, and numbered ids."""
    ev = fuse.number_events(events_of(spark, sf).withColumn("recording_id", F.lit("all")), ["recording_id"], ["track_id", "fs", "fe", "direction"])
    z = scored(spark, sf).select("track_id", "frame_idx", "z")
    a = z.select("track_id", (F.col("frame_idx") + 1).alias("fs"), F.round("z", 6).alias("before_z"))
    b = z.select("track_id", F.col("frame_idx").alias("fe"), F.round("z", 6).alias("after_z"))
    got = ev.join(a, ["track_id", "fs"], "left").join(b, ["track_id", "fe"], "left")
    return got.select("track_id", "fs", "fe", "direction", "before_z", "after_z", act.event_id("affect.default", "deviation", F.col("n")).alias("event_id"))


@query("moving_median", f"WITH {GD} SELECT track_id, f AS frame_idx, round(quantile_cont(v,0.5) OVER (PARTITION BY track_id ORDER BY f ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING),6) AS moving_median FROM gd")
def moving_median(spark, sf):
    return robust.moving_median(dense(spark, sf), KEY, 3).select("track_id", "frame_idx", F.round("moving_median", 6).alias("moving_median"))


@query(
    "rolling_mad",
    f"""WITH {GD}, w AS (SELECT track_id, f, count(v) OVER o AS c, quantile_cont(v,0.5) OVER o AS m, list(v) OVER o AS l FROM gd WINDOW o AS (PARTITION BY track_id ORDER BY f ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING))
SELECT track_id, f AS frame_idx, CASE WHEN c >= 4 THEN round(m,6) END AS rolling_median, CASE WHEN c >= 4 THEN round(list_aggregate(list_transform(list_filter(l, lambda x: x IS NOT NULL), lambda x: abs(x-m)),'median'),6) END AS rolling_mad FROM w""",
)
def rolling_mad(spark, sf):
    return robust.rolling_mad(dense(spark, sf), KEY, 8).select("track_id", "frame_idx", F.round("rolling_median", 6).alias("rolling_median"), F.round("rolling_mad", 6).alias("rolling_mad"))


def leaves(spark, sf, seed: float = SEED) -> DataFrame:
    ev = fuse.number_events(events_of(spark, sf, seed).withColumn("recording_id", F.lit("all")), ["recording_id"], ["track_id", "fs", "fe", "direction"])
    return ev.select("recording_id", F.col("n").cast("long").alias("event_id"), "track_id", "direction", (F.col("fs") + 0.5).cast("double").alias("start_sec"), (F.col("fe") - 0.5).cast("double").alias("end_sec"), F.round("peak_z", 6).alias("score"), "peak_frame", F.col("n").alias("leaf"))


def leaves_sql(seed: float = SEED, name: str = "ev") -> str:
    return f"{events_sql(seed, name)}, {name}l AS (SELECT row_number() OVER (ORDER BY track_id, fs, fe, direction)-1 AS event_id, track_id, direction, fs+0.5::DOUBLE AS start_sec, fe-0.5::DOUBLE AS end_sec, round(peak_z,6) AS score, peak_frame FROM {name})"


@query("overlap_edges", f"WITH {Z}, {leaves_sql()} SELECT a.event_id AS id_a, b.event_id AS id_b, least(a.end_sec,b.end_sec)-greatest(a.start_sec,b.start_sec) AS overlap FROM evl a JOIN evl b ON a.event_id < b.event_id AND a.track_id <> b.track_id AND least(a.end_sec,b.end_sec)-greatest(a.start_sec,b.start_sec) >= 1")
def overlap_edges(spark, sf):
    return fuse.overlap_edges(leaves(spark, sf), ["recording_id"], 1.0).select("id_a", "id_b", "overlap")


@query("joint_events")
def joint_events(spark, sf):
    """Greedy cliques are sequential by definition: no SQL oracle; overlap_edges checks their edges."""
    ev = leaves(spark, sf)
    members = fuse.clique_fuse(ev, "recording_id", 1.0)
    return fuse.joints(ev, members, "recording_id").select("joint_no", "start_sec", "end_sec", F.round("score", 6).alias("score"), F.concat_ws(",", "tracks").alias("tracks"), F.concat_ws(",", F.col("children").cast("array<string>")).alias("children"), "peak_frame")


@query("param_sweep_deviation", f"""WITH {Z}, s AS (SELECT track_id, f, z, t::DOUBLE AS threshold FROM z, (VALUES (0.5),(1.0),(1.5),(2.0),(3.0)) v(t)), i AS (SELECT track_id, threshold, f - row_number() OVER (PARTITION BY track_id, threshold ORDER BY f) AS i FROM s WHERE z >= threshold),
r AS (SELECT track_id, threshold, count(*)::DOUBLE AS dur FROM i GROUP BY track_id, threshold, i) SELECT track_id, threshold, count(*) AS n_events, sum(dur) AS total_sec, quantile_cont(dur,0.5) AS median_sec FROM r GROUP BY ALL""")
def param_sweep_deviation(spark, sf):
    return summarize.sweep(scored(spark, sf), KEY, [0.5, 1.0, 1.5, 2.0, 3.0], 1.0)


@query("correlation_pairs", f"WITH {G} SELECT a.track_id AS track_a, b.track_id AS track_b, round(corr(a.v,b.v),6) AS r, count(*) AS n FROM g a JOIN g b ON a.f=b.f AND a.track_id < b.track_id GROUP BY ALL")
def correlation_pairs(spark, sf):
    g = grid(spark, sf).withColumn("recording_id", F.lit("all"))
    return summarize.correlation_pairs(g, ["recording_id"]).select("track_a", "track_b", F.round("r", 6).alias("r"), "n")


@query("autocorrelation", f"""WITH {G}, x AS (SELECT track_id, f, v - avg(v) OVER (PARTITION BY track_id) AS d FROM g), y AS (SELECT track_id, d, lead(d,1) OVER w AS l1, lead(d,6) OVER w AS l6, lead(d,24) OVER w AS l24 FROM x WINDOW w AS (PARTITION BY track_id ORDER BY f)),
a AS (SELECT track_id, avg(d*d) AS var, avg(d*l1) AS c1, avg(d*l6) AS c6, avg(d*l24) AS c24 FROM y GROUP BY 1) SELECT track_id, lag, round(c/var,6) AS acf FROM (SELECT track_id, var, unnest([1,6,24]) AS lag, unnest([c1,c6,c24]) AS c FROM a)""")
def autocorrelation(spark, sf):
    return summarize.autocorrelation(grid(spark, sf), KEY, [1, 6, 24]).select("track_id", "lag", F.round("acf", 6).alias("acf"))


@query("chunk_stationarity", f"""WITH {G}, x AS (SELECT track_id, v, row_number() OVER (PARTITION BY track_id ORDER BY f)-1 AS p, greatest(count(*) OVER (PARTITION BY track_id)//6,1) AS s FROM g)
SELECT track_id, CAST(least(p//s,5) AS INT) AS chunk, count(*) AS n, round(avg(v),6) AS mean, round(stddev_pop(v),6) AS std FROM x GROUP BY ALL""")
def chunk_stationarity(spark, sf):
    return summarize.chunk_stats(grid(spark, sf), KEY).select("track_id", "chunk", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("histogram", "WITH x AS (SELECT event_type, round(value,6) AS v FROM events), r AS (SELECT event_type, min(v) AS lo, max(v) AS hi FROM x GROUP BY 1) SELECT event_type, CAST(CASE WHEN hi=lo THEN 0 ELSE least(floor((v-lo)/((hi-lo)/60)),59) END AS INT) AS bin, count(*) AS n FROM x JOIN r USING (event_type) WHERE v IS NOT NULL GROUP BY ALL")
def histogram(spark, sf):
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_type", F.round("value", 6).alias("value"))
    return summarize.histogram(rows, ["event_type"], 60)


@query("signal_stats", f"""WITH {G}, m AS (SELECT track_id, quantile_cont(v,0.5) AS md FROM g GROUP BY 1) SELECT track_id, count(v) AS n, min(v) AS min, round(quantile_cont(v,0.05),6) AS p5, round(md,6) AS median, round(quantile_cont(v,0.95),6) AS p95, max(v) AS max, round(avg(v),6) AS mean, round(stddev_pop(v),6) AS std, round(quantile_cont(abs(v-md),0.5),6) AS mad FROM g JOIN m USING (track_id) GROUP BY track_id, md""")
def signal_stats(spark, sf):
    got = summarize.describe(grid(spark, sf), KEY)
    return got.select("track_id", "n", "min", "max", *[F.round(c, 6).alias(c) for c in ("p5", "median", "p95", "mean", "std", "mad")])


@query("gap_stats", f"WITH {K}, x AS (SELECT e-s AS dur, lead(s) OVER (ORDER BY s)-e AS gap FROM k) SELECT count(*) AS n, round(quantile_cont(dur,0.5),6) AS dur_median, round(quantile_cont(dur,0.9),6) AS dur_p90, max(dur) AS dur_max, round(quantile_cont(gap,0.5),6) AS gap_median, round(quantile_cont(gap,0.9),6) AS gap_p90, max(gap) AS gap_max FROM x HAVING count(*) > 0")
def gap_stats(spark, sf):
    got = summarize.gap_stats(activity(spark, sf), ["recording_id"])
    return got.select("n", *[F.round(c, 6).alias(c) for c in ("dur_median", "dur_p90", "dur_max", "gap_median", "gap_p90", "gap_max")])


@query("region_stats", f"WITH {K}, x AS (SELECT g.track_id, g.v, EXISTS (SELECT 1 FROM k WHERE g.f >= k.s AND g.f < k.e) AS active FROM g) SELECT track_id, active, count(*) AS n, round(quantile_cont(v,0.1),6) AS p10, round(quantile_cont(v,0.5),6) AS median, round(quantile_cont(v,0.9),6) AS p90, max(v) AS max FROM x GROUP BY ALL")
def region_stats(spark, sf):
    g = grid(spark, sf).withColumn("recording_id", F.lit("all"))
    got = iv.paint(g.select("recording_id", "track_id", "frame_idx", "value"), activity(spark, sf), ["recording_id"], 1.0).withColumn("active", F.col("painted") == 1)
    return got.groupBy("track_id", "active").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.percentile("value", q), 6).alias(n) for n, q in (("p10", 0.1), ("median", 0.5), ("p90", 0.9))], F.max("value").alias("max"))


@query("painted_labels", f"WITH {K}, fr AS (SELECT CAST(unnest(range(0,{HOURS})) AS INT) AS f) SELECT f AS frame_idx, CASE WHEN EXISTS (SELECT 1 FROM k WHERE f >= s AND f < e) THEN 1 ELSE 0 END AS painted FROM fr")
def painted_labels(spark, sf):
    frames = spark.range(HOURS).select(F.lit("all").alias("recording_id"), F.col("id").cast("int").alias("frame_idx"))
    return iv.paint(frames, activity(spark, sf), ["recording_id"], 1.0).select("frame_idx", "painted")


@query("multilabel_combinations", f"""WITH {Z}, {events_sql()}, fr AS (SELECT CAST(unnest(range(0,{HOURS})) AS INT) AS f), t AS (SELECT DISTINCT track_id FROM g), x AS (SELECT f, t.track_id, CASE WHEN EXISTS (SELECT 1 FROM ev WHERE ev.track_id=t.track_id AND f >= ev.fs AND f < ev.fe) THEN '1' ELSE '0' END AS on_ FROM fr, t),
y AS (SELECT f, string_agg(on_, '' ORDER BY track_id) AS combination FROM x GROUP BY f) SELECT combination, count(*) AS n FROM y GROUP BY 1""")
def multilabel_combinations(spark, sf):
    frames = dense(spark, sf).select("track_id", "frame_idx")
    ev = events_of(spark, sf).select("track_id", F.col("fs").cast("double").alias("start_sec"), F.col("fe").cast("double").alias("end_sec"))
    got = iv.paint(frames, ev, KEY, 1.0).groupBy("frame_idx").agg(F.array_sort(F.collect_list(F.struct("track_id", "painted"))).alias("x"))
    return got.groupBy(F.concat_ws("", F.transform("x", lambda s: s["painted"].cast("string"))).alias("combination")).agg(F.count(F.lit(1)).alias("n"))


def _samples(spark, sf):
    from pyspark.sql import Window

    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select("event_type", F.col("value"), (F.row_number().over(Window.partitionBy("event_type").orderBy("event_id")) - 1).alias("i"))


_S = "s AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id)-1 AS i FROM events)"


@query("envelope", f"WITH {_S}, x AS (SELECT *, greatest(1, count(*) OVER (PARTITION BY event_type)//300) AS sz FROM s) SELECT event_type, CAST(i//sz AS INT) AS bin, CASE WHEN count(*) < sz THEN least(min(value),0) ELSE min(value) END AS lo, CASE WHEN count(*) < sz THEN greatest(max(value),0) ELSE max(value) END AS hi FROM x GROUP BY event_type, i//sz, sz")
def envelope(spark, sf):
    return summarize.envelope(_samples(spark, sf), ["event_type"], 300)


@query("envelope_window", f"WITH {_S}, c AS (SELECT event_type, value, i-100 AS i FROM s WHERE i >= 100 AND i < 1100), x AS (SELECT *, greatest(1, count(*) OVER (PARTITION BY event_type)//40) AS sz FROM c) SELECT event_type, CAST(i//sz AS INT) AS bin, CASE WHEN count(*) < sz THEN least(min(value),0) ELSE min(value) END AS lo, CASE WHEN count(*) < sz THEN greatest(max(value),0) ELSE max(value) END AS hi FROM x GROUP BY event_type, i//sz, sz")
def envelope_window(spark, sf):
    part = _samples(spark, sf).filter("i >= 100 and i < 1100").withColumn("i", F.col("i") - 100)
    return summarize.envelope(part, ["event_type"], 40)


@query("enframe", """WITH s AS (SELECT user_id, list(round(value,6) ORDER BY event_id) AS l FROM events GROUP BY 1), n AS (SELECT user_id, l, CASE WHEN len(l) <= 16 THEN 1 ELSE 1+CAST(ceil((len(l)-16)/6.0) AS INT) END AS c FROM s), w AS (SELECT user_id, CAST(unnest(range(0,c)) AS INT) AS frame_idx, l FROM n),
f AS (SELECT user_id, frame_idx, l[frame_idx*6+1:frame_idx*6+16] AS x FROM w) SELECT user_id, frame_idx, len(x) AS filled, round(list_sum(x),4) AS total FROM f""")
def enframe(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", F.round("value", 6).alias("v")))), lambda s: s["v"]).alias("l"))
    w = e.select("user_id", F.size("l").alias("n"), F.posexplode(act.enframe(F.col("l"), 16, 6)).alias("frame_idx", "x"))
    filled = F.least(F.lit(16), F.col("n") - F.col("frame_idx") * 6).cast("long")
    return w.select("user_id", "frame_idx", filled.alias("filled"), F.round(act.total(F.col("x")), 4).alias("total"))
