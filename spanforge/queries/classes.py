"""Class probabilities, thresholds, class events, disfluency regions and sequence statistics (``embeddings``, ``conversations``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import BACKGROUND, DISFLUENCIES, EMOTIONS, EVENT_EMOTIONS, ClassConfig, RegionConfig
from ..functions import activations as act
from ..operators import detect, intervals, ontology, summarize
from ..plans import producers
from ..registry import query

KEY = ["recording_id"]


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    n = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    return e.select(F.col("label").alias("recording_id"), n.alias("frame_idx"), F.transform("embedding", lambda x: x.cast("double") * 20.0).alias("l"))


def probabilities(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    return v.select("recording_id", "frame_idx", act.softmax(F.slice("l", 1, 8)).alias("values"), (F.col("frame_idx") % 13 != 12).alias("valid"))


_NAMES = "[" + ",".join(f"'{x}'" for x in EMOTIONS) + "]"
_EVENTS = "(" + ",".join(f"'{x}'" for x in EVENT_EMOTIONS) + ")"
_BACK = "(" + ",".join(f"'{x}'" for x in BACKGROUND) + ")"
_BG = "greatest(" + ",".join(f"p[{EMOTIONS.index(x) + 1}]" for x in BACKGROUND) + ")"
E0 = "e0 AS (SELECT label AS recording_id, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id)-1 AS INT) AS frame_idx, list_transform(embedding, lambda x: 20*x::DOUBLE) AS a FROM embeddings)"
E = f"""{E0}, e1 AS (SELECT recording_id, frame_idx, list_transform(a[1:8], lambda x: exp(x-list_max(a[1:8]))) AS x FROM e0),
e AS (SELECT recording_id, frame_idx, list_transform(x, lambda y: y/list_sum(x)) AS p, frame_idx % 13 <> 12 AS valid FROM e1)"""
EL = f"{E}, el AS (SELECT recording_id, frame_idx, valid, p, unnest({_NAMES}) AS label, unnest(p) AS pr, list_position(p, list_max(p)) AS top, unnest(range(1,9)) AS ch, {_BG} AS bg FROM e)"
TH = f"{EL}, th AS (SELECT recording_id, label, greatest(0.6::DOUBLE, quantile_cont(pr,0.9) FILTER (WHERE valid)) AS threshold FROM el WHERE label IN {_EVENTS} GROUP BY ALL)"
SU = f"{TH}, su AS (SELECT el.*, threshold, top = ch AND pr >= threshold AND pr-bg >= 0.15::DOUBLE AS test FROM el JOIN th USING (recording_id, label))"
CL = f"""{SU}, sg AS (SELECT *, frame_idx - row_number() OVER (PARTITION BY recording_id, label ORDER BY frame_idx) AS seg FROM su WHERE valid),
rr AS (SELECT recording_id, label, seg, frame_idx - row_number() OVER (PARTITION BY recording_id, label, seg ORDER BY frame_idx) AS run, frame_idx FROM sg WHERE test),
r1 AS (SELECT recording_id, label, seg, min(frame_idx) AS fs, max(frame_idx)+1 AS fe FROM rr GROUP BY recording_id, label, seg, run),
r2 AS (SELECT *, max(fe) OVER (PARTITION BY recording_id, label, seg ORDER BY fs, fe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM r1),
r3 AS (SELECT *, sum(CASE WHEN pe IS NULL OR fs-pe > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, label, seg ORDER BY fs, fe ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM r2),
cl AS (SELECT recording_id, label, min(fs) AS fs, max(fe) AS fe, sum(fe-fs) AS raw FROM r3 GROUP BY recording_id, label, seg, grp HAVING max(fe)-min(fs) >= 1),
ce AS (SELECT cl.recording_id, cl.label, fs, fe, raw, (list(frame_idx ORDER BY pr DESC, frame_idx))[1] AS peak_frame, max(pr) AS peak_p, avg(pr) AS mean_p FROM cl JOIN su ON su.recording_id=cl.recording_id AND su.label=cl.label AND su.valid AND su.test AND su.frame_idx >= fs AND su.frame_idx < fe GROUP BY ALL)"""


def _long(spark, sf, labels=EMOTIONS) -> DataFrame:
    p = probabilities(spark, sf).withColumn("top", act.argmax(F.col("values")))
    rows = p.select(*KEY, "frame_idx", "valid", "top", F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.lit(EMOTIONS.index(x)).alias("ch"), F.get("values", EMOTIONS.index(x)).alias("p")) for x in labels])).alias("c"))
    return rows.select(*KEY, "frame_idx", "valid", "c.label", "c.p", (F.col("top") == F.col("c.ch")).alias("is_top"))


@query("class_probabilities", f"WITH {EL} SELECT recording_id, frame_idx, label, round(pr,6) AS p FROM el")
def class_probabilities(spark, sf):
    return _long(spark, sf).select(*KEY, "frame_idx", "label", F.round("p", 6).alias("p"))


@query("top1_margin", f"WITH {E} SELECT recording_id, frame_idx, {_NAMES}[list_position(p, list_max(p))] AS top1, round(list_max(p),6) AS p, round(list_max(p)-list_sort(p,'DESC')[2],6) AS margin, round({_BG},6) AS background_p, round(list_max(p)-{_BG},6) AS background_margin FROM e")
def top1_margin(spark, sf):
    v = F.col("values")
    best, _ = act.background_margin(v, [EMOTIONS.index(x) for x in BACKGROUND])
    return probabilities(spark, sf).select(*KEY, "frame_idx", F.get(F.array(*map(F.lit, EMOTIONS)), act.argmax(v)).alias("top1"), F.round(F.array_max(v), 6).alias("p"), F.round(act.top2_margin(v), 6).alias("margin"), F.round(best, 6).alias("background_p"), F.round(F.array_max(v) - best, 6).alias("background_margin"))


@query("class_entropy", f"WITH {E} SELECT recording_id, frame_idx, round(-list_sum(list_transform(p, lambda x: x*ln(greatest(least(x,1),1e-12)))),6) AS entropy, round(p[1]+p[2]+p[3],6) AS interesting, round(p[1]/greatest(p[1]+p[2]+p[3],1e-9),6) AS first_share FROM e")
def class_entropy(spark, sf):
    v = F.col("values")
    return probabilities(spark, sf).select(*KEY, "frame_idx", F.round(act.entropy(v), 6).alias("entropy"), F.round(act.mass(v, [0, 1, 2]), 6).alias("interesting"), F.round(F.get(act.share(v, [0, 1, 2]), 0), 6).alias("first_share"))


@query("topk_classes", f"WITH {EL} SELECT recording_id, frame_idx, string_agg(label, ',' ORDER BY pr DESC, ch) AS names FROM (SELECT *, row_number() OVER (PARTITION BY recording_id, frame_idx ORDER BY pr DESC, ch) AS r FROM el) WHERE r <= 5 GROUP BY ALL")
def topk_classes(spark, sf):
    return probabilities(spark, sf).select(*KEY, "frame_idx", F.concat_ws(",", F.transform(act.topk(F.col("values"), list(EMOTIONS), 5), lambda s: s["name"])).alias("names"))


@query("topk_by_maximum", f"WITH {EL} SELECT label, round(max(pr),6) AS max_p FROM el GROUP BY 1 ORDER BY max(pr) DESC, label LIMIT 3")
def topk_by_maximum(spark, sf):
    return _long(spark, sf).groupBy("label").agg(F.max("p").alias("m")).orderBy(F.col("m").desc(), "label").limit(3).select("label", F.round("m", 6).alias("max_p"))


@query("sigmoid_softmax", f"WITH {E0}, x AS (SELECT recording_id, frame_idx, a[9] AS a0, a[10] AS a1, a[11:15] AS t FROM e0) SELECT recording_id, frame_idx, round(exp(a1-greatest(a0,a1))/(exp(a0-greatest(a0,a1))+exp(a1-greatest(a0,a1))),6) AS p, round(1/(1+exp(-t[1])),6) AS t1, round(1/(1+exp(-t[5])),6) AS t5 FROM x")
def sigmoid_softmax(spark, sf):
    v = _vectors(spark, sf)
    return v.select(*KEY, "frame_idx", F.round(F.get(act.softmax(F.slice("l", 9, 2)), 1), 6).alias("p"), F.round(act.sigmoid(F.get("l", 10)), 6).alias("t1"), F.round(act.sigmoid(F.get("l", 14)), 6).alias("t5"))


_CATEGORY = {"anger": "negative", "disgust": "negative", "fear": "negative", "sadness": "negative", "happiness": "positive", "surprise": "positive", "neutral": "none", "other": "none"}


@query("label_fold", f"WITH {EL} SELECT recording_id, frame_idx, CASE WHEN label IN ('anger','disgust','fear','sadness') THEN 'negative' WHEN label IN ('happiness','surprise') THEN 'positive' ELSE 'none' END AS category, round(sum(CASE WHEN pr >= 0.05 THEN pr ELSE 0 END),6) AS p FROM el GROUP BY ALL")
def label_fold(spark, sf):
    mapping = spark.createDataFrame(list(_CATEGORY.items()), "label string, category string")
    got = ontology.fold(_long(spark, sf), F.broadcast(mapping), [*KEY, "frame_idx"], floor=0.05)
    return got.select(*KEY, "frame_idx", "category", F.round("p", 6).alias("p"))


def _thresholds(spark, sf) -> DataFrame:
    return summarize.thresholds(_long(spark, sf, EVENT_EMOTIONS), KEY, 0.6, 0.9)


@query("class_thresholds", f"WITH {TH} SELECT recording_id, label, round(threshold,6) AS threshold FROM th")
def class_thresholds(spark, sf):
    return _thresholds(spark, sf).select(*KEY, "label", F.round("threshold", 6).alias("threshold"))


@query("class_occupancy", f"""WITH {TH} SELECT recording_id, label, count(*) AS n, round(avg(pr),6) AS mean, round(quantile_cont(pr,0.5),6) AS p50, round(quantile_cont(pr,0.9),6) AS p90, round(quantile_cont(pr,0.95),6) AS p95, round(quantile_cont(pr,0.99),6) AS p99, round(max(pr),6) AS max, round(avg((top=ch)::INT),6) AS top1_share, round(avg((pr>=threshold)::INT),6) AS above_share FROM el JOIN th USING (recording_id, label) GROUP BY ALL""")
def class_occupancy(spark, sf):
    got = summarize.occupancy(_long(spark, sf, EVENT_EMOTIONS), KEY, _thresholds(spark, sf))
    return got.select(*KEY, "label", "n", *[F.round(c, 6).alias(c) for c in ("mean", "p50", "p90", "p95", "p99", "max", "top1_share", "above_share")])


@query("argmax_share", f"WITH {E}, x AS (SELECT recording_id, {_NAMES}[list_position(p, list_max(p))] AS label, count(*) AS n FROM e GROUP BY 1, 2) SELECT recording_id, label, round(n::DOUBLE/sum(n) OVER (PARTITION BY recording_id),6) AS share FROM x")
def argmax_share(spark, sf):
    top = F.get(F.array(*map(F.lit, EMOTIONS)), act.argmax(F.col("values")))
    got = probabilities(spark, sf).groupBy(*KEY, top.alias("label")).count()
    return got.select(*KEY, "label", F.round(F.col("count") / F.sum("count").over(Window.partitionBy(*KEY)), 6).alias("share"))


@query("emotion_support", f"WITH {SU} SELECT recording_id, frame_idx, label, valid AND test AS support FROM su")
def emotion_support(spark, sf):
    got = detect.class_support(probabilities(spark, sf), KEY, _thresholds(spark, sf), EVENT_EMOTIONS, EMOTIONS, BACKGROUND, 0.15)
    return got.select(*KEY, "frame_idx", "label", "support")


@query("emotion_events", f"WITH {CL} SELECT recording_id, label, fs, fe, raw AS raw_frames, fe-fs-raw AS bridge_frames, peak_frame, round(peak_p,6) AS peak_p, round(mean_p,6) AS mean_p FROM ce")
def emotion_events(spark, sf):
    got, _ = producers.class_events(probabilities(spark, sf), 1.0, 1.0, ClassConfig())
    return got.select(*KEY, "label", "fs", "fe", F.col("raw_frames").cast("long").alias("raw_frames"), F.col("bridge_frames").cast("long").alias("bridge_frames"), "peak_frame", F.round("peak_p", 6).alias("peak_p"), F.round("mean_p", 6).alias("mean_p"))


@query("event_summary", f"WITH {CL} SELECT coalesce(label,'all') AS label, count(*) AS n, sum(fe-fs)::DOUBLE AS total_sec, round(max(peak_p),6) AS max_p FROM ce GROUP BY GROUPING SETS ((label),()) HAVING count(*) > 0")
def event_summary(spark, sf):
    got, _ = producers.class_events(probabilities(spark, sf), 1.0, 1.0, ClassConfig())
    return got.rollup("label").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("fe") - F.col("fs")).cast("double")).alias("total_sec"), F.round(F.max("peak_p"), 6).alias("max_p")).filter("n > 0").withColumn("label", F.coalesce("label", F.lit("all")))


@query("suppressed_frames", f"WITH {SU} SELECT recording_id, label, count(*) FILTER (WHERE NOT valid AND test) AS n, round(max(pr) FILTER (WHERE NOT valid AND test),6) AS max_p FROM su GROUP BY ALL")
def suppressed_frames(spark, sf):
    p = probabilities(spark, sf)
    return producers.suppressed_frames(p, KEY, _thresholds(spark, sf)).select(*KEY, "label", "n", F.round("max_p", 6).alias("max_p"))


@query("param_sweep_prob_margin", f"""WITH {EL}, g AS (SELECT t::DOUBLE AS threshold, m::DOUBLE AS margin FROM (VALUES (0.4),(0.6),(0.8)) a(t), (VALUES (0.0),(0.2),(0.4)) b(m)),
s AS (SELECT recording_id, frame_idx, label, threshold, margin FROM el, g WHERE label IN {_EVENTS} AND top=ch AND pr >= threshold AND pr-bg >= margin), i AS (SELECT *, frame_idx - row_number() OVER (PARTITION BY recording_id, label, threshold, margin ORDER BY frame_idx) AS i FROM s),
r AS (SELECT threshold, margin, count(*) AS n FROM i GROUP BY recording_id, label, threshold, margin, i) SELECT threshold, margin, count(*) AS n_events, sum(n) AS n_frames FROM r GROUP BY ALL""")
def param_sweep_prob_margin(spark, sf):
    v = F.col("values")
    back = F.greatest(*[F.get(v, EMOTIONS.index(b)) for b in BACKGROUND])
    grid = F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(m).alias("margin")) for t in (0.4, 0.6, 0.8) for m in (0.0, 0.2, 0.4)])
    top = F.get(F.array(*map(F.lit, EMOTIONS)), act.argmax(v))
    rows = probabilities(spark, sf).select(*KEY, "frame_idx", top.alias("label"), F.array_max(v).alias("p"), back.alias("b"), F.explode(grid).alias("g")).select("*", "g.*")
    rows = rows.withColumn("on", F.col("label").isin(*EVENT_EMOTIONS) & (F.col("p") >= F.col("threshold")) & (F.col("p") - F.col("b") >= F.col("margin")))
    got = intervals.runs(rows, [*KEY, "label", "threshold", "margin"], "on")
    return got.groupBy("threshold", "margin").agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.col("fe") - F.col("fs")).alias("n_frames"))


def logits(spark, sf) -> DataFrame:
    return _vectors(spark, sf).select(*KEY, "frame_idx", F.slice("l", 9, 2).alias("fluency"), F.slice("l", 11, 5).alias("types"))


_TN = "[" + ",".join(f"'{x.lower().replace(' ', '_')}'" for x in DISFLUENCIES) + "]"
D = f"""{E0}, d0 AS (SELECT recording_id, frame_idx, 1/(1+exp(a[9]-a[10])) AS p, list_transform(a[11:15], lambda x: 1/(1+exp(-x))) AS tp FROM e0),
di AS (SELECT *, frame_idx - row_number() OVER (PARTITION BY recording_id ORDER BY frame_idx) AS i FROM d0 WHERE p >= 0.5), d1 AS (SELECT recording_id, min(frame_idx) AS fs, max(frame_idx)+1 AS fe FROM di GROUP BY recording_id, i HAVING max(p) >= 0.7),
d2 AS (SELECT *, max(fe) OVER (PARTITION BY recording_id ORDER BY fs, fe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM d1), d3 AS (SELECT *, sum(CASE WHEN pe IS NULL OR (fs-pe)*0.25 > 0.5+1e-12 THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id ORDER BY fs, fe ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM d2),
dr AS (SELECT recording_id, min(fs) AS fs, max(fe) AS fe FROM d3 GROUP BY recording_id, grp HAVING max(fe)-min(fs) >= 2),
dx AS (SELECT dr.recording_id, fs, fe, max(p) AS peak_p, avg(p) AS mean_p, (list(frame_idx ORDER BY p DESC, frame_idx))[1] AS peak_frame, (list(tp ORDER BY p DESC, frame_idx))[1] AS tk, max(tp[1]) AS m1, max(tp[2]) AS m2, max(tp[3]) AS m3, max(tp[4]) AS m4, max(tp[5]) AS m5 FROM dr JOIN d0 ON d0.recording_id=dr.recording_id AND frame_idx >= fs AND frame_idx < fe GROUP BY ALL),
dy AS (SELECT *, list_max([CASE WHEN m1>=0.7 THEN tk[1] END, CASE WHEN m2>=0.7 THEN tk[2] END, CASE WHEN m4>=0.7 THEN tk[4] END, CASE WHEN m5>=0.7 THEN tk[5] END]) AS u, CASE WHEN m3>=0.7 THEN tk[3] END AS s FROM dx),
de AS (SELECT *, CASE WHEN u IS NOT NULL AND s IS NOT NULL AND s >= u THEN 'vetoed' WHEN u IS NOT NULL THEN 'typed' WHEN s IS NOT NULL THEN 'suppressed' ELSE 'unspecified' END AS outcome,
 CASE WHEN m1>=0.7 AND tk[1]=u THEN {_TN}[1] WHEN m2>=0.7 AND tk[2]=u THEN {_TN}[2] WHEN m4>=0.7 AND tk[4]=u THEN {_TN}[4] ELSE {_TN}[5] END AS best FROM dy)"""


def regions(spark, sf) -> DataFrame:
    return producers.region_events(logits(spark, sf), 0.25, 3.0, None, RegionConfig())


@query("disfluency_regions", f"WITH {D} SELECT recording_id, fs, fe, peak_frame, round(peak_p,6) AS peak_p, round(mean_p,6) AS mean_p FROM de")
def disfluency_regions(spark, sf):
    return regions(spark, sf).select(*KEY, "fs", "fe", "peak_frame", F.round("peak_p", 6).alias("peak_p"), F.round("mean_p", 6).alias("mean_p"))


@query("disfluency_events", f"WITH {D} SELECT recording_id, best AS label, greatest(0, fs*0.25+1.5-0.125)::DOUBLE AS start_sec, (fe-1)*0.25+1.5+0.125::DOUBLE AS end_sec, round(peak_p,6) AS score FROM de WHERE outcome='typed'")
def disfluency_events(spark, sf):
    return regions(spark, sf).filter("label is not null").select(*KEY, "label", "start_sec", "end_sec", F.round("peak_p", 6).alias("score"))


@query("disfluency_counters", f"WITH {D} SELECT recording_id, count(*) AS candidates, count(*) FILTER (WHERE outcome='typed') AS emitted, count(*) FILTER (WHERE outcome IN ('suppressed','vetoed')) AS suppressed, count(*) FILTER (WHERE outcome IN ('suppressed','unspecified')) AS unspecified FROM de GROUP BY ALL")
def disfluency_counters(spark, sf):
    o = F.col("outcome")
    return regions(spark, sf).groupBy(*KEY).agg(F.count(F.lit(1)).alias("candidates"), F.count_if(o == "typed").alias("emitted"), F.count_if(o.isin("suppressed", "vetoed")).alias("suppressed"), F.count_if(o.isin("suppressed", "unspecified")).alias("unspecified"))


@query("run_lengths", """WITH x AS (SELECT conv_id, turn, role, CASE WHEN role IS DISTINCT FROM lag(role) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS c FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), y AS (SELECT *, sum(c) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM x) SELECT conv_id, run, role, min(turn) AS first, max(turn) AS last, count(*) AS length FROM y GROUP BY ALL""")
def run_lengths(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role")
    return intervals.run_lengths(rows, ["conv_id"], "turn", "role")


@query("clip_pooling", f"WITH {EL} SELECT recording_id, label, round(max(pr),6) AS pool_max, round(avg(pr) FILTER (WHERE valid),6) AS pool_mean, round(sum(exp(pr)*pr)/sum(exp(pr)),6) AS pool_attention FROM el GROUP BY ALL")
def clip_pooling(spark, sf):
    rows = _long(spark, sf)
    a = summarize.pool(rows, [*KEY, "label"], F.col("p"), F.col("p")).select(*KEY, "label", F.round("pool_max", 6).alias("pool_max"), F.round("pool_attention", 6).alias("pool_attention"))
    b = summarize.pool(rows, [*KEY, "label"], F.col("p"), mask=F.col("valid")).select(*KEY, "label", F.round("pool_mean", 6).alias("pool_mean"))
    return a.join(b, [*KEY, "label"])


@query("nearest_codebook", """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a FROM embeddings), u AS (SELECT vec_id, list_transform(a, lambda x: x/greatest(sqrt(list_sum(list_transform(a, lambda y: y*y))),1e-12)) AS a FROM v),
c AS (SELECT vec_id AS code, a AS b FROM u ORDER BY vec_id LIMIT 10), d AS (SELECT vec_id, code, list_sum(list_transform(list_zip(a,b), lambda z: (z[1]-z[2])*(z[1]-z[2]))) AS dist FROM u, c) SELECT vec_id, code, round(dist,6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(dist,9), code) AS r FROM d) WHERE r=1""")
def nearest_codebook(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    codes = v.orderBy("vec_id").limit(10).select(F.col("vec_id").alias("code_id"), F.col("vec").alias("code"))
    return summarize.nearest_code(v, codes).select("vec_id", "code", F.round("distance", 6).alias("distance"))


_CE = f"""{CL.replace("WITH ", "", 1) if CL.startswith("WITH ") else CL}"""


@query("class_event_rows", f"""WITH {_CE}, x AS (SELECT recording_id, label, greatest(0, fs*1.0+0.5-0.5)::DOUBLE AS start_sec, ((fe-1)*1.0+0.5+0.5)::DOUBLE AS end_sec, peak_p FROM ce)
SELECT recording_id, 'emotion.categorical.v1.categorical.' || printf('%06d', row_number() OVER (PARTITION BY recording_id ORDER BY start_sec, label)-1) AS event_id, label, start_sec, end_sec, round(peak_p,6) AS score FROM x""")
def class_event_rows(spark, sf):
    got, _ = producers.class_events(probabilities(spark, sf), 1.0, 1.0, ClassConfig())
    return producers.class_event_rows(got, 1.0, 1.0).select(*KEY, "event_id", "label", "start_sec", "end_sec", F.round("score", 6).alias("score"))


@query("composed_events", f"""WITH {_CE}, {D.replace(E0 + ", ", "", 1)}, x AS (SELECT recording_id, label, greatest(0, fs*1.0)::DOUBLE AS s, (fe*1.0)::DOUBLE AS e, peak_p FROM ce), y AS (SELECT recording_id, best AS label, greatest(0, fs*0.25+1.5-0.125)::DOUBLE AS s, ((fe-1)*0.25+1.5+0.125)::DOUBLE AS e, fs, fe, peak_p FROM de WHERE outcome='typed')
SELECT recording_id, 'emotion.categorical.v1.categorical.' || printf('%06d', row_number() OVER (PARTITION BY recording_id ORDER BY s, label)-1) AS event_id, 'emotion' AS task, label, round(e-s,6) AS duration_sec, round(peak_p,6) AS score FROM x
UNION ALL SELECT recording_id, 'disfluency.default.instance.' || printf('%06d', row_number() OVER (PARTITION BY recording_id ORDER BY fs, fe)-1), 'disfluency', label, round(e-s,6), round(peak_p,6) FROM y""")
def composed_events(spark, sf):
    """Events of two producers over the same recordings in one schema."""
    got, _ = producers.class_events(probabilities(spark, sf), 1.0, 1.0, ClassConfig())
    both = producers.compose(producers.class_event_rows(got, 1.0, 1.0), producers.region_event_rows(regions(spark, sf).filter("outcome = 'typed'")))
    return both.select(*KEY, "event_id", "task", "label", F.round("duration_sec", 6).alias("duration_sec"), F.round("score", 6).alias("score"))


@query("producer_runs", f"""WITH {_CE}, {D.replace(E0 + ", ", "", 1)} SELECT recording_id, 'emotion.categorical.v1' AS producer_id, count(*) AS n_events FROM ce GROUP BY 1 UNION ALL SELECT recording_id, 'disfluency.default', count(*) FROM de WHERE outcome='typed' GROUP BY 1""")
def producer_runs(spark, sf):
    got, _ = producers.class_events(probabilities(spark, sf), 1.0, 1.0, ClassConfig())
    both = producers.compose(producers.class_event_rows(got, 1.0, 1.0), producers.region_event_rows(regions(spark, sf).filter("outcome = 'typed'")))
    return producers.producer_runs(both, {producers.CLASS_ID: "x", producers.REGION_ID: "y"}).select(*KEY, "producer_id", "n_events")


@query("valid_frame_policy", f"WITH {E} SELECT recording_id, frame_idx, valid, CASE WHEN bool_or(valid) OVER (PARTITION BY recording_id) THEN 'speech_frames' ELSE 'none_no_speech' END AS frame_policy FROM e")
def valid_frame_policy(spark, sf):
    p = probabilities(spark, sf).withColumnRenamed("valid", "speech")
    return producers.valid_frames(p, p, KEY).select(*KEY, "frame_idx", "valid", "frame_policy")
