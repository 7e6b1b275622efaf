"""Review list, labels, hierarchy, artifacts and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import fingerprint
from ..functions import activations as act
from ..operators import labels, ontology
from ..registry import query
from ..sources import store
from .signals import Z, events_of, leaves, leaves_sql


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    """A label log keyed like the events: every labelled document in turn labels one event."""
    rows = spark.read.parquet(f"{sf}/labels.parquet")
    verdict = F.when(F.col("toxic") == 1, "fp").when(F.col("quality") == 1, "tp").otherwise("unclear")
    return rows.select((F.col("doc_id") % 200).alias("event_id"), F.col("doc_id").alias("version"), F.when(F.col("doc_id") % 11 != 0, verdict).alias("verdict"))


_L = """lg AS (SELECT doc_id % 200 AS event_id, doc_id AS version, CASE WHEN doc_id % 11 <> 0 THEN CASE WHEN toxic=1 THEN 'fp' WHEN quality=1 THEN 'tp' ELSE 'unclear' END END AS verdict FROM labels),
la AS (SELECT event_id, verdict FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY version DESC) AS r FROM lg) WHERE r=1 AND verdict IS NOT NULL)"""


@query("label_upsert", f"WITH {_L} SELECT event_id, verdict FROM la")
def label_upsert(spark, sf):
    return labels.latest(labels.check_verdicts(_labels(spark, sf))).select("event_id", "verdict")


@query("review_filter_sort", f"WITH {Z}, {leaves_sql()}, {_L} SELECT event_id, track_id, start_sec, score, verdict, row_number() OVER (ORDER BY score DESC, start_sec, event_id) AS position FROM evl LEFT JOIN la USING (event_id) WHERE score >= 2 AND coalesce(verdict,'') <> 'fp'")
def review_filter_sort(spark, sf):
    from pyspark.sql import Window

    ev = leaves(spark, sf)
    got = labels.review(ev, labels.latest(_labels(spark, sf)), min_score=2.0).filter("coalesce(verdict,'') <> 'fp'")
    return got.select("event_id", "track_id", "start_sec", "score", "verdict", F.row_number().over(Window.orderBy(F.col("score").desc(), "start_sec", "event_id")).alias("position"))


@query("label_inherit", f"""WITH {Z}, {leaves_sql(1.5, "ev")}, {leaves_sql(2.0, "nv")}, {_L}, p AS (SELECT n.event_id, o.event_id AS inherited_from, la.verdict, CASE WHEN least(n.end_sec-n.start_sec, o.end_sec-o.start_sec) > 0 THEN greatest(0, least(n.end_sec,o.end_sec)-greatest(n.start_sec,o.start_sec))/least(n.end_sec-n.start_sec, o.end_sec-o.start_sec) ELSE 0 END AS score
FROM nvl n JOIN evl o ON n.track_id=o.track_id AND n.direction=o.direction AND n.start_sec <= o.end_sec AND o.start_sec <= n.end_sec JOIN la ON la.event_id=o.event_id)
SELECT event_id, verdict, inherited_from, round(score,6) AS inherited_match_score FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY score DESC, inherited_from) AS r FROM p WHERE score >= 0.5) WHERE r=1""")
def label_inherit(spark, sf):
    old = leaves(spark, sf, 1.5).join(labels.latest(_labels(spark, sf)).select("event_id", "verdict"), "event_id", "left").withColumnsRenamed({"event_id": "old_id", "leaf": "old_order"})
    got = labels.inherit(old, leaves(spark, sf, 2.0), ["track_id", "direction"])
    return got.select("event_id", "verdict", "inherited_from", F.round("inherited_match_score", 6).alias("inherited_match_score"))


@query("event_facets", f"WITH {Z}, {leaves_sql()} SELECT DISTINCT track_id, direction FROM evl")
def event_facets(spark, sf):
    return events_of(spark, sf).select("track_id", "direction").distinct()


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    """nation -> region -> world, and two diamonds."""
    n = spark.read.parquet(f"{sf}/nation.parquet").join(spark.read.parquet(f"{sf}/region.parquet"), F.col("n_regionkey") == F.col("r_regionkey"))
    a = n.select(F.col("n_name").alias("child_id"), F.col("r_name").alias("parent_id"))
    b = n.select(F.col("r_name").alias("child_id"), F.lit("WORLD").alias("parent_id")).distinct()
    c = n.filter("n_nationkey % 7 = 0").select(F.col("n_name").alias("child_id"), F.lit("CLUB").alias("parent_id"))
    return a.unionByName(b).unionByName(c).unionByName(spark.createDataFrame([("CLUB", "WORLD")], "child_id string, parent_id string"))


_ED = "ed AS (SELECT n_name AS c, r_name AS p FROM nation JOIN region ON n_regionkey=r_regionkey UNION SELECT r_name, 'WORLD' FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation) UNION SELECT n_name, 'CLUB' FROM nation WHERE n_nationkey % 7 = 0 UNION SELECT 'CLUB','WORLD')"
_UP = f"{_ED}, up AS (SELECT n AS node, n AS ancestor, 0 AS depth FROM (SELECT c AS n FROM ed UNION SELECT p FROM ed) UNION ALL SELECT node, ed.p, depth+1 FROM up JOIN ed ON up.ancestor=ed.c), uu AS (SELECT node, ancestor, min(depth) AS depth FROM up GROUP BY ALL)"


@query("ontology_ancestors", f"WITH RECURSIVE {_UP} SELECT node, ancestor, depth FROM uu")
def ontology_ancestors(spark, sf):
    return ontology.closure(_edges(spark, sf))


@query("subtree_classes", f"WITH RECURSIVE {_UP} SELECT node FROM uu WHERE ancestor='WORLD' EXCEPT SELECT node FROM uu WHERE ancestor='ASIA'")
def subtree_classes(spark, sf):
    return ontology.include_exclude(ontology.closure(_edges(spark, sf)), "WORLD", "ASIA").distinct()


@query("category_counts", f"WITH RECURSIVE {_UP}, x AS (SELECT node, min(CASE ancestor WHEN 'ASIA' THEN 1 WHEN 'EUROPE' THEN 2 WHEN 'CLUB' THEN 3 END) AS r FROM uu GROUP BY 1) SELECT CASE r WHEN 1 THEN 'east' WHEN 2 THEN 'west' WHEN 3 THEN 'club' ELSE 'rest' END AS category, count(*) AS n FROM x GROUP BY 1")
def category_counts(spark, sf):
    got = ontology.category_of(ontology.closure(_edges(spark, sf)), {"ASIA": "east", "EUROPE": "west", "CLUB": "club"}, "rest")
    return got.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def _manifests(spark, sf) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select(F.concat(F.lit("rec"), (F.col("o_custkey") % 50).cast("string")).alias("recording_id"), F.sha2(F.col("o_custkey").cast("string"), 256).alias("audio_sha256"), F.lower("o_orderpriority").alias("task"), F.lit("0" * 16).alias("config_hash"), F.when(F.col("o_orderstatus") == "F", "complete").otherwise("partial").alias("status"), F.col("o_orderkey").cast("long").alias("n_frames"))


_M = "m AS (SELECT 'rec' || (o_custkey % 50) AS recording_id, sha256(o_custkey::VARCHAR) AS audio_sha256, lower(o_orderpriority) AS task, '0000000000000000' AS config_hash, CASE WHEN o_orderstatus='F' THEN 'complete' ELSE 'partial' END AS status, o_orderkey::BIGINT AS n_frames FROM orders)"


@query("artifact_listing", f"WITH {_M} SELECT recording_id, audio_sha256, task, config_hash, max(n_frames) AS n_frames FROM m WHERE status='complete' AND recording_id='rec7' GROUP BY ALL")
def artifact_listing(spark, sf):
    return store.latest_manifests(_manifests(spark, sf).withColumn("created", F.lpad(F.col("n_frames").cast("string"), 20, "0")), recording_id="rec7")


@query("missing_work", f"WITH {_M} SELECT DISTINCT recording_id, audio_sha256, task, config_hash FROM m x WHERE NOT EXISTS (SELECT 1 FROM m y WHERE y.status='complete' AND y.recording_id=x.recording_id AND y.audio_sha256=x.audio_sha256 AND y.task=x.task AND y.config_hash=x.config_hash)")
def missing_work(spark, sf):
    m = _manifests(spark, sf)
    return store.missing_work(m.select(*store.KEY).distinct(), m)


@query("package_fingerprint")
def package_fingerprint(spark, sf):
    """A package's fingerprint from the hash of its events, which is folded where they are: rows only."""
    content = store.content_hash(leaves(spark, sf))
    mark = fingerprint({"events": content, "path": "anywhere"})
    return spark.createDataFrame([(mark[:24], mark, int(content.split(":")[1]))], "package_id string, package_fingerprint string, n_events long")


_ALIASES = {"click": "tap", "purchase": "buy", "<unk>": "other"}


@query("canonical_label", "SELECT event_id, CASE b WHEN 'click' THEN 'tap' WHEN 'purchase' THEN 'buy' WHEN '<unk>' THEN 'other' ELSE b END AS label FROM (SELECT event_id, lower(trim('  ns/' || upper(event_type) || ' ')) AS t, lower(trim(string_split(trim('  ns/' || upper(event_type) || ' '),'/')[-1])) AS b FROM events)")
def canonical_label(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select("event_id", act.normalize_label(F.concat(F.lit("  ns/"), F.upper("event_type"), F.lit(" ")), _ALIASES).alias("label"))


@query("clock_and_names", "SELECT event_id, printf('%02d:%02d:%03d', (CAST(round(value*1000) AS BIGINT)//60000), (CAST(round(value*1000) AS BIGINT)//1000)%60, CAST(round(value*1000) AS BIGINT)%1000) AS clock, regexp_replace(event_type || ' #' || user_id, '[^a-zA-Z0-9\\-_.]', '_', 'g') AS name FROM events WHERE value >= 0")
def clock_and_names(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").filter("value >= 0")
    return e.select("event_id", act.clock(F.col("value")).alias("clock"), act.safe_filename(F.concat("event_type", F.lit(" #"), F.col("user_id").cast("string"))).alias("name"))
