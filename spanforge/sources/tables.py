"""Small inputs: class lists (CSV), category maps and timelines (JSON), label frames and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLANNED = "duration double, base_segments array<struct<start:double,`end`:double,type:string,transition:string,sample_idx:int>>, sfx_events array<struct<time:double,duration:double,type:string,sample_idx:int>>"
ACTUAL = "duration double, segments array<struct<start:double,`end`:double,type:string>>, sfx_events array<struct<start:double,`end`:double,type:string>>"


def classes(spark: SparkSession, path: str) -> DataFrame:
    """index, mid, display_name; quoted names may hold commas."""
    return spark.read.csv(path, header=True, quote='"', escape='"', schema="`index` int, mid string, display_name string")


def category_map(spark: SparkSession, path: str) -> DataFrame:
    """label, category of a JSON object."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    return raw.select(F.explode("m").alias("label", "category"))


def timelines(spark: SparkSession, path: str, planned: bool = False) -> DataFrame:
    """Segments and effects of timeline files as intervals: recording_id, kind, type, start_sec, end_sec."""
    rows = spark.read.schema(PLANNED if planned else ACTUAL).json(path, multiLine=True).withColumn("recording_id", F.regexp_extract(F.input_file_name(), r"([^/]+?)\.json$", 1))
    seg = rows.select("recording_id", F.lit("segment").alias("kind"), F.explode("base_segments" if planned else "segments").alias("s")).select("recording_id", "kind", "s.type", F.col("s.start").alias("start_sec"), F.col("s.end").alias("end_sec"))
    if planned:
        fx = rows.select("recording_id", F.lit("sfx").alias("kind"), F.explode("sfx_events").alias("s")).select("recording_id", "kind", "s.type", F.col("s.time").alias("start_sec"), (F.col("s.time") + F.col("s.duration")).alias("end_sec"))
    else:
        fx = rows.select("recording_id", F.lit("sfx").alias("kind"), F.explode("sfx_events").alias("s")).select("recording_id", "kind", "s.type", F.col("s.start").alias("start_sec"), F.col("s.end").alias("end_sec"))
    return seg.unionByName(fx)


def write_timeline(intervals: DataFrame, path: str, duration: float) -> None:
    """One JSON document per recording, in the ``actual`` form."""
    item = F.struct(F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), "type")
    pick = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, item)))
    intervals.groupBy("recording_id").agg(F.lit(float(duration)).alias("duration"), pick("segment").alias("segments"), pick("sfx").alias("sfx_events")).write.partitionBy("recording_id").json(path)


def sessions(spark: SparkSession, path: str) -> DataFrame:
    """Legacy session files, newest first: path, modified, and their JSON text."""
    raw = spark.read.format("text").option("wholetext", "true").load(path)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("body")).orderBy(F.col("modified").desc(), "path")
