"""Review labels: an append-only log, inheritance between runs, filters and orders of the review list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import VERDICTS
from ..schema import DataError
from .intervals import overlap_join, overlap_ratio


def check_verdicts(labels: DataFrame) -> DataFrame:
    bad = labels.filter(~F.coalesce(F.col("verdict"), F.lit("")).isin("", *VERDICTS)).limit(1).collect()
    if bad:
        raise DataError(f"unknown verdict {bad[0]['verdict']!r}")
    return labels


def check_known(log: DataFrame, events: DataFrame) -> DataFrame:
    bad = log.join(events.select("event_id"), "event_id", "left_anti").limit(1).collect()
    if bad:
        raise DataError(f"label for unknown event {bad[0]['event_id']!r}")
    return log


def latest(log: DataFrame, version: str = "version") -> DataFrame:
    """The last row per event of an append-only log; a row with a null verdict clears the label."""
    w = Window.partitionBy("event_id").orderBy(F.col(version).desc())
    return log.withColumn("_r", F.row_number().over(w)).filter("_r = 1 and verdict is not null").drop("_r")


def inherit(old: DataFrame, new: DataFrame, keys: list[str], min_ratio: float = 0.5, bucket: float = 64.0) -> DataFrame:
    """For each new event the labelled old event of the same keys with the best overlap ratio (>= ``min_ratio``); of equals the
    first in old order. old: keys, old_id, old_order, start_sec, end_sec, verdict; new: keys, event_id, start_sec, end_sec."""
    a = new.select(*keys, "event_id", F.col("start_sec").cast("double").alias("a0"), F.col("end_sec").cast("double").alias("a1"))
    b = old.filter("verdict is not null").select(*keys, "old_id", "old_order", "verdict", F.col("start_sec").cast("double").alias("b0"), F.col("end_sec").cast("double").alias("b1"))
    ratio = overlap_ratio(F.col("a0"), F.col("a1"), F.col("b0"), F.col("b1"))
    pairs = overlap_join(a, b, keys, bucket).withColumn("score", ratio).filter(F.col("score") >= min_ratio).filter("score > 0")
    w = Window.partitionBy("event_id").orderBy(F.col("score").desc(), "old_order")
    return pairs.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("event_id", "verdict", F.col("old_id").alias("inherited_from"), F.col("score").alias("inherited_match_score"))


def child_signature(joint: DataFrame, events: DataFrame, joint_id: str = "event_id") -> DataFrame:
    """joint id, signature: the sorted (label, direction) of its known children."""
    child = joint.select(F.col(joint_id).alias("joint_id"), F.explode("children").alias("event_id")).join(events.select("event_id", "label", "direction"), "event_id")
    return child.groupBy("joint_id").agg(F.concat_ws(",", F.array_sort(F.collect_set(F.concat_ws(":", "label", F.coalesce("direction", F.lit("")))))).alias("signature"))


def review(events: DataFrame, labels: DataFrame, task: str | None = None, producer: str | None = None, label: str | None = None, event_type: str | None = None, track: str | None = None, min_score: float | None = None, unlabeled: bool = False) -> DataFrame:
    """Events with their current verdict, filtered as the review list does."""
    out = events.join(labels.select("event_id", "verdict"), "event_id", "left")
    tests: list[Column] = [F.col(c) == v for c, v in (("task", task), ("producer_id", producer), ("label", label), ("event_type", event_type)) if v is not None]
    if track is not None:
        tests.append(F.array_contains("source_track_ids", track))
    if min_score is not None:
        tests.append(F.col("score") >= min_score)
    if unlabeled:
        tests.append(F.coalesce("verdict", F.lit("")) == "")
    for t in tests:
        out = out.filter(t)
    return out


#: Orders of the review list and task ranks of the composed list.
ORDERS = {"time": ["start_sec", "event_id"], "score": ["-score", "start_sec", "event_id"], "duration": ["-duration", "start_sec", "event_id"]}


def ordered(events: DataFrame, by: str = "time") -> DataFrame:
    """Total orders, so that equal scores keep the order of time."""
    rows = events.withColumn("duration", F.col("end_sec") - F.col("start_sec"))
    cols = [F.col(c[1:]).desc() if c[0] == "-" else F.col(c) for c in ORDERS[by]]
    return rows.orderBy(*cols)


def compose_order(events: DataFrame, tasks: tuple[str, ...] = ("affect", "disfluency", "emotion")) -> DataFrame:
    """The composed list: start, task rank, label, type, id."""
    rank = F.array_position(F.array(*map(F.lit, tasks)), F.col("task"))
    return events.orderBy("start_sec", F.when(rank == 0, len(tasks) + 1).otherwise(rank), "label", "event_type", "event_id")
