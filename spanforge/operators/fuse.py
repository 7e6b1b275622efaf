"""Cross-signal fusion of overlapping events, and links between joint events and their children."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import overlap_join


def overlap_edges(events: DataFrame, keys: list[str], min_overlap: float, bucket: float = 64.0) -> DataFrame:
    """Pairs (id_a < id_b) of events on different tracks of a recording that overlap by at least ``min_overlap`` seconds.
    events: keys, event_id, track_id, start_sec, end_sec."""
    a = events.select(*keys, F.col("event_id").alias("id_a"), F.col("track_id").alias("track_a"), F.col("start_sec").cast("double").alias("a0"), F.col("end_sec").cast("double").alias("a1"))
    b = events.select(*keys, F.col("event_id").alias("id_b"), F.col("track_id").alias("track_b"), F.col("start_sec").cast("double").alias("b0"), F.col("end_sec").cast("double").alias("b1"))
    shared = F.least("a1", "b1") - F.greatest("a0", "b0")
    pairs = overlap_join(a, b, keys, bucket, "inner", (F.col("id_a") < F.col("id_b")) & (F.col("track_a") != F.col("track_b")) & (shared >= min_overlap))
    return pairs.select(*keys, "id_a", "id_b", "track_a", "track_b", shared.alias("overlap"))


def clique_fuse(events: DataFrame, key: str, min_overlap: float) -> DataFrame:
    """Greedy groups of events that all overlap one another: (key, joint_no, event_id, ord).

    Seeds go by falling score, then start, then leaf order. A seed collects, in that order, unused events of tracks it has not
    yet, if they overlap every member by at least ``min_overlap``; groups of two or more are kept and their members used. The
    choice is sequential by definition, so a recording's events (not its frames) are one Arrow group.
    events: key, event_id, track_id, start_sec, end_sec, score, leaf (a total order)."""

    def run(g):
        g = g.sort_values(["score", "start_sec", "leaf"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        lo, hi, track = g["start_sec"].to_numpy(float), g["end_sec"].to_numpy(float), g["track_id"].tolist()
        # only events that start before a seed ends can meet it
        used, out, joint = [False] * len(g), [], 0
        for s in range(len(g)):
            if used[s]:
                continue
            members, tracks = [s], {track[s]}
            a, b = lo[s], hi[s]
            near = [i for i in range(len(g)) if not used[i] and i != s and min(hi[i], b) - max(lo[i], a) >= min_overlap]
            for i in near:
                if track[i] not in tracks and all(min(hi[i], hi[m]) - max(lo[i], lo[m]) >= min_overlap for m in members):
                    members.append(i)
                    tracks.add(track[i])
            if len(members) > 1:
                for order, m in enumerate(members):
                    used[m] = True
                    out.append((g[key].iloc[0], joint, g["event_id"].iloc[m], order))
                joint += 1
        import pandas as pd

        return pd.DataFrame(out, columns=[key, "joint_no", "event_id", "ord"])

    kind = events.schema["event_id"].dataType.simpleString()
    cols = events.select(key, "event_id", "track_id", F.col("start_sec").cast("double").alias("start_sec"), F.col("end_sec").cast("double").alias("end_sec"), F.col("score").cast("double").alias("score"), "leaf")
    return cols.groupBy(key).applyInPandas(run, f"`{key}` {events.schema[key].dataType.simpleString()}, joint_no long, event_id {kind}, ord long")


def signature(signed: Column, axis: Column, axes: dict[str, str], threshold: float) -> Column:
    """Aggregate 'A+ V- D0': per axis the stronger side if it reaches the threshold; a tie goes to +."""
    parts = []
    for name, letter in axes.items():
        plus = F.coalesce(F.max(F.when((axis == name) & (signed > 0), signed)), F.lit(0.0))
        minus = F.coalesce(F.max(F.when((axis == name) & (signed < 0), -signed)), F.lit(0.0))
        parts.append(F.concat(F.lit(letter), F.when(F.greatest(plus, minus) < threshold, "0").when(plus >= minus, "+").otherwise("-")))
    return F.concat_ws(" ", *parts)


def joints(events: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """One row per group: span, score sqrt(sum of squares), tracks, children by start, and the seed's peak frame."""
    got = events.join(members, [key, "event_id"])
    return got.groupBy(key, "joint_no").agg(
        F.min("start_sec").alias("start_sec"), F.max("end_sec").alias("end_sec"), F.sqrt(F.sum(F.col("score") * F.col("score"))).alias("score"),
        F.array_sort(F.collect_set("track_id")).alias("tracks"), F.transform(F.array_sort(F.collect_list(F.struct("start_sec", "event_id"))), lambda x: x["event_id"]).alias("children"),
        F.min_by("peak_frame", "ord").alias("peak_frame"),
    )


def attach_parents(events: DataFrame, joint: DataFrame, key: str, joint_id: str = "joint_id") -> DataFrame:
    """``parent_id`` of each event: the joint that lists it as a child."""
    child = joint.select(key, F.col(joint_id).alias("parent_id"), F.explode("children").alias("event_id"))
    return events.join(child, [key, "event_id"], "left")


def number_events(events: DataFrame, keys: list[str], order: list, name: str = "n", offset: Column | None = None) -> DataFrame:
    """Dense numbers from 0 in a total order."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return events.withColumn(name, n if offset is None else n + offset)
