"""Table schemas and input checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .config import SCORE_NAMES

FRAMES = "recording_id string, track_id string, frame_idx int, value double"
FRAMES_MULTI = "recording_id string, track_id string, frame_idx int, values array<double>"
TRACKS = "recording_id string, track_id string, producer_id string, task string, name string, value_type string, renderer string, hop_sec double, window_sec double, n_frames int, channels array<string>"
INTERVALS = "recording_id string, start_sec double, end_sec double"
MARKERS = "recording_id string, track_id string, start_sec double, end_sec double, label string, score double, payload variant"
EVENT = "event_id string, producer_id string, task string, event_type string, label string, start_sec double, end_sec double, duration_sec double, source_track_ids array<string>, score double, score_name string, direction string, parent_id string, children array<string>, evidence variant, extra variant"
LABELS = "event_id string, verdict string, tags array<string>, comment string, labeler string, labeled_at string, inherited_from string, inherited_match_score double"


class DataError(ValueError):
    """Rows break a rule of their table."""


def _first(df: DataFrame, condition, message: str) -> None:
    row = df.filter(condition).limit(1).collect()
    if row:
        raise DataError(f"{message}: {row[0].asDict()}")


def check_frames(frames: DataFrame, keys: list[str], idx: str = "frame_idx") -> DataFrame:
    """Indices are unique, dense and start at 0 in every track: a missing frame would not break a run."""
    per = frames.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(idx).alias("lo"), F.max(idx).alias("hi"), F.count_distinct(idx).alias("d"))
    _first(per, (F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.col("d") != F.col("n")), "frames are not dense")
    return frames


def check_probabilities(frames: DataFrame, values: str = "values", tolerance: float = 1e-3) -> DataFrame:
    """Finite, not below -1e-12, and rows that sum to one."""
    v = F.col(values)
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")) | (x < -1e-12)) | (F.abs(total - 1.0) > tolerance)
    _first(frames, bad, "not probabilities")
    return frames


def check_events(events: DataFrame) -> DataFrame:
    """Ends do not precede starts, score names are known, ids are unique."""
    _first(events, (F.col("end_sec") < F.col("start_sec")) | ~F.col("score_name").isin(*SCORE_NAMES), "not an event")
    _first(events.groupBy("event_id").count().filter("count > 1"), F.lit(True), "event id is not unique")
    return events


def check_grid(tracks: DataFrame) -> DataFrame:
    _first(tracks, (F.col("hop_sec") <= 0) | (F.col("window_sec") <= 0) | ((F.col("renderer") == "multi_probability") & F.col("channels").isNull()), "not a track")
    return tracks


def null_nan(c):
    """NaN as null: Spark sorts NaN above every number, where a missing value must compare as false."""
    return F.when(~F.isnan(c.cast("double")), c)
