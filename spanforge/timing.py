"""Seconds and frames. Frame i of a grid summarises [i * hop, i * hop + window]; its centre is i * hop + window / 2.

The rules from seconds to frames differ on purpose; they depend on configuration only, so they run on the driver and enter
plans as literals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def seed_frames(seconds: float, hop: float) -> int:
    """Least width of a deviation seed."""
    return max(1, math.ceil(seconds / hop))


def min_event_frames(seconds: float, hop: float) -> int:
    """Least frames of a deviation event, whose span runs from first to last centre."""
    return max(1, math.ceil(seconds / hop) + 1)


def merge_gap_frames(seconds: float, hop: float) -> int:
    """Deviation merge gap; halves round to even."""
    return max(0, round(seconds / hop))


def support_frames(seconds: float, hop: float) -> int:
    """Least support of a hysteresis region."""
    return max(1, math.ceil(seconds / hop))


def class_min_frames(seconds: float, hop: float) -> int:
    """Least frames of a class event."""
    return max(1, math.ceil(seconds / hop - 1e-9))


def closing_gap_frames(seconds: float, hop: float) -> int:
    """Holes of a class event that closing fills."""
    return math.floor(seconds / hop + 1e-9)


def frame_start(idx: Column, hop: float) -> Column:
    return idx * F.lit(float(hop))


def frame_center(idx: Column, hop: float, window: float) -> Column:
    return idx * F.lit(float(hop)) + F.lit(window / 2.0)


def frame_end(idx: Column, hop: float, window: float) -> Column:
    return idx * F.lit(float(hop)) + F.lit(float(window))


def time_to_frame(seconds: Column, sample_rate: int, hop_samples: int) -> Column:
    """Frame of a time: whole samples first, then whole hops."""
    return F.floor(F.floor(seconds * F.lit(float(sample_rate))) / F.lit(float(hop_samples))).cast("long")


def grid_duration(n_frames: Column, hop: float, window: float) -> Column:
    return (n_frames - 1) * F.lit(float(hop)) + F.lit(float(window))
