"""Hysteresis regions over a stream of frames: the batch semantics, emitted when a region closes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def close_regions(rows: list[tuple[int, float]], state: tuple[int, int, bool] | None, seed: float, shoulder: float) -> tuple[list[tuple[int, int]], tuple[int, int, bool] | None]:
    """Feed (frame, p) in order; returns closed [start, end) regions and the open one (start, next frame, seeded)."""
    out = []
    for i, p in rows:
        if state is not None and (i != state[1] or p < shoulder):
            if state[2]:
                out.append(state[:2])
            state = None
        if p >= shoulder:
            state = (i, i + 1, p >= seed) if state is None else (state[0], i + 1, state[2] or p >= seed)
    return out, state


def regions(stream: DataFrame, key: str, seed: float, shoulder: float, timeout_ms: int | None = None) -> DataFrame:
    """(key, fs, fe) of each region as it closes. stream: key, frame_idx, p, in order of frame_idx per key within the input; the state
    of a key is three numbers. With a timeout, a key that falls silent closes its open region."""
    schema = f"`{key}` string, fs long, fe long"

    def run(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else None
        open_ = None if held is None or held[0] < 0 else (int(held[0]), int(held[1]), bool(held[2]))
        if state.hasTimedOut:
            out = [open_[:2]] if open_ and open_[2] else []
            state.remove()
        else:
            rows = sorted((int(i), float(p)) for part in parts for i, p in zip(part["frame_idx"], part["p"], strict=True) if p == p)
            out, open_ = close_regions(rows, open_, seed, shoulder)
            state.update(open_ or (-1, -1, False))
            if timeout_ms:
                state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame([(str(k[0]), a, b) for a, b in out], columns=[key, "fs", "fe"])

    kind = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    return stream.groupBy(key).applyInPandasWithState(run, schema, "start long, next long, seeded boolean", "append", kind)
