"""The model slot: predictors are injected callables over batches of windows; results land in the artifact store."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.activations import enframe
from ..sources import store

Predictor = Callable[[np.ndarray], np.ndarray]


def predict(recordings: DataFrame, predictor: Predictor, rate: int, window_sec: float, hop_sec: float, batch: int = 128, key: str = "recording_id") -> DataFrame:
    """key, frame_idx, values: ``predictor`` maps windows x samples to windows x channels, ``batch`` windows a call."""
    win, hop = round(window_sec * rate), round(hop_sec * rate)
    wins = recordings.select(key, F.posexplode(enframe(F.col("samples").cast("array<double>"), win, hop)).alias("frame_idx", "window"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                x = np.array(part.column(2).to_pylist(), dtype=np.float32)
                y = np.asarray(predictor(x), dtype=np.float32).reshape(len(x), -1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(y.astype(float).tolist(), pa.list_(pa.float64()))], names=[key, "frame_idx", "values"])

    return wins.mapInArrow(run, f"`{key}` string, frame_idx int, values array<double>")


def run_all(spark: SparkSession, recording: DataFrame, root: str, tasks: dict[str, tuple[Predictor, dict]], rate: int, reuse: bool = True) -> dict[str, bool]:
    """Run the tasks of one recording in order, each written before the next begins: a failure leaves finished ones valid. Returns
    task -> reused. tasks: name -> (predictor, config with window_sec, hop_sec and batch)."""
    row = recording.select("recording_id", "audio_sha256").first()
    reused = {}
    for task, (predictor, config) in tasks.items():
        key = {"recording_id": row.recording_id, "audio_sha256": row.audio_sha256, "task": task, "config_hash": store.config_hash(config)}
        reused[task] = reuse and store.find_artifact(spark, root, key) is not None
        if not reused[task]:
            got = predict(recording, predictor, rate, config["window_sec"], config["hop_sec"], config.get("batch", 128))
            store.write_artifact(got, root, key, config, config["hop_sec"], config["window_sec"])
    return reused


def one_audio(manifests: DataFrame, tasks: tuple[str, ...]) -> DataFrame:
    """Recordings with exactly one audio hash and a complete artifact for each task."""
    per = manifests.filter("status = 'complete'").groupBy("recording_id").agg(F.count_distinct("audio_sha256").alias("n"), F.array_sort(F.collect_set("task")).alias("tasks"))
    return per.filter((F.col("n") == 1) & (F.col("tasks") == F.array(*map(F.lit, sorted(tasks))))).select("recording_id")
