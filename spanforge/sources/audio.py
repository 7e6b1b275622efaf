"""Recordings: WAV files through Spark's binary reader, decoded in Arrow batches; no path is opened outside Spark."""

from __future__ import annotations

import hashlib
import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.activations import safe_filename


def decode_wav(data: bytes, rate: int | None = None, peak: float | None = None) -> tuple[np.ndarray, int]:
    """Mono float32 samples of a PCM WAV: channels are averaged, then resampled by linear interpolation and scaled to a peak."""
    with wave.open(io.BytesIO(data)) as w:
        width, channels, own = w.getsampwidth(), w.getnchannels(), w.getframerate()
        raw = w.readframes(w.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / 8388608
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / float(1 << 8 * width - 1)
    x = x.reshape(-1, channels).mean(axis=1)
    if rate and rate != own and len(x):
        n = max(1, round(len(x) * rate / own))
        x = np.interp(np.arange(n) * own / rate, np.arange(len(x)), x).astype(np.float32)
    if peak and len(x) and np.abs(x).max() > 0:
        x = x / np.abs(x).max() * peak
    return x.astype("<f4"), rate or own


def sample_hash(x: np.ndarray) -> str:
    """sha256 of the little-endian float32 bytes."""
    return hashlib.sha256(np.ascontiguousarray(x, "<f4").tobytes()).hexdigest()


def discover(spark: SparkSession, root: str, pattern: str = "*.wav") -> DataFrame:
    """path, modificationTime, length of audio files, by path."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root).select("path", "modificationTime", "length").orderBy("path")


def load(spark: SparkSession, root: str, rate: int = 16000, peak: float | None = None, pattern: str = "*.wav") -> DataFrame:
    """recording_id, category (parent folder), path, sample_rate, duration_sec, audio_sha256, samples, error. A file that can't be
    read has its error and null samples."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    schema = "path string, sample_rate int, duration_sec double, audio_sha256 string, samples array<float>, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for path, data in zip(part["path"], part["content"], strict=True):
                try:
                    x, r = decode_wav(bytes(data), rate, peak)
                    rows.append((path, r, len(x) / r, sample_hash(x), x.tolist(), None))
                except (wave.Error, EOFError, KeyError, ValueError) as e:
                    rows.append((path, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "sample_rate", "duration_sec", "audio_sha256", "samples", "error"])

    got = files.select("path", "content").mapInPandas(run, schema)
    name = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    return got.select(safe_filename(name).alias("recording_id"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("category"), *got.columns)


def crop_center(samples: Column, n: int) -> Column:
    """The middle n samples."""
    return F.slice(samples, F.greatest(F.lit(0), F.floor((F.size(samples) - n) / 2)).cast("int") + 1, F.lit(n))


def capped(rows: DataFrame, category: str, order: str, per_category: int, total: int) -> DataFrame:
    """At most ``per_category`` rows of each category and ``total`` in all, in order of arrival."""
    from pyspark.sql import Window

    w = Window.partitionBy(category).orderBy(order)
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per_category).drop("_r").orderBy(order).limit(total)


def write_wav(path: str, x: np.ndarray, rate: int) -> None:
    """For fixtures: 16-bit mono."""
    with wave.open(path, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
