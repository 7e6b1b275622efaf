"""Spectral kernels on windows of samples, Arrow-batched NumPy: power spectrogram and log-mel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def hann(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def power_frames(x: np.ndarray, n_fft: int, hop: int) -> np.ndarray:
    """Power of a Hann-windowed STFT, centred with reflected edges: frames x (n_fft // 2 + 1)."""
    if len(x) <= n_fft // 2:
        x = np.pad(x, (0, n_fft // 2 + 1 - len(x)))
    padded = np.pad(x, n_fft // 2, mode="reflect")
    n = 1 + (len(padded) - n_fft) // hop
    view = np.lib.stride_tricks.as_strided(padded, (n, n_fft), (padded.strides[0] * hop, padded.strides[0]))
    return np.abs(np.fft.rfft(view * hann(n_fft), axis=1)) ** 2


#: Fixed values of the mel scale: Hz per mel below the bend, the bend in Hz, and mels per factor of 6.4 above it.
MEL_HZ, MEL_BEND, MEL_STEPS = 200.0 / 3, 1000.0, 27.0


def hz_to_mel(f: np.ndarray) -> np.ndarray:
    bend = MEL_BEND / MEL_HZ
    return np.where(f < MEL_BEND, f / MEL_HZ, bend + MEL_STEPS * np.log(np.maximum(f, MEL_BEND) / MEL_BEND) / np.log(6.4))


def mel_to_hz(m: np.ndarray) -> np.ndarray:
    bend = MEL_BEND / MEL_HZ
    return np.where(m < bend, m * MEL_HZ, MEL_BEND * np.exp((np.maximum(m, bend) - bend) * np.log(6.4) / MEL_STEPS))


def mel_filters(rate: int, n_fft: int, n_mels: int, lo: float, hi: float) -> np.ndarray:
    """Triangular filters, evenly spaced on the auditory-toolbox mel scale (linear up to 1 kHz, logarithmic above), each of
    unit area."""
    edges = mel_to_hz(np.linspace(*hz_to_mel(np.array([lo, hi], float)), n_mels + 2))
    freq = np.linspace(0, rate / 2, n_fft // 2 + 1)
    up = (freq - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    down = (edges[2:, None] - freq) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def to_db(power: np.ndarray, amin: float = 1e-10, ref: float = 1.0, top_db: float | None = 80.0) -> np.ndarray:
    db = 10 * np.log10(np.maximum(power, amin)) - 10 * np.log10(max(ref, amin))
    return db if top_db is None else np.maximum(db, db.max() - top_db)


def log_mel(samples: Column, rate: int, n_fft: int = 512, hop: int = 160, n_mels: int = 64, lo: float = 50.0, hi: float | None = None) -> Column:
    """ARRAY<ARRAY<DOUBLE>> of frames x mels for an ARRAY of samples; null stays null."""
    high = hi or rate / 2

    @F.pandas_udf("array<array<double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bank = mel_filters(rate, n_fft, n_mels, lo, high).T
        for s in batches:
            yield s.map(lambda x: None if x is None else [r.tolist() for r in to_db(power_frames(np.asarray(x, float), n_fft, hop) @ bank)])

    return run(samples)


def spectrogram(samples: Column, n_fft: int = 512, hop: int = 160) -> Column:
    @F.pandas_udf("array<array<double>>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else [r.tolist() for r in power_frames(np.asarray(x, float), n_fft, hop)])

    return run(samples)


def magnitude_phase(re: Column, im: Column) -> tuple[Column, Column, Column]:
    """Magnitude, cosine and sine of the phase; the divisor has a floor of 1e-10."""
    mag = F.sqrt(re * re + im * im)
    low = F.greatest(mag, F.lit(1e-10))
    return mag, re / low, im / low
