"""Audio cells and waveforms, inside Arrow workers only: decoding, mono, mel spectrograms."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

RATE = 16_000


def decode(data: bytes | None, path: str | None) -> tuple[np.ndarray, int]:
    """Mono float32 samples and rate of a PCM WAV: the bytes if there are any, else the file; both missing is an error."""
    if not data and not path:
        raise ValueError("an audio cell needs bytes or a path")
    with wave.open(io.BytesIO(data) if data else path) as f:
        width, channels, rate = f.getsampwidth(), f.getnchannels(), f.getframerate()
        raw = f.readframes(f.getnframes())
    if width not in (1, 2, 4):
        raise ValueError(f"samples of {width} bytes aren't supported")
    x = np.frombuffer(raw, {1: "u1", 2: "<i2", 4: "<i4"}[width]).astype(np.float32)
    x = (x - 128) / 128 if width == 1 else x / float(1 << (8 * width - 1))
    return np.ascontiguousarray(x.reshape(-1, channels).mean(1), np.float32), rate


def decoded(cell: Column) -> Column:
    """struct<samples, rate, error> of a column struct<bytes, path>; a bad cell has an error, not a failed task."""

    @F.pandas_udf("samples array<float>, rate int, error string")
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for data, path in zip(part["bytes"], part["path"]):
                try:
                    x, rate = decode(data, path)
                    rows.append((x, rate, None))
                except Exception as e:  # noqa: BLE001
                    rows.append((None, None, f"{type(e).__name__}: {str(e)[:200]}"))
            yield pd.DataFrame(rows, columns=["samples", "rate", "error"]).astype({"rate": "Int32"})

    return run(cell)


def waveform(cell: Column, rate: int = RATE, peak: float | None = -1.0) -> Column:
    """struct<samples, error> of an audio cell at a rate, its peak brought to peak decibels of full scale; null for null."""

    @F.pandas_udf("samples array<float>, error string")
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for data, path in zip(part["bytes"], part["path"]):
                try:
                    x = resampled(*decode(data, path), rate)
                    top = np.abs(x).max(initial=0.0)
                    rows.append((x * np.float32(10 ** (peak / 20) / top) if peak is not None and top > 0 else x, None))
                except Exception as e:  # noqa: BLE001
                    rows.append((None, f"{type(e).__name__}: {str(e)[:200]}"))
            yield pd.DataFrame(rows, columns=["samples", "error"])

    return F.when(cell.isNotNull(), run(cell))


def seconds(samples: Column, rate: int = RATE) -> Column:
    return F.size(samples) / F.lit(float(rate))


def resampled(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Band-limited resampling by zero-padding or cutting the spectrum."""
    if rate == to or not len(x):
        return x
    n = round(len(x) * to / rate)
    spectrum = np.fft.rfft(x)
    keep = min(len(spectrum), n // 2 + 1)
    out = np.zeros(n // 2 + 1, complex)
    out[:keep] = spectrum[:keep]
    return (np.fft.irfft(out, n) * (n / len(x))).astype(np.float32)


def rerated(samples: Column, rate: int, to: int) -> Column:
    """Samples at another rate."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([None if x is None else resampled(np.asarray(x, np.float32), rate, to) for x in part], dtype=object)

    return run(samples)


@cache
def mel_filters(rate: int, n_fft: int, n_mels: int, fmax: float) -> np.ndarray:
    """Triangular filters of equal area on the mel scale that is linear below 1 kHz and logarithmic above."""
    def to_mel(f):
        return np.where(f < 1000, f * 3 / 200, 15 + np.log(np.maximum(f, 1e-9) / 1000) * 27 / np.log(6.4))

    def to_hz(m):
        return np.where(m < 15, m * 200 / 3, 1000 * np.exp((m - 15) * np.log(6.4) / 27))

    edges = to_hz(np.linspace(0, to_mel(np.array(fmax)), n_mels + 2))
    bins = np.linspace(0, rate / 2, n_fft // 2 + 1)
    up = (bins - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    down = (edges[2:, None] - bins) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def mel_spectrogram(x: np.ndarray, rate: int = 48_000, n_fft: int = 1024, hop: int = 80, window: int = 170, n_mels: int = 32, fmax: float = 16_000, top_db: float = 80.0) -> np.ndarray:
    """Mel amplitudes in decibels, (n_mels, frames): Hann windows centred on each frame, the ends reflected."""
    if len(x) < 2:
        return np.zeros((n_mels, 0))
    half = n_fft // 2
    padded = np.pad(x, half, mode="reflect") if len(x) > half else np.pad(x, half, mode="symmetric")
    hann = np.zeros(n_fft)
    hann[(n_fft - window) // 2 : (n_fft - window) // 2 + window] = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(window) / window)
    frames = np.lib.stride_tricks.sliding_window_view(padded, n_fft)[::hop] * hann
    mel = mel_filters(rate, n_fft, n_mels, fmax) @ np.abs(np.fft.rfft(frames, axis=1)).T
    db = 20 * np.log10(np.maximum(mel, 1e-4))
    return np.maximum(db, db.max() - top_db)


def mel(samples: Column, rate: int = 48_000) -> Column:
    """Mel spectrogram as an array of frames."""

    @F.pandas_udf("array<array<float>>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([None if x is None else [f.astype(np.float32) for f in mel_spectrogram(np.asarray(x, np.float32), rate).T] for x in part], dtype=object)

    return run(samples)
