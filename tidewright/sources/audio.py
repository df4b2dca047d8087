"""WAV files as arrays: whole, or a slice, decoded late and in batches."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def decode(data: bytes, start: float | None, end: float | None, rate: int | None, channel: int | None = None) -> np.ndarray:
    """The samples from start to end seconds in [-1, 1], at that rate; channels are averaged unless one, from 1, is named.

    A slice that is negative, turned round or beyond the end is an error.
    """
    with wave.open(io.BytesIO(data)) as f:
        own = f.getframerate()
        first = 0 if start is None else round(start * own)
        n = f.getnframes() - first if end is None else round((end - (start or 0.0)) * own)
        if first < 0 or n < 0 or first + n > f.getnframes():
            raise ValueError("the slice is not within the file")
    x = _samples(data, first, n, channel)
    return x if rate is None or rate == own else resample(x, own, rate)


def _samples(data: bytes, first: int, n: int, channel: int | None = None) -> np.ndarray:
    """n frames from the first on, at the file's rate, as one channel."""
    with wave.open(io.BytesIO(data)) as f:
        width, channels = f.getsampwidth(), f.getnchannels()
        f.setpos(first)
        raw = f.readframes(n)
    if width == 1:
        x = (np.frombuffer(raw, dtype=np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, dtype=f"<i{width}").astype(np.float32) / float(1 << (8 * width - 1))
    x = x.reshape(-1, channels)
    return x[:, channel - 1] if channel else x.mean(axis=1, dtype=np.float32)


def resample(x: np.ndarray, own: int, rate: int, zeros: int = 6) -> np.ndarray:
    """Windowed-sinc interpolation, cut off at the lower of both Nyquist rates."""
    n = -(-len(x) * rate // own)
    if not len(x):
        return np.zeros(n, dtype=np.float32)
    cut = min(1.0, rate / own)
    half = int(np.ceil(zeros / cut))
    at = np.arange(n) * own / rate
    base = np.floor(at).astype(np.int64)
    out, padded = np.zeros(n), np.pad(x.astype(np.float64), half + 1)
    for k in range(-half, half + 2):
        d = (base + k) - at
        out += padded[np.clip(base + k + half + 1, 0, len(padded) - 1)] * np.sinc(d * cut) * cut * np.where(np.abs(d) < half + 1, np.cos(np.pi * d / (2 * (half + 1))) ** 2, 0)
    return out.astype(np.float32)


def offset_window(offset: int, length: int | None, rate: int, own: int, frames: int) -> tuple[int, int, int]:
    """(first frame, frames to read, zeros to add) at the file's rate, of an offset and length at the target's."""
    first = min(frames, round(offset * own / rate))
    wanted = frames - first if length is None else round(length * own / rate)
    got = min(wanted, frames - first)
    return first, got, wanted - got


def decode_window(data: bytes, offset: int = 0, length: int | None = None, rate: int | None = None, channel: int | None = None) -> np.ndarray:
    """``length`` samples from ``offset`` on, both counted at the target rate, with zeros after the file's end; all that is left if length is None."""
    with wave.open(io.BytesIO(data)) as f:
        own, frames = f.getframerate(), f.getnframes()
    rate = own if rate is None else rate
    first, got, _ = offset_window(offset, length, rate, own, frames)
    x = resample(_samples(data, first, got, channel), own, rate) if own != rate else _samples(data, first, got, channel)
    if length is None:
        return x
    return np.pad(x[:length], (0, max(0, length - len(x))))


def decode_windows(rows: DataFrame, files: DataFrame, rate: int, path: str = "path", offset: str = "offset", length: str = "length", channel: int | None = None) -> DataFrame:
    """rows (path, offset, length, ...) with audio: array<float> of that many samples at ``rate``; files (path, content)."""

    @F.pandas_udf(ArrayType(FloatType()))
    def run(content: pd.Series, offsets: pd.Series, lengths: pd.Series) -> pd.Series:
        return pd.Series([decode_window(c, int(o), None if pd.isna(n) else int(n), rate, channel) for c, o, n in zip(content, offsets, lengths, strict=True)])

    held = files.select(F.col("path").alias(path), "content")
    return rows.join(held, path).withColumn("audio", run("content", offset, length)).drop("content")


def decode_slices(rows: DataFrame, files: DataFrame, rate: int, path: str = "source_wav_path") -> DataFrame:
    """rows (path, start, end, ...) with audio: array<float>; files (path, content).

    Rows meet their file by a join, so a file is read once for a partition of rows.
    Filter rows first: decoding comes last.
    """

    @F.pandas_udf(ArrayType(FloatType()))
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for content, start, end in batches:
            yield pd.Series([decode(c, s, e, rate) for c, s, e in zip(content, start, end, strict=True)])

    held = files.select(F.col("path").alias(path), "content")
    return rows.join(held, path).withColumn("audio", run("content", "start", "end")).drop("content")


def _filtered(x: np.ndarray, rate: int, kind: int, low: float, high: float) -> np.ndarray:
    """Without what lies outside (0: band pass, 2: high pass, 3: low pass) or inside (1: band stop) the band, by smooth edges in the spectrum."""
    f = np.fft.rfftfreq(len(x), 1 / rate)
    above, below = 1 / (1 + (low / np.maximum(f, 1e-9)) ** 8), 1 / (1 + (f / high) ** 8)
    gain = (above * below, 1 - above * below, above, below)[kind]
    return np.fft.irfft(np.fft.rfft(x) * gain, len(x))


def augment(rows: DataFrame, seed: int, column: str = "audio", key: str = "id", rate: int = 16_000, noises: list[list[float]] | None = None) -> DataFrame:
    """Peak-normalised audio with a gain, background noise (seven rows in ten, if any is given), coloured noise (one in five) and a band-pass, band-stop, high-pass or low-pass filter (one in five); keyed, so reruns agree.

    noises: a few recordings, as they are sent to all tasks, repeated to the length of each row.
    """
    beds = [np.asarray(n, dtype=np.float64) for n in noises or [] if len(n)]

    @F.pandas_udf(ArrayType(FloatType()))
    def run(audio: pd.Series, keys: pd.Series) -> pd.Series:
        out = []
        for a, k in zip(audio, keys, strict=True):
            x, rng = np.asarray(a, dtype=np.float64), np.random.default_rng([seed, int(k) & 0xFFFFFFFF])
            peak = np.abs(x).max(initial=0)
            x = x / peak if peak else x
            x = x * 10 ** (rng.uniform(-18, 6) / 20)
            if beds and rng.random() < 0.7 and len(x):
                bed = beds[rng.integers(len(beds))]
                x = x + _scaled(np.resize(np.roll(bed, -int(rng.integers(len(bed)))), len(x)), rng.uniform(3, 30), x)
            if rng.random() < 0.2 and len(x):
                spectrum = np.fft.rfft(rng.standard_normal(len(x))) / np.maximum(1, np.arange(len(x) // 2 + 1)) ** (rng.uniform(-2, 2) / 2)
                x = x + _scaled(np.fft.irfft(spectrum, len(x)), rng.uniform(3, 30), x)
            if rng.random() < 0.2 and len(x) > 1:
                low = rng.uniform(0.01, 0.2) * rate
                x = _filtered(x, rate, int(rng.integers(4)), low, min(rate / 2, low * rng.uniform(1.5, 4)))
            out.append(x.astype(np.float32))
        return pd.Series(out)

    return rows.withColumn(column, run(F.col(column), F.xxhash64(key)))


def _scaled(noise: np.ndarray, decibels: float, signal: np.ndarray) -> np.ndarray:
    """The noise, so many decibels below the signal."""
    power = np.sqrt((noise**2).mean())
    return noise / power * np.sqrt((signal**2).mean()) * 10 ** (-decibels / 20) if power else noise
