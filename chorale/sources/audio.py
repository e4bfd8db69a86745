"""WAV files as rows: a binary-file scan, decoded and turned into log-mel frames by numpy in Arrow batches."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SAMPLE_RATE
from ..schemas import AUDIO, MEL
from ..shipping import ship

# Fixed values of the features.
N_FFT, N_MELS, FRAME_SECONDS, HOP_SECONDS, LOG_FLOOR, DITHER = 512, 80, 0.025, 0.010, 1e-9, 1e-5


#: WAV files, whatever the case of their ending.
ANY_WAV = "*.[wW][aA][vV]"


def list_recordings(spark: SparkSession, path: str, pattern: str = ANY_WAV, limit: int | None = None) -> DataFrame:
    """(recording_id, path, content) of the WAV files under a folder (or one file), the first ``limit`` by path.

    The id is the file's name without its ending.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not path.lower().endswith(".wav") and files.exists(at) and files.getFileStatus(at).isFile():
        raise ValueError("only .wav files can be read")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    files = files.where(F.lower("path").endswith(".wav"))
    if limit is not None:
        # The names decide, so only the chosen files are opened; and Spark would make a task of every few names.
        address = F.col("_metadata.file_path")
        names = files.select("path", address.alias("address")).coalesce(int(spark.conf.get("spark.sql.shuffle.partitions")))
        files = files.where(address.isin([r["address"] for r in names.orderBy("path").limit(limit).collect()]))
    named = files.select(F.regexp_extract("path", r"([^/]*)[.][^./]*$", 1).alias("recording_id"), "path", "content")
    return named


def contents(rows: DataFrame, key: str, column: str, make: Callable[..., bytes]) -> DataFrame:
    """(key, content): the file that ``make`` builds from a row's column.

    Every file goes on by itself: those of a whole batch of rows can exceed a worker's memory, and what one Arrow array holds.
    Rows are dealt anew, as they are small beside their files and Spark would put very many in one task.
    """
    spark = rows.sparkSession
    ship(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                name, value = batch.column(0).slice(at, 1), batch.column(1)[at].as_py()
                yield pa.RecordBatch.from_arrays([name, pa.array([make(value)], pa.binary())], [key, "content"])

    dealt = rows.select(key, column).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dealt.mapInArrow(work, f"`{key}` {rows.schema[key].dataType.simpleString()}, content binary")


def decode_wav(content: bytes, rate: int = SAMPLE_RATE) -> np.ndarray:
    """PCM samples as mono floats in -1..1 at the rate; more than two channels are refused."""
    with wave.open(io.BytesIO(content)) as w:
        channels, width, source, n = w.getnchannels(), w.getsampwidth(), w.getframerate(), w.getnframes()
        raw = w.readframes(n)
    if channels > 2:
        raise ValueError("only mono and stereo can be read")
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / (1 << (8 * width - 1))
    x = x.reshape(-1, channels)
    return resample(x, source, rate).mean(1).astype(np.float32)


def resample(x: np.ndarray, source: int, target: int, taps: int = 16) -> np.ndarray:
    """Band-limited interpolation of (frames, channels) with a Hann-windowed sinc, in blocks."""
    if source == target or not len(x):
        return x
    ratio = target / source
    cut = min(1.0, ratio)
    half = int(np.ceil(taps / cut))
    n = int(len(x) * ratio)
    out = np.empty((n, x.shape[1]), np.float32)
    for at in range(0, n, 1 << 16):
        where = np.arange(at, min(n, at + (1 << 16))) / ratio
        idx = np.floor(where).astype(int)[:, None] + np.arange(-half + 1, half + 1)
        distance = where[:, None] - idx
        kernel = cut * np.sinc(cut * distance) * (0.5 + 0.5 * np.cos(np.pi * np.clip(distance / half, -1, 1)))
        out[at : at + len(where)] = np.einsum("ik,ikc->ic", kernel, x[np.clip(idx, 0, len(x) - 1)])
    return out


@cache
def mel_filters(rate: int = SAMPLE_RATE, n_fft: int = N_FFT, n_mels: int = N_MELS) -> np.ndarray:
    """Triangular filters evenly spaced on the mel scale 2595 log10(1 + f / 700), from 0 to half the rate."""
    top = 2595 * np.log10(1 + rate / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, n_mels + 2) / 2595) - 1)
    f = np.linspace(0, rate / 2, n_fft // 2 + 1)
    rise = (f - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    fall = (edges[2:, None] - f) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(rise, fall))


def log_mel(samples: np.ndarray, rate: int = SAMPLE_RATE, normalise: bool = False, dither: float = DITHER, seed: int = 0) -> np.ndarray:
    """Log10 power in mel bands per frame (frames, bands); ``normalise`` scales each band over the recording."""
    size, hop = int(rate * FRAME_SECONDS), int(rate * HOP_SECONDS)
    if len(samples) < size:
        return np.zeros((0, N_MELS), np.float32)
    x = samples.astype(np.float64)
    if dither:
        x = x + np.random.default_rng(seed).uniform(-dither, dither, len(x))
    frames = np.lib.stride_tricks.sliding_window_view(x, size)[::hop]
    window, filters = np.hanning(size + 1)[:-1], mel_filters(rate).T
    out = np.empty((len(frames), N_MELS))
    for at in range(0, len(frames), 4096):
        power = np.abs(np.fft.rfft(frames[at : at + 4096] * window, N_FFT)) ** 2
        out[at : at + 4096] = np.log10(np.maximum(power @ filters, LOG_FLOOR))
    if normalise:
        out = (out - out.mean(0)) / np.sqrt(out.var(0) + 1e-12)
    return out.astype(np.float32)


def decoded(recordings: DataFrame, rate: int = SAMPLE_RATE) -> DataFrame:
    """One row of samples per recording."""
    ship(recordings.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                samples = pa.array(decode_wav(batch.column(1)[at].as_py(), rate))
                listed = pa.ListArray.from_arrays(pa.array([0, len(samples)], pa.int32()), samples)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), pa.array([rate], pa.int32()), listed], ["recording_id", "sample_rate", "samples"])

    return recordings.select("recording_id", "content").mapInArrow(work, AUDIO)


def mel_frames(recordings: DataFrame, normalise: bool = False) -> DataFrame:
    """One row per frame; decoding and features share a task, so samples are never shuffled."""
    ship(recordings.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                mel = log_mel(decode_wav(batch.column(1)[row].as_py()), normalise=normalise)
                for at in range(0, len(mel), 4096):
                    part = mel[at : at + 4096]
                    name = pa.array([batch.column(0)[row].as_py()] * len(part), pa.string())
                    feats = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * N_MELS), pa.array(part.ravel()))
                    yield pa.RecordBatch.from_arrays([name, pa.array(np.arange(at, at + len(part))), feats], ["recording_id", "frame_idx", "feats"])

    return recordings.select("recording_id", "content").mapInArrow(work, MEL)
