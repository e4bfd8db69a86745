"""Scorers of speech and of speakers: ONNX files where given, else deterministic stand-ins."""

from __future__ import annotations

import os
from typing import Protocol

import numpy as np
from pyspark.sql import SparkSession


class VadScorer(Protocol):
    def speech(self, windows: np.ndarray) -> np.ndarray:
        """Windows (batch, bands, frames) to probabilities (batch, frames) or (batch, 1)."""


class Embedder(Protocol):
    def embed(self, windows: np.ndarray) -> np.ndarray:
        """Windows (batch, bands, frames) to vectors (batch, size)."""


class EnergyVad:
    """Speech where the mean log energy of a frame is above a level."""

    def __init__(self, level: float = -6.0, slope: float = 4.0):
        self.level, self.slope = level, slope

    def speech(self, windows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.slope * (windows.mean(1) - self.level)))


class PooledEmbedder:
    """Mean and deviation of each band over the window."""

    def embed(self, windows: np.ndarray) -> np.ndarray:
        return np.concatenate([windows.mean(2), windows.std(2)], 1)


_SESSIONS: dict[str, object] = {}


def distribute(spark: SparkSession, path: str) -> str:
    """Send a model file (of any file system that Spark knows) to all executors; the name that the scorers find it by."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


def _session(path: str):
    """One session per Python worker and file: a path, or the name of a distributed file."""
    if path not in _SESSIONS:
        import onnxruntime
        from pyspark import SparkFiles

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = 1
        at = path if "/" in path or os.path.exists(path) else SparkFiles.get(path)
        _SESSIONS[path] = onnxruntime.InferenceSession(at, options, providers=["CPUExecutionProvider"])
    return _SESSIONS[path]


def describe_model(path: str) -> list[tuple[str, list, str]]:
    """Name, shape and type of each input."""
    return [(i.name, i.shape, i.type) for i in _session(path).get_inputs()]


def _batched(session) -> bool:
    """Whether the model takes many windows at once: its first dimension is no fixed number."""
    return not isinstance(session.get_inputs()[0].shape[0], int)


def _feeds(windows: np.ndarray) -> dict[str, np.ndarray]:
    return {"audio_signal": np.ascontiguousarray(windows, np.float32), "length": np.full(len(windows), windows.shape[2], np.int64)}


def speech_of_logits(logits: np.ndarray) -> np.ndarray:
    """Two-class logits (frames, 2), or the same with a batch of one, to probabilities of the second class."""
    if logits.ndim == 3 and logits.shape[0] == 1:
        logits = logits[0]
    if logits.ndim != 2 or logits.shape[1] != 2:
        raise ValueError(f"the model must return (frames, 2) or (1, frames, 2), not {logits.shape}")
    return 1 / (1 + np.exp(logits[:, 0] - logits[:, 1]))


class OnnxVad:
    def __init__(self, path: str):
        self.path = path

    def speech(self, windows: np.ndarray) -> np.ndarray:
        """All windows in one call where the model allows it and answers with (batch, frames, 2) or (batch, 2)."""
        session = _session(self.path)
        if _batched(session):
            logits = session.run(None, _feeds(windows))[0]
            logits = logits[:, None] if logits.ndim == 2 else logits
            if logits.ndim != 3 or logits.shape[0] != len(windows) or logits.shape[2] != 2:
                raise ValueError(f"the model must return (batch, frames, 2) or (batch, 2), not {logits.shape}")
            return 1 / (1 + np.exp(logits[:, :, 0] - logits[:, :, 1]))
        return np.stack([speech_of_logits(session.run(None, _feeds(w[None]))[0]) for w in windows])


class OnnxEmbedder:
    def __init__(self, path: str):
        self.path = path

    def embed(self, windows: np.ndarray) -> np.ndarray:
        """The last output is the vector of each window; all windows go in one call where the model allows it."""
        session = _session(self.path)
        parts = [windows] if _batched(session) else [w[None] for w in windows]
        found = [session.run(None, _feeds(part))[-1] for part in parts]
        for part, vectors in zip(parts, found):
            if vectors.ndim != 2 or len(vectors) != len(part):
                raise ValueError(f"the model must return (batch, size), not {vectors.shape}")
        return np.concatenate(found)


def sliding_speech(mel: np.ndarray, scorer: VadScorer, window: int = 63, shift: int = 1, smoothing: str = "none", overlap: float = 0.5) -> np.ndarray:
    """Speech probability per frame from full windows only; a recording shorter than a window has zeros.

    Without smoothing every frame has the mean over the windows that cover it.  With it, every so many windows stand for
    ``window`` + 1 frames by their mean score, and a frame takes the mean or the upper median of those.
    """
    n = len(mel)
    if n < window:
        return np.zeros(n)
    views = np.lib.stride_tricks.sliding_window_view(mel, window, axis=0)[::shift]  # (windows, bands, frames)
    total, count, means = np.zeros(n), np.zeros(n), []
    for at in range(0, len(views), 512):
        scores = scorer.speech(views[at : at + 512])
        scores = np.broadcast_to(scores, (len(scores), window)) if scores.shape[1] == 1 else scores
        means.append(scores.mean(1))
        starts = np.arange(at, at + len(scores)) * shift
        for k in range(scores.shape[1]):
            inside = starts + k < n
            np.add.at(total, starts[inside] + k, scores[inside, k])
            np.add.at(count, starts[inside] + k, 1)
    if smoothing == "none":
        return np.divide(total, count, out=np.zeros(n), where=count > 0)
    from ..operators.ordered import jump_of

    means = np.concatenate(means)
    jump, size = jump_of(window, overlap, shift), window + 1
    covering: list[list[float]] = [[] for _ in range(n)]
    for i in range(0, len(means), jump):
        for j in range(i * shift, min(i * shift + size, n)):
            covering[j].append(means[i])
    out, last = np.zeros(n), 0.0
    for j, values in enumerate(covering):
        if values:
            last = float(np.mean(values)) if smoothing == "mean" else sorted(values)[len(values) // 2]
        out[j] = last
    return out


def embed_scales(mel: np.ndarray, embedder: Embedder, windows: tuple[int, ...], shifts: tuple[int, ...], weights: tuple[float, ...]) -> np.ndarray:
    """The weighted mean over scales of the mean vector of a sub-segment's windows; a short one is padded by its last frame."""
    vectors = []
    for win, shift in zip(windows, shifts):
        padded = mel if len(mel) >= win else np.concatenate([mel, np.repeat(mel[-1:], win - len(mel), 0)])
        views = np.lib.stride_tricks.sliding_window_view(padded, win, axis=0)[::shift]
        vectors.append(embedder.embed(views).mean(0))
    total = sum(weights)
    mixed = sum(w * v for w, v in zip(weights, vectors))
    return mixed / total if total > 0 else mixed
