"""Clustering of the vectors of one recording at a time, with numpy, inside ``applyInPandas``.

Recordings are independent, so they run in parallel; inside one, distances are matrix products, and merging keeps
running sums of members in place of recomputed centroids.  Neither method holds a recording's pairs as numbers: the agglomerative one
holds the vectors only, the spectral one a bit for each pair of a large recording, in a file where there are many.
"""

from __future__ import annotations

import tempfile
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship

EPS = 1e-10
#: The value of the affinity subsampling, and the share of rows and number of tries in the search for p.
SAMPLE_SIZE, MAX_SHARE, SEARCH_VOLUME = 512, 0.25, 30
#: Rows of distances that agglomeration makes at once.
_BLOCK = 512
#: Vectors of one recording up to which the spectral method holds the affinity and finds all eigenvectors.
DENSE = 1_024
#: Numbers of an affinity that are made at once beyond that, and bytes of graph from which it is in a file.
_CELLS, _IN_MEMORY = 1 << 21, 1 << 28
#: The residual of an eigenvector, as a share of the largest eigenvalue's bound.
_RESIDUAL = 1e-9


def cosine_distances(x: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(x, axis=1)
    safe = np.where(lengths > 0, lengths, 1.0)
    d = 1.0 - (x / safe[:, None]) @ (x / safe[:, None]).T
    d[lengths == 0] = 1.0
    d[:, lengths == 0] = 1.0
    return d


def _nan_last(values: np.ndarray) -> np.ndarray:
    """NaN never wins: it counts as the largest."""
    return np.where(np.isnan(values), np.inf, values)


def merges_of(x: np.ndarray, threshold: float = 0.3) -> list[tuple[int, int, float]]:
    """The merges (i, j, distance) in order, of which j goes into i.  Centroid linkage by cosine distance: the closest pair (first of ties) merges while within the threshold.

    A cluster's direction is that of its members' sum.  Of the distances only each cluster's nearest later one is kept, so memory
    grows with the vectors and not with their pairs; a row is computed again where a merge may have changed it.  A distance
    that is no number never wins, so the other vectors still merge.
    """
    n, merges = len(x), []
    if n <= 1:
        return merges
    sums = x.astype(float).copy()
    lengths = np.linalg.norm(sums, axis=1)
    alive = np.ones(n, bool)
    nearest, closest = np.zeros(n, int), np.full(n, np.inf)

    def distances(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        dots, norms = sums[rows] @ sums[columns].T, lengths[rows][:, None] * lengths[columns][None]
        return _nan_last(np.where(norms <= 0, 1.0, 1.0 - dots / np.where(norms > 0, norms, 1.0)))

    def refresh(rows: np.ndarray) -> None:
        for at in range(0, len(rows), _BLOCK):
            part = rows[at : at + _BLOCK]
            later = np.flatnonzero(alive)
            later = later[later > part[0]]
            if not len(later):
                closest[part] = np.inf
                continue
            d = np.where(later[None] > part[:, None], distances(part, later), np.inf)
            best = d.argmin(1)
            nearest[part], closest[part] = later[best], d[np.arange(len(part)), best]

    refresh(np.arange(n))
    while True:
        i = int(closest.argmin())
        if not closest[i] <= threshold:
            break
        j = int(nearest[i])
        merges.append((i, j, float(closest[i])))
        sums[i] += sums[j]
        lengths[i] = np.linalg.norm(sums[i])
        alive[j], closest[j] = False, np.inf
        stale = alive & ((nearest == i) | (nearest == j)) & np.isfinite(closest)
        stale[i] = True
        refresh(np.flatnonzero(stale))
        # Rows before i may have become closer to it.
        before = np.flatnonzero(alive[:i] & ~stale[:i])
        if len(before):
            d = distances(before, np.array([i]))[:, 0]
            won = (d < closest[before]) | ((d == closest[before]) & np.isfinite(d) & (i < nearest[before]))
            nearest[before[won]], closest[before[won]] = i, d[won]
    return merges


def labels_after(n: int, merges: list[tuple[int, int, float]], threshold: float) -> np.ndarray:
    """Labels of n vectors by the merges before the first one beyond the threshold; they number clusters by their smallest member."""
    owner = np.arange(n)
    for i, j, d in merges:
        if not d <= threshold:
            break
        owner[j] = i
    while (owner[owner] != owner).any():
        owner = owner[owner]
    return np.unique(owner, return_inverse=True)[1]


def agglomerate(x: np.ndarray, threshold: float = 0.3) -> np.ndarray:
    """Labels by centroid linkage within a threshold."""
    return labels_after(len(x), merges_of(x, threshold), threshold)


def affinity_of(x: np.ndarray) -> np.ndarray:
    n = len(x)
    if n <= 1:
        return np.ones((n, n))
    u = x / (np.linalg.norm(x, axis=1, keepdims=True) + EPS)
    w = u @ u.T
    np.fill_diagonal(w, 1.0)
    low, span = np.nanmin(w), np.nanmax(w) - np.nanmin(w)
    return np.ones((n, n)) if span < 1e-12 else (w - low) / span


def affinity_rows(x: np.ndarray, scaled: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of ``affinity_of``, some at a time, each with the number of its first."""
    n = len(x)
    u = x / (np.linalg.norm(x, axis=1, keepdims=True) + EPS)
    low, span = affinity_range(x) if scaled else (0.0, 1.0)
    step = max(1, _CELLS // max(1, n))
    for at in range(0, n, step):
        w = u[at : at + step] @ u.T
        w[np.arange(len(w)), at + np.arange(len(w))] = 1.0
        if scaled:
            w = np.ones_like(w) if span < 1e-12 else (w - low) / span
        yield at, w


def affinity_range(x: np.ndarray) -> tuple[float, float]:
    """The least cosine of all pairs, and how far the largest lies above it."""
    low, high = np.inf, -np.inf
    for _, w in affinity_rows(x, scaled=False):
        low, high = min(low, np.nanmin(w)), max(high, np.nanmax(w))
    return float(low), float(high - low)


def sampled_affinity(x: np.ndarray, size: int = SAMPLE_SIZE) -> tuple[np.ndarray, int]:
    """``affinity_of`` in the rows and columns that ``estimate`` looks at, and the step between them."""
    ratio = subsampling(len(x), size)
    if len(x) <= DENSE:
        return affinity_of(x)[::ratio, ::ratio], ratio
    u = x / (np.linalg.norm(x, axis=1, keepdims=True) + EPS)
    w = u[::ratio] @ u[::ratio].T
    np.fill_diagonal(w, 1.0)
    low, span = affinity_range(x)
    return np.ones_like(w) if span < 1e-12 else (w - low) / span, ratio


class Neighbours:
    """The graph that ``graph_of`` makes of ``affinity_of``, as a bit for each pair.  It is multiplied by blocks of rows."""

    def __init__(self, x: np.ndarray, p: int) -> None:
        self.n, p = len(x), min(p, len(x))
        shape = self.n, (self.n + 7) // 8
        self.file = tempfile.TemporaryFile() if shape[0] * shape[1] > _IN_MEMORY else None
        self.bits = np.empty(shape, np.uint8) if self.file is None else np.memmap(self.file, np.uint8, "w+", shape=shape)
        chosen_by = np.zeros(self.n)
        for at, w in affinity_rows(x):
            w[np.isnan(w)] = -np.inf
            cut = np.partition(w, self.n - p, axis=1)[:, self.n - p, None]
            chosen, tied = w > cut, w == cut
            chosen |= tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= p - chosen.sum(1, keepdims=True))
            chosen_by += chosen.sum(0)
            self.bits[at : at + len(w)] = np.packbits(chosen, axis=1)
        self.degrees = (p + chosen_by) / 2

    def laplacian_times(self, v: np.ndarray) -> np.ndarray:
        """Loops take nothing from the product: they count in the degree too."""
        ahead, back = np.empty_like(v), np.zeros_like(v)
        step = max(1, _CELLS // self.n)
        for at in range(0, self.n, step):
            chosen = np.unpackbits(self.bits[at : at + step], axis=1, count=self.n).astype(float)
            ahead[at : at + step] = chosen @ v
            back += chosen.T @ v[at : at + step]
        return self.degrees[:, None] * v - (ahead + back) / 2


def smallest_eigenvectors(times: Callable[[np.ndarray], np.ndarray], n: int, k: int, bound: float, seed: int = 0) -> np.ndarray:
    """The eigenvectors of the k smallest eigenvalues of a symmetric matrix that is known by its products; ``bound``: of its eigenvalues.

    A block Krylov method.  The block has more columns than are asked for, so equal eigenvalues are all found.  It goes on until the residuals
    are small; each restart gets a larger space, which in the end is the whole one.
    """
    width, small = min(n, k + 4), _RESIDUAL * bound
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, width)))[0]
    basis, images, room = np.empty((n, 0)), np.empty((n, 0)), 8 * width
    while True:
        basis, images = np.hstack([basis, block]), np.hstack([images, times(block)])
        inner = basis.T @ images
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        found = basis @ turn[:, :k]
        residuals = np.linalg.norm(images @ turn[:, :k] - found * values[:k], axis=0)
        if (residuals <= small).all() or basis.shape[1] >= n:
            return found
        block = _beside(basis, images[:, -block.shape[1] :], 1e-3 * small)
        if not block.shape[1]:  # nothing new, though not all residuals are small: go on at random
            block = _beside(basis, np.random.default_rng(seed + basis.shape[1]).normal(size=(n, min(width, n - basis.shape[1]))), 0.0)
        if basis.shape[1] + block.shape[1] > room:
            basis, images, room = basis @ turn[:, : room // 2], images @ turn[:, : room // 2], room + 2 * width


def _beside(basis: np.ndarray, fresh: np.ndarray, least: float) -> np.ndarray:
    """An orthonormal basis of what ``fresh`` adds to another one; directions shorter than ``least`` are nothing."""
    for _ in range(2):
        fresh = fresh - basis @ (basis.T @ fresh)
    u, sizes, _ = np.linalg.svd(fresh, full_matrices=False)
    u = u[:, sizes > least]
    u = u - basis @ (basis.T @ u)
    return np.linalg.qr(u)[0]


def graph_of(w: np.ndarray, p: int) -> np.ndarray:
    """The symmetrised graph of the p strongest of each row; ties go to the lower index."""
    chosen = np.zeros_like(w)
    np.put_along_axis(chosen, np.argsort(-w, axis=1, kind="stable")[:, :p], 1.0, axis=1)
    return (chosen + chosen.T) / 2


def laplacian_of(graph: np.ndarray) -> np.ndarray:
    off = graph - np.diag(np.diag(graph))
    return np.diag(off.sum(1)) - off


def speaker_count(graph: np.ndarray, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of clusters by the largest eigengap (first of ties), the eigenvalues and their gaps."""
    values = np.linalg.eigvalsh(laplacian_of(graph))
    gaps = np.diff(values)
    return (int(_nan_last(-gaps[:most]).argmin()) + 1 if len(gaps[:most]) else 1), values, gaps


def connected(graph: np.ndarray) -> bool:
    if not len(graph):
        return True
    reached = np.zeros(len(graph), bool)
    reached[0], front = True, np.array([0])
    while len(front):
        front = np.flatnonzero((graph[front] > 0).any(0) & ~reached)
        reached[front] = True
    return bool(reached.all())


def p_candidates(n: int, largest: int, fixed: bool = False, volume: int = SEARCH_VOLUME) -> list[int]:
    """All p from 2 to the largest, or about ``volume`` of them evenly spaced."""
    if fixed:
        return [max(2, largest)]
    if largest <= volume:
        return list(range(2, largest + 1)) or [2]
    spaced = 1 + np.rint(np.arange(volume) * (largest - 1) / (volume - 1)).astype(int)
    return sorted(set(np.maximum(spaced, 2).tolist()))


def first_connected_after(w: np.ndarray, candidates: list[int]) -> int:
    """The candidate that follows the first connected one (p = 2 counts as preceding the first); 2 if there is none.

    This look-behind is part of the method's observable results and is kept.
    """
    before = [2, *candidates[:-1]]
    return next((p for previous, p in zip(before, candidates) if connected(graph_of(w, previous))), 2)


def subsampling(n: int, size: int = SAMPLE_SIZE) -> int:
    """The step between the vectors that the search for p looks at."""
    return max(1, n // size) if n > size else 1


def estimate(w: np.ndarray, max_speakers: int = 8, share: float = MAX_SHARE, volume: int = SEARCH_VOLUME, size: int = SAMPLE_SIZE, fixed: float = -1.0, majority: bool = False) -> tuple[int, int]:
    """(p, number of speakers) by the smallest ratio of p to the normalised largest eigengap."""
    ratio = subsampling(len(w), size)
    return estimate_sampled(w[::ratio, ::ratio], ratio, max_speakers, share, volume, fixed, majority)


def estimate_sampled(w: np.ndarray, ratio: int, max_speakers: int = 8, share: float = MAX_SHARE, volume: int = SEARCH_VOLUME, fixed: float = -1.0, majority: bool = False) -> tuple[int, int]:
    """``estimate`` on what was subsampled already."""
    if not len(w):
        return 2, 1
    n = len(w)
    candidates = p_candidates(n, max(2, int(n * (fixed if fixed > 0 else share))), fixed > 0, volume)
    ratios, counts = [], []
    for p in candidates:
        k, values, gaps = speaker_count(graph_of(w, p), max_speakers)
        widest = gaps[:max_speakers].max() if len(gaps) else 0.0
        ratios.append((p / n) / (widest / (values.max() + EPS) + EPS))
        counts.append(k)
    at = int(np.argmin(_nan_last(np.array(ratios))))
    p = candidates[at]
    if not connected(graph_of(w, p)):
        p = first_connected_after(w, candidates)
    if majority:
        tally = Counter(counts)
        return max(2, p * ratio), min(tally, key=lambda k: (-tally[k], k))
    return max(2, p * ratio), counts[at]


def spread_start(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """k rows: a random one, then each with a chance in proportion to its squared distance from those before (k-means++)."""
    rng = np.random.default_rng(seed)
    rows = [int(rng.integers(len(x)))]
    apart = np.full(len(x), np.inf)
    while len(rows) < k:
        apart = np.minimum(apart, ((x - x[rows[-1]]) ** 2).sum(1))
        total = apart.sum()
        rows.append(int(rng.choice(len(x), p=apart / total if total > 0 else None)))
    return x[rows].astype(float)


def kmeans(x: np.ndarray, k: int, max_iter: int = 100, seed: int = 0, start: np.ndarray | None = None) -> np.ndarray:
    """Lloyd's rounds from ``start`` or distinct random rows; ties go to the lower cluster, an empty one moves to the origin."""
    n = len(x)
    if not 1 <= k <= n:
        raise ValueError(f"k must lie between 1 and {n}")
    centres = x[np.random.default_rng(seed).choice(n, k, replace=False)].astype(float) if start is None else start
    labels = np.zeros(n, int)
    for _ in range(max_iter):
        found = ((x[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        if (found == labels).all():
            break
        labels = found
        members = np.eye(k)[labels]
        centres = (members.T @ x) / np.maximum(members.sum(0), 1)[:, None]
    return labels


def spectral_labels(graph: np.ndarray, k: int, trials: int = 10, seed: int = 0) -> np.ndarray:
    """k-means on the eigenvectors of the k smallest eigenvalues of the Laplacian; the tightest of some trials.

    Random rows seldom start with one in each cluster, and Lloyd's rounds do not leave a cluster that was cut in two; so starts are spread.
    """
    if len(graph) <= 1:
        return np.zeros(len(graph), int)
    k = min(k, len(graph))
    return tightest(np.linalg.eigh(laplacian_of(graph))[1][:, :k], k, trials, seed)


def spectral(x: np.ndarray, max_speakers: int = 8) -> np.ndarray:
    """Labels of vectors by the spectral method; those of many without their affinity as a whole."""
    if len(x) <= DENSE:
        w = affinity_of(x)
        p, k = estimate(w, max_speakers)
        return spectral_labels(graph_of(w, p), k)
    p, k = estimate_sampled(*sampled_affinity(x), max_speakers)
    if k == 1:
        return np.zeros(len(x), int)
    graph = Neighbours(x, p)
    return tightest(smallest_eigenvectors(graph.laplacian_times, len(x), k, 2 * graph.degrees.max()), k)


def tightest(x: np.ndarray, k: int, trials: int = 10, seed: int = 0) -> np.ndarray:
    """The labels with the least squares of some trials of k-means."""

    def spread(labels: np.ndarray) -> float:
        members = np.eye(k)[labels]
        centres = (members.T @ x) / np.maximum(members.sum(0), 1)[:, None]
        return float(((x - centres[labels]) ** 2).sum())

    return min((kmeans(x, k, start=spread_start(x, k, seed + t)) for t in range(max(1, trials))), key=spread)


def silhouette_of(x: np.ndarray, labels: np.ndarray) -> float:
    """The mean silhouette by cosine distance.  The mean distance of a unit u to n others with the sum S is 1 - u S / n, so no pairs
    are held; blocks of rows meet all clusters, which can be as many as the rows.  A vector without length is at 1 from all."""
    names, own, sizes = np.unique(labels, return_inverse=True, return_counts=True)
    if len(names) <= 1:
        return -1.0
    lengths = np.linalg.norm(x, axis=1, keepdims=True)
    units = x / np.where(lengths == 0, 1.0, lengths)
    sums = np.zeros((len(names), x.shape[1]))
    np.add.at(sums, own, units)
    scores = np.empty(len(x))
    for at in range(0, len(x), _BLOCK):
        u, mine = units[at : at + _BLOCK], own[at : at + _BLOCK]
        along, rows, n = u @ sums.T, np.arange(len(u)), sizes[mine]
        inner = np.where(n > 1, 1 - (along[rows, mine] - (u * u).sum(1)) / np.maximum(n - 1, 1), 0.0)
        outer = 1 - along / sizes
        outer[rows, mine] = np.inf
        nearest = _nan_last(outer).min(1)
        nearest = np.where(np.isinf(nearest), 0.0, nearest)
        with np.errstate(invalid="ignore", divide="ignore"):
            scores[at : at + _BLOCK] = (nearest - inner) / np.maximum(nearest, inner)
    return float(scores.mean())


def search_threshold(x: np.ndarray, low: float = 0.10, high: float = 0.50, step: float = 0.02, penalty: float = 0.05) -> tuple[np.ndarray, float, float]:
    """Labels, threshold and score of the best silhouette less a penalty per cluster, over evenly spaced thresholds.

    A score that is no number never wins; without any other the result is that of the lowest threshold, scored minus infinity.
    """
    if len(x) <= 1:
        return agglomerate(x, high), high, 0.0
    best = None, low, -np.inf
    merges = merges_of(x, high + step / 2)  # those of every threshold, each of which takes the first so many
    for i in range(int(round((high - low) / step)) + 1):
        threshold = low + i * step
        labels = labels_after(len(x), merges, threshold)
        score = silhouette_of(x, labels) - penalty * len(set(labels.tolist()))
        if score > best[2]:
            best = labels, threshold, score
    return best if best[0] is not None else (agglomerate(x, low), low, -np.inf)


def _per_recording(vectors: DataFrame, key: str, idx: str, vec: str, schema: str, work) -> DataFrame:
    """``work`` on each recording's rows in order."""
    ship(vectors.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(idx, kind="stable")
        return work(pdf, np.array(pdf[vec].tolist(), float))

    return vectors.select(F.col(key), F.col(idx), F.col(vec)).groupBy(key).applyInPandas(run, schema)


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def cluster_labels(vectors: DataFrame, key: str = "recording_id", idx: str = "sub_idx", vec: str = "vec", method: str = "agglomerative", threshold: float = 0.3, max_speakers: int = 8) -> DataFrame:
    """(key, idx, label) per vector, by the agglomerative or the spectral method."""

    def work(pdf: pd.DataFrame, x: np.ndarray) -> pd.DataFrame:
        labels = agglomerate(x, threshold) if method == "agglomerative" else spectral(x, max_speakers)
        return pd.DataFrame({key: pdf[key], idx: pdf[idx], "label": labels})

    return _per_recording(vectors, key, idx, vec, f"`{key}` {_kind(vectors, key)}, `{idx}` {_kind(vectors, idx)}, label int", work)


def speaker_estimates(vectors: DataFrame, key: str = "recording_id", idx: str = "sub_idx", vec: str = "vec", max_speakers: int = 8) -> DataFrame:
    """(key, p, n_speakers) per recording."""

    def work(pdf: pd.DataFrame, x: np.ndarray) -> pd.DataFrame:
        p, k = estimate_sampled(*sampled_affinity(x), max_speakers)
        return pd.DataFrame({key: pdf[key].iloc[:1], "p": [p], "n_speakers": [k]})

    return _per_recording(vectors, key, idx, vec, f"`{key}` {_kind(vectors, key)}, p int, n_speakers int", work)


def threshold_searches(vectors: DataFrame, key: str = "recording_id", idx: str = "sub_idx", vec: str = "vec") -> DataFrame:
    """(key, idx, label, threshold, score) with the best threshold of each recording."""

    def work(pdf: pd.DataFrame, x: np.ndarray) -> pd.DataFrame:
        labels, threshold, score = search_threshold(x)
        return pd.DataFrame({key: pdf[key], idx: pdf[idx], "label": labels, "threshold": threshold, "score": score})

    return _per_recording(vectors, key, idx, vec, f"`{key}` {_kind(vectors, key)}, `{idx}` {_kind(vectors, idx)}, label int, threshold double, score double", work)
