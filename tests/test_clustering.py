"""numpy kernels on planted clusters and on small hand-made graphs."""

import numpy as np
import pytest

from chorale.operators import clustering as c


def planted(k, each, d=16, noise=0.05, seed=0):
    rng = np.random.default_rng(seed)
    centres = np.linalg.qr(rng.normal(size=(d, d)))[0][:k]
    return np.concatenate([m + noise * rng.normal(size=(each, d)) for m in centres]), np.repeat(np.arange(k), each)


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def plain_agglomerate(x, threshold):
    clusters = [[i] for i in range(len(x))]
    while len(clusters) > 1:
        best = None
        for i in range(len(clusters)):
            for j in range(i + 1, len(clusters)):
                a, b = x[clusters[i]].mean(0), x[clusters[j]].mean(0)
                norm = np.linalg.norm(a) * np.linalg.norm(b)
                d = 1 - a @ b / norm if norm > 0 else 1.0
                if best is None or d < best[0] - 1e-12:
                    best = d, i, j
        if best[0] > threshold:
            break
        clusters[best[1]] += clusters.pop(best[2])
    labels = np.zeros(len(x), int)
    for n, members in enumerate(clusters):
        labels[members] = n
    return labels


def test_agglomerative_fixture():
    assert c.agglomerate(np.array([[1, 0], [0, 1], [1, 0.01]])).tolist() == [0, 1, 0]
    assert c.agglomerate(np.zeros((0, 2))).tolist() == [] and c.agglomerate(np.ones((1, 2))).tolist() == [0]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("threshold", [0.1, 0.4, 0.8, 1.2])
def test_agglomerative_equals_recomputed_centroids(seed, threshold):
    x = np.random.default_rng(seed).normal(size=(25, 5))
    assert c.agglomerate(x, threshold).tolist() == plain_agglomerate(x, threshold).tolist()


def test_planted_speakers_are_found():
    x, truth = planted(4, 30)
    w = c.affinity_of(x)
    p, k = c.estimate(w)
    assert k == 4
    assert same_partition(c.spectral_labels(c.graph_of(w, 12), k), truth)
    assert same_partition(c.agglomerate(x, 0.3), truth)
    labels, threshold, score = c.search_threshold(x)
    assert same_partition(labels, truth) and 0.1 <= threshold <= 0.5


def test_small_cases():
    assert c.affinity_of(np.zeros((0, 3))).shape == (0, 0) and c.affinity_of(np.ones((1, 3))).tolist() == [[1]]
    assert c.estimate(np.zeros((0, 0))) == (2, 1) and c.estimate(np.ones((1, 1)))[1] == 1
    assert c.p_candidates(8, 2) == [2] and c.p_candidates(100, 25) == list(range(2, 26))
    sparse = c.p_candidates(500, 125)
    assert len(sparse) == 30 and sparse[0] == 2 and sparse[-1] == 125 and c.p_candidates(9, 1, True) == [2]
    assert c.connected(np.zeros((0, 0))) and not c.connected(np.eye(2))
    with pytest.raises(ValueError):
        c.kmeans(np.ones((2, 1)), 3)


def test_connection_looks_one_behind():
    x, _ = planted(2, 6)
    w = c.affinity_of(x)
    joined = [p for p in range(2, 12) if c.connected(c.graph_of(w, p))]
    assert c.first_connected_after(w, list(range(2, 12))) == joined[0] + 1
    assert c.first_connected_after(w, [2, 3]) == 2


def test_silhouette():
    x = np.array([[1, 0], [1, 0.1], [0, 1.0]])
    assert c.silhouette_of(x, np.zeros(3, int)) == -1
    assert c.silhouette_of(x, np.array([0, 0, 1])) > 0.9
    assert np.isnan(c.silhouette_of(np.array([[1.0, 0], [1, 0], [1, 0]]), np.array([0, 0, 1])))


def test_per_recording(spark):
    x, truth = planted(3, 10)
    rows = [(r, i, v.tolist()) for r in ("a", "b") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "recording_id string, sub_idx long, vec array<double>")
    got = c.cluster_labels(df).orderBy("recording_id", "sub_idx").toPandas()
    for _, g in got.groupby("recording_id"):
        assert same_partition(g["label"].tolist(), truth.tolist())
    spectral = c.cluster_labels(df, method="spectral").groupBy("recording_id").agg({"label": "max"})
    assert {r[1] for r in spectral.collect()} == {2}
    assert {r["n_speakers"] for r in c.speaker_estimates(df).collect()} == {3}
    assert c.threshold_searches(df).count() == 60
    assert c.cluster_labels(df.limit(0)).count() == 0


def plain_search(x):
    """As a search should go that never takes a score that is no number."""
    best = None, 0.1, -np.inf
    for i in range(21):
        t = 0.1 + i * 0.02
        labels = c.agglomerate(x, t)
        score = c.silhouette_of(x, labels) - 0.05 * len(set(labels.tolist()))
        if score > best[2]:
            best = labels, t, score
    return best


def test_no_number_never_wins():
    pairs = np.array([[1, 0, 0], [1, 0.05, 0], [0, 1, 0], [0, 1, 0.05]], float)
    assert c.agglomerate(pairs).tolist() == [0, 0, 1, 1]
    for at in range(5):
        x = np.insert(pairs, at, np.nan, axis=0)
        expected = np.insert(np.array([0, 0, 1, 1]) + 0, at, 9)
        assert same_partition(c.agglomerate(x).tolist(), expected.tolist())
        labels, threshold, score = c.search_threshold(x)
        assert threshold == 0.1 and score == -np.inf and same_partition(labels.tolist(), expected.tolist())
    w = c.affinity_of(np.insert(pairs, 2, np.nan, axis=0))
    assert np.isfinite(np.delete(np.delete(w, 2, 0), 2, 1)).all() and c.estimate(w)[1] >= 1
    x, _ = planted(3, 9)
    labels, threshold, score = c.search_threshold(x)
    plain = plain_search(x)
    assert labels.tolist() == plain[0].tolist() and (threshold, score) == plain[1:]


def test_many_vectors_are_agglomerated_without_their_pairs(monkeypatch):
    monkeypatch.setattr(c, "_BLOCK", 7)
    x = np.random.default_rng(3).normal(size=(60, 4))
    assert c.agglomerate(x, 0.5).tolist() == plain_agglomerate(x, 0.5).tolist()


def test_spectral_labels_of_clear_clusters_with_copies():
    """Two of five clusters were one where no random start had a row in each (found on six copies of each vector)."""
    rng = np.random.default_rng(3)
    for seed in range(6):
        owner = np.repeat(np.arange(5), (30, 36, 42, 48, 60))
        graph = (rng.random((216, 216)) < np.where(owner[:, None] == owner, 0.8, 0.02)).astype(float)
        graph = (graph + graph.T) / 2
        labels = c.spectral_labels(graph, 5, trials=1, seed=seed)
        assert len(set(zip(labels, owner))) == 5


def test_threshold_search_holds_no_pairs():
    import tracemalloc

    x, owner = planted(5, 800)
    tracemalloc.start()
    labels, _, _ = c.search_threshold(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert same_partition(labels, owner) and peak < 4000 * 4000 * 8  # one matrix of all distances
    few, owner = planted(3, 6)
    distances = c.cosine_distances(few)
    means = np.array([[distances[i][(owner == k) & (np.arange(18) != i)].mean() for k in range(3)] for i in range(18)])
    inner = means[np.arange(18), owner]
    means[np.arange(18), owner] = np.inf
    assert c.silhouette_of(few, owner) == pytest.approx(((means.min(1) - inner) / np.maximum(means.min(1), inner)).mean(), abs=1e-12)


def test_many_vectors_are_labelled_without_their_affinity(monkeypatch):
    """Recordings of 10,000 vectors and more: all pairs as numbers took an executor's memory."""
    import tracemalloc

    import pandas as pd

    monkeypatch.setattr(c, "_CELLS", 1 << 18, raising=False)
    monkeypatch.setattr(c, "_per_recording", lambda *given: given[5])  # what is done with one recording
    monkeypatch.setattr(c, "_kind", lambda *_: "int")
    x, owner = planted(5, 640, 64)
    order = np.random.default_rng(1).permutation(3200)
    x, owner, rows = x[order], owner[order], pd.DataFrame({"recording_id": 0, "sub_idx": range(3200)})
    tracemalloc.start()
    labels = c.cluster_labels(None, method="spectral")(rows, x)["label"].tolist()
    counts = c.speaker_estimates(None)(rows, x)["n_speakers"].tolist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert same_partition(labels, owner) and counts == [5] and peak < 3200 * 3200 * 8 / 2  # half of one affinity


def test_sampled_affinity_is_that_of_the_whole():
    x, _ = planted(5, 240, 64)
    w, ratio = c.sampled_affinity(x)
    assert len(x) > c.DENSE and ratio == 2 and np.allclose(w, c.affinity_of(x)[::2, ::2], rtol=0, atol=1e-12)
    assert c.estimate_sampled(w, ratio) == c.estimate(c.affinity_of(x))


@pytest.mark.parametrize("in_memory", [0, 1 << 28])
def test_graph_of_bits_is_the_graph(monkeypatch, in_memory):
    monkeypatch.setattr(c, "_CELLS", 1000)
    monkeypatch.setattr(c, "_IN_MEMORY", in_memory)
    rng = np.random.default_rng(5)
    few = np.eye(4)[rng.integers(0, 4, 61)]  # many ties, and lengths without rounding
    holes = rng.normal(size=(61, 4))
    holes[[3, 40]], holes[50] = np.nan, 0
    for x in (few, holes, np.ones((61, 4))):
        for p in (2, 7, 60, 61, 99):
            expected = c.laplacian_of(c.graph_of(c.affinity_of(x), p))
            assert np.allclose(c.Neighbours(x, p).laplacian_times(np.eye(61)), expected, atol=1e-12)


def test_smallest_eigenvectors():
    rng = np.random.default_rng(2)
    sets = np.kron(np.eye(6), np.ones((20, 20)))  # six components: the eigenvalue 0 six times
    chain = (abs(np.subtract.outer(np.arange(300), np.arange(300))) <= 2).astype(float)  # small gaps, so many restarts
    full = (rng.random((90, 90)) < 0.5).astype(float)
    for graph in (sets, chain, full + full.T, np.zeros((9, 9)), np.ones((40, 40))):
        laplacian = c.laplacian_of(graph)
        exact = np.linalg.eigvalsh(laplacian)
        for k in (1, 2, 5, 8):
            got = c.smallest_eigenvectors(lambda v, m=laplacian: m @ v, len(graph), k, 2 * max(graph.sum(1).max(), 1))
            assert got.shape == (len(graph), k) and np.allclose(got.T @ got, np.eye(k), atol=1e-8)
            assert np.allclose(np.diag(got.T @ laplacian @ got), exact[:k], atol=1e-6)
            assert np.abs(laplacian @ got - got * exact[:k]).max() < 1e-5
