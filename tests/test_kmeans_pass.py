import numpy as np
import pyarrow as pa
import pytest

from termloom.functions import kernels as K
from termloom.operators import kmeans


def packed(x):
    lists = pa.array([v.tolist() for v in x], pa.list_(pa.float64()))
    return list(K.to_bits([pa.RecordBatch.from_arrays([lists], ["vec"])]))


def test_bits_keep_the_vectors():
    x = np.random.default_rng(0).normal(size=(7, 3))
    bits = packed(x)[0].column("bits")
    assert np.array_equal(K.from_bits(bits, 3), x) and np.array_equal(K.from_bits(bits.slice(2, 4), 3), x[2:6])


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_a_pass_takes_distances_once(metric, monkeypatch):
    rng = np.random.default_rng(1)
    x, means = rng.normal(size=(200, 3)), rng.normal(size=(2, 4, 3))
    calls, real = [], K.nearest_dense
    monkeypatch.setattr(K, "nearest_dense", lambda *a: calls.append(1) or real(*a))
    (got,) = K.change_batches(None, means, metric)(packed(x))
    assert len(calls) == 2
    total, margin = np.zeros((2, 4, 4)), np.zeros(2)
    for t, c, pos, s in zip(*(got.column(i).to_pylist() for i in range(4))):
        if pos < 0:
            margin[t] = s
        else:
            total[t, c, pos] += s
    for t in range(2):
        d = K.dense_center_distances(x, means[t], metric)
        best, two = d.argmin(axis=1), np.partition(d, 1, axis=1)
        assert np.isclose(margin[t], (two[:, 1] - two[:, 0]).min())
        for c in range(4):
            assert np.allclose(total[t, c], [*x[best == c].sum(axis=0), (best == c).sum()])


def test_a_broken_row_stays_with_its_cluster():
    x = np.array([[1.0, 2.0], [np.nan, 1.0], [3.0, np.inf]])
    got = K.cluster_sums(x, np.array([0, 1, 1]), 3)
    assert got[0].tolist() == [1.0, 2.0] and got[2].tolist() == [0.0, 0.0] and np.isnan(got[1, 0])


def test_sizes_share_their_passes(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(120, 3))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    calls, real = [], kmeans._changes
    monkeypatch.setattr(kmeans, "_changes", lambda *a: calls.append(len(a[2])) or real(*a))
    alone, passes = [], []
    for k in (2, 5):
        alone.append(kmeans.fit(rows, k, repeats=2))
        passes.append(len(calls))
        calls.clear()
    both = kmeans.fit_sizes(rows, (2, 5), repeats=2)
    assert calls[0] == 4 and len(calls) < sum(passes)
    for one, other in zip(alone, both):
        assert one.n_iter == other.n_iter and one.converged == other.converged and np.allclose(one.means, other.means)
