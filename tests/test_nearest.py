"""Nearest means from one product of matrices, as from differences one by one."""

import numpy as np
import pyarrow as pa
import pytest

from termloom.functions import kernels as K


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_nearest_as_from_differences(metric, monkeypatch):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(3000, 16)), np.zeros((2, 16))])
    means = rng.normal(size=(9, 16))
    means[5] = means[2]
    means[7] = means[3] * (1 + 1e-13)
    exact, seen = K.dense_center_distances(x, means, metric), []
    plain = K.dense_center_distances
    monkeypatch.setattr(K, "dense_center_distances", lambda a, m, kind: seen.append(len(a)) or plain(a, m, kind))
    best, gap = K.nearest_dense(x, means, metric)
    assert (best == exact.argmin(axis=1)).all()
    two = np.partition(exact, 1, axis=1)
    assert gap == pytest.approx(two[:, 1] - two[:, 0], abs=1e-9)
    # only rows with two means as near are compared one mean after the other
    assert 0 < sum(seen) < len(x)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_changes_and_distances(metric):
    rng = np.random.default_rng(3)
    x, means, before = rng.normal(size=(500, 4)), rng.normal(size=(1, 5, 4)), rng.normal(size=(1, 5, 4))
    batch = pa.RecordBatch.from_pydict({"id": list(range(500)), "vec": x.tolist()})
    new, old = (K.dense_center_distances(x, m[0], metric).argmin(axis=1) for m in (means, before))
    total = np.zeros((5, 5))
    for r in np.flatnonzero(new != old):
        total[new[r]] += [*x[r], 1.0]
        total[old[r]] -= [*x[r], 1.0]
    got = np.zeros((5, 5))
    for out in K.change_batches(before, means, metric)([batch]):
        for r in out.to_pylist():
            if r["pos"] >= 0:
                got[r["c"], r["pos"]] += r["s"]
    assert got == pytest.approx(total, abs=1e-9)
    (out,) = K.assign_batches(means[0], metric)([batch])
    assert out.column("cluster").to_pylist() == new.tolist()
    exact = K.dense_center_distances(x, means[0], metric)
    assert out.column("d").to_pylist() == pytest.approx(exact.min(axis=1).tolist(), abs=1e-12)
