import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.operators import classify, dbscan, distance, kmeans, quality


def rows_of(spark, x, **extra):
    x = np.asarray(x, float)
    x = x[:, None] if x.ndim == 1 else x
    names = list(extra)
    types = ", ".join(f"{n} {'int' if isinstance(extra[n][0], (int, np.integer)) else 'string'}" for n in names)
    data = [
        (i, v.tolist(), *[int(extra[n][i]) if isinstance(extra[n][i], np.integer) else extra[n][i] for n in names])
        for i, v in enumerate(x)
    ]
    return spark.createDataFrame(data, "id bigint, vec array<double>" + (", " + types if names else ""))


def matrix(x, metric="euclidean"):
    x = np.asarray(x, float)
    x = x[:, None] if x.ndim == 1 else x
    if metric == "euclidean":
        return np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    norm = np.sqrt((x * x).sum(1))
    scale = norm[:, None] * norm[None]
    return 1 - np.divide(x @ x.T, scale, out=np.zeros_like(scale), where=scale > 0)


def brute_dbscan(d, eps, m):
    near = d <= eps
    np.fill_diagonal(near, True)
    core = near.sum(1) >= m
    label, nxt = np.full(len(d), -1), 0
    for i in range(len(d)):
        if label[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            p = stack.pop()
            if label[p] != -1:
                continue
            label[p] = nxt
            if core[p]:
                stack += [q for q in np.flatnonzero(near[p]) if label[q] == -1]
        nxt += 1
    return label, core


def clusters(df):
    return [r.cluster for r in df.orderBy("id").collect()]


def test_dbscan_fixtures(spark):
    a = rows_of(spark, [0, 0.1, 0.2, 1, 1.1, 1.2, 5])
    got = dbscan.dbscan(a, 0.15, 3)
    assert clusters(got) == [0, 0, 0, 1, 1, 1, -1]
    assert [r.id for r in got.where("is_core").orderBy("id").collect()] == [1, 4]
    b = rows_of(spark, [-1, -1, -1, 0, 1, 2, 3, 3, 3])
    assert clusters(dbscan.dbscan(b, 1, 4)) == [0, 0, 0, 0, 0, 1, 1, 1, 1]


@pytest.mark.parametrize(
    "metric, eps, block_rows, local_edges",
    [("euclidean", 0.25, 2000, 1_000_000), ("euclidean", 0.25, 16, 0), ("cosine", 0.01, 16, 1_000_000)],
)
def test_dbscan_against_sequential(spark, metric, eps, block_rows, local_edges):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=(80, 2)), np.tile([[0.5, 0.5]], (45, 1)), [[0.0, 0.0]]])
    want, core = brute_dbscan(matrix(x, metric), eps, 4)
    got = dbscan.dbscan(rows_of(spark, x), eps, 4, metric, block_rows, local_edges).orderBy("id").collect()
    assert [r.cluster for r in got] == list(want)
    assert [r.is_core for r in got] == list(core)


def test_dbscan_sparse_rows_and_all_noise(spark):
    rows = spark.createDataFrame(
        [(0, ["a"], [1.0]), (1, ["a"], [1.1]), (2, ["b"], [1.0]), (3, [], [])], "id bigint, idx array<string>, val array<double>"
    )
    assert clusters(dbscan.dbscan(rows, 0.2, 2)) == [0, 0, -1, -1]
    assert clusters(dbscan.dbscan(rows, 0.01, 2)) == [-1] * 4


def test_eps_neighbors_with_tiny_radius(spark):
    x = np.arange(300) / 10.0
    got = distance.eps_neighbors(rows_of(spark, x), 0.1001, 3, block_rows=20).orderBy("id").collect()
    assert [r.n_neighbors for r in got] == [2] + [3] * 298 + [2]


@pytest.mark.parametrize("local_edges", [0, 3, 1000])
def test_connected_components(spark, local_edges):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))]
    edges += [(100, i) for i in range(101, 140)] + [(i, i + 1) for i in range(200, 230)]
    root = {v: v for e in edges for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    want = {v: find(v) for e in edges if e[0] != e[1] for v in e}
    got = dbscan.connected_components(spark.createDataFrame(edges, "u bigint, v bigint"), local_edges)
    assert {r.node: r.root for r in got.collect()} == want


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("block_rows", [2000, 10])
def test_distance_profile(spark, metric, block_rows):
    x = np.concatenate([np.random.default_rng(2).normal(size=(30, 3)), np.tile([[1.0, 2.0, 3.0]], (15, 1))])
    d = matrix(x, metric)
    got = distance.distance_profile(rows_of(spark, x), metric, block_rows).orderBy("id").collect()
    off = d.copy()
    np.fill_diagonal(off, np.nan)
    assert np.allclose([r.mean_d for r in got], np.nanmean(off, 1))
    assert np.allclose([r.min_d for r in got], np.nanmin(off, 1), atol=1e-12)
    assert np.allclose([r.max_d for r in got], np.nanmax(off, 1))


def test_column_distances(spark):
    rows = spark.createDataFrame([([0.0, 3.0], [4.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])], "x array<double>, y array<double>")
    got = rows.select(distance.euclidean(F.col("x"), F.col("y")), distance.cosine(F.col("x"), F.col("y"))).collect()
    assert [tuple(r) for r in got] == [(5.0, 1.0), (1.0, 1.0)]


def brute_silhouette(d, label):
    out = []
    for i in range(len(d)):
        own = label == label[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, label == c].mean() for c in set(label) if c != label[i])
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return out


def test_silhouette_fixture(spark):
    got = quality.silhouette_samples(rows_of(spark, [0, 1, 5, 6], cluster=[0, 0, 1, 1])).orderBy("id").collect()
    assert [r.s for r in got] == pytest.approx([0.818182, 0.777778, 0.777778, 0.818182], abs=1e-6)
    one = quality.silhouette(rows_of(spark, [0, 1], cluster=[0, 0])).first()
    assert one.n_clusters == 1 and one.silhouette is None


@pytest.mark.parametrize("block_rows", [2000, 9])
def test_silhouette_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 3))
    label = np.array([0] * 40 + [-1] * 25 + [2 + i // 3 for i in range(24)] + [99])
    got = quality.silhouette_samples(rows_of(spark, x, cluster=label), block_rows).orderBy("id").collect()
    assert [r.s for r in got] == pytest.approx(brute_silhouette(matrix(x), label))


def test_quality_fixtures(spark):
    one = rows_of(spark, [[0], [0], [0], [0]], cluster=[0, 0, 0, 0], label=["a", "a", "a", "b"])
    assert quality.cluster_entropy(one).first().entropy == pytest.approx(0.562335145)
    pure = rows_of(spark, [[0], [1]], cluster=[0, 0], label=["a", "a"])
    assert quality.cluster_entropy(pure).first().entropy == 0.0
    unknown = rows_of(spark, [[0], [1]], cluster=[0, 0], label=["a", None])
    assert {r.label for r in quality.cluster_label_counts(unknown).collect()} == {"a", "unknown label"}
    two = rows_of(spark, [[1, 3], [5, 7], [2, 9]], cluster=[0, 0, 1])
    assert {r.cluster: r.variance for r in quality.cluster_variance(two).collect()} == {0: 5.0, 1: 0.0}
    sparse = spark.createDataFrame([(0, [1.0]), (0, [3.0])], "cluster int, val array<double>")
    assert quality.sparse_cluster_variance(sparse, 2).first().variance == pytest.approx(np.var([1, 0, 3, 0]))


def test_split(spark):
    rows = spark.range(10)
    both = classify.train_test_split(rows, "id")
    assert [r.is_train for r in both.orderBy("id").collect()] == [True] * 6 + [False] * 4
    assert classify.train_test_split(rows, "id", drop_last=True).where("not is_train").count() == 3


def test_knn_fixture(spark):
    train = rows_of(spark, [0, 1, 3], label=["a", "b", "b"])
    test = spark.createDataFrame([(9, [0.4], "b")], "id bigint, vec array<double>, label string")
    near = classify.knn_neighbors(train, test, 3)
    got = {r.k: r.predicted for r in classify.knn_classify(near, train, (2, 3)).collect()}
    assert got == {2: "a", 3: "b"}
    acc = {r.k: r.accuracy for r in classify.accuracy(classify.knn_classify(near, train, (2, 3)), test).collect()}
    assert acc == {2: 0.0, 3: 1.0}


@pytest.mark.parametrize("block_rows", [2000, 11])
def test_knn_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(60, 3)), np.tile([[0.1, 0.2, 0.3]], (30, 1))])
    df = rows_of(spark, x)
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    d, ids = matrix(x), np.arange(len(x))
    got = {}
    for r in classify.knn_neighbors(train, test, 7, block_rows=block_rows).orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append(r.id)
    for q in ids[ids % 3 == 0]:
        t = ids[ids % 3 > 0]
        want = t[np.lexsort((t, d[q, t]))][:7]
        assert got[q] == list(want)


def numpy_lloyd(x, means, rounds):
    for _ in range(rounds):
        at = np.sqrt(((x[:, None] - means[None]) ** 2).sum(2)).argmin(1)
        means = np.array([(means[c] + x[at == c].sum(0)) / (1 + (at == c).sum()) for c in range(len(means))])
    return means, np.sqrt(((x[:, None] - means[None]) ** 2).sum(2)).argmin(1)


def test_lloyd_dense_and_joined_forms(spark):
    rng = np.random.default_rng(8)
    x = np.abs(rng.normal(size=(60, 4))) + np.repeat(np.eye(4)[:3] * 4, 20, axis=0)
    df = rows_of(spark, x)
    start = kmeans.initial_means(df, 5)
    assert np.allclose(start, x[:5])
    means, want = numpy_lloyd(x, start, 3)
    got = kmeans.lloyd(df, start[None], max_iter=3)[0]
    assert np.allclose(got.means, means) and (got.n_iter, got.converged) == (3, False)
    assert clusters(kmeans.assign(df, got.means)) == list(want)
    joined = kmeans.sparse_lloyd(cells_of(df), 5, max_iter=3)
    assert clusters(joined.assigned.withColumnRenamed("doc_id", "id")) == list(want) and not joined.converged


def cells_of(df):
    return df.select(F.col("id").alias("doc_id"), F.posexplode("vec").alias("p", "value")).select(
        "doc_id", F.concat(F.lit("f"), "p").alias("feature"), "value"
    )


def plain_fit(x, means, metric):
    """Rounds until the means rest, one after the other and over all rows."""
    n = 0
    while True:
        at = np.array([matrix(np.vstack([v, means]), metric)[0, 1:].argmin() for v in x])
        new = np.array([(m + x[at == c].sum(0)) / (1 + (at == c).sum()) for c, m in enumerate(means)])
        moved = sum(matrix([a, b], metric)[0, 1] for a, b in zip(means, new))
        means, n = new, n + 1
        if moved < kmeans.CONVERGED:
            return means, n


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_converges_as_plain_rounds(spark, metric):
    rng = np.random.default_rng(2)
    x = np.abs(rng.normal(size=(80, 5))) * (rng.random((80, 5)) < 0.7) + 0.01
    x[60:] = x[0]  # copies
    df = rows_of(spark, x).repartition(5)
    starts = np.array([x[:6], x[10:16], x[54:60]])
    fits = kmeans.lloyd(df, starts, metric)
    packed, width = kmeans.packed_rows(cells_of(df))
    sparse = kmeans.lloyd(packed.withColumnRenamed("doc_id", "id"), starts, metric)
    assert width == 5
    for start, dense, other in zip(starts, fits, sparse):
        means, n = plain_fit(x, start, metric)
        assert dense.converged and (dense.n_iter, other.n_iter) == (n, n)
        assert np.allclose(dense.means, means, atol=1e-9) and np.allclose(other.means, means, atol=1e-9)


def test_passes_are_left_out_when_no_row_can_change(spark, monkeypatch):
    calls = []
    real = kmeans._changes
    monkeypatch.setattr(kmeans, "_changes", lambda *a: calls.append(1) or real(*a))
    df = rows_of(spark, [[0.0], [0.2], [10.0], [10.2]])
    got = kmeans.lloyd(df, np.array([[[0.0], [10.0]]]))[0]
    assert got.converged and got.n_iter > 10 and len(calls) < 4
    assert np.allclose(got.means, [[0.1], [10.1]], atol=1e-5)


def test_empty_cluster_keeps_its_mean(spark):
    df = rows_of(spark, [[1.0], [2.0]])
    got = kmeans.lloyd(df, np.array([[[1.5], [100.0]]]), max_iter=1)[0]
    assert got.means[1][0] == 100.0 and got.means[0][0] == pytest.approx((1.5 + 3.0) / 3)


def test_choice_of_a_trial():
    def made(*means):
        return kmeans.Fit(np.array(means, float), 1, True)

    near, same, far = made([9.0], [0.0]), made([0.1], [9.1]), made([4.0], [30.0])
    got = kmeans.choose([far, near, same])
    assert got.means.tolist() in ([[0.0], [9.0]], [[0.1], [9.1]]) and kmeans.choose([near]) is near


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_kmeans_fit(spark, metric):
    x = np.concatenate([np.tile([[1.0, 0.0]], (10, 1)), np.tile([[0.0, 1.0]], (10, 1)), [[0.0, 0.0]]])
    got = kmeans.fit_predict(rows_of(spark, x), 2, metric=metric).orderBy("id").collect()
    label = [r.cluster for r in got]
    assert len(got) == 21 and len(set(label[:10])) == 1 and len(set(label[10:20])) == 1
    assert all(r.converged for r in got)
    with pytest.raises(ValueError):
        kmeans.fit_predict(rows_of(spark, x).limit(0), 2)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_documents_joined_form_is_the_same(spark, metric):
    rng = np.random.default_rng(4)
    x = np.abs(rng.normal(size=(24, 4))) + np.repeat(np.eye(4) * 5, 6, axis=0)
    cells = cells_of(rows_of(spark, x))
    got = [
        {r.id: (r.cluster, r.n_iter, r.converged) for r in kmeans.cluster_documents(cells, 3, repeats=2, metric=metric, limit=limit, max_iter=6).collect()}
        for limit in (1_000_000, 1)
    ]
    assert got[0] == got[1] and len(got[0]) == 24
    with pytest.raises(ValueError):
        kmeans._checked(np.zeros((2, kmeans.CENTROID_CELLS)))


def test_decision_tree(spark):
    from pyspark.ml.functions import array_to_vector

    x = [[i % 2, i] for i in range(40)]
    rows = rows_of(spark, x, label=["even" if i % 2 == 0 else "odd" for i in range(40)]).select(
        "id", "label", array_to_vector("vec").alias("features")
    )
    row = classify.dtree_classify(rows.where("id < 24"), rows.where("id >= 24")).first()
    assert (row.n_train, row.n_test, row.accuracy, row.depth) == (24, 16, 1.0, 1)
