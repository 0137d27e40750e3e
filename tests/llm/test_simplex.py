"""Bounds hold, and clusters equal those of plain integer k-means."""

import hashlib

import numpy as np
import pytest

from termloom.llm import simplex


def plain(ids, x, k, rounds):
    order = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"3:{'' if ids[i] is None else ids[i]}".encode()).hexdigest(), list(x[i])))
    means = [list(map(int, x[i])) for i in order[:k]]

    def assign():
        d = [[sum((int(a) - b) ** 2 for a, b in zip(row, m)) for m in means] for row in x]
        at = [min(range(len(means)), key=lambda c: (r[c], c)) for r in d]
        return at, [r[c] for r, c in zip(d, at)]

    for _ in range(rounds):
        at, _ = assign()
        for c in range(len(means)):
            own = [x[i] for i in range(len(x)) if at[i] == c]
            if own:
                means[c] = [sum(int(v) for v in col) // len(own) for col in zip(*own)]
    at, d = assign()
    inertia = {c: sum(b for a, b in zip(at, d) if a == c) for c in set(at)}
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return sorted(((i, c, v, inertia[c], sum(d), digest[c]) for i, c, v in zip(ids, at, d)), key=str)


def got(df, **kw):
    found = simplex.clusters(df, **kw).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("kind", ["random", "clustered", "flat", "far"])
def test_bounds_and_nearest(kind):
    rng = np.random.RandomState(3)
    x = rng.randint(-500, 500, (600, 24))
    if kind == "clustered":
        x = x // 20 + rng.randint(-900, 900, (6, 24))[rng.randint(0, 6, 600)]
    if kind == "flat":  # all in a plane, many equal
        x = rng.randint(-3, 4, (600, 2)) @ rng.randint(-9, 9, (2, 24))
    if kind == "far":
        x = x + 10**7
    x = x.astype(np.int64)
    base = simplex.Base(simplex.pivots(x[:100], 5, 4))
    centroids = np.concatenate((x[200:206], x[200:201]))  # one twice: the first wins
    apexes, own = base.apexes(x), base.apexes(centroids)
    d = simplex.squared(x, centroids)
    low, high = simplex.bounds(apexes, own)
    room = simplex.SLACK * ((apexes**2).sum(axis=1)[:, None] + (own**2).sum(axis=1)[None, :] + 1.0)
    assert (low <= d + room).all() and (d <= high + room).all()
    at, compared = simplex.nearest(x, apexes, centroids, base)
    assert (at == d.argmin(axis=1)).all() and ((compared == 0) | (compared >= 2)).all()


def test_clusters(spark):
    rng = np.random.RandomState(5)
    centres = rng.normal(size=(6, 64))
    rows = [(i, (centres[i % 6] + rng.normal(size=64) * 0.3).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = [[int(np.floor(1024 * v)) for v in r[1]] for r in rows]
    assert got(df) == plain([r[0] for r in rows], x, 8, 10)
    compared = simplex.clusters(df).groupBy().avg("compared").first()[0]
    assert compared < 4  # of 8


def test_ties_repeats_few_rows_and_bad_vectors(spark):
    good = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (None, [-1.0, -0.0001]), (3, [0.5, 1.0])] + [(9, [2.0, 2.0])] * 30
    bad = [(4, None), (5, [1.0]), (6, [1.0, None]), (7, [1.0, float("nan")]), (8, [float("inf"), 0.0]), (10, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 as cluster", "2 as `x.y`", "3 as apex")
    x = [[int(np.floor(1024 * v)) for v in r[1]] for r in good]
    for k in (1, 3, 50):
        assert got(df, width=2, k=k, rounds=4) == plain([r[0] for r in good], x, k, 4)
    assert got(df, width=7) == []
    assert got(df.limit(0)) == []


def test_too_far(spark):
    df = spark.createDataFrame([(1, [1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exceeds"):
        simplex.clusters(df, width=1).collect()
