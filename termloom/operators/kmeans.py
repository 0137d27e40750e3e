"""k-means to convergence, over dense vectors and over sparse rows of any vocabulary.

The rule is one for all forms: a mean moves to (mean + sum of its rows) / (1 + rows), so that
an empty cluster keeps its mean, until the means move less than ``CONVERGED`` in total. Of
several trials the one whose means differ least from those of the others is taken. A result
says after how many rounds it stopped and whether it converged.

Means of up to ``CENTROID_CELLS`` numbers are shipped to the tasks, all trials (also those of
several numbers of means) in one pass.
A pass over dense rows sums them anew by one product; of sparse rows only those that change
their cluster are summed after the first pass. A pass also returns the
least margin by which a row prefers its mean; while the means have drifted less than half of
it since, no row can change (triangle inequality), and rounds need no pass. Larger sets of
means are a table joined on the feature.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions import kernels as K
from termloom.operators.features import packed_rows
from termloom.session import hot_split_join, materialise, narrow, stored

CLUSTERS = 25
REPEATS = 3
CONVERGED = 1e-6
MAX_ROUNDS = 1000
# Largest set of centroids (cells) that is shipped to every task.
CENTROID_CELLS = 4_000_000


@dataclass(frozen=True)
class Fit:
    """``means``: k x width; ``converged`` is False where ``n_iter`` reached the limit."""

    means: np.ndarray
    n_iter: int
    converged: bool


def start_order(seed: int | None, key: str = "id") -> list[Column]:
    """The first rows in this order are starting means: by id, or by a digest of seed and id."""
    own = F.col(key)
    return [own] if seed is None else [F.md5(F.concat(F.lit(f"{seed}:"), own.cast("string")).cast("binary")), own]


def initial_means(rows: DataFrame, k: int, seed: int | None = None, width: int | None = None) -> np.ndarray:
    """Vectors of the ``k`` rows first in order, dense; ``width`` is for sparse rows."""
    first = rows.orderBy(*start_order(seed)).limit(k).collect()
    if "vec" in rows.columns:
        return np.array([r["vec"] for r in first], dtype=np.float64)
    means = np.zeros((len(first), width))
    for i, r in enumerate(first):
        means[i, r["idx"]] = r["val"]
    return means


def _checked(means: np.ndarray) -> np.ndarray:
    if means.size > CENTROID_CELLS:
        raise ValueError("centroids are too large to ship: use the sparse form, which joins them")
    return means


def assign(rows: DataFrame, means: np.ndarray, metric: str = "euclidean") -> DataFrame:
    """(id, cluster, d), and vec of dense rows: nearest mean of each row, ties to the lowest."""
    vec = ", vec array<double>" if "vec" in rows.columns else ""
    rows = rows.select("id", "vec") if vec else rows.select("id", "idx", "val")
    return rows.mapInArrow(K.assign_batches(_checked(means), metric), f"id bigint, cluster int, d double{vec}")


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def mean_distances(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return 1.0 - (_unit(x) * _unit(y)).sum(axis=1)
    return np.sqrt(((x - y) ** 2).sum(axis=1))


def _changes(rows: DataFrame, before: list[np.ndarray] | None, means: list[np.ndarray], metric: str):
    """Change of cluster sums and sizes, and the least margin, per trial."""
    found = rows.mapInArrow(K.change_batches(before, means, metric), "trial int, c int, pos int, s double")
    merged = found.groupBy("trial", "c", "pos").agg(F.sum("s").alias("s"), F.min("s").alias("lo")).toPandas()
    trial, c, pos = (merged[x].to_numpy() for x in ("trial", "c", "pos"))
    sums, counts, margin = [], [], []
    for t, m in enumerate(means):
        total, cell = np.zeros((len(m), m.shape[1] + 1)), (trial == t) & (pos >= 0)
        total[c[cell], pos[cell]] = merged["s"][cell]
        sums.append(total[:, :-1])
        counts.append(np.round(total[:, -1]))
        margin.append(merged["lo"][(trial == t) & (pos < 0)].min())
    return sums, counts, margin


def lloyd(rows: DataFrame, means: Sequence[np.ndarray], metric: str = "euclidean", max_iter: int = MAX_ROUNDS) -> list[Fit]:
    """One fit per trial from its starting means (k x width); k may differ, passes are shared."""
    dense = "vec" in rows.columns
    if dense:
        rows = materialise(rows.select("vec").mapInArrow(K.to_bits, "bits binary"), "bits")
    else:
        rows = stored(narrow(rows, "id", "idx", "val"), "vectors")
    means = [np.array(_checked(m)) for m in means]
    sums, counts, seen = [np.zeros(m.shape) for m in means], [np.zeros(len(m)) for m in means], [np.zeros(m.shape) for m in means]
    margin, drift = np.zeros(len(means)), np.zeros(len(means))
    fits: dict[int, Fit] = {}
    for n in range(1, max_iter + 1):
        open_ = [t for t in range(len(means)) if t not in fits]
        late = [t for t in open_ if n == 1 or 2 * drift[t] >= margin[t]]
        if late:
            before = None if dense or n == 1 else [seen[t] for t in late]
            for t, more, rows_more, least in zip(late, *_changes(rows, before, [means[t] for t in late], metric)):
                sums[t] = more if dense else sums[t] + more
                counts[t] = rows_more if dense else counts[t] + rows_more
                margin[t], drift[t], seen[t] = least, 0.0, means[t]
        for t in open_:
            new = (means[t] + sums[t]) / (1.0 + counts[t])[:, None]
            moved = float(mean_distances(means[t], new, metric).sum())
            step = new - means[t] if metric == "euclidean" else _unit(new) - _unit(means[t])
            drift[t] += np.sqrt((step * step).sum(axis=1)).max(initial=0.0)
            means[t] = new
            if moved < CONVERGED or n == max_iter:
                fits[t] = Fit(new.copy(), n, moved < CONVERGED)
        if len(fits) == len(means):
            break
    return [fits[t] for t in range(len(means))]


def choose(fits: list[Fit], metric: str = "euclidean") -> Fit:
    """Of several fits the one whose means, in the order of their component sums, are least
    far from those of the others; of equal ones the first. One fit is taken as it is."""
    if len(fits) == 1:
        return fits[0]
    ordered = [replace(f, means=f.means[np.argsort(f.means.sum(axis=1), kind="stable")]) for f in fits]
    apart = [sum(mean_distances(f.means, g.means, metric).sum() for g in ordered if g is not f) for f in ordered]
    return ordered[int(np.argmin(apart))]


def seeds_of(seed: int | None, repeats: int) -> list[int | None]:
    """Seeds of the trials; without a seed the start is fixed and one trial is all there is."""
    return [None] if seed is None else [seed + i for i in range(repeats)]


def fit_sizes(
    rows: DataFrame, sizes: Sequence[int], repeats: int = REPEATS, metric: str = "euclidean",
    seed: int | None = 1, max_iter: int = MAX_ROUNDS, width: int | None = None,
) -> list[Fit]:
    """``fit`` for each number of means in ``sizes``; the trials of all of them share their passes."""
    seeds = seeds_of(seed, repeats)
    first = [initial_means(rows, max(sizes), s, width) for s in seeds]
    if not len(first[0]):
        raise ValueError("no rows to cluster")
    found = lloyd(rows, [start[:k] for k in sizes for start in first], metric, max_iter)
    return [choose(found[i * len(seeds) : (i + 1) * len(seeds)], metric) for i in range(len(sizes))]


def fit(
    rows: DataFrame, k: int = CLUSTERS, repeats: int = REPEATS, metric: str = "euclidean",
    seed: int | None = 1, max_iter: int = MAX_ROUNDS, width: int | None = None,
) -> Fit:
    """Means over stored rows (id, vec), or (id, idx, val) of ``width`` positions. With fewer
    than ``k`` rows there are fewer means; no rows are an error."""
    return fit_sizes(rows, (k,), repeats, metric, seed, max_iter, width)[0]


def predict_sizes(rows: DataFrame, sizes: Sequence[int], repeats: int = REPEATS, metric: str = "euclidean", seed: int | None = 1) -> list[DataFrame]:
    """``fit_predict`` for each number of clusters in ``sizes``."""
    rows = stored(narrow(rows, "id", "vec"), "vectors")
    return [
        assign(rows, found.means, metric).withColumns({"n_iter": F.lit(found.n_iter), "converged": F.lit(found.converged)})
        for found in fit_sizes(rows, sizes, repeats, metric, seed)
    ]


def fit_predict(rows: DataFrame, k: int = CLUSTERS, repeats: int = REPEATS, metric: str = "euclidean", seed: int | None = 1) -> DataFrame:
    """(id, cluster, d, vec, n_iter, converged) of dense rows (id, vec)."""
    return predict_sizes(rows, (k,), repeats, metric, seed)[0]


def cluster_documents(
    cells: DataFrame, k: int = CLUSTERS, repeats: int = REPEATS, metric: str = "euclidean",
    seed: int | None = 1, max_iter: int = MAX_ROUNDS, limit: int = CENTROID_CELLS,
) -> DataFrame:
    """(id, cluster, n_iter, converged) for a long-form matrix (doc_id, feature, value).

    While ``k`` centroids over the vocabulary stay within ``limit`` cells they are shipped to
    the tasks, else joined; the result is the same.
    """
    cells = stored(cells, "cells")
    width = cells.agg(F.countDistinct("feature")).first()[0]
    if width * k > limit:
        tried = [sparse_lloyd(cells, k, metric, max_iter, s) for s in seeds_of(seed, repeats)]
        found = choose_joined(tried, metric)
        out = found.assigned.select(F.col("doc_id").alias("id"), "cluster")
    else:
        packed, width = packed_rows(cells)
        packed = narrow(packed, F.col("doc_id").alias("id"), "idx", "val")
        found = fit(packed, k, repeats, metric, seed, max_iter, width)
        out = assign(packed, found.means, metric).drop("d")
    return materialise(out.withColumns({"n_iter": F.lit(found.n_iter), "converged": F.lit(found.converged)}), "kmeans")


# Sparse rows: centroids live in a table (feature, n_cells, m array<double>[k]).

@dataclass(frozen=True)
class JoinedFit:
    assigned: DataFrame
    means: DataFrame
    k: int
    n_iter: int
    converged: bool


def sparse_lloyd(
    cells: DataFrame, k: int = CLUSTERS, metric: str = "euclidean", max_iter: int = MAX_ROUNDS, seed: int | None = None
) -> JoinedFit:
    """(doc_id, cluster) for long-form rows (doc_id, feature, value), and the means.

    Centroids are as wide as the vocabulary, so they are a table joined on the feature; the
    driver holds k norms and counts. Each round: join and sum dot products per document, pick
    the nearest mean, sum members per (feature, cluster).
    """
    cells = stored(cells, "cells")
    norms = materialise(cells.groupBy("doc_id").agg(F.sum(F.col("value") * F.col("value")).alias("sq")), "norms")
    first = [row["doc_id"] for row in norms.orderBy(*start_order(seed, "doc_id")).limit(k).collect()]
    k = len(first)
    chosen = F.create_map(*[x for i, d in enumerate(first) for x in (F.lit(d), F.lit(i))])
    start = cells.where(F.col("doc_id").isin(first)).select(
        "feature", F.element_at(chosen, F.col("doc_id")).alias("c"), "value"
    )
    weights = cells.groupBy("feature").agg(F.count("*").alias("n_cells"))
    placed = start.groupBy("feature").agg(*_per_cluster(k, "c", "value"))
    zero = F.array_repeat(F.lit(0.0), k)
    # one row per feature for all rounds
    means = materialise(
        weights.join(_wide(placed, k), "feature", "left").select("feature", "n_cells", F.coalesce("m", zero).alias("m")),
        "means",
    )
    sq = _norms(means, k)
    for n in range(1, max_iter + 1):
        assigned = _nearest_joined(cells, norms, means, sq, metric)
        counts = np.zeros(k)
        for row in assigned.groupBy("cluster").agg(F.count("*").alias("n")).collect():
            counts[row["cluster"]] = row["n"]
        members = cells.join(assigned, "doc_id").groupBy("feature").agg(*_per_cluster(k, "cluster", "value"))
        total = _wide(members, k).withColumnRenamed("m", "s")
        ones = F.array(*[F.lit(1.0 + c) for c in counts])
        new = F.transform("m", lambda o, c: (o + F.get("s", c)) / F.get(ones, c))
        both = materialise(means.join(total, "feature").select("feature", "n_cells", F.col("m").alias("old"), new.alias("m")), "means")
        moved = float(_apart(both, "old", "m", k, metric).sum())
        means = narrow(both, "feature", "n_cells", "m")
        sq = _norms(means, k)
        if moved < CONVERGED:
            break
    return JoinedFit(_nearest_joined(cells, norms, means, sq, metric), means, k, n, moved < CONVERGED)


def _nearest_joined(cells: DataFrame, norms: DataFrame, means: DataFrame, sq: np.ndarray, metric: str) -> DataFrame:
    k = len(sq)
    # a broadcast holds at most CENTROID_CELLS numbers
    hits = hot_split_join(cells, means, "feature", "n_cells", max(CENTROID_CELLS // k, 1))
    dots = hits.groupBy("doc_id").agg(*[F.sum(F.col("value") * F.get("m", F.lit(c))).alias(f"c{c}") for c in range(k)])
    scores = []
    for c in range(k):
        if metric == "cosine":
            cos = F.try_divide(F.col(f"c{c}"), F.sqrt("sq") * F.lit(float(sq[c] ** 0.5)))
            d = F.lit(1.0) - F.coalesce(cos, F.lit(0.0))
        else:
            d = F.lit(float(sq[c])) - 2 * F.col(f"c{c}")
        scores.append(F.struct(d.alias("d"), F.lit(c).alias("c")))
    best = F.array_min(F.array(*scores))["c"].alias("cluster")
    return materialise(norms.join(dots, "doc_id").select("doc_id", best), "assigned")


def _norms(means: DataFrame, k: int) -> np.ndarray:
    return np.array(means.agg(*[F.sum(F.pow(F.get("m", F.lit(c)), F.lit(2.0))) for c in range(k)]).first())


def _apart(both: DataFrame, x: str, y: str, k: int, metric: str) -> np.ndarray:
    """Distance of each mean in column ``x`` to the one in ``y``: k numbers to the driver."""
    a, b = (lambda c, n=n: F.get(n, F.lit(c)) for n in (x, y))
    total = lambda f: np.array(both.agg(*[F.sum(f(c)) for c in range(k)]).first(), dtype=np.float64)
    if metric == "euclidean":
        return np.sqrt(total(lambda c: (a(c) - b(c)) * (a(c) - b(c))))
    scale = np.sqrt(total(lambda c: a(c) * a(c)) * total(lambda c: b(c) * b(c)))
    return 1.0 - np.divide(total(lambda c: a(c) * b(c)), scale, out=np.zeros(k), where=scale > 0)


def choose_joined(fits: list[JoinedFit], metric: str) -> JoinedFit:
    """As ``choose``, with means in tables of the same features; only sums reach the driver."""
    if len(fits) == 1:
        return fits[0]
    k, ordered = fits[0].k, []
    for f in fits:
        sums = np.array(f.means.agg(*[F.sum(F.get("m", F.lit(c))) for c in range(k)]).first())
        order = np.argsort(sums, kind="stable").tolist()
        place = F.array(*[F.lit(order.index(c)) for c in range(k)])
        means = f.means.select("feature", F.array(*[F.get("m", F.lit(c)) for c in order]).alias("m"))
        ordered.append(replace(f, means=means, assigned=f.assigned.withColumn("cluster", F.get(place, F.col("cluster")))))
    apart = np.zeros(len(fits))
    for i in range(len(fits)):
        for j in range(i):
            both = ordered[i].means.withColumnRenamed("m", "x").join(ordered[j].means.withColumnRenamed("m", "y"), "feature")
            apart[[i, j]] += _apart(both, "x", "y", k, metric).sum()
    return ordered[int(np.argmin(apart))]


def _per_cluster(k: int, cluster: str, value: str):
    return [F.coalesce(F.sum(F.when(F.col(cluster) == c, F.col(value))), F.lit(0.0)).alias(f"c{c}") for c in range(k)]


def _wide(summed: DataFrame, k: int) -> DataFrame:
    return summed.select("feature", F.array(*[F.col(f"c{c}") for c in range(k)]).alias("m"))
