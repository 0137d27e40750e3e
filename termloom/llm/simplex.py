"""k-means over integer vectors, with centroids filtered by n-simplex projection.

Each vector's distances to a few pivots are taken once and turned into the coordinates of the
apex of a simplex whose base the pivots are. For two apexes x and y, all coordinates but the
last lie in the span of the pivots, the last is the height above it. So the distance of the
two vectors is at least that of the apexes, and at most that with y's height turned to the
other side (public method of Connor, Vadicamo, Cardillo and Rabitti, 2018). Apexes are
stored beside the vectors; a round compares them with the apexes of the centroids, drops the
centroids whose lower bound exceeds the least upper bound, and compares what is left by exact
integers.

Vectors stay in their partitions in all rounds: a task adds up its own rows per cluster, and
only these sums are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.session import materialise

CLUSTERS, ROUNDS, WIDTH, SCALE, SALT = 8, 10, 64, 1024, "3:"
# Rows that pivots are looked for among; the search runs on the driver.
PIVOT_SAMPLE = 1024
# A component beyond this would let a squared distance of 64 components exceed 64 bits.
LARGEST = 1 << 27
# A pivot nearer than this share of its distance to the span of the others adds rounding only.
LEAST_HEIGHT = 1e-2
# Rounding of bounds, as a share of the squared distances they come from.
SLACK = 1e-9


def quantised(vectors: DataFrame, vec_id: str, vec: str, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, x array<int>): floor(scale * component) of the vectors that have ``width``
    components, none of them null or not finite; other vectors go. A component of over 2^27
    after scaling is an error, as its distances do not fit 64 bits."""
    x = F.col(vec).cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = vectors.where((F.size(x) == width) & whole)
    too_far = F.raise_error(F.lit(f"a component times {scale} exceeds {LARGEST}")).cast("int")
    number = lambda v: F.when(F.abs(v * scale) < LARGEST, F.floor(v * scale).cast("int")).otherwise(too_far)
    return kept.select(F.col(vec_id).alias("vec_id"), F.transform(x, number).alias("x"))


def first_by_hash(rows: DataFrame, n: int, salt: str = SALT) -> np.ndarray:
    """The ``n`` vectors of smallest SHA-256 of salt and id (a null id: of the salt alone); rows
    that share an id go by their components."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = rows.select(key.alias("key"), "x").orderBy("key", "x").limit(n).collect()
    return np.array([r["x"] for r in found], dtype=np.int64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to the few rows of ``y``."""
    return np.stack([((x - row) ** 2).sum(axis=1) for row in y], axis=1) if len(y) else np.zeros((len(x), 0), np.int64)


class Base:
    """The simplex of the pivots: coordinates of pivot k are row k, zero from column k on."""

    def __init__(self, candidates: np.ndarray) -> None:
        """Take candidates in order, leaving out those that lie (almost) in the span of the
        ones taken."""
        self.pivots, self.corners = candidates[:1], np.zeros((min(1, len(candidates)), 0))
        for row in candidates[1:]:
            apex = self.apexes(row[None, :])[0]
            if apex[-1] > LEAST_HEIGHT * max(np.sqrt((apex**2).sum()), 1.0):
                self.pivots = np.concatenate((self.pivots, row[None, :]))
                self.corners = np.concatenate((np.pad(self.corners, ((0, 0), (0, 1))), apex[None, :]))

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """Apex coordinates of integer vectors from their distances to the pivots."""
        d = squared(x, self.pivots).astype(np.float64)
        inner = (d[:, :1] + (self.corners[1:] ** 2).sum(axis=1) - d[:, 1:]) / 2
        flat = np.linalg.solve(self.corners[1:], inner.T).T if len(self.pivots) > 1 else inner
        return np.column_stack((flat, np.sqrt(np.maximum(d[:, 0] - (flat**2).sum(axis=1), 0.0))))


def bounds(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between apexes of rows and centroids."""
    low = np.stack([((x - row) ** 2).sum(axis=1) for row in y], axis=1)
    return low, low + 4 * x[:, -1:] * y[None, :, -1]


def nearest(x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, base: Base) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row (of equally near ones the smallest), and how
    many centroids were compared exactly for it; none where the bounds leave one."""
    own = base.apexes(centroids)
    low, high = bounds(apexes, own)
    slack = SLACK * ((apexes**2).sum(axis=1)[:, None] + (own**2).sum(axis=1)[None, :] + 1.0)
    open_ = low - slack <= (high + slack).min(axis=1)[:, None]
    left = open_.sum(axis=1)
    open_[left == 1] = False
    best = np.argmin(np.where(open_ | (left == 1)[:, None], low, np.inf), axis=1)
    rows, cs = np.nonzero(open_)
    exact = np.full(open_.shape, np.iinfo(np.int64).max)
    exact[rows, cs] = ((x[rows] - centroids[cs]) ** 2).sum(axis=1)
    return np.where(left == 1, best, np.argmin(exact, axis=1)), np.where(left == 1, 0, left)


def moved(centroids: np.ndarray, totals: dict[tuple[int, int], int], counts: dict[int, int]) -> np.ndarray:
    """Floor of the mean of each component; a centroid without vectors stays."""
    new = centroids.copy()
    for (c, i), total in totals.items():
        new[c, i] = total // counts[c]
    return new


def pivots(sample: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Candidates: centroids of the sample, near which those of all rows will lie, then the
    first vectors of the sample."""
    means = sample[:k]
    for _ in range(rounds):
        at = np.argmin(squared(sample, means), axis=1)
        means = np.array([sample[at == c].sum(axis=0) // max((at == c).sum(), 1) if (at == c).any() else means[c] for c in range(len(means))])
    return np.concatenate((means, sample[:k]))


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def with_apexes(rows: DataFrame, base: Base) -> DataFrame:
    """The stored vectors with their apexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apex = base.apexes(matrix(batch.column("x"), np.int64))
                ends = np.arange(len(apex) + 1, dtype=np.int32) * apex.shape[1]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, pa.array(apex.ravel()))], ["vec_id", "x", "apex"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return materialise(rows.mapInArrow(run, f"vec_id {kind}, x array<int>, apex array<double>"), "apexes")


def sums(rows: DataFrame, centroids: np.ndarray, base: Base) -> tuple[dict[tuple[int, int], int], dict[int, int]]:
    """Component sums and sizes of the clusters: (k times width) numbers to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), centroids.shape[1] + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"), np.int64)
                at, _ = nearest(x, matrix(batch.column("apex"), np.float64), centroids, base)
                for c in range(len(centroids)):
                    own = x[at == c]
                    total[c, :-1] += own.sum(axis=0)
                    total[c, -1] += len(own)
        c, i = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(total[c, i])], ["c", "i", "s"])

    parts = rows.select("x", "apex").mapInArrow(run, "c int, i int, s bigint")
    found = parts.groupBy("c", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    width = centroids.shape[1]
    counts = {r["c"]: int(r["s"]) for r in found if r["i"] == width}
    totals = {(c, i): 0 for c in counts for i in range(width)}
    return totals | {(r["c"], r["i"]): int(r["s"]) for r in found if r["i"] < width}, counts


def assign(rows: DataFrame, centroids: np.ndarray, base: Base) -> DataFrame:
    """(vec_id, cluster, distance, compared): the nearest centroid, its exact squared distance
    and how many centroids the bounds left to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"), np.int64)
                at, compared = nearest(x, matrix(batch.column("apex"), np.float64), centroids, base)
                found = [at.astype(np.int32), ((x - centroids[at]) ** 2).sum(axis=1), compared.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *map(pa.array, found)], ["vec_id", "cluster", "distance", "compared"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint, compared int")


def fit(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT) -> tuple[DataFrame, np.ndarray, Base]:
    """Stored vectors with apexes, the centroids after ``rounds`` rounds, and the pivots' base.

    ``rows``: (vec_id, x). Centroids start as the ``k`` vectors first by hash; with fewer
    vectors there are fewer centroids. Equal vectors and repeated ids are rows like others.
    """
    rows = materialise(rows, "quantised")
    sample = first_by_hash(rows, max(PIVOT_SAMPLE, k), salt)
    if not len(sample):
        raise ValueError("no vectors")
    base = Base(pivots(sample, k, rounds))
    stored, centroids = with_apexes(rows, base), sample[:k]
    for _ in range(rounds):
        centroids = moved(centroids, *sums(stored, centroids, base))
    return stored, centroids, base


RESULT = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def clusters(
    vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
    width: int = WIDTH, scale: int = SCALE, salt: str = SALT,
) -> DataFrame:
    """(vec_id, cluster, distance, compared, cluster_inertia, inertia, centroid_sha256) of the
    vectors that ``quantised`` keeps. No such vector: no rows. Other columns are not read."""
    rows = quantised(vectors, vec_id, vec, width, scale)
    if rows.isEmpty():
        facts = [F.lit(None).cast(kind).alias(name) for name, kind in (f.split() for f in RESULT.split(", "))]
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("distance"), F.lit(0).alias("compared"), *facts)
    stored, centroids, base = fit(rows, k, rounds, salt)
    assigned = materialise(assign(stored, centroids, base), "assigned")
    # one row per cluster, at most k
    own = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(c, own[c], sum(own.values()), digest[c]) for c in own]
    return assigned.join(F.broadcast(vectors.sparkSession.createDataFrame(facts, RESULT)), "cluster")
