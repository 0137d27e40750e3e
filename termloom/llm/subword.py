"""Quality scores by supervised subword embeddings.

Words, pairs of neighbouring words and the character n-grams within words (the blanks at both
ends of a word count as characters) are hashed to a fixed number of buckets; a pair is the
exclusive-or of its words' hashes, so that any repeated word meets in one bucket. Each bucket has a learned vector; a
document is the mean of the vectors of all its features, and a softmax over a linear map of
that mean gives the probability of each label. Vectors and map are learned together by plain
stochastic gradient descent in numpy, on a bounded sample of labelled rows: ``sample`` rows
of at most ``longest`` characters each, drawn by a hash. Everything else covers all rows and
whole texts.

Scoring folds the model: the mean of the vectors is only used through one linear map, so each
bucket contributes one number, and a text's score is the mean of these numbers over its
features. A text longer than ``PIECE`` characters is cut at blanks and its sums are added up,
which bounds memory; a run of ``PIECE`` characters without a blank is cut in itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.session import materialise

PIECE = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
BLANK = 32


@dataclass(frozen=True)
class Settings:
    """``bits``: two to that power buckets; ``size``: length of a vector; ``grams``: lengths of
    character n-grams; ``rate``: first learning rate, times ``gain`` for the vectors, whose
    steps are shared out over all features of a text; ``sample`` and ``longest``: rows, and
    characters of a row, that are learned from at most."""

    bits: int = 17
    size: int = 12
    grams: tuple[int, ...] = (3, 4)
    epochs: int = 4
    rate: float = 0.5
    gain: float = 30.0
    seed: int = 7
    sample: int = 4096
    longest: int = 1 << 16


@cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for all places of a piece."""
    inverse = pow(BASE, -1, 1 << 64)
    n = PIECE + 8
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.array([1, *[b] * n], dtype=np.uint64)) for b in (BASE, inverse))
    return up, down


def bucket(hashes: np.ndarray, kind: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * kind)
        return ((h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - bits)).astype(np.int64)


def pieces(text: str) -> Iterator[str]:
    """Parts of at most ``PIECE`` characters, cut after a blank where there is one."""
    at = 0
    while len(text) - at > PIECE:
        cut = max(text.rfind(" ", at, at + PIECE), text.rfind("\n", at, at + PIECE)) + 1
        cut = cut if cut > at else at + PIECE
        yield text[at:cut]
        at = cut
    yield text[at:]


def features(part: str, settings: Settings) -> np.ndarray:
    """Buckets of all words, pairs and n-grams of one piece, as often as they occur."""
    c = np.frombuffer(f" {part} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    blank = (c <= BLANK) | (c == 0xA0) | (c == 0x3000)
    c[blank] = BLANK
    up, down = powers()
    with np.errstate(over="ignore"):
        upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(c * up[: len(c)])))
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        first, last = edge[::2], edge[1::2]
        words = (upto[last] - upto[first]) * down[first]
        found = [bucket(words, 0, settings.bits), bucket(words[1:] ^ words[:-1], 1, settings.bits)]
        inner = ~blank
        for n in settings.grams:
            if len(c) < n:
                continue
            ok = inner[1 : len(c) - n + 2].copy()
            for i in range(2, n - 1):
                ok &= inner[i : len(c) - n + 1 + i]
            at = np.flatnonzero(ok)
            found.append(bucket((upto[at + n] - upto[at]) * down[at], n, settings.bits))
    return np.concatenate(found)


def counted(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    total = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in pieces(text):
        ids, n = np.unique(features(part, settings), return_counts=True)
        ids, where = np.unique(np.concatenate((total[0], ids)), return_inverse=True)
        total = ids, np.bincount(where, np.concatenate((total[1], n)), len(ids)).astype(np.int64)
    return total


class Model:
    """``vectors``: one row per bucket; ``out``: size x labels; ``bias``: one per label."""

    def __init__(self, vectors: np.ndarray, out: np.ndarray, bias: np.ndarray) -> None:
        self.vectors, self.out, self.bias = vectors, out, bias

    def folded(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the logit of label 1 against label 0, and the rest."""
        return self.vectors @ (self.out[:, 1] - self.out[:, 0]), float(self.bias[1] - self.bias[0])


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Stochastic gradient descent over (buckets, counts, label) rows, one row a step, the
    rate falling to zero. The bias stays at the labels' shares (one added to each count), so
    that a text without features gets these. The order of steps follows from the seed."""
    rng = np.random.RandomState(settings.seed)
    vectors = rng.uniform(-1, 1, (1 << settings.bits, settings.size)) / settings.size
    out = rng.uniform(-1, 1, (settings.size, 2))
    ones = sum(y for _, _, y in rows)
    bias = np.log(np.array([len(rows) - ones + 1.0, ones + 1.0]) / (len(rows) + 2.0))
    step, steps = 0, max(settings.epochs * len(rows), 1)
    for _ in range(settings.epochs):
        for i in rng.permutation(len(rows)):
            ids, n, y = rows[i]
            rate = settings.rate * (1 - step / steps)
            step += 1
            share = (n / max(n.sum(), 1))[:, None]
            mean = (vectors[ids] * share).sum(axis=0)
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1.0
            if len(ids):
                pull = out @ p
                out -= rate * np.outer(mean, p)
                vectors[ids] -= rate * settings.gain * share * pull
    return Model(vectors, out, bias)


def logit(text: str | None, weights: np.ndarray, rest: float, settings: Settings) -> float:
    total, n = 0.0, 0
    for part in pieces(text or ""):
        ids = features(part, settings)
        total, n = total + float(weights[ids].sum()), n + len(ids)
    return rest + (total / n if n else 0.0)


def held_out(doc_id: Column, parts: int = 5, fold: int = 0) -> Column:
    """Whether a document belongs to the fold that is not learned from; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == fold, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, settings: Settings) -> DataFrame:
    """(text, y): at most ``sample`` labelled rows outside the held-out fold, lowest hash of
    the id first. An id with several labels takes the most frequent one, of equally frequent
    ones 1; null ids, labels and texts, and texts of over ``longest`` characters, are left out.
    Only ids are joined before the sample is drawn."""
    ids = docs.select(F.col(doc_id).alias("id")).where(F.col("id").isNotNull() & ~held_out(F.col("id"))).distinct()
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y")).where(F.col("y").isin(0, 1))
    known = known.groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    drawn = known.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(settings.sample)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    texts = texts.where(F.col("text").isNotNull() & (F.length("text") <= settings.longest))
    # at most ``sample`` ids; rows that repeat an id are bounded by the second limit
    rows = texts.join(F.broadcast(drawn), "id")
    return rows.orderBy(F.xxhash64("id"), "id", F.xxhash64("text"), "text").limit(settings.sample).select("text", "y")


MODEL = "bucket int, vector array<double>, out array<double>, bias array<double>"


def learn(rows: DataFrame, settings: Settings) -> DataFrame:
    """The model as a stored table, one row per bucket, from (text, y) rows of bounded number:
    one task cuts them into features as they come and learns. Without rows both labels are
    as likely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [
            (*(x.astype(np.int32) for x in counted(text, settings)), y)
            for batch in batches
            for at in range(0, batch.num_rows, 64)
            for text, y in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True)
        ]
        if not held:
            return
        model = fit(held, settings)
        for at in range(0, len(model.vectors), 8192):
            part = model.vectors[at : at + 8192]
            n = len(part)
            lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * settings.size, pa.array(part.ravel()))
            same = [pa.array([x.ravel().tolist()] * n) for x in (model.out, model.bias)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + n, dtype=np.int32)), lists, *same], ["bucket", "vector", "out", "bias"])

    return materialise(rows.coalesce(1).mapInArrow(run, MODEL), "subword")


def folded(model: DataFrame, settings: Settings) -> tuple[np.ndarray, float]:
    """One number per bucket and the rest of the logit, to the driver: 2^bits numbers."""
    parts = [F.col("bucket")] + [F.get("out", F.lit(2 * i + 1)) - F.get("out", F.lit(2 * i)) for i in range(settings.size)]
    add = sum((F.get("vector", F.lit(i)) * parts[i + 1] for i in range(settings.size)), F.lit(0.0))
    rows = model.select("bucket", add.alias("w"), (F.get("bias", F.lit(1)) - F.get("bias", F.lit(0))).alias("b")).toPandas()
    weights = np.zeros(1 << settings.bits)
    weights[rows["bucket"]] = rows["w"]
    return weights, float(rows["b"].iloc[0]) if len(rows) else 0.0


def scores(docs: DataFrame, model: DataFrame, text: str = "text", settings: Settings = Settings(), out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text. A null, empty or blank
    text has no features: its score is the share of label 1 among the rows learned from.
    Equal texts get equal scores; extra columns pass, one named as ``out`` is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(folded(model, settings))

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, rest = shared.value
        for values in batches:
            found = [logit(v, weights, rest, settings) for at in range(0, len(values), 256) for v in values.slice(at, 256).to_pylist()]
            yield pa.array(1.0 / (1.0 + np.exp(-np.clip(found, -500, 500))), pa.float64())

    udf = F.arrow_udf(score, "double", functionType=F.ArrowUDFType.SCALAR_ITER)
    return docs.withColumn(out, udf(F.col(text)))


THRESHOLD = 0.3


def documents(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    settings: Settings = Settings(), threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row, learned from ``labels``."""
    model = learn(training_rows(docs, labels, doc_id, text, label, settings), settings)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    found = scores(rows, model, "_text", settings)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
