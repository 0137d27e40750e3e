"""Language identification by rank-order profiles of character n-grams.

The profile of a language is the list of its ``profile_size`` most frequent n-grams in rank
order, learned from all labelled texts. A document's own most frequent n-grams are compared
with each profile by the out-of-place distance: the sum of the differences in rank, where an
n-gram that the profile lacks counts as ``profile_size``. The nearest profile wins.

N-grams of one to three characters are taken within words (runs of letters, lower case, with
a blank at both ends). An n-gram is one integer of three code points, which sorts as the
string does, so a text is cut and counted by array operations.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE_SIZE = 400
UNDETERMINED = "und"
# Distinct n-grams of a language that a training task holds before it passes them on.
HELD_GRAMS = 500_000
# Labels are a closed set by nature; more than this many is taken for a wrong column.
MAX_LANGUAGES = 10_000

BITS, BLANK = 21, 32


@cache
def letters() -> np.ndarray:
    """Code point to itself if it is a letter, else to the blank."""
    points = np.arange(0x110000, dtype=np.int64)
    return np.where([chr(c).isalpha() for c in range(0x110000)], points, BLANK)


def gram_keys(text: str) -> np.ndarray:
    """All n-grams of a text, as often as they occur; none without a letter. The first code
    point stands in the highest bits, a missing one is 0."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = letters()[points]
    c = c[np.concatenate(([True], (c[1:] != BLANK) | (c[:-1] != BLANK)))]  # one blank in a row
    if len(c) < 3:
        return np.empty(0, np.int64)
    two = (c[:-1] << 2 * BITS) | (c[1:] << BITS)
    three = two[:-1] | c[2:]
    return np.concatenate((c[c != BLANK] << 2 * BITS, two, three[c[1:-1] != BLANK]))


def gram(key: int) -> str:
    return "".join(chr(p) for p in (key >> 2 * BITS, key >> BITS & 0x1FFFFF, key & 0x1FFFFF) if p)


def key_of(gram: str) -> int:
    a, b, c = (*map(ord, gram), 0, 0)[:3]
    return a << 2 * BITS | b << BITS | c


def gram_counts(texts: DataFrame, label: str, text: str) -> DataFrame:
    """(lang, gram, n): occurrences of each n-gram in all texts of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            keys, counts = (np.concatenate(x) for x in zip(*held[lang], strict=True))
            keys, where = np.unique(keys, return_inverse=True)
            return keys, np.bincount(where, counts, len(keys)).astype(np.int64)

        def out(lang: str) -> pa.RecordBatch:
            keys, counts = merged(lang)
            del held[lang]
            columns = [pa.array([lang] * len(keys)), pa.array(list(map(gram, keys.tolist())), pa.string()), pa.array(counts)]
            return pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                together: dict[str, list[str]] = defaultdict(list)
                for lang, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    together[lang].append(value)
                for lang, values in together.items():
                    held[lang].append(np.unique(gram_keys("\n".join(values)), return_counts=True))
                    if len(held[lang]) >= 16:
                        held[lang] = [merged(lang)]
                        if len(held[lang][0][0]) > HELD_GRAMS:
                            yield out(lang)
        for lang in list(held):
            yield out(lang)

    known = texts.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    counted = known.select(F.col(label).alias("lang"), F.col(text).alias("text"))
    per_task = counted.mapInArrow(run, "lang string, gram string, n bigint")
    return per_task.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def profiles(texts: DataFrame, label: str = "lang", text: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """(lang, gram, rank) of each language's most frequent n-grams, ranks from 0; equal
    counts go in the order of the n-gram. Null labels and texts are left out."""
    ranked = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    counts = gram_counts(texts, label, text)
    return counts.withColumn("rank", F.row_number().over(ranked) - 1).where(F.col("rank") < size).drop("n")


class Model:
    """Ranks of all profiles, over the n-grams that occur in one; the last column stands for
    all other n-grams."""

    def __init__(self, rows: list[tuple[str, str, int]], size: int) -> None:
        self.size = size
        self.langs = sorted({lang for lang, _, _ in rows})
        self.keys = np.unique(np.array([key_of(g) for _, g, _ in rows], dtype=np.int64))
        self.ranks = np.full((len(self.langs), len(self.keys) + 1), -1, dtype=np.int64)
        place = {lang: i for i, lang in enumerate(self.langs)}
        for lang, g, rank in rows:
            self.ranks[place[lang], np.searchsorted(self.keys, key_of(g))] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = gram_keys(text) if text and self.langs else np.empty(0, np.int64)
        if not len(grams):
            return UNDETERMINED, 0.0
        keys, counts = np.unique(grams, return_counts=True)
        # by falling count, then in the order of the n-gram, in which the keys are
        keys = keys[np.argsort(-counts, kind="stable")[: self.size]]
        at = np.searchsorted(self.keys, keys)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != keys] = len(self.keys)
        ranks = self.ranks[:, at]
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(keys)))).sum(axis=1)
        best = int(np.argmin(away))
        return self.langs[best], 1.0 - float(away[best]) / (self.size * len(keys))


def predict(
    docs: DataFrame, learned: DataFrame, text: str = "text", size: int = PROFILE_SIZE,
    lang_out: str = "lang_pred", score_out: str = "score",
) -> DataFrame:
    """``docs`` with the predicted language and its score, one minus the distance as a share
    of the greatest possible one.

    ``und`` and score 0 for a null text, a text without letters, or when nothing was learned.
    Equal distances go to the first language by name. Extra columns pass; ``lang_out`` and
    ``score_out`` replace columns of the same name. ``learned`` is read to the driver: it has
    at most ``size`` rows per language, and a bound on languages that is checked.
    """
    rows = [tuple(r) for r in learned.select("lang", "gram", "rank").limit(MAX_LANGUAGES * size + 1).collect()]
    if len(rows) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is the label column a language?")
    model = docs.sparkSession.sparkContext.broadcast(rows)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(model.value, size)
        for values in batches:
            found = [own.predict(v) for at in range(0, len(values), 256) for v in values.slice(at, 256).to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang", "score"],
            )

    udf = F.arrow_udf(score, "struct<lang string, score double>", functionType=F.ArrowUDFType.SCALAR_ITER)
    kept = [c for c in docs.columns if c not in (lang_out, score_out)]
    found = docs.withColumn("_found", udf(F.col(text)))
    return found.select(*kept, F.col("_found.lang").alias(lang_out), F.col("_found.score").alias(score_out))


def held_out(doc_id: Column, parts: int = 4, fold: int = 2) -> Column:
    """Whether a document belongs to the fold that is not learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == fold
