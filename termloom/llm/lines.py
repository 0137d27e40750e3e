"""Exact deduplication of lines and paragraphs by hashing.

A text is cut at line ends and, as a line of prose can be a whole paragraph, after the end
of a sentence. A unit is normalised (case, runs of white space), hashed to 128 bits and
grouped with its equals over all documents. The occurrence with the lowest rank (document
id, then place) stays, all others are cut out, and where they stood is kept.

Only digests and places are shuffled. Counts and first occurrences are combined in the tasks
before the shuffle, so the most frequent line is no hot spot; the join back can be split by
Spark where one digest is frequent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 8
SENTENCES = re.compile(r"\n\s*|(?<=[.!?])\s+")
LINES = re.compile(r"\n\s*")
PARAGRAPHS = re.compile(r"\n[ \t\r]*\n\s*")

UNITS = "high bigint, low bigint, doc_id bigint, text_key bigint, start int, length int"
_TYPES = [("high", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("start", pa.int32()), ("length", pa.int32())]


def split(text: str, ends: re.Pattern) -> list[tuple[int, int]]:
    """(start, length) of all units, each with the white space that follows it."""
    cuts = [0, *(m.end() for m in ends.finditer(text)), len(text)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def digest(unit: str) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(" ".join(unit.lower().split()).encode())
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    return signed(h >> 64), signed(h & ((1 << 64) - 1))


def units(docs: DataFrame, doc_id: str, text: str, ends: re.Pattern, min_words: int) -> DataFrame:
    """Digest and place of every unit of at least ``min_words`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [
                    (*digest(unit), key, text_key, start, length)
                    for key, text_key, value in zip(*(c.to_pylist() for c in part.columns), strict=True)
                    for start, length in split(value, ends)
                    if (unit := value[start : start + length]).count(" ") + 1 >= min_words and len(unit.split()) >= min_words
                ]
                if rows:
                    columns = zip(zip(*rows, strict=True), _TYPES, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in columns], [n for n, _ in _TYPES])

    known = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    return known.where(F.col("id").isNotNull() & F.col("text").isNotNull()).mapInArrow(run, UNITS)


def repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ends: re.Pattern = SENTENCES, min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc_id, text_key, start, length, first_doc_id, first_start): every unit that occurs
    earlier. ``text_key``, a hash of the text, tells rows apart that share an id."""
    found = units(docs, doc_id, text, ends, min_words)
    groups = (
        found.groupBy("high", "low")
        .agg(F.min(F.struct("doc_id", "text_key", "start")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("high", "low", "first")
    )
    again = found.join(groups, ["high", "low"]).where(F.struct("doc_id", "text_key", "start") != F.col("first"))
    return again.select("doc_id", "text_key", "start", "length", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start"))


def dedupe(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", spans: str = "removed",
    ends: re.Pattern = SENTENCES, min_words: int = MIN_WORDS,
) -> DataFrame:
    """``docs`` with repeated units cut out of ``text``, and ``spans``: (start, length,
    first_doc_id, first_start) of what went, in code points of the old text, in order.

    All rows and extra columns stay; a column named as ``spans`` is replaced. Null texts stay
    null and, as rows without an id, lose nothing (``spans`` is empty). Rows that share an id
    and a text are the same occurrence and keep the same units; rows that share an id only are
    occurrences of their own, ranked by a hash of the text, and each loses its own units. An
    empty table stays empty.
    """
    names = [c for c in docs.columns if c != spans]
    # the rows' own columns stay apart from the ones added, whatever their names
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    old = F.col("row").getField(text)
    rows = rows.select("row", F.col("row").getField(doc_id).cast("bigint").alias("id"), F.xxhash64(old).alias("key"))
    lost = repeats(docs, doc_id, text, ends, min_words).distinct().groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "first_doc_id", "first_start"))).alias("lost")
    )
    both = rows.join(lost, ["id", "key"], "left")
    # the parts between the spans: each from the end of one to the start of the next
    edges = F.concat(
        F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("length"))),
        F.transform("lost", lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))),
    )
    parts = F.transform(
        F.col("edges"),
        lambda e, i: F.substring(
            old, e["start"] + e["length"] + 1, F.coalesce(F.get("edges", i + 1)["start"], F.length(old)) - e["start"] - e["length"]
        ),
    )
    cut = both.withColumn("edges", edges).withColumn("new", F.when(F.col("lost").isNull(), old).otherwise(F.array_join(parts, "")))
    empty = F.array().cast("array<struct<start:int,length:int,first_doc_id:bigint,first_start:int>>")
    kept = [(F.col("new") if c == text else F.col("row").getField(c)).alias(c) for c in names]
    return cut.select(*kept, F.coalesce("lost", empty).alias(spans))
