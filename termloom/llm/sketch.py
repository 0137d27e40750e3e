"""Threshold-scaled sketches: every shingle hash below a fixed fraction of the hash range.

A sketch grows with its document, so a short text can be compared with a part of a very long
one: containment and Jaccard index are taken over hashes that both sides were bound to keep.
Sketches of parts merge into the sketch of the whole. A text of which no hash falls below
the threshold keeps its smallest one, so no text with a word has an empty sketch; merging
drops it again where a hash below the threshold comes in.

All on built-in functions: shingles are hashed from word hashes, without building strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.session import materialise, with_row_index

SHINGLE_WORDS = 5
# One in so many hashes is kept. A power of two.
SCALE = 8


def threshold(scale: int = SCALE) -> int:
    """Hashes are taken as signed; the kept ones are the lowest share of their range."""
    return -(1 << 63) + (1 << 64) // scale


def words(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def shingle_hashes(text: Column, k: int = SHINGLE_WORDS) -> Column:
    """One hash per run of ``k`` words; fewer words make one shingle, no word none."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    # an array literal is bound once by the one-element transform, so it is computed once
    return F.flatten(
        F.transform(
            F.array(hashed),
            lambda h: F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
            .when(F.size(h) < k, F.array(F.xxhash64(F.array_join(F.transform(h, lambda x: x.cast("string")), ","))))
            .otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.size(h) - k),
                    lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]),
                )
            ),
        )
    )


def keep(hashes: Column, scale: int = SCALE) -> Column:
    """Sorted distinct hashes below the threshold, else the smallest one."""
    return F.flatten(
        F.transform(
            F.array(hashes),
            lambda h: F.flatten(
                F.transform(
                    F.array(F.filter(h, lambda x: x < threshold(scale))),
                    lambda low: F.when((F.size(low) > 0) | (F.size(h) == 0), F.array_sort(F.array_distinct(low))).otherwise(
                        F.array(F.array_min(h))
                    ),
                )
            ),
        )
    )


def sketch(text: Column, k: int = SHINGLE_WORDS, scale: int = SCALE) -> Column:
    """Sketch of a text as a sorted array; a null or blank text has an empty one."""
    return keep(shingle_hashes(F.coalesce(text, F.lit("")), k), scale)


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Sketch of two texts' shingles together."""
    return keep(F.array_union(a, b), scale)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard index, 0 to 1; two empty sketches are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(a) + F.size(b) - both))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b holds; 1 for an empty a."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def printed(a: Column) -> Column:
    """A sketch as a string: hashes in hexadecimal, in order."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS, scale: int = SCALE) -> DataFrame:
    """``docs`` with ``sketch``; rows and extra columns stay, a column ``sketch`` is replaced."""
    return docs.withColumn("sketch", sketch(F.col(text), k, scale))


def edited_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS, scale: int = SCALE) -> DataFrame:
    """Each document beside an edited form of itself: its last third is replaced by as much of
    the beginning of the next document, in descending order of the id, the last one's next
    being the first.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. A null text is an empty one. A null id comes after all others (inside, the
    lowest long stands for it). Rows that share
    an id have the same next document, and where the next id has several texts, the smallest
    wanted part and its sketch are taken. Only ids are put in global order; texts move once,
    to their place by id, and a third of them once more, to the document before.
    """
    lowest = F.lit(-(1 << 63))
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), lowest).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    ids = rows.groupBy("key").agg(F.max(F.floor(F.length("text") / 3)).alias("wanted"))
    numbered, n = with_row_index(ids, "key", name="row")
    order = materialise(numbered, "order")
    # ascending, so a document's next one has the row before it, and row 0 the last row
    before = order.select(F.when(F.col("row") == n - 1, 0).otherwise(F.col("row") + 1).alias("row"), F.col("key").alias("next"))
    links = order.join(before, "row").select(F.col("key").alias("previous"), "next", "wanted")
    # read by both joins under the same names, so that Spark sees one shuffle
    own = rows.select("key", "text", sketch(F.col("text"), k, scale).alias("sketch"))
    heads = (
        own.join(links, F.col("key") == F.col("next"))
        .select(F.col("previous").alias("key"), F.expr("substring(text, 1, cast(wanted as int))").alias("head"), F.col("sketch").alias("next_sketch"))
        .groupBy("key")
        .agg(F.min(F.struct("head", "next_sketch")).alias("n"))
    )
    size, third = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - third), F.substring("n.head", F.lit(1), third))
    both = own.join(heads, "key").select(
        "key", size.cast("bigint").alias("n_chars"), "sketch", "n.next_sketch", edited.alias("edited")
    )
    sketched = both.withColumn("edited_sketch", sketch(F.col("edited"), k, scale))
    return sketched.select(
        F.nullif(F.col("key"), lowest).alias("doc_id"),
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
