"""MinHash sketches: (doc_id, seed, num_perm, sig array<bigint>), one per document.

A document is one row, so its sketch is built inside the row; merging sketches is a
slot-wise ``min`` that combines map-side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions import kernels as K
from termloom.functions.hashing import MAX_HASH, PRIME, permutations, sha1_hash32
from termloom.session import spread

DEFAULT_SLOTS = 128
DEFAULT_SEED = 1


def signatures(
    bags: DataFrame,
    num_perm: int = DEFAULT_SLOTS,
    seed: int = DEFAULT_SEED,
    hash_expr: Callable[[Column], Column] = sha1_hash32,
) -> DataFrame:
    """Sketch the distinct terms of each bag; a bag without terms stays at the initial
    value in every slot. ``hash_expr`` maps a term to a 32-bit value.

    The slot arithmetic wraps around int64, which SQL cannot express under ANSI mode
    without 38-digit decimals per slot and term; the batches go through numpy.
    """
    a, b = permutations(num_perm, seed)
    hashed = F.transform(F.coalesce("terms", F.array()), lambda e: hash_expr(e["term"]))
    rows = spread(bags).select(F.col("doc_id").alias("id"), hashed.alias("hashes"))
    signed = rows.mapInArrow(K.signature_batches(a, b, PRIME, MAX_HASH), "id bigint, sig array<bigint>")
    return signed.select(
        F.col("id").alias("doc_id"), F.lit(seed).alias("seed"), F.lit(num_perm).alias("num_perm"), "sig"
    )


def slots(sigs: DataFrame, *keys: str) -> DataFrame:
    """(keys…, slot, hv): sketches in long form."""
    return sigs.select(*keys, F.posexplode("sig").alias("slot", "hv"))


def merge(sigs: DataFrame, by: str, min_inputs: int = 1) -> DataFrame:
    """Slot-wise minimum per group of ``by``: (by, seed, num_perm, n_inputs, slot, hv).

    Only sketches of equal seed and length are merged. ``min_inputs`` = 2 gives the
    n-ary union, which is not defined for fewer sketches.
    """
    long = slots(sigs, by, "seed", "num_perm")
    merged = long.groupBy(by, "seed", "num_perm", "slot").agg(
        F.min("hv").alias("hv"), F.count("*").alias("n_inputs")
    )
    return merged.where(F.col("n_inputs") >= min_inputs)


def cardinality(sigs: DataFrame) -> DataFrame:
    """(doc_id, n_est): estimated number of distinct terms."""
    share = F.aggregate("sig", F.lit(0.0), lambda s, h: s + h / F.lit(float(MAX_HASH)))
    return sigs.select("doc_id", (F.col("num_perm") / share - 1).alias("n_est"))


def is_empty(sigs: DataFrame) -> DataFrame:
    return sigs.select("doc_id", F.forall("sig", lambda h: h == MAX_HASH).alias("is_empty"))


def equal_groups(sigs: DataFrame) -> DataFrame:
    """(first_id, n_docs) for each distinct sketch; the members are not collected."""
    return sigs.groupBy("seed", "sig").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_docs"))


def jaccard(x: Column, y: Column) -> Column:
    """Share of equal slots of two sketches of the same seed and length."""
    equal = F.filter(F.zip_with(x, y, lambda a, b: a == b), lambda e: e)
    return F.size(equal) / F.size(x)


def check_comparable(x: Column, y: Column) -> Column:
    """Raise unless two sketch structs have the same seed and number of slots."""
    same = (x["seed"] == y["seed"]) & (x["num_perm"] == y["num_perm"])
    return F.assert_true(same, F.lit("sketches differ in seed or number of slots"))


def save(sigs: DataFrame, path: str) -> None:
    sigs.write.parquet(path)


def load(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
