"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised by its own quantiles, so that cells hold about as many rows as
each other, a document's cell gets its place on the curve, and the table is cut into runs of
the curve order. Neighbours on the curve are neighbours in every dimension, so the minima and
maxima of a shard are narrow in all of them and a filter on any dimension skips shards.

Law ``rows``: counts of shards differ by at most one. Only ids, sizes and places on the curve
are sorted; texts stay where they are until shards are written.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.session import free_name, with_row_index

BITS = 5
SHARDS = 40
ACCURACY = 10_000


def is_numeric(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")


def shared_prefixes(df: DataFrame, dimensions: list[str]) -> dict[str, int]:
    """Bytes that all values of a string dimension begin with: those of the least and the
    greatest value."""
    texts = [d for d in dimensions if not is_numeric(dict(df.dtypes)[d])]
    if not texts:
        return {}
    ends = [f(F.col(f"`{d}`").cast("string")) for d in texts for f in (F.min, F.max)]
    row = df.agg(*[e.alias(f"e{i}") for i, e in enumerate(ends)]).first()
    same = {}
    for i, d in enumerate(texts):
        lo, hi = ((v or "").encode() for v in row[2 * i : 2 * i + 2])
        same[d] = next((n for n, (x, y) in enumerate(zip(lo, hi)) if x != y), min(len(lo), len(hi)))
    return same


def as_number(column: Column, kind: str, skip: int = 0) -> Column:
    """A dimension as a number that keeps its order, as files are skipped by the least and
    greatest value they hold: numbers as they are, strings by six bytes after the ``skip`` ones
    that all share. Null is lowest."""
    if is_numeric(kind):
        value = column.cast("double")
    else:
        six = F.substring(F.encode(column.cast("string"), "UTF-8"), skip + 1, F.lit(6))
        value = F.conv(F.rpad(F.hex(six), 12, "0"), 16, 10).cast("double")
    return F.when(column.isNull() | F.isnan(value), F.lit(float("-inf"))).otherwise(value)


def boundaries(df: DataFrame, dimensions: list[str], bits: int = BITS, skip: dict[str, int] | None = None) -> dict[str, list[float]]:
    """Distinct inner quantiles of each dimension over all rows; at most 2^bits - 1 values."""
    kinds, skip = dict(df.dtypes), skip or {}
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    asked = [F.percentile_approx(as_number(F.col(f"`{d}`"), kinds[d], skip.get(d, 0)), shares, ACCURACY).alias(f"q{i}") for i, d in enumerate(dimensions)]
    row = df.agg(*asked).first()
    return {d: sorted(set(row[i] or [])) for i, d in enumerate(dimensions)}


def cell(value: Column, bounds: list[float]) -> Column:
    """Number of boundaries that lie below or at a value."""
    out = F.lit(0)
    for b in bounds:
        out = out + (value >= F.lit(b)).cast("int")
    return out


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of cells (one row per dimension) of ``bits`` bits each.

    Public method of J. Skilling (2004): undo the rotations bit by bit, Gray-encode, then
    interleave the bits of all dimensions, the highest first.
    """
    x = cells.astype(np.int64).copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        bit, low = 1 << b, (1 << b) - 1
        for i in range(n):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn = np.where((x[n - 1] & (1 << b)) != 0, turn ^ ((1 << b) - 1), turn)
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def with_curve(df: DataFrame, dimensions: list[str], bits: int = BITS, name: str = "curve") -> DataFrame:
    """Add the place on the curve; ``bits`` times the number of dimensions is at most 62."""
    if not 0 < bits * len(dimensions) <= 62:
        raise ValueError("the curve index has to fit 62 bits")
    kinds, skip = dict(df.dtypes), shared_prefixes(df, dimensions)
    bounds = boundaries(df, dimensions, bits, skip)

    @F.pandas_udf("bigint")
    def place(*cells: pd.Series) -> pd.Series:
        return pd.Series(curve_index(np.stack([c.to_numpy() for c in cells]), bits))

    return df.withColumn(name, place(*[cell(as_number(F.col(f"`{d}`"), kinds[d], skip.get(d, 0)), bounds[d]) for d in dimensions]))


def shard(df: DataFrame, dimensions: list[str], order: list[str], shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """``df`` with ``curve``, ``shard`` (0 to shards - 1) and ``slot`` (from 0, without gaps).

    Rows are cut into runs by (curve, *order): equal counts, the difference at most one. Rows
    that agree in all of these are interchangeable. Nulls are lowest. With fewer rows than
    shards some shards stay empty; an empty table stays empty. Columns named curve, shard or
    slot are replaced. ``df`` is stored once in sorted form: pass narrow rows.
    """
    placed = with_curve(df.drop("curve", "shard", "slot"), dimensions, bits)
    row = free_name(placed, "_row")
    numbered, n = with_row_index(placed, "curve", *order, name=row)
    at = F.expr(f"cast({row} as decimal(30,0)) * {shards} div {max(n, 1)}").cast("int")
    out = numbered.withColumn("shard", at)
    first = F.expr(f"(cast(shard as decimal(30,0)) * {n} + {shards - 1}) div {shards}").cast("bigint")
    return out.withColumn("slot", F.col(row) - first).drop(row)


def documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve) for documents with
    ``source``, ``lang`` and ``n_chars``; equal texts of one cell lie side by side. A null
    text has no bytes, and checksum 0."""
    bytes_ = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    narrow = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), (F.octet_length(bytes_) + 16).cast("bigint").alias("size"),
        F.crc32(bytes_).alias("text_crc32"), "source", "lang", "n_chars",
    )
    placed = shard(narrow, ["source", "lang", "n_chars"], ["text_crc32", "doc_id"], shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """Write the rows of ``docs`` shard by shard, each in slot order, one folder per shard.
    ``placed``: doc_id, shard and slot, ids unique."""
    both = docs.join(placed.select(F.col(doc_id).alias("_id"), "shard", "slot"), F.col(doc_id) == F.col("_id")).drop("_id")
    both.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def ranges(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Per shard its rows and the least and greatest value of each dimension, for pruning."""
    return df.groupBy("shard").agg(
        F.count("*").alias("rows"), *[f(d).alias(f"{n}_{d}") for d in dimensions for f, n in ((F.min, "min"), (F.max, "max"))]
    )
