"""Session-level helpers: shared scratch tables, input spreading, safe lookups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows a broadcast "hot key" table may hold (see hot_split_join).
HOT_KEY_LIMIT = 100_000
# Most bits of the table that may_match sends to all tasks (16 MB), and of a part of it.
FILTER_BITS, FILTER_PART = 1 << 27, 1 << 20

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="termloom-")
    return _local_dirs[app]


def new_table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/termloom/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Used where several branches read the same costly intermediate, and between
    rounds of an iterative job: a lost executor re-reads the table instead of
    replaying the lineage.
    """
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return _mark(df.sparkSession.read.schema(df.schema).parquet(path))


def _mark(df: DataFrame) -> DataFrame:
    df._termloom_stored = True
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself when it is a narrow view of a stored table, else a stored copy."""
    return df if getattr(df, "_termloom_stored", False) else materialise(df, name)


def narrow(df: DataFrame, *columns: Column | str, where: Column | str | None = None) -> DataFrame:
    """Project and filter; a view of a stored table still counts as stored."""
    out = df if where is None else df.where(where)
    out = out.select(*columns) if columns else out
    return _mark(out) if getattr(df, "_termloom_stored", False) else out


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition only when the scan has fewer splits than the cluster has cores.

    A large input already has more splits than cores, so this adds no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def hot_split_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    limit: int = HOT_KEY_LIMIT,
) -> DataFrame:
    """Inner-join ``rows`` to a table with one row per ``key``, safe under skew.

    The lookup is stored and counted; up to ``limit`` rows it is broadcast. Beyond
    that only its hot keys are: ``weight`` is the number of ``rows`` with the key, a
    key is hot when its weight is at least total/limit, and because weights add up to
    the total at most ``limit`` keys can be hot. All other keys hold less than
    total/limit rows each and go through a plain shuffle join.
    """
    table = stored(lookup, "lookup")
    n_keys, total = table.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    if n_keys <= limit:
        return rows.join(F.broadcast(table), key)
    is_hot: Column = F.col(weight) * F.lit(limit) >= F.lit(total)
    hot = F.broadcast(table.where(is_hot))
    by_broadcast = rows.join(hot, key)
    by_shuffle = rows.join(hot.select(key), key, "left_anti").join(table.where(~is_hot), key)
    return by_broadcast.unionByName(by_shuffle)


def may_match(keys: DataFrame, n: int) -> Callable[..., Column]:
    """A test of columns that holds for each of the ``n`` rows of ``keys`` and for few others.

    Rows are hashed to a table of bits, which tasks put together by parts. Its size is bounded, so
    with very many keys only more other rows pass: drop them by a join on what has passed.
    """
    bits = max(FILTER_PART, min(FILTER_BITS, 1 << (32 * n).bit_length()))
    place = lambda *columns: F.pmod(F.xxhash64(*columns), F.lit(bits))

    def part_of(table: pa.Table) -> pa.Table:
        flags = np.zeros(FILTER_PART, bool)
        flags[table.column("at").to_numpy()] = True
        packed = np.packbits(flags, bitorder="little").tobytes()
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([packed], pa.binary())})

    at = keys.select(place(*keys.columns).alias("p")).select(F.expr(f"p div {FILTER_PART}").alias("part"), (F.col("p") % FILTER_PART).alias("at"))
    table = np.zeros(bits // 8, np.uint8)
    for row in at.groupBy("part").applyInArrow(part_of, "part bigint, bits binary").toLocalIterator():
        table[row["part"] * FILTER_PART // 8 :][: FILTER_PART // 8] = np.frombuffer(row["bits"], np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def is_set(p: pa.Array) -> pa.Array:
        p = p.to_numpy()
        return pa.array((shared.value[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1)

    return lambda *columns: is_set(place(*columns))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the name with underscores, so that no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_index(df: DataFrame, *order: str, name: str = "row_index") -> tuple[DataFrame, int]:
    """Number rows 0..n-1 in a global order without a one-task window; also returns n.

    Rows are range-partitioned by ``order`` and stored; each partition is numbered
    on its own and shifted by the sizes of the partitions before it. The only
    driver-side data is one count per partition.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    part, start = free_name(df, "_part"), free_name(df, "_start")
    ranged = materialise(
        df.repartitionByRange(parts, *order).withColumn(part, F.spark_partition_id()), "ranged"
    )
    sizes = ranged.groupBy(part).agg(F.count("*").alias("n")).orderBy(part).collect()
    starts, seen = [], 0
    for row in sizes:
        starts.append((row[part], seen))
        seen += row["n"]
    offsets = F.broadcast(spark.createDataFrame(starts, f"{part} int, {start} bigint"))
    in_part = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    numbered = ranged.join(offsets, part).withColumn(name, F.col(start) + in_part - 1)
    return numbered.drop(part, start), seen
