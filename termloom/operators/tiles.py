"""Tiled pair passes: work over pairs of rows without emitting the pairs.

Some measures are defined over all pairs of rows (mean silhouette, the error of a
sketch against the exact value). Rows are dealt to blocks of bounded size; one task
group, a *tile*, holds two blocks, computes its pairs in numpy and returns per-row
summaries only. Blocks are dealt by a hash of the row id, so copies and hot keys
spread evenly and every tile costs the same. Blocks are sent in groups: a task holds
two groups of at most ``GROUP_BYTES``, goes through their pairs of blocks and sums up
before it returns, so that a row is sent once per group and not once per block. The rows
of a block are put together and compressed once before they are sent. Range passes drop the
tiles that cannot hold a neighbour.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from termloom.functions.kernels import by_blocks, pack_rows
from termloom.session import hot_split_join, materialise

BLOCK_ROWS = 2000
MIN_BLOCK_ROWS = 64
# Largest side of a tile. Below it a pass has as many groups, whatever the number of rows, as
# give each core some TILES_PER_CORE tiles, so that what is sent grows with the rows.
GROUP_BYTES = 96 << 20
TILES_PER_CORE = 4


def block_count(df: DataFrame, n_rows: int, block_rows: int = BLOCK_ROWS) -> int:
    """Blocks of at most about ``block_rows`` rows, and enough tiles for all cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    for_cores = min(math.ceil(math.sqrt(12 * cores)), math.ceil(n_rows / MIN_BLOCK_ROWS))
    return max(1, math.ceil(n_rows / block_rows), for_cores)


def hash_block(n_blocks: int | Column, *cols: str) -> Column:
    n = n_blocks if isinstance(n_blocks, Column) else F.lit(n_blocks)
    return F.pmod(F.xxhash64(*cols), n.cast("bigint")).cast("int")


def weigh(items: DataFrame, is_packed: bool = False) -> tuple[int, int]:
    """Rows, and about the bytes of a row: what its arrays hold."""
    text = 4 if is_packed else 24
    arrays = {f.name: text if isinstance(f.dataType.elementType, StringType) else 8 for f in items.schema if isinstance(f.dataType, ArrayType)}
    size = F.lit(32) + sum((F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) * w for c, w in arrays.items()), F.lit(0))
    n, total = items.agg(F.count("*"), F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()
    return n, math.ceil(total / max(n, 1))


def group_size(df: DataFrame, n_blocks: int, block_rows: int, row_bytes: int) -> int:
    """Blocks that are sent together."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    for_cores = n_blocks // math.ceil(math.sqrt(2 * TILES_PER_CORE * cores))
    return max(1, min(for_cores, GROUP_BYTES // max(block_rows * row_bytes, 1)))


def packed(items: DataFrame, *keys: str) -> DataFrame:
    """One row per block, named by ``keys``, with its rows as ``pack``."""
    kinds = [f"{k} {items.schema[k].dataType.simpleString()}" for k in keys]
    return items.groupBy(*keys).applyInArrow(pack_rows(keys), ", ".join([*kinds, "pack binary"]))


def run_tiles(tiled: DataFrame, keys: list[str], n_tiles: int, kernel, schema: str, combine=None) -> DataFrame:
    """Run ``kernel`` once per pair of blocks of each tile, ``combine`` over what it returned.
    The number of tasks follows the number of tiles, because tiles are small in bytes but
    heavy in work."""
    cores = tiled.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n_tiles, max(16 * cores, n_tiles // 64)))
    return tiled.repartition(tasks, *keys).groupBy(*keys).applyInArrow(by_blocks(kernel, schema, combine), schema)


def all_pairs(items: DataFrame, n_blocks: int, group: int = 1) -> DataFrame:
    """Send each row (with ``block``) to every tile (ti <= tj) of its group of blocks."""
    last = math.ceil(n_blocks / group) - 1
    own = F.floor(F.col("block") / group).cast("int")
    other = items.withColumns({"_g": own, "_o": F.explode(F.sequence(F.lit(0), F.lit(last)))})
    placed = other.select("*", F.least("_g", "_o").alias("ti"), F.greatest("_g", "_o").alias("tj"))
    return placed.select(
        "*", (F.col("_g") == F.col("ti")).alias("left"), (F.col("ti") == F.col("tj")).alias("diag")
    ).drop("_g", "_o")


def all_pairs_pass(items: DataFrame, kernel, schema: str, block_rows: int = BLOCK_ROWS, combine=None) -> DataFrame:
    """One symmetric pass over all pairs of ``items`` (column ``id`` is unique)."""
    n_rows, row_bytes = weigh(items, is_packed=True)
    n = block_count(items, n_rows, block_rows)
    group = group_size(items, n, math.ceil(n_rows / n), row_bytes)
    tiled = all_pairs(packed(items.withColumn("block", hash_block(n, "id")), "block"), n, group)
    tiles = math.ceil(n / group)
    return run_tiles(tiled, ["ti", "tj"], tiles * (tiles + 1) // 2, kernel, schema, combine)


def cross_pass(
    left: DataFrame, right: DataFrame, kernel, schema: str, block_rows: int = BLOCK_ROWS, combine=None
) -> DataFrame:
    """One pass over left × right blocks; both inputs have the same columns."""
    sides = []
    for df in (left, right):
        n_rows, row_bytes = weigh(df)
        n = block_count(df, n_rows, block_rows)
        group = group_size(df, n, math.ceil(n_rows / n), row_bytes)
        sides.append((df.withColumn("block", hash_block(n, "id")), group, math.ceil(n / group)))
    (lt, gl, nl), (rt, gr, nr) = sides
    own = lambda group: F.floor(F.col("block") / group).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    lt = lt.select("*", own(gl).alias("ti"), all_of(nr).alias("tj"), F.lit(True).alias("left"))
    rt = rt.select("*", all_of(nl).alias("ti"), own(gr).alias("tj"), F.lit(False).alias("left"))
    tiled = lt.unionByName(rt).withColumn("diag", F.lit(False))
    return run_tiles(tiled, ["ti", "tj"], nl * nr, kernel, schema, combine)


def place_in_cells(
    items: DataFrame, position: Column, radius: float, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, int]:
    """Deal rows to cells so that pairs within ``radius`` meet in few tiles.

    ``position`` must change by at most the distance between two rows, so rows
    within ``radius`` lie in the same cell of width >= radius or in the next one.
    A cell with many rows is dealt to several sub-blocks by id. Cells are at least as
    wide as needed to hold ``block_rows`` rows on average, so a tiny radius does not
    make a tile per row. ``items`` must be a stored table.

    Returns the stored rows with their place, for ``range_tiles``, and the number of tiles.
    ``group`` sub-blocks of a cell go to a tile together.
    """
    _, row_bytes = weigh(items, is_packed=True)
    placed = items.withColumn("_p", position)
    lo, hi, n = placed.agg(F.min("_p"), F.max("_p"), F.count("*")).first()
    if not n:
        lo, hi = 0.0, 0.0
    # as many rows per sub-block as give every core a few tiles
    rows = min(block_rows, math.ceil(max(n, 1) / block_count(items, max(n, 1), block_rows)))
    # wider than the radius by more than the rounding of positions
    slack = 1e-12 * max(abs(lo), abs(hi))
    width = max(radius * (1 + 1e-6) + slack, (hi - lo) * rows / max(n, 1), 1e-300)
    placed = placed.withColumn("cell", F.floor((F.col("_p") - lo) / width).cast("bigint")).drop("_p")
    cells = placed.groupBy("cell").agg(F.count("*").alias("n_rows")).withColumn(
        "subs", F.ceil(F.col("n_rows") / rows).cast("int")
    )
    shifted = lambda by, name: cells.select((F.col("cell") + by).alias("cell"), F.col("subs").alias(name))
    cells = materialise(cells, "cells")
    near = (
        cells.join(shifted(-1, "subs_up"), "cell", "left")
        .join(shifted(1, "subs_down"), "cell", "left")
        .na.fill(0, ["subs_up", "subs_down"])
    )
    sub = hash_block(F.col("subs"), "id")
    group = group_size(items, math.ceil(max(n, 1) / rows), rows, row_bytes)
    near = materialise(near.withColumn("group", F.lit(group)), "near")
    own, up = (F.ceil(F.col(c) / group) for c in ("subs", "subs_up"))
    up_tiles = own * (own + 1) / 2 + own * up
    n_tiles = int(near.agg(F.coalesce(F.sum(up_tiles), F.lit(0))).first()[0])
    joined = hot_split_join(placed, near, "cell", "n_rows").withColumn("sub", sub).drop("n_rows")
    return materialise(joined, "placed"), max(n_tiles, 1)


RANGE_KEYS = ["c1", "s1", "c2", "s2"]


def range_tiles(placed: DataFrame) -> DataFrame:
    """Send the blocks of placed rows to the tiles of their own and the neighbouring cells; the
    tile key is the pair of (cell, sub-block)."""
    placed = packed(placed, "cell", "sub", "subs", "subs_up", "subs_down", "group")

    def tiles(count: Column, make) -> Column:
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), make)).otherwise(F.array())

    def key(c1, s1, c2, s2):
        return F.struct(c1.alias("c1"), s1.cast("int").alias("s1"), c2.alias("c2"), s2.cast("int").alias("s2"))

    groups = lambda c: F.ceil(F.col(c) / F.col("group")).cast("int")
    cell, s0 = F.col("cell"), F.floor(F.col("sub") / F.col("group")).cast("int")
    own = tiles(groups("subs"), lambda s: key(cell, F.least(s0, s), cell, F.greatest(s0, s)))
    up = tiles(groups("subs_up"), lambda s: key(cell, s0, cell + 1, s))
    down = tiles(groups("subs_down"), lambda s: key(cell - 1, s, cell, s0))
    out = placed.withColumn("_t", F.explode(F.concat(own, up, down)))
    return out.select("*", "_t.*").select(
        "*", F.col("sub").alias("block"),
        ((F.col("cell") == F.col("c1")) & (s0 == F.col("s1"))).alias("left"),
        ((F.col("c1") == F.col("c2")) & (F.col("s1") == F.col("s2"))).alias("diag"),
    ).drop("_t", "cell", "sub", "subs", "subs_up", "subs_down", "group")
