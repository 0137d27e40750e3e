"""DBSCAN over tiled passes (see distance.py).

Neighbour pairs are never emitted. The first pass counts neighbours per row. In the
second each tile returns a spanning forest of its core-core links, so a dense group
of copies costs at most one link per row and tile, and the links of border rows, of
which a border row has fewer than ``min_samples``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions import kernels as K
from termloom.operators.distance import count_neighbors, eps_passes
from termloom.operators.tiles import BLOCK_ROWS, hash_block
from termloom.session import hot_split_join, materialise, narrow, with_row_index

NOISE = -1
# Links that one task may finish on its own, once they are known to be this few.
LOCAL_EDGES = 1_000_000


def connected_components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(node, root): the smallest node of the component of each node in ``edges`` (u, v).

    Links are first dealt to parts of at most some ``2 * local_edges``, each of which keeps a
    spanning forest, as long as that leaves a quarter less: fewer nodes than ``local_edges``
    come to one part so. Otherwise each round hooks every component to its smallest neighbour, follows the
    hooks to their ends and replaces the links by links between components. When at most
    ``local_edges`` links are left (counted), one task finishes them.
    """
    edges = materialise(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "edges")
    # (node, root) of nodes that have been hooked so far
    members: DataFrame | None = None
    n = edges.count()
    while n > local_edges:
        dealt = edges.withColumn("part", hash_block(math.ceil(n / max(2 * local_edges, 1)), "u", "v"))
        edges = materialise(dealt.groupBy("part").applyInArrow(K.forest_kernel, "u bigint, v bigint"), "edges")
        before, n = n, edges.count()
        if n > 0.75 * before:
            break
    while True:
        n = edges.count()
        if n <= local_edges:
            last = edges.groupBy().applyInArrow(K.components_kernel, "node bigint, root bigint") if n else None
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("degree"))
        hooks = materialise(
            around.select(F.col("u").alias("node"), F.least("u", "low").alias("root"), "degree"), "hooks"
        )
        hooks = _follow(hooks)
        root_of = lambda c: hooks.select(F.col("node").alias(c), F.col("root").alias(f"r_{c}"), "degree")
        moved = hot_split_join(edges, root_of("u"), "u", "degree").drop("degree")
        moved = hot_split_join(moved, root_of("v"), "v", "degree")
        edges = materialise(
            moved.where(F.col("r_u") != F.col("r_v"))
            .select(F.least("r_u", "r_v").alias("u"), F.greatest("r_u", "r_v").alias("v"))
            .distinct(),
            "edges",
        )
        members = _merge(members, hooks.select("node", "root"))
    if last is None and members is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    if members is None:
        return last
    return _merge(members, last) if last is not None else members


def _follow(hooks: DataFrame) -> DataFrame:
    """Pointer jumping until each node points at the end of its chain."""
    while True:
        sizes = hooks.groupBy("root").agg(F.count("*").alias("n"))
        targets = hooks.select(F.col("node").alias("root"), F.col("root").alias("next")).join(sizes, "root")
        jumped = materialise(
            hot_split_join(hooks, targets, "root", "n").select("node", F.col("next").alias("root"), "degree",
                                                               (F.col("next") != F.col("root")).alias("moved")),
            "hooks",
        )
        done = jumped.where("moved").isEmpty()
        hooks = jumped.drop("moved")
        if done:
            return hooks


def _merge(members: DataFrame | None, newer: DataFrame) -> DataFrame:
    """Send older members on to the newer roots of their roots."""
    if members is None:
        return newer
    sizes = members.groupBy("root").agg(F.count("*").alias("n"))
    known = newer.select(F.col("node").alias("root"), F.col("root").alias("next"))
    table = sizes.join(known, "root", "left").select("root", F.coalesce("next", "root").alias("next"), "n")
    moved = hot_split_join(members, table, "root", "n").select("node", F.col("next").alias("root"))
    return materialise(moved.unionByName(newer.join(moved.select("node"), "node", "left_anti")), "members")


def dbscan(
    items: DataFrame,
    eps: float,
    min_samples: int,
    metric: str = "euclidean",
    block_rows: int = BLOCK_ROWS,
    local_edges: int = LOCAL_EDGES,
) -> DataFrame:
    """(id, cluster, is_core): clusters numbered by their smallest core id, noise -1.

    A border row goes to the lowest-numbered cluster it touches.
    """
    return sweep(items, [(eps, min_samples)], metric, block_rows, local_edges)[0]


def sweep(
    items: DataFrame,
    params: list[tuple[float, int]],
    metric: str = "euclidean",
    block_rows: int = BLOCK_ROWS,
    local_edges: int = LOCAL_EDGES,
) -> list[DataFrame]:
    """One ``dbscan`` result for each (eps, min_samples) of ``params``.

    Rows are placed once, for the largest eps, and each of the two passes takes distances once
    for all parameters: the first counts neighbours within every eps, the second returns the
    links of every pair.
    """
    eps = tuple(sorted({e for e, _ in params}))
    level = tuple(eps.index(e) for e, _ in params)
    items, passes = eps_passes(items, eps[-1], metric, block_rows)
    counted = count_neighbors(items, passes, eps, metric)
    cores = F.array(*[F.get("n", F.lit(e)) >= m for e, (_, m) in zip(level, params)])
    counts = materialise(counted.select("id", cores.alias("core")), "counts")
    found = [p.run(K.eps_edges_kernel(metric, eps, level), "p int, u bigint, v bigint, core boolean", K.fewer_links, counts) for p in passes]
    links = materialise(reduce(DataFrame.unionByName, found), "links")
    return [
        _clusters(
            counts.select("id", F.get("core", F.lit(p)).alias("is_core")), narrow(links, "u", "v", "core", where=F.col("p") == p), local_edges
        )
        for p in range(len(params))
    ]


def _clusters(counts: DataFrame, links: DataFrame, local_edges: int) -> DataFrame:
    linked = connected_components(links.where("core"), local_edges)
    core = counts.where("is_core").select(F.col("id").alias("node"))
    roots = materialise(
        core.join(linked, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots"
    )
    sizes = roots.groupBy("root").agg(F.count("*").alias("n"))
    numbered, _ = with_row_index(sizes, "root", name="cluster")
    core_cluster = materialise(
        hot_split_join(roots, numbered, "root", "n").select("node", F.col("cluster").cast("int").alias("cluster")),
        "core_cluster",
    )
    border_links = links.where(~F.col("core")).select(F.col("u").alias("id"), F.col("v").alias("node"))
    touching = border_links.groupBy("node").agg(F.count("*").alias("n"))
    around = core_cluster.join(touching, "node")
    border = hot_split_join(border_links, around, "node", "n").groupBy("id").agg(F.min("cluster").alias("cluster"))
    assigned = border.unionByName(core_cluster.select(F.col("node").alias("id"), "cluster"))
    return counts.join(assigned, "id", "left").select(
        "id", F.coalesce("cluster", F.lit(NOISE)).alias("cluster"), "is_core"
    )
