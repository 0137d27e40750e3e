"""A manifest of a dataset as a Merkle tree, with a proof for every row.

Leaves are digests of rows. Within a group they are ranked; every ``FAN`` consecutive nodes
become one, level by level, until one is left, the group's subroot. Subroots, in the order of
their groups, become the root in the same way.

Ranks are written in digits of base ``FAN``. The lowest ``LEVELS`` digits stay within a block;
one shuffle brings a block together, and its digits are grouped away one after the other, each
time nesting the nodes below into their parent. So a block is one row, bounded by FAN^LEVELS
nodes. Its top is a node of the next tier, which is built alike, until a group has one node.
Then proofs run downwards: the steps above a block meet the block by its number, and each
level explodes the children with what stands left and right of them. Nothing larger than a
block is ever in one place, and no proof is looked up by a join.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.session import materialise

FAN = 8
LEVELS = 3
BLOCK = FAN**LEVELS


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    return digest(F.concat(*map(field, values)))


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (grp, hash, …, stored) with ``pos``, the place from 0 within ``grp`` by
    ``order``, and ``n``, the rows of the group. No group is sorted in one task: rows are
    dealt by ranges of (grp, order), and places counted on from range to range. Rows that
    agree in all of ``order`` are interchangeable; their place in the stored files deals them."""
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    tied = nodes.select("*", F.col("_metadata.row_index").alias("_tie"))
    dealt = materialise(tied.repartitionByRange(parts, "grp", *order, "_tie").withColumn("_part", F.spark_partition_id()), "ranges")
    of_group = Window.partitionBy("grp")
    spans = dealt.groupBy("grp", "_part").agg(F.count("*").alias("_rows"))
    spans = spans.select(
        "grp", "_part", F.sum("_rows").over(of_group).alias("n"),
        (F.sum("_rows").over(of_group.orderBy("_part")) - F.col("_rows")).alias("_before"),
    )
    within = F.row_number().over(Window.partitionBy("grp", "_part").orderBy(*order, "_tie")) - 1
    numbered = dealt.withColumn("_at", within).join(spans, ["grp", "_part"])
    return numbered.withColumn("pos", F.col("_before") + F.col("_at")).drop("_tie", "_part", "_before", "_at")


def joined(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda x: x["hash"]), "")


def tier(nodes: DataFrame) -> DataFrame:
    """(grp, n, block, node): the nodes (grp, n, pos, hash, item) of each block as one nested
    struct <hash, folded, kids>. ``n`` is the group's number of nodes in this tier; where one
    node is left it is passed up unchanged."""
    out = nodes.select(
        "grp", "n", F.expr(f"pos div {BLOCK}").alias("block"),
        *[F.expr(f"pos div {FAN**i} % {FAN}").cast("int").alias(f"d{i}") for i in range(LEVELS)],
        F.struct("hash", "item").alias("node"),
    ).repartition("grp", "block")
    for i in range(LEVELS):
        rest = [f"d{j}" for j in range(i + 1, LEVELS)]
        kids = F.sort_array(F.collect_list(F.struct(f"d{i}", "node")))
        # grouped by more than the rows are dealt by: no shuffle
        grouped = out.groupBy("grp", "n", "block", *rest).agg(kids.alias("kids"))
        grouped = grouped.withColumn("kids", F.transform("kids", lambda x: x["node"]))
        many = F.col("n") > FAN**i
        top = F.when(many, digest(joined(F.col("kids")))).otherwise(F.element_at("kids", 1)["hash"])
        out = grouped.select("grp", "n", "block", *rest, F.struct(top.alias("hash"), many.alias("folded"), "kids").alias("node"))
    return out


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """Stored tiers of the tree over ranked nodes; the last has one block per group."""
    out = [materialise(tier(nodes), "tier")]
    widest = out[0].agg(F.max("n")).first()[0] or 0
    while widest > BLOCK:
        widest = -(-widest // BLOCK)
        tops = out[-1].select(
            "grp", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("block").alias("pos"),
            F.col("node.hash").alias("hash"), F.lit(None).cast("int").alias("item"),
        )
        out.append(materialise(tier(tops), "tier"))
    return out


def descend(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(grp, pos, hash, item, subroot, root, steps) for the nodes of a tier.

    ``above``: (grp, pos, subroot, root, steps) of its blocks. A step is <left, right>: the
    joined digests beside the node in its run; the lowest comes first."""
    met = (
        blocks.select("grp", "block", "node")
        .unionByName(above.select("grp", F.col("pos").alias("block"), "subroot", "root", "steps"), allowMissingColumns=True)
        .groupBy("grp", "block")
        .agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("node", "subroot", "root", "steps")])
    )
    out = met.withColumnRenamed("block", "pos")
    kids = F.col("node.kids")

    def beside(x: Column, i: Column) -> Column:
        left, right = joined(F.slice(kids, F.lit(1), i)), joined(F.slice(kids, i + 2, F.size(kids)))
        return F.struct(x.alias("node"), i.alias("i"), F.struct(left.alias("left"), right.alias("right")).alias("step"))

    for _ in range(LEVELS):
        opened = out.select("grp", "pos", "subroot", "root", "steps", F.col("node.folded").alias("folded"), F.explode(F.transform(kids, beside)).alias("kid"))
        steps = F.when(F.col("folded"), F.concat(F.array("kid.step"), "steps")).otherwise(F.col("steps"))
        out = opened.select("grp", (F.col("pos") * FAN + F.col("kid.i")).alias("pos"), F.col("kid.node").alias("node"), "subroot", "root", steps.alias("steps"))
    return out.select("grp", "pos", "node.hash", "node.item", "subroot", "root", "steps")


def walk(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """From the tops of all groups down to the nodes of the lowest tier."""
    for blocks in reversed(levels):
        above = descend(blocks, above)
    return above


STEPS = "array<struct<left:string,right:string>>"


def proofs(nodes: DataFrame, order: list[str]) -> DataFrame:
    """(grp, pos, hash, item, subroot, root, steps) for rows (grp, hash, item, *order).

    ``grp`` is a string, never null; ``order`` ranks rows within it. A proof holds by
    ``folded_up(hash, steps) = root``. An empty table gives none."""
    stored = materialise(nodes, "leaves")
    lower = tiers(ranked(stored, order).select("grp", "n", "pos", "hash", "item"))
    subroots = lower[-1].select(F.lit("").alias("grp"), F.col("node.hash").alias("hash"), F.col("grp").alias("item"))
    upper = tiers(ranked(materialise(subroots, "subroots"), ["item"]))
    tops = upper[-1].select("grp", F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("subroot"), F.col("node.hash").alias("root"), F.array().cast(STEPS).alias("steps"))
    groups = walk(upper, tops).select(F.col("item").alias("grp"), F.lit(0).cast("bigint").alias("pos"), F.col("hash").alias("subroot"), "root", "steps")
    return walk(lower, groups)


def folded_up(start: Column, steps: Column) -> Column:
    """The root that a leaf and its steps lead to."""
    return F.aggregate(steps, start, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def siblings(steps: Column) -> Column:
    """All digests of a proof in one string, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang", changed: dict[str, Column] | None = None) -> DataFrame:
    """(key, leaf, changed_leaf, subroot, root, steps) for every row.

    Rows go by ``key`` within ``group``, null first, equal keys by their leaf; rows equal in
    all fields are leaves of their own, with equal digests. A null group is a group, before all
    others. ``changed`` replaces fields for ``changed_leaf``, which is null without it or where
    nothing changes. Other columns are not read. A table without rows has no manifest rows."""
    columns = {f: F.col(f"`{f}`") for f in fields}
    leaf_now = leaf(list(columns.values()))
    other = F.lit(None).cast("string")
    if changed:
        differs = F.lit(False)
        for f, value in changed.items():
            differs = differs | ~columns[f].eqNullSafe(value)
        other = F.when(differs, leaf([changed.get(f, c) for f, c in columns.items()]))
    # null before the empty string, both before all others
    grp = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("key"), leaf_now.alias("hash"), other.alias("other"), grp.alias("grp"))
    nodes = rows.select("grp", "key", "hash", F.struct("key", "other").alias("item"))
    found = proofs(nodes, ["key", "hash"])
    return found.select(F.col("item.key").alias(key), F.col("hash").alias("leaf"), F.col("item.other").alias("changed_leaf"), "subroot", "root", "steps")


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified). Rows whose id's
    checksum three divides are tampered with: capital letters A to Z of the text become small.
    A null id is not tampered with."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    small = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = manifest(docs, changed={"text": F.when(hit, small).otherwise(F.col("text"))})
    top = folded_up(F.coalesce("changed_leaf", "leaf"), F.col("steps"))
    rows = found.select("doc_id", "leaf", "subroot", "root", digest(siblings(F.col("steps"))).alias("proof_sha256"), top.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
