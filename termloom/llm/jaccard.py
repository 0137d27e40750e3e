"""Jaccard join on word n-grams by prefix filters under several global orders.

Two sets can only be similar if their prefixes share a token, whatever the global order of
tokens: of n tokens the first ``n - ceil(t n) + 1``. Candidates have to pass under every one
of these orders before they are verified:

1. rarest first, over the whole corpus. A fixed share of the hash range goes first, by document
   frequency, and the rest follows by hash; so only that share has to be counted. A token
   that no other set has can match nothing, and most documents have a prefix of such tokens:
   they are done.
2. by hash, up; 3. by hash, down; and the rarest first again among what is compared. These
   need no corpus statistics and are intersected in the task that verifies.

Documents with equal sets are one class from the start. Classes that share a token in their
first prefixes are tied to the smallest class of that token, never to each other, and the
components of these ties are the units of verification. A component is compared in blocks of
bounded bytes; within a block pair a search over the similar ones starts from any class and
compares each class it takes up with those not yet reached, so a group of thousands of near
copies costs little more than one comparison each. Only one link per reached class leaves a
task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.decontaminate import window_hashes
from termloom.operators.dbscan import connected_components
from termloom.session import materialise, may_match

WORDS, PERCENT = 3, 90
# Bytes of sets in one block, and in a task's share of small components.
BLOCK_BYTES, SHARE_BYTES = 24 << 20, 6 << 20
# Ties and links that one task may put together; more are contracted by joins first.
LOCAL_EDGES = 200_000
# Rows of some numbers that may be broadcast. Beyond it documents are tested by a table of bits of
# bounded size where they are read, and what passes is shuffled for a join.
BROADCAST_ROWS = 50_000


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of word n-grams; words are what stands between ASCII white
    space, with A-Z in lower case. Fewer words than ``words`` make one n-gram."""
    found = text.encode().lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.array(list(map(xxhash.xxh3_64_intdigest, found)), dtype=np.uint64)
    return np.unique(window_hashes(hashes, min(words, len(hashes))))


def class_of(tokens: np.ndarray) -> int:
    """Equal sets have equal classes."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def counted_share(percent: int) -> int:
    """Hashes below this bound are counted. The share has to be over that of a prefix; the more
    it is over, the more of the frequent tokens a prefix can avoid, and the more is shuffled:
    twice the prefix up to a quarter of all tokens, and never less than 1.25 times."""
    prefix = (100 - percent) / 100
    return int((1 << 64) * min(0.49, max(1.25 * prefix, min(2 * prefix, 0.25))))


SETS = "doc_id bigint, text_key bigint, class bigint, n int, prefix int, counted int, tokens array<bigint>"


def _sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Per document its class, set size, prefix length and the tokens that can be in its first
    prefix: all counted ones, or as many by hash as the prefix has."""
    bound = np.uint64(counted_share(percent))
    fields = [("doc_id", pa.int64()), ("text_key", pa.int64()), ("class", pa.int64()), ("n", pa.int32()), ("prefix", pa.int32()), ("counted", pa.int32()), ("tokens", pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for key, text_key, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    tokens = shingles(text, words)
                    n = len(tokens)
                    if not n or key is None:
                        rows.append((key, text_key, None, n, 0, 0, None))
                        continue
                    counted, prefix = int(np.searchsorted(tokens, bound)), prefix_length(n, percent)
                    rows.append((key, text_key, class_of(tokens), n, prefix, counted, tokens[: max(counted, prefix)].view(np.int64)))
                columns = zip(zip(*rows, strict=True), fields, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in columns], [name for name, _ in fields])

    return docs.mapInArrow(run, SETS)


def _ties(sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): classes that share a token in their first prefixes, each with the smallest."""
    bound = counted_share(percent)
    postings = sets.where(F.col("class").isNotNull()).select("class", "prefix", "counted", F.explode("tokens").alias("token"))
    shared = (
        postings.groupBy("token")
        .agg(F.count("*").alias("df"), F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low != high")
        .select("token", "df")
    )
    shared = materialise(shared, "shared")
    # most tokens have one posting, which need not be shuffled again
    some = postings.where(may_match(shared.select("token"), shared.count())("token"))
    own = some.join(shared, "token").groupBy("class").agg(
        F.first("prefix").alias("prefix"), F.first("counted").alias("counted"), F.collect_set(F.struct("df", "token")).alias("shared")
    )
    is_counted = lambda s: (s["token"] >= 0) & (s["token"] < bound)
    counted = F.array_sort(F.filter("shared", is_counted))
    # tokens that nobody else has come first and use up the prefix
    room = F.greatest(F.lit(0), F.col("prefix") - (F.col("counted") - F.size(F.filter("shared", is_counted))))
    first = F.concat(F.slice(counted, F.lit(1), room), F.filter("shared", lambda s: ~is_counted(s)))
    matching = materialise(own.select("class", F.explode(F.transform(first, lambda s: s["token"])).alias("token")), "prefixes")
    leaders = matching.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high")
    return matching.join(leaders.select("token", "low"), "token").where("class != low").select(
        F.col("low").alias("u"), F.col("class").alias("v")
    ).distinct()


class Group:
    """Sets that are compared with each other in one task."""

    def __init__(self, classes: np.ndarray, sets: list[np.ndarray], percent: int) -> None:
        self.classes, self.percent = classes, percent
        self.n = np.array(list(map(len, sets)))
        self.at = np.concatenate(([0], np.cumsum(self.n)))
        _, tokens, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # numbered by hash, each set in rising order; a block pair has far fewer than 2**31 tokens
        self.tokens = tokens.astype(np.int32)
        del tokens
        self.size = len(counts)
        up = np.arange(self.size, dtype=np.int32)
        rare = np.empty(self.size, np.int32)
        rare[np.lexsort((up, counts))] = up
        del counts
        self.indexes = [self._index(order) for order in (rare, up, -up)]

    def _index(self, order: np.ndarray):
        """Prefix tokens of every set under an order, and the sets of every prefix token."""
        prefixes = []
        for i in range(len(self.n)):
            own = self.tokens[self.at[i] : self.at[i + 1]]
            k = prefix_length(len(own), self.percent)
            prefixes.append(own[np.argpartition(order[own], k - 1)[:k]] if k < len(own) else own)
        flat = np.concatenate(prefixes)
        owner = np.repeat(np.arange(len(prefixes), dtype=np.int32), list(map(len, prefixes)))
        starts = np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=self.size)))).astype(np.int32)
        return prefixes, owner[np.argsort(flat, kind="stable")], starts

    def similar(self, u: int, open_: np.ndarray) -> np.ndarray:
        """Sets among the open ones that are similar to set u."""
        n, percent = self.n, self.percent
        passing = open_ & (100 * n >= percent * n[u]) & (percent * n <= 100 * n[u])
        for prefixes, owners, start in self.indexes:
            if not passing.any():
                return np.empty(0, np.int64)
            hit = np.zeros(len(n), bool)
            for t in prefixes[u].tolist():
                hit[owners[start[t] : start[t + 1]]] = True
            passing &= hit
        found = np.flatnonzero(passing)
        if not len(found):
            return found
        mark = np.zeros(self.size, bool)
        mark[self.tokens[self.at[u] : self.at[u + 1]]] = True
        both = np.array([np.count_nonzero(mark[self.tokens[self.at[v] : self.at[v + 1]]]) for v in found.tolist()])
        return found[100 * both >= percent * (n[u] + n[found] - both)]

    def links(self) -> list[tuple[int, int]]:
        """(class, class) from one class of each component to all others in it."""
        out, open_ = [], np.ones(len(self.n), bool)
        for root in range(len(self.n)):
            if not open_[root]:
                continue
            open_[root] = False
            todo = [root]
            while todo and open_.any():
                new = self.similar(todo.pop(), open_)
                open_[new] = False
                todo += new.tolist()
                out += [(int(self.classes[root]), c) for c in self.classes[new].tolist()]
        return out


def _links(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Verified links (u, v) among candidate ``classes`` (class, doc_id, unit, n)."""
    spark = docs.sparkSession
    sizes = classes.groupBy("unit").agg(F.sum("n").alias("tokens"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("tokens") * 8 / BLOCK_BYTES)).cast("int")
    rows = classes.join(sizes, "unit").select("class", "doc_id", "unit", "n", blocks.alias("blocks"))
    rows = materialise(rows, "candidates")
    count, tokens = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not count:
        return spark.createDataFrame([], "u bigint, v bigint")
    shares = max(1, -(-tokens * 8 // SHARE_BYTES))
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    small = F.col("blocks") == 1
    keys = F.when(
        small, F.array(F.struct(F.pmod(F.xxhash64("unit"), F.lit(shares)).alias("share"), F.lit(0).alias("i"), F.lit(0).alias("j")))
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda b: F.struct((-F.col("unit").bitwiseAND((1 << 62) - 1) - 1).alias("share"), F.least(b, block).alias("i"), F.greatest(b, block).alias("j")),
        )
    )
    wanted = rows.select(F.col("doc_id").alias("_id"), "class", "unit", "blocks")
    if count <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    else:
        docs = docs.where(may_match(rows.select("doc_id"), count)("doc_id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                made = [shingles(t, words) for t in part.column("text").to_pylist()]
                # a row of the same id with another text is another class
                right = pa.array([len(s) > 0 and class_of(s) == c for s, c in zip(made, part.column("class").to_pylist(), strict=True)])
                whole = pa.RecordBatch.from_arrays(
                    [part.column("class"), part.column("unit"), part.column("blocks"), pa.array([s.tobytes() for s in made], pa.binary())],
                    ["class", "unit", "blocks", "tokens"],
                )
                yield whole.filter(right)

    texts = docs.join(wanted, F.col("doc_id") == F.col("_id")).select("text", "class", "unit", "blocks")
    ready = texts.mapInArrow(sets, "class bigint, unit bigint, blocks int, tokens binary")
    dealt = ready.select("class", "unit", "tokens", F.explode(keys).alias("k")).select("k.*", "class", "unit", "tokens")

    def verify(table: pa.Table) -> pa.Table:
        units, classes_ = table.column("unit").to_numpy(), table.column("class").to_numpy()
        tokens_ = table.column("tokens")
        order = np.lexsort((classes_, units))
        out: list[tuple[int, int]] = []
        for own in np.split(order, np.flatnonzero(np.diff(units[order])) + 1):
            own = own[np.concatenate(([True], np.diff(classes_[own]) != 0))]
            if len(own) > 1:
                made = [np.frombuffer(tokens_[int(i)].as_py(), dtype=np.uint64) for i in own]
                out += Group(classes_[own], made, percent).links()
        u, v = zip(*out, strict=True) if out else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return dealt.groupBy("share", "i", "j").applyInArrow(verify, "u bigint, v bigint")


def _components(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows of (doc_id, text) as (doc_id, text_key, class, n), and per class its component."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    sets = materialise(_sets(rows, words, percent), "sets")
    first = sets.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    first = materialise(first, "classes")
    units = connected_components(_ties(sets, percent), LOCAL_EDGES)
    candidates = first.join(units.select(F.col("node").alias("class"), F.col("root").alias("unit")), "class")
    linked = connected_components(_links(docs, candidates, words, percent), LOCAL_EDGES)
    placed = first.join(linked.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "doc_id", F.coalesce("root", "class").alias("root")
    )
    return sets, materialise(placed, "placed")


def _without(rows: DataFrame, out: DataFrame) -> DataFrame:
    """``rows`` that have no partner in the stored table ``out`` of some of their columns. Of a long
    table only rows that may have one are shuffled."""
    keys, n = out.columns, out.count()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(out), keys, "left_anti")
    may = may_match(out, n)(*keys)
    return rows.where(~may).unionByName(rows.where(may).join(out, keys, "left_anti"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: set size, and the smallest id that
    links reach. Sets link when their intersection is at least ``percent`` of their union.

    Null, empty and blank texts have no shingles and no links. A row without an id has a null
    component and links nothing. Rows that share an id are rows of their own: each has the
    component of its own text. Other columns are not read. Empty tables give no rows.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sets, placed = _components(rows, words, percent)
    lowest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(lowest, "root").select("class", "component_id")
    return sets.join(named, "class", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest id, of
    several rows with this id the one of the smallest hash of its text, of equal ones one.

    A row is named by its id and text, so rows that share an id are judged each by its own
    text. Rows without an id or without words stay, also repeated ones. Extra columns pass. The
    list of rows to leave out is stored first, so Spark sees its size when it chooses the join."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sets, placed = _components(rows, words, percent)
    named = sets.join(placed.select("class", "root"), "class").groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("copies"))
    named = materialise(named, "named")
    stays = named.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    judged = named.join(stays, "root").select("doc_id", "text_key", "copies", (F.struct("doc_id", "text_key") == F.col("first")).alias("stays"))
    judged = materialise(judged.where(~F.col("stays") | (F.col("copies") > 1)), "judged")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = whole.select("row", F.col("row").getField(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col("row").getField(text)).alias("text_key"))
    same = ["doc_id", "text_key"]
    kept = _without(whole, judged.select(*same))
    repeated = judged.where("stays").select(*same)
    if not repeated.isEmpty():
        once = whole.join(repeated, same, "left_semi").groupBy(*same).agg(F.first("row").alias("row"))
        kept = kept.unionByName(once)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
