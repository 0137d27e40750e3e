"""Benchmark decontamination by template canonicalisation.

Words become canonical tokens: lower case without surrounding punctuation, numbers (also
spelled), names (capitalised inside a sentence) and units (after a number) as typed
placeholders. A benchmark item is the list of its template windows, and the hash of a window
is joined with the windows of all documents. Hits on one diagonal (same document, item and
shift) are put together; where the words agree on enough of the item, the values in the
slots have to be consistent: one value of the item stands for one value in the document and
the other way round. So the same question with other numbers is caught, and two texts that
merely share a frame with unrelated values are not.

A window without a plain word says nothing as a template, as all lists of numbers have the
same: it stands for its literal words. Diagonals are opened by windows that occur once in their
item, and by the first of several where a run of it begins in the document; the others only
add to diagonals that are open. So repeats on both sides are never paired with each other.

The windows of the benchmark are held by the tasks as a sorted array of hashes, in blocks of
at most ``BLOCK_WINDOWS``; a larger benchmark takes one pass over the documents per block.
Only windows that hit leave a task, and the join is on these.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.session import materialise

WINDOW = 8
MIN_COVERAGE = 0.6
BLOCK_WINDOWS = 2_000_000
KEPT_WORDS = 100_000

NUMBER = re.compile(r"[+-]?\d[\d.,:/]*")
MEASURE = re.compile(r"[+-]?\d[\d.,]*[a-z°]+\d?")
# Spelled numbers and units of measure.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million "
    "billion".split()
)
UNITS = frozenset(
    "kg g mg lb lbs oz ton tons tonne tonnes gram grams kilogram kilograms pound pounds ounce ounces km m cm mm mile "
    "miles meter meters metre metres foot feet ft inch inches yard yards s sec second seconds min minute minutes h hr "
    "hour hours day days week weeks month months year years dollar dollars euro euros cent cents usd eur percent "
    "liter liters litre litres ml l gallon gallons mph kmh volt volts watt watts degree degrees".split()
)
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’„…–—¿¡"
ORDINARY, NUM, MEAS, UNIT = 0, 1, 2, 3
CAPITAL, STOP = 4, 8


def _hash(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token.encode())


PLACE = {k: np.uint64(_hash(f"\x00{k}")) for k in ("number", "name", "unit", "measure")}
BASE = 0x9E3779B97F4A7C15
LITERAL = np.uint64(0xA5A5A5A55A5A5A5B)


def _word(word: str) -> tuple[int, int]:
    """Hash of the lower-case token and its flags."""
    bare = word.strip(PUNCTUATION) or word
    low = bare.lower()
    # both patterns begin with a sign or a digit
    digits = low[:1] in "+-" or low[:1].isdecimal()
    if low in NUMBER_WORDS or digits and NUMBER.fullmatch(low):
        kind = NUM
    elif digits and MEASURE.fullmatch(low):
        kind = MEAS
    else:
        kind = UNIT if low in UNITS else ORDINARY
    stop = word.rstrip("\"')]»”’")[-1:] in (".", "!", "?", ":")
    return _hash(low), kind | (CAPITAL if bare[:1].isupper() else 0) | (STOP if stop else 0)


class Words(dict):
    """Place of each word in the arrays of hashes and flags, which grow by doubling."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes, self.flags = np.empty(1024, np.uint64), np.empty(1024, np.int8)

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.hashes):
            self.hashes, self.flags = (np.concatenate([x, np.empty_like(x)]) for x in (self.hashes, self.flags))
        self.hashes[at], self.flags[at] = _word(word)
        self[word] = at
        return at


class Canonical:
    """Templates of texts, with a bounded cache of words."""

    def __init__(self) -> None:
        self.words = Words()

    def tokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token hashes, and which tokens are slots."""
        return self.template(words)[:2]

    def template(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token hashes, which tokens are slots, and the hashes of the words as they stand."""
        if not words:
            return np.empty(0, np.uint64), np.empty(0, bool), np.empty(0, np.uint64)
        if len(self.words) > KEPT_WORDS:
            self.words = Words()
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        literal, flags = self.words.hashes[at], self.words.flags[at]
        tokens = literal.copy()
        kind = flags & 3
        starts = np.concatenate(([True], (flags[:-1] & STOP) > 0))
        follows_number = np.concatenate(([False], kind[:-1] == NUM))
        number, measure = kind == NUM, kind == MEAS
        unit = (kind == UNIT) & follows_number
        name = ((flags & CAPITAL) > 0) & ~starts & ~number & ~measure & ~unit
        for where, place in ((number, "number"), (measure, "measure"), (unit, "unit"), (name, "name")):
            tokens[where] = PLACE[place]
        return tokens, number | measure | unit | name, literal


def template_hashes(tokens: np.ndarray, slots: np.ndarray, literal: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` template tokens; a run of slots only is hashed as it stands."""
    hashes = window_hashes(tokens, width)
    if slots.any() and len(hashes):
        upto = np.concatenate(([0], np.cumsum(slots)))
        bare = np.flatnonzero(upto[width:] - upto[:-width] == width)
        if len(bare):
            hashes[bare] = window_hashes(literal, width)[bare] ^ LITERAL
    return hashes


def run_starts(hashes: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """Whether the same window does not begin within the ``width`` words before."""
    order = np.lexsort((places, hashes))
    again = (hashes[order][1:] == hashes[order][:-1]) & (np.diff(places[order]) <= width)
    out = np.ones(len(places), bool)
    out[order[1:][again]] = False
    return out


def window_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` tokens."""
    n = len(tokens) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = out * np.uint64(BASE) + tokens[i : i + n]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return out + np.uint64(width)


HITS = "id bigint, position int, hash bigint, width int, n_tokens int, opens boolean, slots array<string>"
_FIELDS = [("id", pa.int64()), ("position", pa.int32()), ("hash", pa.int64()), ("width", pa.int32()),
           ("n_tokens", pa.int32()), ("opens", pa.bool_()), ("slots", pa.list_(pa.string()))]


def _windows(texts: DataFrame, width: int, hits_of=None) -> DataFrame:
    """Template windows of (id, text) rows; ``opens`` where a run of equal windows begins. ``hits_of``: broadcast (widths, sorted hashes) to
    keep only windows among them; without, the windows of a benchmark item, or the item as
    one window where it is shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical()
        if hits_of is not None:
            widths, known = hits_of.value
            table = np.zeros(1 << 16, dtype=bool)
            table[(known >> np.uint64(48)).astype(np.int64)] = True
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows: list[tuple] = []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = text.split() if text else []
                    tokens, slots, literal = canonical.template(words)
                    for w in widths if hits_of is not None else ([min(width, len(tokens))] if words else []):
                        hashes = template_hashes(tokens, slots, literal, w)
                        places = np.arange(len(hashes))
                        if hits_of is not None:
                            places = places[table[(hashes >> np.uint64(48)).astype(np.int64)]]
                            at_most = np.minimum(np.searchsorted(known, hashes[places]), len(known) - 1)
                            places = places[known[at_most] == hashes[places]]
                        opens = run_starts(hashes[places], places, w)
                        for p, o in zip(places.tolist(), opens.tolist(), strict=True):
                            inside = [words[i].strip(PUNCTUATION).lower() if slots[i] else None for i in range(p, p + w)]
                            rows.append((key, p, int(hashes[p].astype(np.int64)), w, len(tokens), o, inside))
                if rows:
                    columns = zip(zip(*rows, strict=True), _FIELDS, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in columns], [n for n, _ in _FIELDS])

    return texts.mapInArrow(run, HITS)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    window: int = WINDOW,
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """(doc_id, item_id, position, covered, n_tokens, coverage, n_slots, n_changed): documents
    that hold the template of an item with consistent slots, at the best shift.

    ``position`` is the word of the document at which the item starts, ``covered`` counts
    the item's tokens in windows that agree, ``n_changed`` slots with another value. Null and
    empty texts hold nothing, rows without an id are left out, repeated rows count once,
    columns beside id and text are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    bench = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(text).alias("text")).where("id is not null")
    grams = materialise(_windows(bench, window).dropDuplicates(["id", "position", "hash"]), "templates")
    blocks = max(1, -(-grams.count() // BLOCK_WINDOWS))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).where("id is not null")
    hits: DataFrame | None = None
    for b in range(blocks):
        block = grams.where(F.pmod("hash", F.lit(blocks)) == b).select("hash", "width").distinct().toPandas()
        widths = sorted({int(w) for w in block["width"]})
        known = np.sort(block["hash"].to_numpy(dtype=np.int64).view(np.uint64))
        if not len(known):
            continue
        found = _windows(rows, window, spark.sparkContext.broadcast((widths, known)))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = spark.createDataFrame([], HITS)
    hits = materialise(hits.withColumnRenamed("id", "doc_id"), "hits")
    times = grams.groupBy("id", "hash", "width").agg(F.count("*").alias("times"), F.min("position").alias("first_at"))
    # 1: opens wherever it is; 2: where a run begins; 0: adds to open diagonals only
    role = F.when(F.col("times") == 1, 1).when(F.col("position") == F.col("first_at"), 2).otherwise(0)
    item = grams.join(times, ["id", "hash", "width"]).select(
        "hash", "width", F.col("id").alias("item_id"), F.col("position").alias("at"), role.alias("role"),
        F.col("n_tokens").alias("item_tokens"), F.col("slots").alias("item_slots"),
    )
    item = materialise(item, "items")
    columns = (
        "doc_id", "item_id", (F.col("position") - F.col("at")).alias("position"), "at", "width", "item_tokens",
        F.transform("slots", lambda new, i: F.struct((F.col("at") + i).alias("place"), F.get("item_slots", i).alias("old"), new.alias("new"))).alias("pairs"),
    )
    seeds = hits.join(item.where("role > 0"), ["hash", "width"])
    both = seeds.where("role = 1 or opens").select(*columns)
    rest = item.where("role < 1")
    if not rest.isEmpty():
        both = materialise(both, "seeds")
        open_ = both.select("doc_id", "item_id", F.col("position").alias("shift")).distinct()
        wanted = open_.join(rest, "item_id").withColumn("position", F.col("shift") + F.col("at"))
        more = hits.drop("opens", "n_tokens").join(wanted, ["doc_id", "position", "hash", "width"])
        again = hits.where(~F.col("opens")).drop("opens", "n_tokens").join(
            open_.join(item.where("role = 2"), "item_id").withColumn("position", F.col("shift") + F.col("at")),
            ["doc_id", "position", "hash", "width"],
        )
        both = both.unionByName(more.select(*columns)).unionByName(again.select(*columns))
    merged = both.groupBy("doc_id", "item_id", "position").agg(
        F.first("item_tokens").alias("n_tokens"),
        F.array_distinct(F.flatten(F.collect_set(F.sequence("at", F.col("at") + F.col("width") - 1)))).alias("places"),
        F.array_distinct(F.flatten(F.collect_set(F.filter("pairs", lambda p: p["new"].isNotNull())))).alias("pairs"),
    )
    kinds = lambda *names: F.size(F.array_distinct(F.transform("pairs", lambda p: F.struct(*[p[n].alias(n) for n in names]))))
    judged = merged.select(
        "doc_id", "item_id", "position", F.size("places").alias("covered"), "n_tokens",
        (F.size("places") / F.col("n_tokens")).alias("coverage"), F.size("pairs").alias("n_slots"),
        F.size(F.filter("pairs", lambda p: p["old"] != p["new"])).alias("n_changed"),
        ((kinds("old") == kinds("old", "new")) & (kinds("new") == kinds("old", "new"))).alias("consistent"),
    ).where((F.col("coverage") >= min_coverage) & F.col("consistent"))
    best = F.max(F.struct("coverage", (-F.col("n_changed")).alias("same"), (-F.col("position")).alias("first"), "covered", "n_tokens", "n_slots"))
    return judged.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", (-F.col("b.first")).alias("position"), "b.covered", "b.n_tokens", "b.coverage",
        "b.n_slots", (-F.col("b.same")).alias("n_changed"),
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text holds an item.

    Each row is judged by its own text, named by a hash of it: rows that share an id are
    judged apart, rows without an id too, and repeated rows go or stay together. Extra columns
    pass. The list of leaks is stored first, so Spark sees its size when it chooses the join."""
    named = docs.select(F.xxhash64(text).alias("doc_id"), F.col(text).alias("text"))
    found = materialise(leaks(named, items.withColumnRenamed(text, "text"), **options).select("doc_id").distinct(), "leaks")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = whole.withColumn("doc_id", F.xxhash64(F.col("row").getField(text))).join(found, "doc_id", "left_anti")
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
