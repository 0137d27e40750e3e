"""Order-preserving packing of tokenised documents by dynamic programming.

A stream is the concatenation of documents in the order in which the input holds them. It
may be cut at document ends, at sentence ends and, inside what has neither for
``soft_tokens``, at steps of ``soft_tokens``. Cuts are chosen to minimise the padding of all
sequences plus a penalty per cut:

    best[j] = cut(j) + min over i<j, end[j]-end[i] <= window of best[i] + pad(end[j]-end[i])

``pad`` is what is missing to ``window`` tokens, but nothing for a length that is a power of
two. As the padding is linear in end[i], the minimum over the window is a sliding minimum of
best[i] + end[i], kept in a monotone queue; the powers of two are looked up one by one.

The job needs no shuffle: each task packs the documents of its own split, in the order in
which it reads them, in streams of about ``stream_tokens`` ids. A sequence id is made of the
split and a counter; it is the same when a lost task runs again.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.tokens import encoder, tokenizer_path

WINDOW = 1024
SENTENCE_CUT = 4  # penalty, in tokens of padding, of a cut at a sentence end inside a document
SOFT_CUT = 12  # of a cut inside a sentence
SOFT_TOKENS = 48
SEQUENCE_COST = 1  # of any further sequence
STREAM_TOKENS = 1 << 19
END_OF_TEXT = 0

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def cut_points(ends: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Indexes of the cheapest cuts. ``ends``: rising positions where a cut is allowed, the
    last one is the stream's length; ``penalty``: of each. No two may lie over ``window``
    apart. Ties go to the longer last sequence."""
    end, cost = ends.tolist(), penalty.tolist()
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    at = {0: -1}
    best, back = [0.0] * (len(end) + 1), [0] * len(end)  # best[-1] belongs to position 0
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, -1)])  # best + end, end, index
    for j, e in enumerate(end):
        low = e - window
        while queue[0][1] < low:
            queue.popleft()
        value, _, i = queue[0]
        value += window - e
        for p in powers:  # no padding at these lengths
            k = at.get(e - p)
            if k is not None and best[k] < value:
                value, i = best[k], k
        value += cost[j] + SEQUENCE_COST
        best[j], back[j], at[e] = value, i, j
        key = value + e
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, e, j))
    cuts, j = [], len(end) - 1
    while j >= 0:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def boundaries(ids: np.ndarray, closes: np.ndarray, opens: np.ndarray, soft: int = SOFT_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a document after which it may be cut, and their penalties; the last is
    the document's length, at no penalty. closes, opens: by id, whether a sentence can end
    with it, and whether what follows a sentence can start with it."""
    n = len(ids)
    ends = np.flatnonzero(closes[ids[:-1]] & opens[ids[1:]]) + 1
    edges = np.concatenate(([0], ends, [n]))
    gaps = np.diff(edges)
    wide = np.flatnonzero(gaps > soft)
    inner = [np.arange(edges[k] + soft, edges[k + 1], soft) for k in wide]
    soft_ends = np.concatenate(inner) if inner else np.empty(0, dtype=np.int64)
    where = np.concatenate((ends, soft_ends, [n]))
    penalty = np.concatenate((np.full(len(ends), SENTENCE_CUT), np.full(len(soft_ends), SOFT_CUT), [0]))
    order = np.argsort(where, kind="stable")
    return where[order], penalty[order]


class Packer:
    """Collects tokenised documents and packs them stream by stream."""

    def __init__(self, path: str, window: int, stream_tokens: int) -> None:
        self.encoder, self.window, self.stream_tokens = encoder(path), window, stream_tokens
        strings = self.encoder.strings
        self.closes = np.array([s.rstrip(b" \"')\n")[-1:] in (b".", b"!", b"?") or s.endswith(b"\n") for s in strings])
        self.opens = np.array([s[:1] in (b" ", b"\n", b"\r", b"\t") or s[:1].isupper() for s in strings])
        self.next_sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        self.clear()

    def clear(self) -> None:
        self.docs, self.ends, self.penalties, self.size = [], [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> list[tuple]:
        ids = np.append(self.encoder.encode(text or ""), np.uint32(END_OF_TEXT)).astype("<u4", copy=False)
        ends, penalty = boundaries(ids, self.closes, self.opens, min(SOFT_TOKENS, self.window))
        self.docs.append((doc_id, self.size, ids))
        self.ends.append(ends + self.size)
        self.penalties.append(penalty)
        self.size += len(ids)
        return self.flush() if self.size >= self.stream_tokens else []

    def flush(self) -> list[tuple]:
        """Pieces of all collected documents."""
        if not self.docs:
            return []
        ends = np.concatenate(self.ends)
        cuts = ends[cut_points(ends, np.concatenate(self.penalties), self.window)].tolist()
        out, c, begin = [], 0, 0
        for doc_id, first, ids in self.docs:
            at, last = first, first + len(ids)
            while at < last:
                stop = min(last, cuts[c])
                part = ids[at - first : stop - first]
                out.append((doc_id, at - first, stop - at, zlib.crc32(part.tobytes()), len(ids), self.next_sequence, at - begin))
                at = stop
                if at == cuts[c]:
                    begin, c, self.next_sequence = at, c + 1, self.next_sequence + 1
        self.clear()
        return out


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    tokenizer: str | None = None,
    stream_tokens: int = STREAM_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is an empty one: the end mark alone. A null id is kept as null; repeated rows
    are packed each for itself. Other columns are not read. An empty table gives no rows.
    ``docs`` in another order (``sortWithinPartitions``) is packed in that order.
    """
    path = tokenizer or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(path, window, stream_tokens)
        names = PIECES.replace(" bigint", "").split(", ")

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    found += packer.add(doc_id, text)
                if found:
                    yield rows(found)
        yield rows(packer.flush())

    return docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text")).mapInArrow(run, PIECES)


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """(sequence_id, tokens, padding): what each sequence is padded by."""
    tokens = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"))
    power = F.col("tokens").bitwiseAND(F.col("tokens") - 1) == 0
    return tokens.withColumn("padding", F.when(power, 0).otherwise(window - F.col("tokens")))
