"""WARC archives: writing, reading and reassembly of segmented records.

Writing: Spark's text writer puts the bytes of one record (or segment) per row into a file,
with the two empty lines that end a WARC record as its separator; with ``compression="gzip"``
the file is one gzip stream. A block longer than ``segment_bytes`` becomes a first record
with segment number 1 and ``continuation`` records that name its id as their origin; the last
of them states the total length.

Reading: each archive file is one task's row, parsed by the lengths in the headers, so a
payload may hold anything. Segments are grouped by origin, put in order of their number and
checked for gaps and for the total length; records in one piece never take part in that
shuffle. Then HTTP headers are split off and chunked framing is removed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.session import HOT_KEY_LIMIT, materialise, new_table_path

END = "\r\n\r\n"
SEGMENT_BYTES = 1 << 16
CHUNK_BYTES = 1 << 13
# Records per archive file; with the segment size it bounds a file, and so a reading task.
FILE_RECORDS = 1000
MIN_REVISIT_BYTES = 1000

RECORDS = (
    "file string, position int, record_id string, record_type string, target_uri string, page_id bigint, "
    "refers_to bigint, digest string, segment_number int, origin_id string, total_length bigint, block binary, problem string"
)


def header(name: str, value: Column) -> Column:
    """One header line, or nothing for a null; line breaks in a value become blanks."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x1f\x7f]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def chunked(payload: Column, size: int = CHUNK_BYTES) -> Column:
    """Bytes in HTTP chunked framing."""
    n = F.octet_length(payload)
    piece = lambda i: F.substring(payload, i * size + 1, F.lit(size))
    parts = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(n / size).cast("int") - 1, F.lit(0))),
        lambda i: F.concat(F.encode(F.concat(F.lower(F.hex(F.octet_length(piece(i)))), F.lit("\r\n")), "UTF-8"), piece(i), F.lit(b"\r\n")),
    )
    return F.concat(F.when(n > 0, joined(parts)).otherwise(F.lit(b"")), F.lit(b"0\r\n\r\n"))


def joined(parts: Column) -> Column:
    """The bytes of an array of binaries in one piece, copied once; a cast keeps bytes as they are."""
    return F.array_join(F.transform(parts, lambda p: p.cast("string")), "").cast("binary")


def pages_to_records(pages: DataFrame, min_revisit: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(record_id, record_type, target_uri, page_id, refers_to, digest, block) of web pages
    with ``page_id``, ``url`` and ``html``.

    Of equal payloads of at least ``min_revisit`` bytes the page with the largest id is the
    response; others are revisits: HTTP headers with the payload's length and no body. Rows
    that share the largest id are all responses; so are rows without an id.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload")).select(
        "*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n")
    )
    last = (
        rows.where(F.col("n") >= min_revisit)
        .groupBy("digest")
        .agg(F.max("page_id").alias("last_page"), F.count("*").alias("copies"))
        .where("copies > 1")
    )
    known = with_last_page(rows, last, min_revisit)
    revisit = F.coalesce(F.col("page_id") < F.col("last_page"), F.lit(False))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.when(revisit, header("Content-Length", F.col("n"))).otherwise(F.lit("Transfer-Encoding: chunked\r\n")),
        F.lit("\r\n"),
    )
    return known.select(
        F.format_string("<urn:page:%s:%s>", "page_id", F.monotonically_increasing_id()).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        "page_id",
        F.when(revisit, F.col("last_page")).alias("refers_to"),
        "digest",
        F.when(revisit, F.encode(http, "UTF-8")).otherwise(F.concat(F.encode(http, "UTF-8"), chunked(F.col("payload")))).alias("block"),
    )


def with_last_page(rows: DataFrame, last: DataFrame, min_revisit: int, limit: int = HOT_KEY_LIMIT) -> DataFrame:
    """``rows`` with ``last_page`` of their digest, null where it is not in ``last``.

    Payloads move only where ``last`` (counted) is too large to broadcast, and then only those
    of at least ``min_revisit`` bytes whose digest is not among the hot ones: at most ``limit``
    digests can have the ``limit``-th part of all copies each."""
    last = materialise(last, "digests")
    n, total = last.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    pages = last.select("digest", "last_page")
    if n <= limit:
        return rows.join(F.broadcast(pages), "digest", "left")
    is_hot = F.col("copies") * F.lit(limit) >= F.lit(total)
    hot, cold = last.where(is_hot).select("digest", "last_page"), last.where(~is_hot).select("digest", "last_page")
    found = rows.join(F.broadcast(hot), "digest", "left")
    open_ = F.col("last_page").isNull() & (F.col("n") >= min_revisit)
    return found.where(~open_).unionByName(found.where(open_).drop("last_page").join(cold, "digest", "left"))


def write(records: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, compression: str = "gzip") -> None:
    """Write records (columns as ``pages_to_records`` gives them) as WARC files."""
    n = F.octet_length("block")
    last = F.greatest(F.ceil(n / segment_bytes).cast("int") - 1, F.lit(0))
    parts = records.select("*", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("i"))
    piece = F.substring("block", F.col("i") * segment_bytes + 1, F.lit(segment_bytes))
    split, first = F.col("last") > 0, F.col("i") == 0
    when = lambda condition, value: F.when(condition, value)
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.when(first, F.col("record_type")).otherwise(F.lit("continuation"))),
        header("WARC-Record-ID", F.when(first, F.col("record_id")).otherwise(F.concat(F.substring_index("record_id", ">", 1), F.lit(":"), F.col("i"), F.lit(">")))),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z\r\n"),
        header("WARC-Target-URI", F.col("target_uri")),
        header("X-Page-ID", F.col("page_id")),
        header("X-Refers-To-Page-ID", when(first, F.col("refers_to"))),
        header("WARC-Profile", when(first & F.col("refers_to").isNotNull(), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        header("WARC-Payload-Digest", when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        header("WARC-Segment-Number", when(split, F.col("i") + 1)),
        header("WARC-Segment-Origin-ID", when(~first, F.col("record_id"))),
        header("WARC-Segment-Total-Length", when(split & (F.col("i") == F.col("last")), n)),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        header("Content-Length", F.octet_length(piece)),
        F.lit("\r\n"),
    )
    value = F.concat(F.encode(head, "UTF-8"), piece).cast("string")  # bytes as they are
    writer = parts.select(value.alias("value")).write.option("maxRecordsPerFile", FILE_RECORDS)
    writer.option("lineSep", END).option("compression", compression).text(path)


def inflate(data: bytes) -> bytes:
    """Plain bytes of a file in one or more gzip members; others are returned as they are."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out) if out else data


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Headers (names in lower case), block and problem of each record."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at : stop if stop >= 0 else len(data)].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, c, v in (line.partition(":") for line in lines[1:]) if c}
        length = fields.get("content-length", "")
        if stop < 0 or not lines[0].startswith("WARC/") or not length.isdigit():
            yield fields, b"", "bad header"
            at = data.find(b"\r\n\r\nWARC/", at)
            at = len(data) if at < 0 else at + 4
            continue
        start, end = stop + 4, stop + 4 + int(length)
        yield fields, data[start:end], None if end <= len(data) else "cut short"
        at = end
        while data[at : at + 2] == b"\r\n":
            at += 2


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record of the files in a folder, plain or gzip; ``problem`` is null
    for a sound record. A row is sent per record; a task holds one file at a time."""
    kinds = [pa.string(), pa.int32(), *[pa.string()] * 3, pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.string()]
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file, rows, held = batch.column(0)[k].as_py(), [], 0
                for position, (h, block, problem) in enumerate(parse(inflate(batch.column(1)[k].as_py()))):
                    digest = h.get("warc-payload-digest")
                    rows.append((
                        file, position, h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"), _number(h.get("x-page-id")),
                        _number(h.get("x-refers-to-page-id")), digest and digest.removeprefix("sha1:"), _number(h.get("warc-segment-number")),
                        h.get("warc-segment-origin-id"), _number(h.get("warc-segment-total-length")), block, problem,
                    ))
                    held += len(block)
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    return files.mapInArrow(run, RECORDS)


def packed(records: DataFrame) -> DataFrame:
    """A stored copy in the closest packing, as blocks are most of the bytes."""
    path = new_table_path(records.sparkSession, "records")
    records.write.option("compression", "zstd").parquet(path)
    return records.sparkSession.read.schema(records.schema).parquet(path)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: (record_id, record_type, target_uri, page_id, refers_to, digest,
    segments, block, problem). ``records`` is stored first, so archives are parsed once. A
    segment sent again with the same bytes counts once.

    ``problem``: what the reader found, ``no origin`` (continuations without a first
    segment), ``missing segment``, ``repeated segment``, ``no total length`` or ``wrong
    length``; null when sound. Broken records are kept, with what is there of the block.
    """
    kept = ["record_id", "record_type", "target_uri", "page_id", "refers_to", "digest"]
    records = packed(records)
    whole = records.where(F.col("segment_number").isNull()).select(*kept, F.lit(1).alias("segments"), "block", "problem")
    key = F.coalesce("origin_id", "record_id")
    first = lambda c: F.max(F.when(F.col("origin_id").isNull(), F.col(c))).alias(c)
    part = F.struct("segment_number", "block")
    groups = records.where(F.col("segment_number").isNotNull()).groupBy(key.alias("key")).agg(
        *[first(c) for c in kept],
        F.sort_array(F.collect_set(part)).alias("parts"), F.max("total_length").alias("total"),
        F.max("segment_number").alias("last"), F.max("problem").alias("found"),
    )
    distinct = F.size(F.array_distinct(F.transform("parts", lambda p: p["segment_number"])))
    together = groups.select("*", joined(F.transform("parts", lambda p: p["block"])).alias("block")).select(
        *kept, F.size("parts").alias("segments"), "block",
        F.when(F.col("found").isNotNull(), F.col("found"))
        .when(F.col("record_id").isNull(), "no origin")
        .when(distinct < F.col("last"), "missing segment")
        .when(F.size("parts") > F.col("last"), "repeated segment")
        .when(F.col("total").isNull(), "no total length")
        .when(F.octet_length("block") != F.col("total"), "wrong length")
        .alias("problem"),
    )
    return whole.unionByName(together)


def unchunk(data: bytes) -> tuple[bytes, str | None]:
    """Body of a chunked message, and what is wrong with the framing."""
    out, at = [], 0
    while True:
        stop = data.find(b"\r\n", at)
        size = data[at:stop].split(b";")[0].strip() if stop >= 0 else b""
        try:
            n = int(size, 16)
        except ValueError:
            return b"".join(out), "bad chunk"
        if n == 0:
            return b"".join(out), None
        piece = data[stop + 2 : stop + 2 + n]
        out.append(piece)
        at = stop + 4 + n
        if len(piece) < n or data[at - 2 : at] != b"\r\n":
            return b"".join(out), "bad chunk"


def payload(block: bytes | None) -> tuple[bytes, int, str | None]:
    """Payload of an HTTP message, the length that it states or has, and a problem."""
    head, found, body = (block or b"").partition(b"\r\n\r\n")
    if not found:
        return b"", 0, "no HTTP header"
    fields = dict(
        (k.strip().lower(), v.strip().lower()) for k, c, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:]) if c
    )
    if "chunked" in fields.get("transfer-encoding", ""):
        body, problem = unchunk(body)
        return body, len(body), problem
    return body, int(fields["content-length"]) if fields.get("content-length", "").isdigit() else len(body), None


def payloads(records: DataFrame) -> DataFrame:
    """Whole records with ``payload_bytes`` and ``payload_digest`` of the full payload, the
    decoded ``payload`` (of a revisit: empty) and ``problem``. A revisit has the length and
    digest that its headers state; a response whose digest differs gets ``wrong digest``."""

    def run(blocks: pa.Array, kinds: pa.Array, digests: pa.Array) -> pa.Array:
        rows = []
        for block, kind, digest in zip(blocks, kinds.to_pylist(), digests.to_pylist(), strict=True):
            body, n, problem = payload(block.as_py())
            own = digest if kind == "revisit" else hashlib.sha1(body).hexdigest()
            rows.append((body, n, own, problem or ("wrong digest" if digest not in (None, own) else None)))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds_ = (pa.binary(), pa.int64(), pa.string(), pa.string())
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds_, strict=True)], ["payload", "n", "digest", "problem"])

    decode = F.arrow_udf(run, "struct<payload binary, n bigint, digest string, problem string>")
    found = records.withColumn("_p", decode("block", "record_type", "digest"))
    kept = [c for c in records.columns if c not in ("block", "digest", "problem")]
    return found.select(*kept, F.col("_p.n").alias("payload_bytes"), F.col("_p.digest").alias("payload_digest"),
                        F.col("_p.payload").alias("payload"), F.coalesce("problem", "_p.problem").alias("problem"))
