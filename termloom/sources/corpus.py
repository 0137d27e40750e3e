"""Corpus scans: one row per article, as
(doc_id, topics array, places array, title, text, source)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.sources import html

RECORD_TAG = "REUTERS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table as articles: language is the topic, source the place."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.array_compact(F.array("lang")).alias("topics"),
        F.array_compact(F.array("source")).alias("places"),
        F.lit("").alias("title"),
        "text",
        "source",
    )


def tagged_records(spark: SparkSession, *paths: str, tag: str = RECORD_TAG, separator: str | None = None) -> DataFrame:
    """Split tagged text files into records and extract their fields.

    The closing tag is the line separator of the text source, so Spark splits large files
    over tasks and no record is assembled in Python. It is written as ``separator``; closing
    tags in another case are split inside the row, so name it for a lower-case corpus.
    ``doc_id`` is a number: the id itself, or a hash of an id that is none. ``seq`` orders
    records by file and place, for ``dedupe_by_id``.
    """
    raw = spark.read.option("lineSep", separator or f"</{tag}>").text(list(paths))
    record = F.col("value")
    split = raw.select(
        F.explode(F.split(record, rf"(?i)</{tag}>")).alias("value"), F.input_file_name().alias("source"),
        F.monotonically_increasing_id().alias("row"),
    ).select("value", "source", F.struct("source", "row", F.monotonically_increasing_id().alias("part")).alias("seq"))
    name = html.attribute(record, tag, "newid")
    one = split.where(record.rlike(rf"(?i)<{tag}[ >]")).select(
        F.coalesce(name.try_cast("bigint"), F.when(name.isNotNull(), F.xxhash64(name))).alias("id"),
        F.coalesce(html.element(record, "topics"), F.lit("")).alias("t"),
        F.coalesce(html.element(record, "places"), F.lit("")).alias("p"),
        html.element(record, "title").alias("title"),
        html.element(record, "body").alias("body"),
        "source",
        "seq",
    )
    decoded = lambda c: F.transform(html.elements(F.col(c), "d"), html.decode_entities)
    return one.select(
        F.col("id").alias("doc_id"),
        decoded("t").alias("topics"),
        decoded("p").alias("places"),
        F.coalesce(html.decode_entities(F.col("title")), F.lit("")).alias("title"),
        html.decode_entities(F.col("body")).alias("text"),
        "source",
        "seq",
    )


def write_tagged_records(docs: DataFrame, path: str, tag: str = RECORD_TAG) -> None:
    """Write articles as tagged text files, the format ``tagged_records`` reads."""
    items = lambda c: F.array_join(
        F.transform(c, lambda x: F.concat(F.lit("<D>"), html.encode_entities(x), F.lit("</D>"))), ""
    )
    body = F.concat(F.lit("<BODY>"), html.encode_entities(F.col("text")), F.lit("</BODY>"))
    docs.select(
        F.concat(
            F.lit(f'<{tag} NEWID="'), F.col("doc_id").cast("string"), F.lit('">\n<TOPICS>'),
            items("topics"), F.lit("</TOPICS><PLACES>"), items("places"),
            F.lit("</PLACES><TEXT><TITLE>"), html.encode_entities(F.col("title")), F.lit("</TITLE>"),
            F.coalesce(body, F.lit("")), F.lit(f"</TEXT></{tag}>"),
        ).alias("value")
    ).write.text(path)


def primary_label(docs: DataFrame) -> DataFrame:
    """Add ``label``: the first topic, NULL when there is none."""
    return docs.withColumn("label", F.try_element_at("topics", F.lit(1)))


def labelled(docs: DataFrame) -> DataFrame:
    """Articles that have both a label and a body, with the ``label`` column."""
    return primary_label(docs).where(F.col("label").isNotNull() & F.col("text").isNotNull())


def first_sources(docs: DataFrame, n: int = 6) -> DataFrame:
    """Articles of the first ``n`` sources in name order.

    The source list is a top-n query, so the broadcast side has at most ``n`` rows.
    """
    first = docs.select("source").distinct().orderBy("source").limit(n)
    return docs.join(F.broadcast(first), "source", "left_semi")


def sample(docs: DataFrame, n: int = 20, nth_source: int = 2) -> DataFrame:
    """The first ``n`` articles, in id order, of the ``nth_source``-th source."""
    names = docs.select("source").distinct().orderBy("source").limit(nth_source)
    chosen = names.orderBy(F.col("source").desc()).limit(1)
    one = docs.join(F.broadcast(chosen), "source", "left_semi")
    return one.orderBy("doc_id").limit(n)


def dedupe_by_id(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """Keep the row with the highest ``seq`` per ``key``; the last record wins.

    A ``max`` over a struct combines map-side, so a key with many rows is no
    hot spot as it would be with a window.
    """
    rest = [c for c in rows.columns if c not in (key, seq)]
    last = rows.groupBy(key).agg(F.max(F.struct(seq, *rest)).alias("last"))
    return last.select(key, "last.*")
