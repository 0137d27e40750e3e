"""Registered queries of the subpackage and the SQL for them, where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from termloom.llm import decontaminate, hilbert, jaccard, language, lines, merkle, oracle, packing, pseudonyms, rollup, simplex, sketch, subword, tokens, warc
from termloom.session import materialise, new_table_path

Query = Callable[[SparkSession, str], DataFrame]


# What one batch may bring to Python: rows hold whole texts, and a task has a batch in the
# JVM's and one in Python's memory.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1_000


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings of its own, so that the caller's stay as they are."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    bound_batches(own)
    return own


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# In production the key comes from a secret store.
PSEUDONYM_KEY = b"termloom registered query"


# A web page has a few KB: with these nearly all pages come in several segments.
SEGMENT_BYTES = 1024


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_table_path(spark, "archives")
    warc.write(warc.pages_to_records(read(spark, sf_dir, "pages")), path, SEGMENT_BYTES)
    whole = warc.payloads(warc.reassemble(warc.read(spark, path)))
    return whole.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "segments", "problem")


def op2_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited_pairs(read(spark, sf_dir, "documents"))


def op3_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.documents(read(spark, sf_dir, "documents"))


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(read(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedupe(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all documents, take out those labelled toxic, count languages other than English
    anew by another vocabulary, and send every batch twice."""
    one, two = tokens.DEFAULT_FILE, "byte_bpe_multi_50k.tiktoken"
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    toxic = labels.where("toxic = 1").select("doc_id").distinct().withColumn("out", F.lit(True))
    # Texts are counted where they are read; only counts go through the join. The second
    # vocabulary gets the texts it is for, as a condition around a Python function spares none.
    counted = docs.select(
        "doc_id", "source", "lang", rollup.token_count(F.col("text")).alias("first"),
        rollup.token_count(F.when(F.col("lang") != "en", F.col("text")), tokens.tokenizer_path(two)).alias("second"),
    ).join(toxic, "doc_id", "left")
    counted = materialise(counted, "counts")
    gone, other = F.col("out").isNotNull(), F.col("out").isNull() & (F.col("lang") != "en")
    ledger = rollup.Ledger(spark, new_table_path(spark, "ledger"))
    for _ in range(2):
        ledger.commit("load", rollup.inserts(counted, one, "first"))
        ledger.commit("toxic", rollup.deletes(counted.where(gone), one, "first"))
        ledger.commit("recount", rollup.revisions(counted.where(other), (one, "first"), (two, "second")))
    return ledger.totals()


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = F.coalesce(language.held_out(F.col("doc_id")), F.lit(False))
    learned = language.profiles(docs.where(~held))
    found = language.predict(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(read(spark, sf_dir, "documents"))


def op11_simplex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex.clusters(read(spark, sf_dir, "embeddings")).drop("compared")


def op12_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.documents(read(spark, sf_dir, "documents"))


def isolated(query: Query) -> Query:
    return wraps(query)(lambda spark, sf_dir: query(own_session(spark), sf_dir))


REGISTRY: dict[str, Query] = {
    fn.__name__: isolated(fn)
    for fn in (
        op1_warc, op2_sketch, op3_hilbert, op4_pseudonyms, op5_lines, op6_token_rollup, op7_language, op8_decontaminate,
        op9_packing, op10_jaccard, op11_simplex, op12_subword, op13_merkle,
    )
}
ORACLE_SQL: dict[str, str] = oracle.all_sql()
