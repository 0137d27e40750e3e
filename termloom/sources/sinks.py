"""Vector-line sinks and corpus summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Header lines of the two vector files.
WORD_COUNT_HEADER = (
    "Word Frequency Feature Vector w/ title and topics",
    "Article Id: (feature, feature value)...",
)
TFIDF_HEADER = (
    "Word td-idf  Vector w/ title, topics, diversity",
    "Article Id: (feature, feature value)...",
)


def _pair(name, value) -> Column:
    return F.concat(F.lit("("), name, F.lit(","), value, F.lit(")"))


def _line(entries: Column) -> Column:
    listed = lambda label, col: F.when(
        F.size(col) > 0, _pair(F.lit(label), F.array_join(col, " "))
    ).otherwise(F.lit(""))
    return F.concat(
        F.col("doc_id").cast("string"), F.lit(":\t"),
        _pair(F.lit("title"), F.rtrim("title")),
        listed("topics", F.col("topics")), listed("places", F.col("places")),
        F.coalesce(entries, F.lit("")),
    ).alias("line")


def wordcount_lines(docs: DataFrame, bags: DataFrame) -> DataFrame:
    """(doc_id, line): ``id:\\t(title,…)(topics,…)(places,…)(word,count)…``, words sorted."""
    entries = F.array_join(
        F.transform("terms", lambda e: _pair(e["term"], e["cnt"].cast("string"))), ""
    )
    return docs.drop("text").join(bags, "doc_id", "left").select("doc_id", _line(entries))


def tfidf_lines(docs: DataFrame, tfidf: DataFrame, digits: int = 9) -> DataFrame:
    """(doc_id, line) with TF-IDF values in fixed notation.

    The per-document list holds that document's own distinct terms only.
    """
    value = F.format_string(f"%.{digits}f", F.round("tfidf", digits) + F.lit(0.0))
    vectors = tfidf.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("term", value.alias("v")))).alias("terms")
    )
    entries = F.array_join(F.transform("terms", lambda e: _pair(e["term"], e["v"])), "")
    return docs.drop("text").join(vectors, "doc_id", "left").select("doc_id", _line(entries))


def write_lines(lines: DataFrame, path: str, header: tuple[str, ...] = ()) -> None:
    """Write the ``line`` column as text under ``path``/vectors and the header, which
    has no place in an unordered set of part files, under ``path``/header."""
    lines.select(F.col("line").alias("value")).write.text(f"{path}/vectors")
    if header:
        spark = lines.sparkSession
        spark.createDataFrame([("\n".join(header),)], "value string").write.text(f"{path}/header")


def corpus_summary(bags: DataFrame, train_share: float = 0.6) -> DataFrame:
    """One row: vectors, features per sample (vocabulary + 2) and split sizes."""
    from termloom.operators.terms import word_counts

    n_docs = bags.agg(F.count("*").alias("n")).scalar()
    vocabulary = word_counts(bags).select("term").distinct()
    n_train = F.floor(F.col("n_vectors") * F.lit(train_share)).cast("bigint")
    return vocabulary.agg(F.count("*").alias("v")).select(
        n_docs.alias("n_vectors"), (F.col("v") + 2).alias("n_features")
    ).select("n_vectors", "n_features", n_train.alias("n_train"), (F.col("n_vectors") - n_train).alias("n_test"))
