"""Word counts, document frequency, TF-IDF and lexical diversity.

The shared intermediate is a *bag*: one row per document with the number of
filtered words and the words that occur at least twice, with their counts. A
document is one row, so counting inside it needs no shuffle; only the
corpus-wide document frequency does, and that combines map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.session import hot_split_join, materialise, spread

MIN_COUNT = 2


def words(docs: DataFrame) -> DataFrame:
    """(doc_id, words): filtered tokens per document, in order, NULL without body."""
    return docs.select("doc_id", F.filter(T.tokens(F.col("text")), T.keep_word).alias("words"))


def term_bags(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(doc_id, num_words, terms array<struct<term, cnt>>), terms sorted by term.

    Words are sorted per row; each run of equal words becomes one term. ``terms``
    and ``num_words`` are NULL when the document has no body.
    """
    ordered = words(spread(docs.select("doc_id", "text"), "doc_id")).select(
        "doc_id", F.sort_array("words").alias("w"), F.size("words").cast("bigint").alias("n")
    )
    starts = ordered.select(
        "doc_id", "w", "n",
        F.filter(
            F.transform(
                "w",
                lambda x, i: F.when((i == 0) | (x != F.get(F.col("w"), i - 1)), i),
            ),
            lambda p: p.isNotNull(),
        ).alias("at"),
    )
    counted = F.transform(
        "at",
        lambda p, j: F.struct(
            F.get(F.col("w"), p).alias("term"),
            (F.coalesce(F.get(F.col("at"), j + 1).cast("bigint"), F.col("n")) - p).alias("cnt"),
        ),
    )
    return starts.select(
        "doc_id",
        F.when(F.col("w").isNotNull(), F.col("n")).alias("num_words"),
        F.filter(counted, lambda s: s["cnt"] >= min_count).alias("terms"),
    )


def exploded(bags: DataFrame) -> DataFrame:
    """One row per kept term, in column ``e``.

    ``explode`` would make Catalyst add a ``size(terms) > 0`` filter and push it
    below the projections, which repeats the tokenising inside it; the outer form
    with a later NULL check does not.
    """
    rows = bags.select("doc_id", "num_words", F.explode_outer("terms").alias("e"))
    return rows.where(F.col("e.term").isNotNull())


def word_counts(bags: DataFrame) -> DataFrame:
    """(doc_id, term, cnt)."""
    return exploded(bags).select("doc_id", "e.term", "e.cnt")


def doc_length(bags: DataFrame) -> DataFrame:
    """(doc_id, num_words): filtered words including those that occur once."""
    return bags.where(F.col("terms").isNotNull()).select("doc_id", "num_words")


def lexical_diversity(bags: DataFrame) -> DataFrame:
    """(doc_id, n_terms, num_words, diversity); 0 when no word is left."""
    n_terms = F.size(F.coalesce("terms", F.array())).cast("bigint")
    return bags.select(
        "doc_id",
        n_terms.alias("n_terms"),
        F.coalesce("num_words", F.lit(0).cast("bigint")).alias("num_words"),
        F.coalesce(F.try_divide(n_terms, F.col("num_words")), F.lit(0.0)).alias("diversity"),
    )


def term_frequency(bags: DataFrame) -> DataFrame:
    """(doc_id, term, tf): count over filtered length."""
    return exploded(bags).select("doc_id", "e.term", (F.col("e.cnt") / F.col("num_words")).alias("tf"))


def document_frequency(bags: DataFrame) -> DataFrame:
    """(term, df) over the kept words."""
    return word_counts(bags).groupBy("term").agg(F.count("*").alias("df"))


def idf(bags: DataFrame) -> DataFrame:
    """(term, df, idf): ln(N/df) without smoothing; N counts every row of ``bags``."""
    n_docs = bags.agg(F.count("*").alias("n")).scalar()
    return document_frequency(bags).select(
        "term", "df", F.log(n_docs.cast("double") / F.col("df")).alias("idf")
    )


def tfidf(bags: DataFrame) -> DataFrame:
    """(doc_id, term, tfidf). ``bags`` is read more than once: store it first."""
    joined = hot_split_join(term_frequency(bags), idf(bags), "term", "df")
    return joined.select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("tfidf"))


def stored_bags(docs: DataFrame) -> DataFrame:
    """Tokenise once and keep the bags as a table for several readers."""
    return materialise(term_bags(docs), "bags")
