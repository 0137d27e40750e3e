"""End-to-end jobs over a corpus of articles (see sources/corpus.py for the columns).

Each takes lists of parameters and returns one report for all of them; features are
built once per call.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.operators import classify, dbscan, features, kmeans, quality, similarity, terms, tree
from termloom.session import materialise, narrow
from termloom.sources import corpus, sinks


def latest(docs: DataFrame) -> DataFrame:
    """The last record of each id where records carry their order (``seq``), as those read
    from tagged files do; other corpora are taken as they are."""
    if "seq" not in docs.columns:
        return docs
    return materialise(corpus.dedupe_by_id(docs, "doc_id", "seq").drop("seq"), "latest")


def word_count_vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, line) of every article, with or without label and body."""
    docs = latest(docs)
    return sinks.wordcount_lines(docs, terms.term_bags(docs))


def tfidf_vectors(docs: DataFrame, digits: int = 9) -> DataFrame:
    """(doc_id, line) with TF-IDF values; articles without body count in N."""
    docs = latest(docs)
    return sinks.tfidf_lines(docs, terms.tfidf(terms.stored_bags(docs)), digits)


def scaled_features(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Column-normalised features of the articles that have a label and a body:
    sparse rows (id, idx, val, label) and the long form (doc_id, feature, value)."""
    kept = corpus.labelled(latest(docs))
    matrix = materialise(features.feature_matrix(terms.stored_bags(kept)), "matrix")
    scaled = materialise(features.l2_normalize_columns(matrix), "scaled")
    rows = features.sparse_rows(scaled).join(kept.select("doc_id", "label"), "doc_id")
    return materialise(rows.withColumnRenamed("doc_id", "id"), "rows"), scaled


def _report(rows: DataFrame, assigned: DataFrame, width: int) -> DataFrame:
    """(cluster, n, entropy, variance, silhouette); the last is the overall mean."""
    full = materialise(rows.join(assigned, "id"), "assigned")
    mean = quality.silhouette(narrow(full, "id", "idx", "val", "cluster")).select("silhouette").scalar()
    return (
        quality.cluster_sizes(full)
        .join(quality.cluster_entropy(full), "cluster")
        .join(quality.sparse_cluster_variance(full, width), "cluster")
        .withColumn("silhouette", mean)
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def kmeans_report(docs: DataFrame, n_clusters: Sequence[int] = (25,), metric: str = "euclidean", repeats: int = 3) -> DataFrame:
    """One row per cluster and entry of ``n_clusters``, with rounds and convergence of the fit."""
    rows, cells = scaled_features(docs)
    width = cells.agg(F.countDistinct("feature")).first()[0]
    parts = []
    for n in n_clusters:
        found = kmeans.cluster_documents(cells, n, repeats, metric)
        ended = found.select("n_iter", "converged").first()
        report = _report(rows, narrow(found, "id", "cluster"), width)
        parts.append(report.withColumns({"n_clusters": F.lit(n), "n_iter": F.lit(ended[0]), "converged": F.lit(ended[1])}))
    return _union(parts)


def dbscan_report(
    docs: DataFrame, eps: Sequence[float] = (0.2,), min_samples: Sequence[int] = (3,), metric: str = "euclidean"
) -> DataFrame:
    """One row per cluster (noise is -1) and pair of parameters."""
    rows, cells = scaled_features(docs)
    width = cells.agg(F.countDistinct("feature")).first()[0]
    items = narrow(rows, "id", "idx", "val")
    params = [(e, m) for e in eps for m in min_samples]
    return _union([
        _report(rows, found, width).withColumn("eps", F.lit(e)).withColumn("min_samples", F.lit(m))
        for (e, m), found in zip(params, dbscan.sweep(items, params, metric))
    ])


def _halves(rows: DataFrame, key: str, drop_last: bool) -> tuple[DataFrame, DataFrame]:
    split = materialise(classify.train_test_split(rows, key, drop_last=drop_last), "split")
    return narrow(split, where="is_train"), narrow(split, where=~F.col("is_train"))


def knn_accuracy(
    docs: DataFrame, ks: Sequence[int] = (5, 10, 25), metric: str = "euclidean", drop_last: bool = False
) -> DataFrame:
    """(k, n_test, accuracy) of topic prediction; neighbours are searched once."""
    rows, _ = scaled_features(docs)
    train, test = _halves(rows, "id", drop_last)
    near = classify.knn_neighbors(train, test, max(ks), metric)
    return classify.accuracy(classify.knn_classify(near, train, tuple(ks)), test)


def dtree_accuracy(docs: DataFrame, drop_last: bool = False) -> DataFrame:
    """One row with split sizes, tree size and accuracy of topic prediction."""
    rows, cells = scaled_features(docs)
    packed, _ = features.packed_rows(cells)
    labelled = packed.withColumnRenamed("doc_id", "id").join(rows.select("id", "label"), "id")
    return tree.report(*_halves(labelled, "id", drop_last))


def similarity_study(docs: DataFrame, ks: Sequence[int] = similarity.STUDY_SLOTS) -> DataFrame:
    """(k, n_pairs, mse) of sketch estimates over all pairs of labelled articles."""
    return similarity.error_study(terms.stored_bags(corpus.labelled(latest(docs))), tuple(ks))
