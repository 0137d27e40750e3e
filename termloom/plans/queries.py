"""Registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import text as X
from termloom.functions.hashing import md5_hash32, sha1_hash32
from termloom.operators import classify, dbscan, distance, features, kmeans, minhash, quality, similarity, terms, tree
from termloom.plans import jobs
from termloom.session import materialise, narrow, new_table_path, spread
from termloom.sources import corpus, html, sinks

EPS = 0.40
EPS_COSINE = 0.30
MIN_SAMPLES = 3
KNN_SIZES = (5, 10, 25)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded double without negative zero."""
    return F.round(c, digits) + F.lit(0.0)


def docs_of(spark, d):
    return corpus.documents(spark, d)


def bags_of(spark, d):
    return terms.stored_bags(docs_of(spark, d))


def vectors_of(spark, d):
    """Column-normalised embeddings as (id, label, vec)."""
    raw = corpus.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vec"))
    return materialise(features.l2_normalize_vectors(raw, "vec"), "embeddings")


def clustered(spark, d):
    """Embeddings with their cluster, converged from the 25 lowest ids."""
    rows = vectors_of(spark, d)
    got = kmeans.fit_predict(rows, seed=None).drop("n_iter", "converged")
    return materialise(got.join(rows.select("id", "label"), "id"), "clustered")


# Scans, sources, sinks.

@query
def corpus_scan(spark, d):
    docs = docs_of(spark, d)
    return docs.select(
        "doc_id", F.array_join("topics", " ").alias("topics"), F.array_join("places", " ").alias("places"),
        "title", F.length("text").cast("bigint").alias("n_chars"),
    )


@query
def corpus_first_n_sources(spark, d):
    return corpus.first_sources(docs_of(spark, d), 6).select("doc_id", "source")


@query
def corpus_sample(spark, d):
    return corpus.sample(docs_of(spark, d), 20, 2).select("doc_id", "source", "text")


@query
def tagged_record_scan(spark, d):
    path = new_table_path(spark, "tagged")
    corpus.write_tagged_records(docs_of(spark, d), path)
    got = corpus.tagged_records(spark, path)
    return got.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.array_join("topics", " ").alias("topics"),
        F.array_join("places", " ").alias("places"), "title", F.md5(F.col("text").cast("binary")).alias("body_md5"),
    )


def retold(spark, d):
    """The documents as tagged files, read back; a tenth of the ids has an older record."""
    path = new_table_path(spark, "tagged")
    docs = docs_of(spark, d)
    corpus.write_tagged_records(docs.where("doc_id % 10 = 0").withColumn("text", F.lit("an older record")), f"{path}/1")
    corpus.write_tagged_records(docs, f"{path}/2")
    return corpus.tagged_records(spark, f"{path}/1", f"{path}/2")


@query
def tagged_similarity_study(spark, d):
    return jobs.similarity_study(retold(spark, d)).select("k", "n_pairs", r("mse", 9).alias("mse"))


@query
def tagged_knn(spark, d):
    return jobs.knn_accuracy(retold(spark, d)).select("k", "n_test", r("accuracy").alias("accuracy"))


@query
def wordcount_vector_lines(spark, d):
    return jobs.word_count_vectors(docs_of(spark, d))


@query
def tfidf_vector_lines(spark, d):
    return jobs.tfidf_vectors(docs_of(spark, d), digits=6)


@query
def corpus_summary(spark, d):
    return sinks.corpus_summary(bags_of(spark, d))


# Projections and scalar functions.

@query
def html_field_extract(spark, d):
    page = F.col("html")
    return spread(corpus.table(spark, d, "pages"), "page_id").select(
        "page_id", html.attribute(page, "html", "lang").alias("lang"),
        F.coalesce(html.decode_entities(html.element(page, "title")), F.lit("")).alias("title"),
        F.md5(html.decode_entities(html.element(page, "article")).cast("binary")).alias("article_md5"),
        html.element(page, "body").isNull().alias("no_body"),
    )


@query
def html_multi_extract(spark, d):
    pages = spread(corpus.table(spark, d, "pages"), "page_id")
    items = html.elements(F.col("html"), "li")
    return pages.select("page_id", F.posexplode(items).alias("pos", "item"))


@query
def primary_label(spark, d):
    pages = spread(corpus.table(spark, d, "pages"), "page_id")
    topics = html.elements(html.element(F.col("html"), "nav"), "a")
    return corpus.primary_label(pages.select("page_id", topics.alias("topics"))).select("page_id", "label")


@query
def tokenize(spark, d):
    docs = spread(docs_of(spark, d).select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", F.posexplode_outer(X.tokens(F.col("text"))).alias("pos", "token")).where(
        F.col("token").isNotNull()
    )


def _token_rows(spark, d):
    return tokenize(spark, d).select("doc_id", "token")


@query
def stopword_filter(spark, d):
    return _token_rows(spark, d).where(~X.is_stop_word(F.col("token"))).groupBy("doc_id", "token").agg(
        F.count("*").alias("n")
    )


@query
def alnum_token_filter(spark, d):
    return _token_rows(spark, d).where(X.is_alnum(F.col("token"))).groupBy("doc_id", "token").agg(
        F.count("*").alias("n")
    )


@query
def labelled_docs(spark, d):
    marks = corpus.table(spark, d, "labels").where(F.col("quality").isNotNull())
    docs = docs_of(spark, d).where(F.col("text").isNotNull())
    return docs.join(marks, "doc_id").select("doc_id", "quality", F.length("text").cast("bigint").alias("n_chars"))


@query
def sha1_term_hash(spark, d):
    words = terms.document_frequency(bags_of(spark, d))
    return words.select("term", sha1_hash32(F.col("term")).alias("hash32"))


# Aggregations.

@query
def word_counts(spark, d):
    return terms.word_counts(terms.term_bags(docs_of(spark, d)))


@query
def doc_length(spark, d):
    return terms.doc_length(bags_of(spark, d))


@query
def lexical_diversity(spark, d):
    return terms.lexical_diversity(bags_of(spark, d)).select(
        "doc_id", "n_terms", "num_words", r("diversity", 9).alias("diversity")
    )


@query
def term_frequency(spark, d):
    return terms.term_frequency(terms.term_bags(docs_of(spark, d))).select("doc_id", "term", r("tf", 9).alias("tf"))


@query
def document_frequency(spark, d):
    return terms.document_frequency(terms.term_bags(docs_of(spark, d)))


@query
def idf(spark, d):
    return terms.idf(bags_of(spark, d)).select("term", "df", r("idf", 9).alias("idf"))


@query
def tfidf(spark, d):
    return terms.tfidf(bags_of(spark, d)).select("doc_id", "term", r("tfidf", 9).alias("tfidf"))


@query
def feature_matrix(spark, d):
    return features.feature_matrix(bags_of(spark, d)).select("doc_id", "feature", r("value", 9).alias("value"))


@query
def tfidf_l2_normalize(spark, d):
    matrix = materialise(features.feature_matrix(bags_of(spark, d)), "matrix")
    return features.l2_normalize_columns(matrix).select("doc_id", "feature", r("value", 9).alias("value"))


@query
def feature_l2_normalize(spark, d):
    rows = vectors_of(spark, d)
    return rows.select(F.col("id").alias("vec_id"), F.posexplode("vec").alias("pos", "v")).select(
        "vec_id", "pos", r("v", 9).alias("value")
    )


@query
def dedupe_by_id(spark, d):
    talk = corpus.table(spark, d, "conversations")
    return corpus.dedupe_by_id(talk, "conv_id", "turn").select("conv_id", "turn", "role", "text")


# Distances.

def _profile(spark, d, metric):
    got = distance.distance_profile(narrow(vectors_of(spark, d), "id", "vec"), metric)
    return got.select(
        F.col("id").alias("vec_id"), "n_others", r("mean_d").alias("mean_d"), r("min_d").alias("min_d"), r("max_d").alias("max_d")
    )


@query
def pairwise_euclidean(spark, d):
    return _profile(spark, d, "euclidean")


@query
def pairwise_cosine(spark, d):
    return _profile(spark, d, "cosine")


@query
def eps_neighbors(spark, d):
    got = distance.eps_neighbors(narrow(vectors_of(spark, d), "id", "vec"), EPS, MIN_SAMPLES)
    return got.select(F.col("id").alias("vec_id"), "n_neighbors", F.col("is_core").cast("int").alias("is_core"))


# Similarity and sketches.

@query
def jaccard_exact(spark, d):
    return similarity.exact_profile(bags_of(spark, d)).select(
        "doc_id", "n_similar", r("sum_jaccard").alias("sum_jaccard"), r("max_jaccard").alias("max_jaccard")
    )


@query
def minhash_jaccard(spark, d):
    return similarity.estimate_profile(bags_of(spark, d)).select(
        "doc_id", "n_similar", r("sum_estimate").alias("sum_estimate"), r("max_estimate").alias("max_estimate")
    )


@query
def minhash_mse(spark, d):
    return jobs.similarity_study(docs_of(spark, d)).select("k", "n_pairs", r("mse", 9).alias("mse"))


@query
def minhash_signature(spark, d):
    return minhash.slots(minhash.signatures(bags_of(spark, d)), "doc_id")


@query
def minhash_signature_md5(spark, d):
    """The same sketch over another digest."""
    return minhash.slots(minhash.signatures(bags_of(spark, d), hash_expr=md5_hash32), "doc_id")


def _with_group(sigs, docs):
    return sigs.join(docs.select("doc_id", F.col("source").alias("grp")), "doc_id")


@query
def minhash_merge(spark, d):
    docs = docs_of(spark, d)
    sigs = minhash.signatures(terms.stored_bags(docs))
    by_lang = sigs.join(corpus.primary_label(docs).select("doc_id", "label"), "doc_id")
    return minhash.merge(by_lang, "label").select("label", "slot", "hv")


@query
def minhash_union(spark, d):
    docs = docs_of(spark, d)
    sigs = _with_group(minhash.signatures(terms.stored_bags(docs)), docs)
    return minhash.merge(sigs, "grp", min_inputs=2).select(F.col("grp").alias("source"), "n_inputs", "slot", "hv")


@query
def minhash_count(spark, d):
    return minhash.cardinality(minhash.signatures(bags_of(spark, d))).select("doc_id", r("n_est").alias("n_est"))


@query
def minhash_empty(spark, d):
    return minhash.is_empty(minhash.signatures(bags_of(spark, d))).select(
        "doc_id", F.col("is_empty").cast("int").alias("is_empty")
    )


@query
def minhash_equal_groups(spark, d):
    return minhash.equal_groups(minhash.signatures(bags_of(spark, d))).select("first_id", "n_docs")


@query
def minhash_table_roundtrip(spark, d):
    path = new_table_path(spark, "signatures")
    minhash.save(minhash.signatures(bags_of(spark, d)), path)
    return minhash.slots(minhash.load(spark, path), "doc_id", "seed", "num_perm")


# Clustering.

@query
def kmeans_assign(spark, d):
    return clustered(spark, d).select(F.col("id").alias("vec_id"), "cluster", r("d").alias("d"))


def _fit_summary(spark, d, metric):
    """Sizes and cost per cluster of the best of three trials."""
    got = kmeans.fit_predict(vectors_of(spark, d), metric=metric)
    cost = r(F.sum(F.col("d") * F.col("d") if metric == "euclidean" else F.col("d")))
    return got.groupBy("cluster", "n_iter", "converged").agg(F.count("*").alias("n"), cost.alias("cost"))


@query
def kmeans_fit(spark, d):
    return _fit_summary(spark, d, "euclidean")


@query
def kmeans_fit_cosine(spark, d):
    return _fit_summary(spark, d, "cosine")


@query
def kmeans_documents(spark, d):
    got = jobs.kmeans_report(docs_of(spark, d))
    return got.select(
        "n_clusters", "n_iter", "converged", "cluster", "n", r("entropy").alias("entropy"), r("variance", 9).alias("variance"),
        r("silhouette").alias("silhouette"),
    )


@query
def kmeans_documents_assign(spark, d):
    """Joined form: converged from the 25 lowest article ids."""
    _, cells = jobs.scaled_features(docs_of(spark, d))
    found = kmeans.sparse_lloyd(cells, kmeans.CLUSTERS)
    return found.assigned.withColumns({"n_iter": F.lit(found.n_iter), "converged": F.lit(found.converged)})


def _labels_of(got):
    return got.select(F.col("id").alias("vec_id"), "cluster", F.col("is_core").cast("int").alias("is_core"))


@query
def dbscan_euclidean(spark, d):
    return _labels_of(dbscan.dbscan(narrow(vectors_of(spark, d), "id", "vec"), EPS, MIN_SAMPLES))


REGISTRY["dbscan"] = REGISTRY.pop("dbscan_euclidean")


@query
def dbscan_cosine(spark, d):
    return _labels_of(dbscan.dbscan(narrow(vectors_of(spark, d), "id", "vec"), EPS_COSINE, MIN_SAMPLES, "cosine"))


@query
def dbscan_documents(spark, d):
    rows, _ = jobs.scaled_features(docs_of(spark, d))
    got = dbscan.dbscan(narrow(rows, "id", "idx", "val"), 0.2, MIN_SAMPLES)
    return got.select(F.col("id").alias("doc_id"), "cluster", F.col("is_core").cast("int").alias("is_core"))


SWEEP = [(0.38, 3), (0.38, 5), (0.42, 3), (0.42, 5)]


@query
def dbscan_sweep(spark, d):
    """Two values of each parameter over one placement and two passes."""
    found = dbscan.sweep(narrow(vectors_of(spark, d), "id", "vec"), SWEEP)
    parts = [_labels_of(got).select(F.lit(e).alias("eps"), F.lit(m).alias("min_samples"), "*") for (e, m), got in zip(SWEEP, found)]
    return reduce(DataFrame.unionByName, parts)


@query
def kmeans_sweep(spark, d):
    """Two numbers of clusters over the same passes."""
    sizes, parts = (10, 25), []
    for n, got in zip(sizes, kmeans.predict_sizes(vectors_of(spark, d), sizes)):
        parts.append(got.groupBy(F.lit(n).alias("n_clusters"), "cluster", "n_iter").agg(F.count("*").alias("n"), r(F.sum(F.col("d") * F.col("d"))).alias("cost")))
    return reduce(DataFrame.unionByName, parts)


@query
def eps_neighbors_documents(spark, d):
    rows, _ = jobs.scaled_features(docs_of(spark, d))
    got = distance.eps_neighbors(narrow(rows, "id", "idx", "val"), 0.2, MIN_SAMPLES)
    return got.select(F.col("id").alias("doc_id"), "n_neighbors", F.col("is_core").cast("int").alias("is_core"))


@query
def dbscan_documents_cosine(spark, d):
    rows, _ = jobs.scaled_features(docs_of(spark, d))
    got = dbscan.dbscan(narrow(rows, "id", "idx", "val"), 0.2, MIN_SAMPLES, "cosine")
    return got.select(F.col("id").alias("doc_id"), "cluster", F.col("is_core").cast("int").alias("is_core"))


@query
def dbscan_documents_report(spark, d):
    """The whole job: features of labelled articles, DBSCAN, report per cluster."""
    got = jobs.dbscan_report(docs_of(spark, d))
    return got.select(
        "cluster", "n", r("entropy").alias("entropy"), r("variance", 9).alias("variance"), r("silhouette").alias("silhouette")
    )


# Cluster quality.

@query
def cluster_sizes(spark, d):
    return quality.cluster_sizes(clustered(spark, d))


@query
def cluster_label_counts(spark, d):
    return quality.cluster_label_counts(clustered(spark, d))


@query
def cluster_entropy(spark, d):
    return quality.cluster_entropy(clustered(spark, d)).select("cluster", r("entropy").alias("entropy"))


@query
def cluster_variance(spark, d):
    return quality.cluster_variance(clustered(spark, d)).select("cluster", r("variance", 9).alias("variance"))


@query
def silhouette(spark, d):
    return quality.silhouette(narrow(clustered(spark, d), "id", "vec", "cluster")).select(
        "n_clusters", r("silhouette").alias("silhouette")
    )


@query
def cluster_report(spark, d):
    return quality.cluster_report(clustered(spark, d)).select(
        "cluster", "n", r("entropy").alias("entropy"), r("variance", 9).alias("variance")
    )


@query
def dbscan_report(spark, d):
    rows = vectors_of(spark, d)
    got = dbscan.dbscan(narrow(rows, "id", "vec"), EPS, MIN_SAMPLES)
    assigned = materialise(rows.join(got, "id"), "assigned")
    mean = quality.silhouette(narrow(assigned, "id", "vec", "cluster")).select("silhouette").scalar()
    return quality.cluster_report(assigned).select(
        "cluster", "n", r("entropy").alias("entropy"), r("variance", 9).alias("variance"), r(mean).alias("silhouette")
    )


# Classification.

def _split_vectors(spark, d):
    rows = materialise(classify.train_test_split(vectors_of(spark, d), "id"), "split")
    return narrow(rows, where="is_train"), narrow(rows, where=~F.col("is_train"))


@query
def train_test_split(spark, d):
    docs = docs_of(spark, d).select("doc_id")
    return classify.train_test_split(docs, "doc_id").select("doc_id", F.col("is_train").cast("int").alias("is_train"))


@query
def knn_neighbors(spark, d):
    train, test = _split_vectors(spark, d)
    return classify.knn_neighbors(train, test, 5).select(
        F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), r("d").alias("d")
    )


def _knn(spark, d, metric="euclidean"):
    train, test = _split_vectors(spark, d)
    near = classify.knn_neighbors(train, test, max(KNN_SIZES), metric)
    return classify.knn_classify(near, train, KNN_SIZES), test


@query
def knn_classify(spark, d):
    return _knn(spark, d)[0].select(F.col("q").alias("vec_id"), "k", "predicted")


@query
def knn_accuracy(spark, d):
    return classify.accuracy(*_knn(spark, d)).select("k", "n_test", r("accuracy").alias("accuracy"))


@query
def knn_accuracy_cosine(spark, d):
    return classify.accuracy(*_knn(spark, d, "cosine")).select("k", "n_test", r("accuracy").alias("accuracy"))


@query
def knn_documents(spark, d):
    """The whole job: features of labelled articles, split, neighbours, accuracy."""
    return jobs.knn_accuracy(docs_of(spark, d)).select("k", "n_test", r("accuracy").alias("accuracy"))


@query
def dtree_classify(spark, d):
    train, test = (tree.dense_cells(half) for half in _split_vectors(spark, d))
    return tree.report(train, test).withColumn("accuracy", r("accuracy"))


@query
def dtree_predict(spark, d):
    """The class that the tree gives each vector of the test part."""
    train, test = (tree.dense_cells(half) for half in _split_vectors(spark, d))
    return tree.predict(tree.grow(train), test).withColumnRenamed("id", "vec_id")


@query
def dtree_documents(spark, d):
    return jobs.dtree_accuracy(docs_of(spark, d)).withColumn("accuracy", r("accuracy"))
