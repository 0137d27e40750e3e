import pytest
from pyspark.sql import functions as F

from termloom.functions import text as X
from termloom.operators import features, terms
from termloom.sources import sinks

W = [
    (1, "apple apple banana banana cherry"),
    (2, "apple apple apple date"),
    (3, "egg fig"),
]


def tokens_of(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(X.tokens(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Hello, World.", ["hello", ",", "world", "."]),
        ("3:30 a:b", ["3:30", "a", ":", "b"]),
        ("it's don't we'll", ["it", "'s", "do", "n't", "we", "'ll"]),
        ("dogs' (cats)", ["dogs", "'", "(", "cats", ")"]),
        ("I cannot cannot gonna", ["i", "can", "not", "can", "not", "gon", "na"]),
        ("'tis cannots", ["'t", "is", "cannots"]),
        ("a--b ... U.S. 1,000", ["a", "--", "b", "...", "u.s", ".", "1,000"]),
        ("", []),
    ],
)
def test_tokens(spark, text, want):
    assert tokens_of(spark, text) == want


def test_word_filters(spark):
    rows = spark.createDataFrame([("the",), ("cat",), ("--",), ("é",), ("x1",)], "t string")
    kept = [r.t for r in rows.where(X.keep_word(F.col("t"))).collect()]
    assert kept == ["cat", "x1"]
    assert len(X.STOP_WORDS) == len(set(X.STOP_WORDS)) == 179


def test_bags_without_body_or_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "?! ..."), (3, "b a b a a c")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in terms.term_bags(docs).collect()}
    assert got[1].terms is None and got[1].num_words is None
    assert got[2].terms == [] and got[2].num_words == 0
    assert [(t.term, t.cnt) for t in got[3].terms] == [("b", 2)] and got[3].num_words == 3


def test_counts_and_tfidf(spark):
    docs = spark.createDataFrame(W, "doc_id bigint, text string")
    bags = terms.stored_bags(docs)
    counts = {(r.doc_id, r.term): r.cnt for r in terms.word_counts(bags).collect()}
    assert counts == {(1, "apple"): 2, (1, "banana"): 2, (2, "apple"): 3}
    stats = {r.doc_id: (r.num_words, r.diversity) for r in terms.lexical_diversity(bags).collect()}
    assert stats == {1: (5, 0.4), 2: (4, 0.25), 3: (2, 0.0)}
    assert {r.term: r.df for r in terms.document_frequency(bags).collect()} == {"apple": 2, "banana": 1}
    got = {(r.doc_id, r.term): r.tfidf for r in terms.tfidf(bags).collect()}
    assert got[(1, "apple")] == pytest.approx(0.162186043)
    assert got[(1, "banana")] == pytest.approx(0.439444915)
    assert got[(2, "apple")] == pytest.approx(0.304098831)
    # an article without body still counts in N
    more = spark.createDataFrame(W + [(4, None)], "doc_id bigint, text string")
    got = {(r.doc_id, r.term): r.tfidf for r in terms.tfidf(terms.stored_bags(more)).collect()}
    assert got[(1, "apple")] == pytest.approx(0.277258872)
    assert got[(2, "apple")] == pytest.approx(0.519860386)


def test_lines(spark):
    docs = spark.createDataFrame(
        [(1, ["cocoa", "tea"], ["usa"], "Title  ", W[0][1]), (9, [], [], "", None)],
        "doc_id bigint, topics array<string>, places array<string>, title string, text string",
    )
    bags = terms.stored_bags(docs)
    got = {r.doc_id: r.line for r in sinks.wordcount_lines(docs, bags).collect()}
    assert got[1] == "1:\t(title,Title)(topics,cocoa tea)(places,usa)(apple,2)(banana,2)"
    assert got[9] == "9:\t(title,)"
    got = {r.doc_id: r.line for r in sinks.tfidf_lines(docs, terms.tfidf(bags), 4).collect()}
    assert got[1].endswith("(apple,0.2773)(banana,0.2773)")
    row = sinks.corpus_summary(bags).first()
    assert (row.n_vectors, row.n_features, row.n_train, row.n_test) == (2, 4, 1, 1)


def test_write_lines(spark, tmp_path):
    docs = spark.createDataFrame([(1, ["t"], ["p"], "x", "a b")], "doc_id bigint, topics array<string>, places array<string>, title string, text string")
    sinks.write_lines(sinks.wordcount_lines(docs, terms.term_bags(docs)), str(tmp_path / "out"), sinks.WORD_COUNT_HEADER)
    assert [r.value for r in spark.read.text(str(tmp_path / "out/vectors")).collect()] == ["1:\t(title,x)(topics,t)(places,p)"]
    assert [r.value for r in spark.read.text(str(tmp_path / "out/header")).collect()] == list(sinks.WORD_COUNT_HEADER)


def test_feature_matrix_and_norms(spark):
    docs = spark.createDataFrame(W, "doc_id bigint, text string")
    matrix = features.feature_matrix(terms.stored_bags(docs))
    got = {(r.doc_id, r.feature): r.value for r in matrix.collect()}
    assert len(got) == 9 and got[(3, "__num_words")] == 2.0 and got[(1, "__diversity")] == 0.4
    cells = spark.createDataFrame(
        [(1, "f", 3.0), (2, "f", 4.0), (1, "g", 0.0), (2, "g", 0.0)], "doc_id bigint, feature string, value double"
    )
    scaled = features.l2_normalize_columns(cells)
    assert sorted(map(tuple, scaled.collect())) == [(1, "f", 0.6), (1, "g", 0.0), (2, "f", 0.8), (2, "g", 0.0)]
    rows = spark.createDataFrame([(1, [3.0, 0.0]), (2, [4.0, 0.0])], "id bigint, vec array<double>")
    assert sorted(map(tuple, features.l2_normalize_vectors(rows, "vec").collect())) == [(1, [0.6, 0.0]), (2, [0.8, 0.0])]


def test_sparse_forms(spark):
    cells = spark.createDataFrame(
        [(1, "b", 2.0), (1, "a", 1.0), (2, "c", 0.0)], "doc_id bigint, feature string, value double"
    )
    rows = {r.doc_id: sorted(zip(r.idx, r.val)) for r in features.sparse_rows(cells).collect()}
    assert rows == {1: [("a", 1.0), ("b", 2.0)], 2: []}
    vectors, width = features.sparse_vectors(cells)
    got = {r.doc_id: r.features for r in vectors.collect()}
    assert width == 3 and list(got[1].toArray()) == [1.0, 2.0, 0.0] and list(got[2].toArray()) == [0.0] * 3
