import pytest
from pyspark.sql import functions as F

from termloom.plans import jobs
from termloom.session import hot_split_join, shared_dir, with_row_index
from termloom.sources import corpus, html

RECORDS = """<!DOCTYPE lewis SYSTEM "lewis.dtd">
<REUTERS TOPICS="YES" NEWID="1">
<TOPICS><D>cocoa</D><D>tea</D></TOPICS><PLACES><D>usa</D></PLACES>
<TEXT>&#2;<TITLE>BAHIA &lt;X></TITLE><BODY>Showers continued
in the week. &#3;</BODY></TEXT></REUTERS>
<REUTERS TOPICS="NO" NEWID="2">
<TOPICS></TOPICS><PLACES></PLACES><TEXT><TITLE>t</TITLE></TEXT></REUTERS>
"""


def test_tagged_records(spark, tmp_path):
    path = tmp_path / "a.sgm"
    path.write_text(RECORDS)
    got = {r.doc_id: r for r in corpus.tagged_records(spark, str(path)).collect()}
    assert set(got) == {1, 2}
    assert got[1].topics == ["cocoa", "tea"] and got[1].places == ["usa"]
    assert got[1].title == "BAHIA <X>" and got[1].text == "Showers continued\nin the week. "
    assert got[2].topics == [] and got[2].title == "t" and got[2].text is None
    kept = corpus.labelled(corpus.tagged_records(spark, str(path)))
    assert [(r.doc_id, r.label) for r in kept.collect()] == [(1, "cocoa")]


def test_all_named_references(spark):
    from html import unescape
    from html.entities import html5

    names = sorted(n for n in html5 if n.endswith(";"))
    rows = spark.createDataFrame([(f"a&{n}b &amp;{n} &x{n}",) for n in names], "t string")
    for t, d in rows.select("t", html.decode_entities(F.col("t"))).collect():
        name = t[2:t.index(";") + 1]
        kept = unescape(f"&x{name}") if f"x{name}" in html5 else f"&x{name}"
        assert d == f"a{html5[name]}b &{name} {kept}", t
    odd = spark.createDataFrame([("&frac12;&nbsp;&Eacute;&eacute;&amp &; &nosuch; &9a;",)], "t string")
    assert odd.select(html.decode_entities(F.col("t"))).first()[0] == "\u00bd\u00a0\u00c9\u00e9&amp &; &nosuch; &9a;"


def test_entities(spark):
    cases = {
        "a &amp;lt; b": "a &lt; b", "&#65;&#233;&#8364;": "Aé€", "&#2;x&#31;": "x", "&#xx; &#12": "&#xx; &#12",
        "R&D &gt; &quot;q&quot;": 'R&D > "q"', "plain": "plain", "&#38;lt;": "&lt;", "a&#10;b&#9;c": "a\nb\tc", "&#x41;&#XE9;": "Aé", "&#1048576;": "\U00100000", "&#9999999;": "&#9999999;",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.d for r in rows.select("t", html.decode_entities(F.col("t")).alias("d")).collect()}
    assert got == cases
    back = rows.select("t", html.decode_entities(html.encode_entities(F.col("t"))).alias("d")).collect()
    assert all(r.t == r.d for r in back if "&#" not in r.t)


def test_record_roundtrip(spark, tmp_path):
    rows = [(7, ["a&b"], ["p", "q"], "t <1>", "x &lt; y <b>\nz"), (8, [], [], "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, topics array<string>, places array<string>, title string, text string")
    corpus.write_tagged_records(docs, str(tmp_path / "out"))
    got = corpus.tagged_records(spark, str(tmp_path / "out")).drop("source", "seq")
    assert sorted(map(tuple, got.collect())) == rows


def test_source_selection(spark):
    docs = spark.createDataFrame([(i, f"s{i % 4}") for i in range(12)], "doc_id bigint, source string")
    assert {r.source for r in corpus.first_sources(docs, 2).collect()} == {"s0", "s1"}
    assert [r.doc_id for r in corpus.sample(docs, 2, 2).collect()] == [1, 5]


def test_dedupe_keeps_last(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, None)], "id bigint, seq int, v string")
    assert sorted(map(tuple, corpus.dedupe_by_id(rows, "id", "seq").collect())) == [(1, 3, "c"), (2, 1, None)]


def test_hot_split_join_equals_plain_join(spark):
    rows = spark.range(600).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 90).alias("k"), "id")
    lookup = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    want = sorted(map(tuple, rows.join(lookup, "k").select("k", "id", "v").collect()))
    for limit in (1000, 10, 2):
        got = hot_split_join(rows, lookup, "k", "n", limit).select("k", "id", "v")
        assert sorted(map(tuple, got.collect())) == want


def test_row_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x"))
    numbered, n = with_row_index(df, "x")
    got = [r.row_index for r in numbered.orderBy("x").collect()]
    assert n == 1000 and got == list(range(1000))


def test_shared_dir_follows_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == named if named else shared_dir(spark)


@pytest.mark.parametrize("change", [str, str.lower, str.title])
def test_records_in_any_case(spark, tmp_path, change):
    text = "".join(f'<REUTERS NEWID="{i}"><TOPICS><D>t</D></TOPICS><TEXT><BODY>b {i}</BODY></TEXT></REUTERS>\n' for i in (1, 2, 3, 2))
    (tmp_path / "a.sgm").write_text(change(text))
    docs = corpus.tagged_records(spark, str(tmp_path))
    assert sorted(r.doc_id for r in docs.collect()) == [1, 2, 2, 3]
    assert sorted(r.doc_id for r in jobs.latest(docs).collect()) == [1, 2, 3]
    assert jobs.word_count_vectors(docs).count() == 3


def test_jobs_on_tagged_files(spark, tmp_path):
    words = ["alpha", "beta", "gamma", "delta"]
    body = lambda i: " ".join([words[i % 4]] * 3 + [words[(i + 1) % 4]] * (2 + i % 3))
    one = lambda i, b: f'<reuters newid="{i}"><topics><d>t{i % 2}</d></topics><text><title>x</title><body>{b}</body></text></reuters>'
    (tmp_path / "a.sgm").write_text("".join(one(i, "old text old text") for i in range(6)))
    (tmp_path / "b.sgm").write_text("".join(one(i, body(i)) for i in range(24)))
    docs = corpus.tagged_records(spark, str(tmp_path), separator="</reuters>")
    assert jobs.tfidf_vectors(docs).count() == 24
    assert jobs.similarity_study(docs, [16]).first().n_pairs == 24 * 23 // 2
    assert jobs.knn_accuracy(docs, [1]).first().n_test == 10
    assert sum(r.n for r in jobs.dbscan_report(docs, [0.3], [2]).collect()) == 24
    assert sum(r.n for r in jobs.kmeans_report(docs, [3]).collect()) == 24
    assert jobs.dtree_accuracy(docs).count() == 1
