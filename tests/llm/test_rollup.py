"""Ledger: totals equal a recount, and no batch counts twice."""

from collections import Counter

import pytest
from tokenizers import Tokenizer

from termloom.llm import rollup, tokens


def test_ledger(spark, tmp_path):
    docs = spark.createDataFrame(
        [("a", "en", "one two", 2), ("a", None, "", 0), (None, "de", None, None), ("b", "de", "drei vier fünf", 3)],
        "source string, lang string, text string, n long",
    )
    ledger = rollup.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.totals().collect() == []
    for turn in range(2):
        assert ledger.commit("1", rollup.inserts(docs, "v1", "n")) == (turn == 0)
        assert ledger.commit("2 / x", rollup.deletes(docs.where("source = 'b'"), "v1", "n")) == (turn == 0)
        assert ledger.commit("3", rollup.revisions(docs.where("lang = 'en'").withColumn("m", docs.n * 10), ("v1", "n"), ("v2", "m"))) == (turn == 0)
        assert ledger.commit("none", rollup.inserts(docs.limit(0), "v1", "n")) == (turn == 0)
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in ledger.totals().collect()}
    assert got == {("a", None, "v1"): (1, 0), (None, "de", "v1"): (1, 0), ("a", "en", "v2"): (1, 20)}
    # a batch that did not come to its commit file counts for nothing and can be sent again
    for name in ("1.json", ".1.json.crc"):
        (tmp_path / "ledger/commits" / name).unlink()
    assert ("a", None, "v1") not in {(r.source, r.lang, r.tokenizer) for r in ledger.totals().collect()}
    assert ledger.commit("1", rollup.inserts(docs, "v1", "n"))
    assert got == {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in ledger.totals().collect()}


def test_commits_stand_without_success_marks(spark, tmp_path):
    docs = spark.createDataFrame([("a", "en", 2), ("b", None, 3)], "source string, lang string, n long")
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(key, "false")
    try:
        ledger = rollup.Ledger(spark, str(tmp_path / "ledger"))
        assert [ledger.commit("x", rollup.inserts(docs, "v1", "n")) for _ in range(2)] == [True, False]
        assert sorted(r.tokens for r in ledger.totals().collect()) == [2, 3]
    finally:
        conf.unset(key)


def test_a_name_with_other_rows_is_refused(spark, tmp_path):
    docs = spark.createDataFrame([("a", "en", 2), ("b", None, 3)], "source string, lang string, n long")
    one, two = (rollup.Ledger(spark, str(tmp_path / "ledger")) for _ in range(2))
    assert one.commit("x", rollup.inserts(docs, "v1", "n"))
    with pytest.raises(ValueError, match="other rows"):
        two.commit("x", rollup.inserts(docs.limit(1), "v1", "n"))
    assert not two._publish("x", {"batch": "x", "folder": "none", "digest": "0:0"})  # the slower of two writers
    assert not two.commit("x", rollup.inserts(docs.orderBy("n", ascending=False), "v1", "n"))
    assert sorted(r.tokens for r in two.totals().collect()) == [2, 3]


def test_query_against_a_recount(spark):
    from termloom.llm.queries import op6_token_rollup

    sf = "/root/testdata/sf0.001"
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
    encode = {n: tokens.encoder(tokens.tokenizer_path(n)) for n in (tokens.DEFAULT_FILE, "byte_bpe_multi_50k.tiktoken")}
    want, docs = Counter(), Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        if r.doc_id not in toxic:
            name = tokens.DEFAULT_FILE if r.lang == "en" else "byte_bpe_multi_50k.tiktoken"
            want[r.source, r.lang, name] += len(encode[name].encode(r.text))
            docs[r.source, r.lang, name] += 1
    got = op6_token_rollup(spark, sf).collect()
    assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in got} == {k: (docs[k], want[k]) for k in docs}
    assert Tokenizer.from_file(tokens.tokenizer_path()).encode("a b", add_special_tokens=False).ids == encode[tokens.DEFAULT_FILE].encode("a b").tolist()
