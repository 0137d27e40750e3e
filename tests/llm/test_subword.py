"""Hashing, gradients and held-out accuracy of the subword classifier."""

import zlib

import numpy as np
import pytest

from termloom.llm import subword

S = subword.Settings(bits=12, size=6, sample=300, epochs=3)


def test_features_by_words(monkeypatch):
    """A text's buckets are those of its words and their n-grams, in whatever place."""
    def of(text):
        ids, n = subword.counted(text, S)
        return dict(zip(ids.tolist(), n.tolist()))

    one, two = of("abcd"), of("  xyz\n")
    both = of("xyz \t abcd")
    pair = {b: n - one.get(b, 0) - two.get(b, 0) for b, n in both.items()}
    assert sum(pair.values()) == 1  # the pair of words
    assert sum(one.values()) == 1 + 4 + 3  # word, 3-grams and 4-grams with the blanks around
    assert of("") == of(" \n") == {}
    assert len(set(of("no no")) - set(of("no"))) == 1 and set(of("no no")) - set(of("no")) == set(of("ja ja")) - set(of("ja"))
    text = " ".join(f"w{i % 50}é" for i in range(2000))
    whole = of(text)
    monkeypatch.setattr(subword, "PIECE", 700)
    cut = of(text)
    assert abs(sum(whole.values()) - sum(cut.values())) <= len(text) // 600 + 1  # pairs across cuts only
    assert sum(of("x" * 5000).values()) > 9000


def test_gradient():
    """One step without decay moves against the numeric gradient of the loss."""
    settings = subword.Settings(bits=4, size=3, epochs=1, rate=1e-3, gain=1.0)
    ids, n, y = np.array([1, 5, 9]), np.array([2, 1, 1]), 1
    rng = np.random.RandomState(settings.seed)
    vectors, out = rng.uniform(-1, 1, (16, 3)) / 3, rng.uniform(-1, 1, (3, 2))
    bias = np.log(np.array([1.0, 2.0]) / 3.0)

    def loss(v, o):
        logits = (v[ids] * (n / 4)[:, None]).sum(axis=0) @ o + bias
        return -(logits[y] - np.log(np.exp(logits).sum()))

    model = subword.fit([(ids, n, y)], settings)
    for own, other, place in ((vectors, model.vectors, "v"), (out, model.out, "o")):
        for at in np.ndindex(own.shape):
            moved = own.copy()
            moved[at] += 1e-6
            slope = (loss(moved, out) if place == "v" else loss(vectors, moved)) - loss(vectors, out)
            assert (own - other)[at] / 1e-3 == pytest.approx(slope / 1e-6, abs=1e-4)


def test_folded_scores_equal_the_model():
    rows = [(*subword.counted(t, S), y) for t, y in (("good words here", 1), ("bad !! bad !!", 0))]
    model = subword.fit(rows, S)
    weights, rest = model.folded()
    for text in ("good bad", "here !!", ""):
        ids, n = subword.counted(text, S)
        mean = (model.vectors[ids] * (n / max(n.sum(), 1))[:, None]).sum(axis=0)
        logits = mean @ model.out + model.bias
        assert subword.logit(text, weights, rest, S) == pytest.approx(logits[1] - logits[0])


def tables(spark, n=500):
    rng = np.random.RandomState(1)
    words = [f"w{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(n):
        y = int(i % 4 != 0)
        text = " ".join(w + ("" if y else "!!") for w in rng.choice(words, 30))
        rows.append((i, text))
        labels.append((i, y))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_documents(spark):
    docs, labels = tables(spark)
    got = subword.documents(docs, labels, settings=S).join(labels, "doc_id").collect()
    assert len(got) == 500 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 60 and sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs, labels = tables(spark)
    some = subword.Settings(sample=40, longest=10**6)
    rows = subword.training_rows(docs, labels, "doc_id", "text", "quality", some)
    texts = {r.text: r.doc_id for r in docs.collect()}
    drawn = rows.collect()
    assert len(drawn) == 40 and all(zlib.crc32(str(texts[r.text]).encode()) % 5 for r in drawn)
    same = docs.selectExpr("1 as doc_id", "text")  # one id on all rows
    assert subword.training_rows(same, labels, "doc_id", "text", "quality", some).count() == 40
    assert subword.training_rows(docs, labels, "doc_id", "text", "quality", subword.Settings(longest=10)).count() == 0


def test_edge_cases(spark):
    docs, labels = tables(spark, 60)
    odd = spark.createDataFrame([(None, "w1 w2"), (900, None), (901, ""), (902, " \n"), (903, "w3 " * 300_000), (903, "w3 " * 300_000)], docs.schema)
    more = labels.union(spark.createDataFrame([(None, 1), (1, None), (2, 7), (0, 1), (0, 1)], labels.schema))
    got = subword.documents(docs.union(odd).selectExpr("*", "1 as score", "2 as _text", "3 as `a.b`"), more, settings=S).collect()
    assert len(got) == 66
    empty = {r.score for r in got if r.doc_id in (900, 901, 902)}
    assert len(empty) == 1 and 0.5 < empty.pop() < 1
    assert len({r.score for r in got if r.doc_id == 903}) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert subword.documents(docs.limit(0), more, settings=S).collect() == []
    none = subword.documents(docs, labels.limit(0), settings=S).collect()
    assert {r.score for r in none} == {0.5}
