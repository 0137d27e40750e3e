"""Profiles and predictions against plain counting, and held-out accuracy."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termloom.llm import language

SF = "/root/testdata/sf0.01"


def plain_grams(text):
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        w = f" {word} "
        out.update(g for n in (1, 2, 3) for i in range(len(w) - n + 1) if (g := w[i : i + n]) != " ")
    return out


def plain_profile(counts, size):
    return {g: r for r, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size])}


@pytest.mark.parametrize("text", ["", "a", "a b", "É été, l'an 1999!", " x\ty ", "ab_cd 12 ef", "字 字字", "123 --"])
def test_grams(text):
    got = Counter(language.gram(k) for k in language.gram_keys(text).tolist())
    assert got == plain_grams(text)
    assert all(language.gram(language.key_of(g)) == g for g in got)


def test_predictions(spark):
    rows = [(1, "The cat and the hat", "en"), (2, "der Hund und die Katze", "de"), (3, "the end", "en"), (4, None, "en"),
            (5, "le chat", None), (6, "12 34 !", "de"), (7, "", None), (8, "Die Katze", "x"), (9, "zzz", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("old"))
    size = 12
    learned = language.profiles(docs, size=size)
    counts = {}
    for _, text, lang in rows:
        if lang and text:
            counts.setdefault(lang, Counter()).update(plain_grams(text))
    want = {(lang, g): r for lang, c in counts.items() for g, r in plain_profile(c, size).items()}
    assert {(r.lang, r.gram): r["rank"] for r in learned.collect()} == want
    got = {r.doc_id: r for r in language.predict(docs, learned, size=size).collect()}
    assert len(got) == len(rows)
    for key, text, _ in rows:
        own = plain_profile(plain_grams(text or ""), size)
        if not own:
            assert (got[key].lang_pred, got[key].score) == ("und", 0.0)
            continue
        far = {lang: sum(abs(want[lang, g] - r) if (lang, g) in want else size for g, r in own.items()) for lang in counts if counts[lang]}
        best = min(far, key=lambda lang: (far[lang], lang))
        assert (got[key].lang_pred, got[key].score) == (best, pytest.approx(1 - far[best] / (size * len(own))))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = language.held_out(F.col("doc_id"))
    found = language.predict(docs.where(held), language.profiles(docs.where(~held)))
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count() > 0


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language.predict(docs, language.profiles(docs)).first().lang_pred == "und"
    assert language.predict(docs.limit(0), language.profiles(docs)).collect() == []
