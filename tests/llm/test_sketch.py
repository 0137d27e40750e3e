"""Scaled sketches against a plain version of the same rule over Spark's own hash."""

import hashlib

import pytest
from pyspark.sql import functions as F

from termloom.llm import sketch


def col(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_sketch_rules(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    df = col(spark, long, long + " tail", "one two", "one two", None, "", " \n", "a b c d e", long[:200])
    rows = [r.s for r in df.select("doc_id", sketch.sketch(F.col("text")).alias("s")).orderBy("doc_id").collect()]
    bound = sketch.threshold()
    assert all(x < bound for x in rows[0]) and rows[0] == sorted(set(rows[0]))
    assert 0.8 < len(rows[0]) / (2996 / sketch.SCALE) < 1.2
    assert rows[2] == rows[3] and len(rows[2]) == 1 and rows[4] == rows[5] == rows[6] == [] and len(rows[7]) == 1
    full = {r.h for r in df.where("doc_id = 0").select(F.explode(sketch.shingle_hashes(F.col("text"))).alias("h")).collect()}
    assert rows[0] == sorted(h for h in full if h < bound) and len(full) == 2996


def test_merge_and_containment(spark):
    rng = [f"w{i}" for i in range(4000)]
    a, b = " ".join(rng), " ".join(rng[:800])
    df = col(spark, a).crossJoin(col(spark, b).select(F.col("text").alias("b")))
    s = df.select(sketch.sketch(F.col("text")).alias("a"), sketch.sketch(F.col("b")).alias("b"))
    one = s.select(
        sketch.containment(F.col("b"), F.col("a")).alias("all"), sketch.containment(F.col("a"), F.col("b")).alias("part"),
        sketch.likeness(F.col("a"), F.col("b")).alias("like"), (sketch.merge(F.col("a"), F.col("b")) == F.col("a")).alias("same"),
    ).first()
    assert one["all"] == 1.0 and one.part == pytest.approx(0.2, abs=0.06) and one.like == one.part and one.same


def test_edited_pairs(spark):
    rows = [(5, "alpha beta gamma delta epsilon zeta"), (9, "x"), (7, None), (-3, "é" * 10), (None, "last one here"), (2, "same text"), (1, "same text")]
    docs = spark.createDataFrame([(a, b, 0.5) for a, b in rows], "doc_id long, text string, next double")
    got = {r.doc_id: r for r in sketch.edited_pairs(docs).collect()}
    order = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -(1 << 63)))
    assert len(got) == len(rows)
    for (key, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        k = len(text) // 3
        want = text[: len(text) - k] + after[:k]
        assert (got[key].n_chars, got[key].edited_sha256) == (len(text), hashlib.sha256(want.encode()).hexdigest())
        assert 0 <= got[key].near_edited <= 1 and 0 <= got[key].near_next <= 1
    assert got[1].fingerprint == got[2].fingerprint and got[2].near_next == 1.0
    assert sketch.edited_pairs(docs.limit(0)).collect() == []
    twice = sketch.edited_pairs(docs.where("doc_id = 5").union(docs.where("doc_id = 5"))).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
