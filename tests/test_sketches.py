import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.functions.hashing import MAX_HASH, PRIME, permutations, sha1_hash32
from termloom.operators import minhash, similarity

BAG = "doc_id bigint, num_words bigint, terms array<struct<term:string,cnt:bigint>>"


def bags_of(spark, sets):
    rows = [(i, len(s), [(t, 2) for t in sorted(s)]) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, BAG)


def brute_signature(terms, k, seed=1):
    a, b = permutations(k, seed)
    sig = np.full(k, MAX_HASH, np.int64)
    for t in terms:
        hv = int.from_bytes(hashlib.sha1(t.encode()).digest()[:4], "little")
        wrapped = [((int(x) * hv + int(y) + 2**63) % 2**64) - 2**63 for x, y in zip(a, b)]
        sig = np.minimum(sig, [w % PRIME & MAX_HASH for w in wrapped])
    return sig


def test_fixed_values(spark):
    a, b = permutations(4, 1)
    assert list(a) == [775169054918279404, 1758426461858698313, 2109959069025162, 965365488286768774]
    assert list(b) == [401325382989534144, 1703346441743126657, 1130051441076870727, 1762784241922636284]
    words = {"hello": 499578026, "a1": 466197490, "wörd": 3695859528}
    rows = spark.createDataFrame([(w,) for w in words], "t string")
    assert {r.t: r.h for r in rows.select("t", sha1_hash32(F.col("t")).alias("h")).collect()} == words


def test_signature_operations(spark):
    bags = bags_of(spark, [{"hello"}, {"a1"}, {"wörd"}, {"hello", "a1"}, {"hello", "wörd"}, set()])
    sigs = minhash.signatures(bags, 4).cache()
    got = {r.doc_id: r.sig for r in sigs.collect()}
    assert got[0] == [1532289145, 657939710, 878936045, 1550743288]
    assert got[1] == [4133689050, 2481631361, 1956480188, 1991538343]
    assert got[2] == [1771358753, 241882120, 1362952979, 903911852]
    assert got[3] == got[0]
    assert got[4] == [1532289145, 241882120, 878936045, 903911852]
    assert got[5] == [MAX_HASH] * 4
    pair = sigs.where("doc_id = 3").alias("x").crossJoin(sigs.where("doc_id = 4").alias("y"))
    assert pair.select(minhash.jaccard(F.col("x.sig"), F.col("y.sig"))).first()[0] == 0.5
    merged = minhash.merge(sigs.where("doc_id in (3, 4)").withColumn("g", F.lit(1)), "g").orderBy("slot")
    assert [r.hv for r in merged.collect()] == got[4]
    assert minhash.merge(sigs.where("doc_id = 3"), "doc_id", min_inputs=2).count() == 0
    counts = {r.doc_id: r.n_est for r in minhash.cardinality(sigs).collect()}
    assert counts[3] == pytest.approx(2.718660303) and counts[5] == 0
    assert {r.doc_id for r in minhash.is_empty(sigs).where("is_empty").collect()} == {5}
    groups = {r.first_id: r.n_docs for r in minhash.equal_groups(sigs).collect()}
    assert groups == {0: 2, 1: 1, 2: 1, 4: 1, 5: 1}


def test_slot_limit_and_mismatch(spark):
    with pytest.raises(ValueError):
        permutations((1 << 32) + 1, 1)
    x = minhash.signatures(bags_of(spark, [{"a"}]), 4)
    y = minhash.signatures(bags_of(spark, [{"a"}]), 8)
    pair = x.select(F.struct("*").alias("x")).crossJoin(y.select(F.struct("*").alias("y")))
    with pytest.raises(Exception, match="differ in seed"):
        pair.select(minhash.check_comparable(F.col("x"), F.col("y"))).collect()


def test_custom_hash(spark):
    crc = minhash.signatures(bags_of(spark, [{"a", "b"}]), 8, hash_expr=F.crc32).first().sig
    assert crc != minhash.signatures(bags_of(spark, [{"a", "b"}]), 8).first().sig


def test_save_and_load(spark, tmp_path):
    sigs = minhash.signatures(bags_of(spark, [{"a"}, set()]), 16)
    minhash.save(sigs, str(tmp_path / "s"))
    assert sorted(map(tuple, minhash.load(spark, str(tmp_path / "s")).collect())) == sorted(map(tuple, sigs.collect()))


def test_set_jaccard(spark):
    rows = spark.createDataFrame(
        [(["a", "b"], ["b", "c"]), ([], []), (["a"], [])], "x array<string>, y array<string>"
    )
    assert [r[0] for r in rows.select(similarity.jaccard(F.col("x"), F.col("y"))).collect()] == [1 / 3, 0.0, 0.0]


@pytest.mark.parametrize("block_rows", [2000, 7])
def test_pair_study_against_brute_force(spark, block_rows):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    sets = [set(rnd.sample(words, rnd.randint(1, 12))) for _ in range(40)]
    sets += [set(sets[0])] * 20 + [set()] * 3  # a third of the rows are copies
    ks = (16, 64)
    sig = {k: [brute_signature(s, k) for s in sets] for k in ks}
    n = len(sets)
    true, est = np.zeros((n, n)), {k: np.zeros((n, n)) for k in ks}
    for i, j in itertools.permutations(range(n), 2):
        union = len(sets[i] | sets[j])
        true[i, j] = len(sets[i] & sets[j]) / union if union else 0.0
        for k in ks:
            est[k][i, j] = np.mean(sig[k][i] == sig[k][j])
    study = similarity.pair_study(bags_of(spark, sets), ks, block_rows=block_rows).cache()
    for k, m in [(0, true), *est.items()]:
        got = {r.id: r for r in study.where(F.col("k") == k).collect()}
        for i in range(n):
            assert got[i].n == (m[i] > 0).sum()
            assert got[i].total == pytest.approx(m[i].sum())
            assert got[i].top == pytest.approx(m[i].max())
    upper = np.triu_indices(n, 1)
    for k in ks:
        err = study.where(F.col("k") == k).agg(F.sum("err")).first()[0]
        assert err == pytest.approx(((est[k] - true)[upper] ** 2).sum())


def test_error_study_falls_with_slots(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    sets = [set(rnd.sample(words, rnd.randint(3, 20))) for _ in range(60)]
    got = {r.k: r for r in similarity.error_study(bags_of(spark, sets)).collect()}
    assert set(got) == set(similarity.STUDY_SLOTS) and all(r.n_pairs == 60 * 59 // 2 for r in got.values())
    assert got[256].mse < got[64].mse < got[16].mse
