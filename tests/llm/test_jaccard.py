"""Components of the Jaccard join against all pairs of exact sets."""

import random
import re

import pytest

from termloom.llm import jaccard
from termloom.session import may_match

SF = "/root/testdata/sf0.001"


def exact_sets(rows, k):
    out = []
    for key, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()
        out.append((key, grams))
    return out


def brute(rows, k, percent):
    sets = exact_sets(rows, k)
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    low = {}
    for i, (key, _) in enumerate(sets):
        low[root(i)] = min(low.get(root(i), key), key)
    return sorted((key, len(s), low[root(i)]) for i, (key, s) in enumerate(sets))


def got(spark, rows, k, percent):
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, class int")
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(docs, words=k, percent=percent).collect())


def near_copies(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    originals = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 120))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(rng.choice(originals))
        for _ in range(rng.choice((0, 0, 1, 2, 4))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((1000 - 3 * i, " ".join(words).title() if i % 3 else "  ".join(words)))
    return rows


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_near_copies(spark, k, percent):
    rows = near_copies(k, 150) + [(-1, None), (-2, ""), (-3, " \t\n"), (-4, "one"), (-5, "ONE"), (-6, "one two"), (-7, "É"), (-8, "é")]
    assert got(spark, rows, k, percent) == brute(rows, k, percent)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 1500)
    rows = near_copies(9, 80)
    assert got(spark, rows, 3, 80) == brute(rows, 3, 80)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, 3, 90)
    assert len({c for _, _, c in want}) < len(want)
    assert sorted(map(tuple, jaccard.groups(docs).collect())) == want


def test_edges(spark):
    kind = "doc_id long, text string"
    assert jaccard.groups(spark.createDataFrame([], kind)).collect() == []
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (5, "x y z"), (2, "x y z")]
    found = jaccard.groups(spark.createDataFrame(rows, kind)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (2, 2), (5, 2), (5, 5), (5, 5)]
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, None, "z")], kind + ", lang string")
    assert sorted(r.doc_id for r in jaccard.keep_one(docs).collect()) == [1, 3]


def test_keep_one_goes_by_rows(spark):
    """Shared ids, repeated rows and null ids: one row of each group, no text lost."""
    long, own = "a b c d e f g h", "one two three four five six"
    rows = [(2, long), (2, long), (5, long), (5, own), (None, long), (None, None), (None, None), (9, ""), (9, ""), (6, own.upper()), (7, "solo words are here now"), (7, "solo words are here now")]
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], "doc_id long, text string, _other string, row int, text_key int, `a.b` int")
    left = jaccard.keep_one(docs)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert got == sorted([(2, long), (5, own), (None, long), (None, None), (None, None), (9, ""), (9, ""), (7, "solo words are here now")], key=str)
    again = jaccard.keep_one(left)
    assert sorted(((r.doc_id, r.text) for r in again.collect()), key=str) == got


def test_documents_without_a_candidate_are_not_shuffled(spark, monkeypatch):
    """Beyond the rows that may be broadcast, a table of bits picks the documents to join."""
    seen, plain = [], jaccard.may_match
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard, "may_match", lambda keys, n: seen.append((keys.columns, n)) or plain(keys, n))
    rows = near_copies(4, 60) + [(7, "alone among all these texts"), (8, None)]
    assert got(spark, rows, 3, 80) == brute(rows, 3, 80)
    assert [columns for columns, _ in seen] == [["token"], ["doc_id"]] and 0 < seen[1][1] < len(rows)
    texts = [(2, "a b c d e f g h"), (5, "a b c d e f g h"), (5, "solo words are here now"), (5, "solo words are here now"), (None, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    left = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(docs).collect()), key=str)
    assert left == sorted([texts[0], texts[2], texts[4]], key=str)


def test_may_match(spark):
    keys = spark.range(0, 6000, 3).withColumnRenamed("id", "key")
    may = may_match(keys, 2000)
    passed = {r.id for r in spark.range(6000).where(may("id")).collect()}
    assert {*range(0, 6000, 3)} <= passed and len(passed) < 2100
    assert spark.range(10).where(may_match(keys.where("key < 0"), 0)("id")).isEmpty()
