"""Packing against a quadratic programme, the tokenizer and the rules of its result."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from termloom.llm import packing
from termloom.llm.tokens import Encoder, tokenizer_path

SF = "/root/testdata/sf0.001"
CASES = ["", " ", "a", "a  b ", " a \n b", "don't we'll 12 34a ²x", "é ß\tñ   x", "x<|endoftext|>y", "字 かな 😀", "\x1c a\x85b"]


def test_ids_equal_the_tokenizers():
    reference, own = Tokenizer.from_file(tokenizer_path()), Encoder(tokenizer_path())
    rng = random.Random(5)
    texts = CASES + ["".join(rng.choices("ab A1.,'\n\t é²字 ", k=rng.randrange(40))) for _ in range(300)]
    for text in texts:
        assert own.encode(text).tolist() == reference.encode(text, add_special_tokens=False).ids


def brute(ends, penalty, window):
    powers = {1 << k for k in range(20)}
    points, best = [0, *ends], [0]
    for j in range(1, len(points)):
        costs = []
        for i in range(j):
            n = points[j] - points[i]
            if n <= window:
                costs.append(best[i] + (0 if n in powers else window - n))
        best.append(min(costs) + penalty[j - 1] + packing.SEQUENCE_COST)
    return best[-1]


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_the_cheapest(seed):
    rng, window = np.random.default_rng(seed), 16
    ends = np.cumsum(rng.integers(1, 9, 60))
    penalty = rng.choice([0, 4, 12], 60)
    cuts = packing.cut_points(ends, penalty, window)
    total, at = 0, 0
    for c in cuts:
        n = int(ends[c]) - at
        assert 0 < n <= window
        total += (0 if n & (n - 1) == 0 else window - n) + penalty[c] + packing.SEQUENCE_COST
        at = int(ends[c])
    assert at == ends[-1]
    assert total == brute(ends.tolist(), penalty.tolist(), window)


def check(rows, texts):
    reference = Tokenizer.from_file(tokenizer_path())
    ids = {d: [*reference.encode(t or "", add_special_tokens=False).ids, 0] for d, t in texts.items()}
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        want = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4").tobytes()
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(want), len(ids[r.doc_id]))
    assert set(parts) == set(ids)
    for d, own in parts.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0
            at += r.length
        assert at == len(ids[d])
    padded = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW
        padded += 0 if at & (at - 1) == 0 else packing.WINDOW - at
    return padded, sum(map(len, ids.values()))


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    padded, tokens = check(packing.pack(docs).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert padded < 0.01 * tokens


def test_edges(spark):
    texts = {1: None, 2: "", 3: "x" * 30000, 4: "word " * 5000, 5: "A b. " * 3000, -7: CASES[6]}
    docs = spark.createDataFrame([(k, v, 0) for k, v in texts.items()], "doc_id long, text string, length int")
    check(packing.pack(docs.coalesce(1)).collect(), texts)
    assert packing.pack(docs.limit(0)).collect() == []
    twice = packing.pack(docs.where("doc_id = 2").union(docs.where("doc_id = 2"))).collect()
    assert sorted((r.doc_id, r.start, r.length) for r in twice) == [(2, 0, 1), (2, 0, 1)]
    assert packing.pack(spark.createDataFrame([(None, "a")], "doc_id long, text string")).first().doc_id is None
