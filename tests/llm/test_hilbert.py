"""The curve visits neighbours; shards are even runs of it."""

import zlib
from collections import Counter

import numpy as np
import pytest

from termloom.llm import hilbert


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 3), (3, 3), (4, 2)])
def test_curve(dims, bits):
    cells = np.indices([1 << bits] * dims).reshape(dims, -1)
    at = hilbert.curve_index(cells, bits)
    assert sorted(at.tolist()) == list(range(1 << bits * dims))
    path = cells[:, np.argsort(at)]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def test_documents(spark):
    rows = [(i, None if i % 17 == 0 else f"text é {i // 3}", "en" if i % 3 else None, f"s{i % 5}", i % 40) for i in range(213)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, shard int")
    got = hilbert.documents(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(213))
    text = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(r["size"] == len(text[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id]) for r in got)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(40)) and set(counts.values()) == {5, 6}
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    line = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in line] == sorted(r.curve for r in got)
    assert hilbert.documents(docs.limit(0)).collect() == []
    assert sorted((r.shard, r.slot) for r in hilbert.documents(docs.limit(3)).collect()) == [(0, 0), (13, 0), (26, 0)]


def test_written_shards(spark, tmp_path):
    docs = spark.range(500).selectExpr("id as doc_id", "cast(id % 20 as double) a", "cast(id * 7 % 100 as int) b")
    placed = hilbert.shard(docs, ["a", "b"], ["doc_id"], shards=10)
    hilbert.write_shards(docs, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500
    spans = hilbert.ranges(back, ["a", "b"]).collect()
    assert {r.rows for r in spans} == {50}
    assert sum((r.max_a - r.min_a) / 20 * (r.max_b - r.min_b) / 100 for r in spans) < 3.5  # 10 without an order


def test_filters_skip_shards(spark):
    """Shards that a filter on one value must read, by least and greatest value."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    placed = hilbert.documents(docs).select("doc_id", "shard").join(docs.select("doc_id", "source", "lang", "n_chars"), "doc_id")
    spans = hilbert.ranges(placed, ["source", "lang", "n_chars"]).collect()
    sources = sorted({r.source for r in placed.select("source").distinct().collect()})
    read = [sum(s.min_source <= v <= s.max_source for s in spans) for v in sources]
    assert len(spans) == 40 and sum(read) / len(read) <= 15
    width = max(s.max_n_chars for s in spans)
    assert sum(s.min_n_chars <= width // 2 <= s.max_n_chars for s in spans) <= 20


def test_order_of_strings_and_names(spark):
    rows = [(i, None if i == 3 else f"http://host/{i % 7}/é", i, 2, 3) for i in range(70)]
    df = spark.createDataFrame(rows, "id long, `a.b` string, _start int, _row int, _part int")
    numbers = df.select("id", hilbert.as_number(df["`a.b`"], "string", 12).alias("x"), df["`a.b`"].alias("s")).collect()
    by_number = [r.s or "" for r in sorted(numbers, key=lambda r: (r.x, r.s or ""))]
    assert by_number == sorted(by_number) and hilbert.shared_prefixes(df, ["a.b", "id"]) == {"a.b": 12}
    got = hilbert.shard(df, ["a.b", "id"], ["id"], shards=7)
    assert got.count() == 70 and set(df.columns) < set(got.columns)
    same = df.selectExpr("1 as id", "'x' as s").union(df.selectExpr("1 as id", "'x' as s"))  # ties and repeated rows
    counts = {r.shard: r["count"] for r in hilbert.shard(same, ["s"], ["id"], shards=8).groupBy("shard").count().collect()}
    assert sorted(counts.values()) == [17] * 4 + [18] * 4
