"""Archives: a round trip, and damaged segments."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from termloom.llm import warc


def back(spark, pages, path, **options):
    warc.write(warc.pages_to_records(pages), path, **options)
    return warc.payloads(warc.reassemble(warc.read(spark, path)))


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, tmp_path, compression):
    long = "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 900
    html = [None, "", "short", "short", long, long, "x" * 1000, "x" * 1000, "x" * 1000, "y" * 999, "y" * 999, "z\r\n\r\n" * 5000]
    rows = [(i, None if i == 3 else f"http://a/{i}\r\nX: y", h, "k") for i, h in enumerate(html)]
    rows += [(None, "u", "x" * 1000, "k"), (8, "again", "x" * 1000, "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = back(spark, pages, str(tmp_path / "w"), segment_bytes=700, compression=compression).collect()
    assert len(got) == len(rows) and all(r.problem is None for r in got)
    for r in got:
        if r.page_id is None or (r.page_id == 8):
            assert (r.record_type, r.refers_to, r.payload_bytes) == ("response", None, 1000)
            continue
        data = (html[r.page_id] or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        want = {4: 5, 6: 8, 7: 8}.get(r.page_id)
        assert (r.record_type, r.refers_to) == (("revisit", want) if want else ("response", None))
        assert r.payload == (b"" if want else data)
    assert any(r.segments > 20 for r in got)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert back(spark, pages, str(tmp_path / "w")).collect() == []


def test_damage(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "abc" * 500) for i in range(1)], "page_id long, url string, html string")
    warc.write(warc.pages_to_records(pages), str(tmp_path / "w"), segment_bytes=400)
    records = warc.read(spark, str(tmp_path / "w"))
    problem = lambda df: [r.problem for r in warc.reassemble(df).collect()]
    assert problem(records) == [None]
    assert problem(records.where("segment_number != 2")) == ["missing segment"]
    assert problem(records.where("origin_id is not null")) == ["no origin"]
    assert problem(records.where("total_length is null")) == ["no total length"]
    assert problem(records.union(records.where("segment_number = 2"))) == [None]  # sent again
    other = records.where("segment_number = 2").withColumn("block", F.expr("reverse(block)"))
    assert problem(records.union(other)) == ["repeated segment"]
    assert problem(records.withColumn("block", F.expr("case when segment_number = 1 then substring(block, 2) else block end"))) == ["wrong length"]
    cut = warc.payloads(warc.reassemble(records).withColumn("block", F.expr("substring(block, 1, 300)"))).first()
    assert cut.problem == "bad chunk"


def test_parse():
    one = b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b, _ in warc.parse(warc.inflate(gzip.compress(one) + gzip.compress(one)))] == [b"abc", b"abc"]
    assert [p for _, _, p in warc.parse(b"rubbish\r\n\r\n" + one)] == ["bad header", None]
    assert [p for _, _, p in warc.parse(one[:-6])] == ["cut short"]
    assert warc.unchunk(b"3;x=y\r\nabc\r\n0\r\n\r\n") == (b"abc", None)
    assert warc.unchunk(b"5\r\nabc")[1] == "bad chunk"


def test_many_repeated_payloads(spark, tmp_path, monkeypatch):
    """Digests beyond the broadcast bound go by hot ones and the rest."""
    rows = [(i, "u", f"{'abc' * 400}{min(i % 40, 20)}") for i in range(400)] + [(900 + i, "u", None) for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(warc.with_last_page, "__defaults__", (10,))
    got = {r.page_id: r for r in back(spark, pages, str(tmp_path / "w"), segment_bytes=200).collect()}
    last = {}
    for i, _, html in rows[:400]:
        last[html] = i
    assert len(got) == 450 and all(r.problem is None for r in got.values())
    assert all(got[i].refers_to == (last[h] if i != last[h] else None) for i, _, h in rows[:400])
    assert all(got[900 + i].refers_to is None and got[900 + i].payload_bytes == 0 for i in range(50))
