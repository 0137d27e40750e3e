"""Line deduplication against a plain dictionary."""

import re

from termloom.llm import lines


def plain(rows, min_words):
    seen, out = {}, {}
    cut = {key: lines.split(text or "", lines.SENTENCES) for key, text in rows}
    for key, text in sorted((k, t) for k, t in rows if t and k is not None):
        kept, lost = "", []
        for start, n in cut[key]:
            unit = text[start : start + n]
            norm = re.sub(r"\s+", " ", unit.lower()).strip()
            first = seen.setdefault(norm, (key, start)) if len(norm.split()) >= min_words else (key, start)
            if first == (key, start):
                kept += unit
            else:
                lost.append((start, n, *first))
        out[key] = (kept, lost)
    return out


def test_dedupe(spark):
    a, b = "Ä long line that many documents do share today.", "another Line which comes back again and again"
    rows = [(4, f"{a} {b}\nown words here"), (2, f"x y\n{a}\n{b}"), (9, f"{a.upper()}  {a}\n\n{b}\nshort. short."), (1, None), (3, ""), (7, "\n \n"), (8, "word " * 4000)]
    docs = spark.createDataFrame([(*r, "s") for r in rows] + [(None, a, "s")], "doc_id long, text string, removed string")
    got = {r.doc_id: r for r in lines.dedupe(docs, min_words=6).collect()}
    assert len(got) == 8 and got[1].text is None and got[1].removed == [] and got[3].text == "" and got[None].text == a
    for key, (text, lost) in plain(rows, 6).items():
        assert (got[key].text, [tuple(x) for x in got[key].removed]) == (text, lost)
    assert got[4].text == "own words here"
    assert lines.dedupe(docs.limit(0)).collect() == []
    twice = lines.dedupe(docs.where("doc_id = 2").union(docs.where("doc_id = 2")), min_words=6).collect()
    assert [r.text for r in twice] == [rows[1][1]] * 2


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain(rows, lines.MIN_WORDS)
    got = {r.doc_id: r for r in lines.dedupe(docs).collect()}
    assert {k: (r.text, [tuple(x) for x in r.removed]) for k, r in got.items()} == want
    assert any(lost for _, lost in want.values())


def test_shared_ids_keep_their_own_text(spark):
    a, b = "first unit of eight words stands here today", "another unit of eight words stands here now"
    rows = [(7, f"{a}\n{b}"), (7, "Completely different text.\n" + b), (7, f"{a}\n{b}"), (9, f"{b}\nmore"), (None, a)]
    docs = spark.createDataFrame([(*r, 1, 2, 3, "z") for r in rows], "doc_id long, text string, _id int, _lost int, `a.b` int, row string")
    got = lines.dedupe(docs)
    assert got.columns == [*docs.columns, "removed"]
    texts = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    keys = {t: k for t, k in docs.selectExpr("text", "xxhash64(text) k").distinct().collect()}
    first = keys[rows[0][1]] < keys[rows[1][1]]  # which of id 7's texts comes first
    other = "Completely different text.\n"
    want = [(7, rows[0][1] if first else f"{a}\n")] * 2 + [(7, other if first else rows[1][1]), (9, "more"), (None, a)]
    assert texts == sorted(want, key=str)
