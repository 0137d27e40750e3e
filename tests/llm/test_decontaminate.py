"""Leaks of benchmark items: as they are, with other values, and what is none."""

import pytest

from termloom.llm import decontaminate as D

ITEM = "A train travels 60 km in 2 hours, then Anna rides another 60 km on her bicycle. How far did Anna go in total?"
SAME = "A train travels 75 km in 3 hours, then Maria rides another 75 km on her bicycle. How far did Maria go in total?"
BROKEN = "A train travels 75 km in 3 hours, then Maria rides another 80 km on her bicycle. How far did Peter go in total?"
FILL = "some other words stand before and after what is of interest "


def test_kinds():
    tokens, slots = D.Canonical().tokens("It is 5 km to Rome. The day has seven hours or 3kg".split())
    assert [i for i, s in enumerate(slots) if s] == [2, 3, 5, 9, 10, 12]
    assert tokens[3] == tokens[10] == D.PLACE["unit"] and tokens[2] == tokens[9] == D.PLACE["number"]


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(a, b, 0) for a, b in docs], "doc_id long, text string, hash int")
    i = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, slots string")
    return {(r.doc_id, r.item_id): r for r in D.leaks(d, i, **options).collect()}


def test_leaks(spark):
    docs = [(1, FILL * 3 + ITEM + " " + FILL), (2, SAME), (3, FILL + SAME.replace("train", "big train") + FILL), (4, BROKEN), (5, FILL * 50), (6, None), (7, ""),
            (None, ITEM), (8, " ".join(ITEM.split()[:8])), (9, "tiny item"), (9, "tiny item"), (10, "... " + ITEM.upper())]
    got = found(spark, docs, [(1, ITEM), (2, "tiny item"), (3, None), (4, ""), (None, FILL)])
    assert {(1, 1), (2, 1), (3, 1), (9, 2)} <= set(got) and not {d for d, _ in got} & {4, 5, 6, 7, 8, None}
    assert got[1, 1].n_changed == 0 and got[1, 1].position == 33
    assert got[2, 1].n_changed == 5 and got[2, 1].coverage == 1.0
    assert found(spark, [], [(1, ITEM)]) == {} and found(spark, docs, []) == {}


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_WINDOWS", 5)
    assert set(found(spark, [(1, FILL + ITEM), (2, FILL)], [(1, ITEM)])) == {(1, 1)}


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_planted_passages(spark, sf):
    docs, items = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.item_id: r.text for r in items.collect()}
    planted = {(r.doc_id, i) for r in docs.collect() for i, t in texts.items() if t in r.text}
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs, items).collect()}
    assert planted and planted <= got
    assert got - planted == {p for p in got - planted if p[0] in {d for d, _ in planted}}
    left = {r.doc_id for r in D.clean(docs, items).collect()}
    assert left == {r.doc_id for r in docs.collect()} - {d for d, _ in got}


def plain(docs, items, width=8, least=0.6):
    """Best shift of each pair of document and item, over all shifts."""
    canonical, best = D.Canonical(), {}
    for item, text in items:
        old = text.split()
        w = min(width, len(old))
        t, s, raw = canonical.template(old)
        for doc, other in docs:
            new = other.split()
            t2, s2, raw2 = canonical.template(new)
            for shift in range(-len(old), len(new)):
                places = set()
                for a in range(len(old) - w + 1):
                    p = a + shift
                    if 0 <= p <= len(new) - w and all(t[a + i] == t2[p + i] for i in range(w)):
                        if s[a : a + w].all() and any(raw[a + i] != raw2[p + i] for i in range(w)):
                            continue
                        places |= set(range(a, a + w))
                pairs = {(a, old[a].strip(D.PUNCTUATION).lower(), new[a + shift].strip(D.PUNCTUATION).lower()) for a in places if s[a]}
                values = {p[1:] for p in pairs}
                if len(places) >= least * len(old) and len({v[0] for v in values}) == len(values) == len({v[1] for v in values}):
                    key = (len(places), -sum(x != y for _, x, y in pairs), -shift)
                    best[doc, item] = max(best.get((doc, item), key), key)
    return {k: (v[0], -v[1], -v[2]) for k, v in best.items()}


def test_all_diagonals(spark):
    import random

    rng = random.Random(4)
    words = lambda n, k: [rng.choice(["red", "Ann", "7", "8", "kg", "0", "blue", "cat"][:k]) for _ in range(n)]
    items = [(1, "0 " * 30), (2, "0 1 " * 15), (3, "x " * 20 + "y"), (4, "a b c d e f g h i j k " * 3), (5, "3 5 7 9 11 13 15 17 19 21"), (6, "a b c")]
    items += [(10 + i, " ".join(words(14, 8))) for i in range(6)]
    docs = [(1, "z " + "0 " * 40), (2, "q " + "0 1 " * 20), (3, "p " + "x " * 50), (4, "w a b c d e f g h i j k " + "a b c d e f g h i j k " * 2), (5, "so 3 5 7 9 11 13 15 17 19 21 ends"),
            (6, "so 4 6 8 9 11 13 15 17 19 21 ends"), (7, "a b c a b c")]
    docs += [(10 + i, " ".join(words(3, 8) + t.split() + words(5, 8))) for i, (_, t) in enumerate(items[6:])]
    got = {k: (r.covered, r.n_changed, r.position) for k, r in found(spark, docs, items).items()}
    want = plain(docs, items)
    assert set(got) == set(want) and {(i, i) for i in range(1, 6)} <= set(want) and (6, 5) not in want
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}


def test_number_lists(spark):
    import random

    rng = random.Random(2)
    listed = lambda n: " ".join(str(rng.randrange(10_000)) for _ in range(n))
    docs, items = [(i, listed(2000)) for i in range(50)], [(i, listed(100)) for i in range(20)]
    docs.append((99, f"{docs[0][1]} {items[7][1]}"))
    assert set(found(spark, docs, items)) == {(99, 7)}


def test_clean_goes_by_rows(spark):
    kind = "doc_id long, text string, row string, _leak int, `a.b` int"
    rows = [(None, f"{FILL}{ITEM}"), (7, f"{FILL}{ITEM}"), (7, "clean words"), (7, "clean words"), (None, None), (8, "")]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], kind)
    left = D.clean(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(rows[2:], key=str)


def test_words_beyond_the_cache(monkeypatch):
    """Hashes and flags stay those of the word when the arrays grow and when the cache starts anew."""
    monkeypatch.setattr(D, "KEPT_WORDS", 1500)
    canonical = D.Canonical()
    for start in (0, 900, 2500):
        words = [w for i in range(start, start + 2000) for w in (f"word{i}", "+5", "٣kg", "Rome.", "-x", "seven")]
        tokens, slots, literal = canonical.template(words)
        found = [D._word(w) for w in words]
        assert literal.tolist() == [h for h, _ in found]
        kinds = [f & 3 for _, f in found]
        assert kinds[:6] == [D.ORDINARY, D.NUM, D.MEAS, D.ORDINARY, D.ORDINARY, D.NUM]
        assert len(canonical.words) <= 1500 + 2005
        assert slots.sum() >= 3 * 2000
