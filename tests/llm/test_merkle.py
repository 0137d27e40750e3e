"""Every proof against a tree built plainly in memory."""

import hashlib
import zlib

import pytest

from termloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, i):
    for nodes in tree[:-1]:
        run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
        yield "".join(run[: i % 8]), "".join(run[i % 8 + 1 :])
        i //= 8


def small(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def plain(rows):
    """Sorted rows of ``merkle.documents``."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for i, (_, _, own, row) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = [*path(trees[g], i), *path(top, at)]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None
            up = leaf((*row[:4], small(row[4]))) if hit else own
            for left, right in steps:
                up = sha(left + up + right)
            out.append((row[0], own, trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), up, up == top[-1][0]))
    return sorted(out, key=str)


def got(docs):
    return sorted(map(tuple, merkle.documents(docs).collect()), key=str)


LANGS = [None, "", "en", "en", "en", "en", "é", "zz"]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 700])
def test_documents(spark, n):
    rows = [(i * 3 - 5, f"s{i}", LANGS[i % 8] if i % 5 else "en", i if i % 4 else None, f"Text É {i}" if i % 6 else None) for i in range(n)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_more_tiers(spark):
    rows = [(i, None, "en" if i % 9 else "de", None, str(i)) for i in range(5000)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_many_groups(spark):
    rows = [(i, None, f"lang {i % 600}", 1, "A") for i in range(1300)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_ties_repeats_and_nulls(spark):
    rows = [(7, "a", "en", 1, "X")] * 700 + [(7, "b", "en", 1, "X"), (None, None, None, None, None), (None, "b", "en", 2, ""), (3, "a", "en", 100_000, "AB" * 50_000)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_no_rows_and_extra_columns(spark):
    rows = [(1, "a", "en", 1, "X"), (2, "a", "de", 1, "Y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert merkle.documents(docs.limit(0)).collect() == []
    for name in ("grp", "hash", "item", "pos", "_tie", "a.b", "leaf", "root"):
        docs = docs.selectExpr("*", f"1 as `{name}`")
    assert got(docs) == plain(rows)


def test_general_interface(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "k int, body string")
    found = merkle.manifest(docs.selectExpr("*", "'x' as part"), ("k", "body"), "k", "part")
    assert [c for c in found.columns] == ["k", "leaf", "changed_leaf", "subroot", "root", "steps"]
    rows = found.withColumn("up", merkle.folded_up(found.leaf, found.steps)).collect()
    assert len(rows) == 20 and all(r.up == r.root == r.subroot and r.changed_leaf is None for r in rows)
