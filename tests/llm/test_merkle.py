"""Merkle manifests against a tree built row by row."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import oracle
from rowloom.llm import merkle, queries

DDL = "doc_id long, text string, lang string, source string, n_chars long, hash string, tree long"


def sha(*values) -> str:
    return hashlib.sha256("".join(values).encode()).hexdigest()


def leaf(row, text) -> str:
    values = (row[0], row[3], row[2], row[4], text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def build(hashes):
    """(root, ways): for every leaf the (before, after) of each level."""
    ways, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for way, p in zip(ways, at):
            start = p - p % 8
            way.append(("".join(level[start:p]), "".join(level[p + 1:start + 8])))
        at = [p // 8 for p in at]
        level = [sha(*level[i:i + 8]) for i in range(0, len(level), 8)]
    return level[0], ways


def expected(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0], leaf(r, r[1]), r))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = []
    for name in names:
        members = sorted(trees[name], key=lambda x: (x[0], x[1] or 0, x[2]))
        built.append((members, *build([m[2] for m in members])))
    root, above = build([b[1] for b in built])
    for (members, subroot, ways), up in zip(built, above):
        for (_, key, own, row), way in zip(members, ways):
            text = row[1]
            if zlib.crc32(str(key if key is not None else "").encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(row, text)
            for before, after in way + up:
                folded = sha(before, folded, after)
            yield key, own, subroot, root, sha(*(b + a for b, a in way + up)), folded, folded == root


def made(n, langs):
    texts = ["Some Text ÄÖ", "lower only", "", None, "A" * 40_000]
    return [
        (i * 3, f"{texts[i % 5] or ''}{i}" if i % 7 and texts[i % 5] else texts[i % 5], langs[i * i % len(langs)], f"s{i % 3}" if i % 4 else None, i if i % 6 else None, "x", i)
        for i in range(n)
    ]


@pytest.mark.parametrize("rows", [
    made(1, ["en"]), made(2, ["en", "de"]), made(9, [None]), made(1300, ["en"]), made(700, ["de", "en", None, "", "é"]),
    made(620, [f"l{i}" for i in range(600)]),
    made(40, ["en", None]) + made(40, ["en", None])[:9] + [(None, "No Id", "en", None, None, None, None)] * 3 + [(6, "Again", "en", "s", 1, None, None)],
])
def test_manifest_equals_a_tree_built_by_hand(spark, rows):
    table = spark.createDataFrame(rows, DDL).repartition(3)
    got = merkle.manifest(table, merkle.third(F.col("doc_id"))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected(rows), key=repr)


def test_only_changed_rows_fail(spark):
    rows = made(80, ["en", "de"])
    got = merkle.manifest(spark.createDataFrame(rows, DDL), merkle.third(F.col("doc_id"))).collect()
    changed = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 0 and (r[1] or "").lower() != (r[1] or "")}
    assert changed and {r.doc_id for r in got if not r.verified} == changed


def test_nothing(spark):
    assert merkle.manifest(spark.createDataFrame([], DDL), merkle.third(F.col("doc_id"))).collect() == []


def test_query_equals_its_sql(spark, folder):
    rows, problems = oracle.compare(queries.QUERIES["op11_merkle"](spark, folder), oracle.connect(folder), queries.SQL["op11_merkle"])
    assert rows and not problems
