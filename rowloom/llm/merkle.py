"""A Merkle manifest of a table: one tree of digests per language, one tree over the languages' roots.

Every row is a leaf. Within a language leaves have dense ranks by doc_id; the rank's digits to base
``ARITY`` are grouped away one after the other, each grouping nesting the structs of the one before. After
``DIGITS`` groupings a row holds one block, ``ARITY ** DIGITS`` leaves at most, and its digest is a leaf of
the next tier. Ways to the root run back down: every tier's blocks are exploded digit by digit, each child
with the digests beside it, so no proof is looked up by a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.session import materialize
from .common import crc_text, parts, ranked

ARITY = 8
#: Digits of one block: 512 leaves, some 100 KB.
DIGITS = 3

#: Columns that a leaf covers, in the order of their place in the digest.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<before:string,after:string>>"


def digest(*values: Column) -> Column:
    """Lowercase hex sha256 of text pieces, one after the other."""
    return F.sha2(F.concat(*values).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value; so no two rows give the same bytes."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: list[Column]) -> Column:
    return digest(*(field(x) for x in fields))


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(documents: DataFrame, tampered: Column) -> DataFrame:
    """lang, doc_id, hash (the leaf), other (the leaf of the tampered row, null where the row is left alone)."""
    own = [F.col(c) for c in FIELDS]
    changed = [lowered(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    return documents.select(
        "lang", "doc_id", leaf(own).alias("hash"), F.when(tampered, leaf(changed)).alias("other"),
    )


def _joined(run: Column) -> Column:
    return F.array_join(F.transform(run, lambda x: x["hash"]), "")


def _tier(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of a level (tree, n, rank, hash, any payload) to blocks: tree, n, rank, hash, run (nested structs)."""
    digit = [F.shiftright(F.col("rank"), 3 * i).bitwiseAND(F.lit(ARITY - 1)).cast("int") for i in range(DIGITS)]
    payload = [c for c in nodes.columns if c not in ("tree", "n", "rank")]
    rows = nodes.select(
        "tree", "n", F.shiftright("rank", 3 * DIGITS).alias("block"), *(d.alias(f"d{i}") for i, d in enumerate(digit)), *payload,
    ).repartition(parts(nodes.sparkSession), "tree", "block")
    kept = payload
    for i in range(DIGITS):
        outer = [f"d{j}" for j in range(DIGITS - 1, i, -1)]
        rows = rows.groupBy("tree", "n", "block", *outer).agg(F.sort_array(F.collect_list(F.struct(f"d{i}", *kept))).alias("run"))
        several = F.col("n") > ARITY ** (level + i)
        rows = rows.withColumn("hash", F.when(several, F.sha2(_joined(F.col("run")), 256)).otherwise(F.col("run")[0]["hash"]))
        kept = ["hash", "run"]
    return rows.withColumnRenamed("block", "rank")


@dataclass
class Tree:
    """The tiers of one or several trees, lowest first, and the trees' roots (tree, hash)."""

    tiers: list[DataFrame]
    roots: DataFrame


def climb(nodes: DataFrame) -> Tree:
    """Roll ranked leaves up to one root per tree."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    tiers: list[DataFrame] = []
    while not tiers or largest > ARITY ** (DIGITS * len(tiers)):
        blocks = _tier(nodes, DIGITS * len(tiers))
        tiers.append(materialize(blocks, "merkle-tier"))
        nodes = tiers[-1].drop("run")
    return Tree(tiers, nodes.select("tree", "hash"))


def _beside(level: int) -> Column:
    """Children of ``run``, each with what stands before and after it; a level that the tree lacks adds no step."""
    def child(x: Column, i: Column) -> Column:
        run = F.col("run")
        step = F.struct(
            _joined(F.slice(run, F.lit(1), i)).alias("before"),
            _joined(F.slice(run, i + 2, F.lit(ARITY))).alias("after"),
        )
        way = F.when(F.col("n") > ARITY ** level, F.array(step)).otherwise(F.array().cast(_PATH))
        return F.struct(x.alias("x"), F.concat(way, F.col("path")).alias("path"))

    return F.transform("run", child)


def descend(tree: Tree, above: DataFrame, carried: list[str]) -> DataFrame:
    """Every leaf's payload with ``path``: the digests beside the way to the root, lowest level first.

    ``above`` has one row per tree: tree, path (what comes above its root) and the columns ``carried``. A
    tier's blocks and the ways above them meet by one grouping: two rows per block.
    """
    ways = above.withColumn("rank", F.lit(0).cast("long"))
    for t in range(len(tree.tiers) - 1, -1, -1):
        blocks = tree.tiers[t].select("tree", "rank", "n", "run")
        both = blocks.unionByName(ways.select("tree", "rank", "path", *carried), allowMissingColumns=True)
        rows = both.groupBy("tree", "rank").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("n", "run", "path", *carried)))
        for i in range(DIGITS - 1, -1, -1):
            rows = rows.withColumn("_child", F.explode(_beside(DIGITS * t + i))).withColumns({
                "rank": F.col("rank") * ARITY + F.col(f"_child.x.d{i}"), "path": F.col("_child.path"),
            })
            rows = rows.withColumn("run", F.col("_child.x.run")) if i else rows
        ways = rows
    payload = [F.col(f"_child.x.{c}").alias(c) for c in ways.schema["_child"].dataType["x"].dataType.names if c != "d0"]
    return ways.select("tree", "path", *carried, *payload)


def manifest(documents: DataFrame, tampered: Column) -> DataFrame:
    """Leaf, subroot, root, proof and check of every row.

    Returns doc_id, leaf, subroot, root, proof_sha256 (of the siblings on the way to the root), folded_root
    (the root recomputed from the leaf, or where ``tampered`` holds from the leaf of the row with its text's
    A-Z lower-cased, and the siblings) and verified.

    Nulls are fields of their own kind. A null lang is a tree of its own and comes first, null doc_ids come
    first in their tree, rows of the same doc_id are ordered by their leaf, and equal rows are all leaves.
    Of an empty table there is no tree. Columns beside those of ``FIELDS`` are not read.
    """
    found = materialize(leaves(documents, tampered), "leaves")  # read by the range sampling and by the sort
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash").asc()]
    own = climb(ranked(found, F.col("lang"), order).drop("lang"))
    top_leaves = own.roots.select(F.col("tree").alias("lang"), "hash")
    top = climb(ranked(top_leaves, F.lit(0), [F.col("lang").asc_nulls_first()]))

    roots = top.roots.select("tree", F.array().cast(_PATH).alias("path"), F.col("hash").alias("root"))
    languages = descend(top, roots, ["root"]).select(F.col("lang").alias("tree"), "path", F.col("hash").alias("subroot"), "root")
    rows = descend(own, languages, ["subroot", "root"])
    folded = F.aggregate("path", F.coalesce("other", "hash"), lambda h, p: F.sha2(F.concat(p["before"], h, p["after"]), 256))
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), "")
    rows = rows.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def third(key: Column) -> Column:
    """Rows that the query tampers with: the checksum of their doc_id is divisible by 3 (a null one's is 0)."""
    return crc_text(key) % 3 == 0


def _crc32_sql(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_filter({codes}, lambda x: x > 0)), "
        "lambda c, b: xor(c >> 8, crc_table[1 + (xor(c, b) & 255)])), 4294967295::BIGINT)"
    )


def sql(levels: int = 8) -> str:
    """The same rows in SQL, level by level, for up to 8 ** levels rows of a language.

    doc_ids are taken to differ, as they do in the given table.
    """
    def piece(value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def leaf_sql(text: str) -> str:
        return "sha256(" + " || ".join(piece(text if c == "text" else c) for c in FIELDS) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        "crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
        "lambda c, x: xor(c >> 1, (c & 1) * 3988292384::BIGINT))) AS crc_table)",
        f"leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf_sql('text')} AS hash, "
        f"CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN {leaf_sql(lower)} ELSE {leaf_sql('text')} END AS other FROM documents CROSS JOIN crc)",
        "own AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS pos, "
        "count(*) OVER (PARTITION BY tree) AS n FROM leaves)",
    ]

    def rise(name: str, source: str, tree: str) -> None:
        steps.append(f"{name}0 AS (SELECT {tree} AS tree, pos, n, hash FROM {source})")
        for k in range(levels):
            steps.append(
                f"{name}r{k} AS (SELECT tree, pos // 8 AS up, any_value(n) AS n, list(hash ORDER BY pos) AS run FROM {name}{k} GROUP BY tree, pos // 8)"
            )
            steps.append(
                f"{name}{k + 1} AS (SELECT tree, up AS pos, n, CASE WHEN n > {8 ** k} THEN sha256(array_to_string(run, '')) ELSE run[1] END AS hash FROM {name}r{k})"
            )

    def fall(name: str, place: str) -> str:
        """The ways of all leaves of a tree: tree, pos, and lists of what stands before and after."""
        runs = " ".join(f"JOIN {name}r{k} AS r{k} ON r{k}.tree = a.tree AND r{k}.up = a.pos // {8 ** (k + 1)}" for k in range(levels))
        ways = ", ".join(
            f"CASE WHEN a.n > {8 ** k} THEN {{'b': array_to_string(r{k}.run[1:(a.pos // {8 ** k}) % 8], ''), "
            f"'a': array_to_string(r{k}.run[(a.pos // {8 ** k}) % 8 + 2:], '')}} END" for k in range(levels)
        )
        return f"{place} AS (SELECT a.tree, a.pos, list_filter([{ways}], lambda x: x IS NOT NULL) AS way FROM {name}0 AS a {runs})"

    rise("l", "own", "tree")
    top = f"l{levels}"
    steps.append(f"subroots AS (SELECT tree AS name, hash, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM {top} WHERE pos = 0)")
    rise("t", "subroots", "0")
    steps += [fall("l", "lways"), fall("t", "tways")]
    steps.append(
        "whole AS (SELECT o.doc_id, o.hash AS leaf, o.other, s.hash AS subroot, r.hash AS root, list_concat(lw.way, tw.way) AS way "
        "FROM own AS o JOIN subroots AS s ON s.name = o.tree JOIN lways AS lw ON lw.tree = o.tree AND lw.pos = o.pos "
        f"JOIN tways AS tw ON tw.pos = s.pos CROSS JOIN (SELECT hash FROM t{levels}) AS r)"
    )
    folded = "other"
    steps.append(f"f0 AS (SELECT *, {folded} AS h FROM whole)")
    for k in range(2 * levels):
        steps.append(
            f"f{k + 1} AS (SELECT * EXCLUDE (h), CASE WHEN len(way) > {k} THEN sha256(way[{k + 1}].b || h || way[{k + 1}].a) ELSE h END AS h FROM f{k})"
        )
    return "WITH " + ",\n".join(steps) + (
        "\nSELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(way, lambda w: w.b || w.a), '')) AS proof_sha256, "
        f"h AS folded_root, h = root AS verified FROM f{2 * levels}"
    )
