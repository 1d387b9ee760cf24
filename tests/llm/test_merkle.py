"""Trees and proofs against a direct computation."""

from __future__ import annotations

from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from framewright.llm import merkle
from tests.llm.cases import empty_documents, odd_documents

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def plain_tree(nodes):
    """The last node, and for each first node what flanks its ancestors."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            other = nodes[p ^ 1] if p ^ 1 < len(nodes) else ""
            paths[i].append((other, "") if p & 1 else ("", other))
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        place = [p // 2 for p in place]
    return nodes[0], paths


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.lang].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        own = sorted(groups[g], key=lambda r: (r.doc_id is not None, r.doc_id or 0, plain_leaf(r)))
        trees[g] = own, *plain_tree([plain_leaf(r) for r in own])
    root, high = plain_tree([trees[g][1] for g in order])
    return [
        (r.doc_id, g, i, plain_leaf(r), [*trees[g][2][i], *path], trees[g][1], root)
        for g, path in zip(order, high)
        for i, r in enumerate(trees[g][0])
    ]


def told(r):
    return (r.doc_id, r.lang, r.position, r.leaf, [tuple(s) for s in r.path], r.subroot, r.root)


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_manifest(spark, monkeypatch, bits):
    """Blocks of two, four and 256 rows; a group of one row, a null group, repeated rows."""
    monkeypatch.setattr(merkle, "BITS", bits)
    langs = F.array(F.lit("en"), F.lit("de"), F.lit("é"), F.lit(""), F.lit(None))
    docs = odd_documents(spark).withColumn("lang", F.when(F.col("doc_id") == 17, "one").otherwise(F.get(langs, F.pmod("doc_id", F.lit(7)))))
    want = plain_manifest(docs.collect())
    got = merkle.manifest(docs, fields=FIELDS)
    assert sorted(map(str, map(told, got.collect()))) == sorted(map(str, want))
    assert got.where(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()


def test_rounds(spark, monkeypatch):
    """A large group over several rounds of blocks."""
    monkeypatch.setattr(merkle, "BITS", 3)
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 10 < 8, "hot").otherwise(F.col("id").cast("string")).alias("lang"), F.lit(1).alias("n_chars"), F.lit("t").alias("text")
    )
    want = plain_manifest(docs.collect())
    assert sorted(map(str, map(told, merkle.manifest(docs, fields=FIELDS).collect()))) == sorted(map(str, want))


def test_empty_and_single(spark):
    assert merkle.manifest(empty_documents(spark), fields=FIELDS).count() == 0
    row = merkle.manifest(odd_documents(spark).limit(1), fields=FIELDS).first()
    assert row.root == row.subroot == row.leaf and row.path == []


def test_clashing_columns(spark):
    clash = {n: F.lit("x") for n in ("name", "key", "node", "position", "total", "range", "row", "block", "path", "root", "also")}
    docs = odd_documents(spark)
    got = merkle.manifest(docs.withColumns(clash), fields=FIELDS)
    assert sorted(map(str, got.collect())) == sorted(map(str, merkle.manifest(docs, fields=FIELDS).collect()))
