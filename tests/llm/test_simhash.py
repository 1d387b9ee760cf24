"""Covering masks, links and components against all pairs."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from framewright.llm import simhash
from tests.llm.cases import empty_documents, odd_documents


@pytest.mark.parametrize("radius", [1, 2, 3, 5, 6, 7])
def test_masks_cover(radius):
    rng = random.Random(radius)
    kept = [m & (1 << 64) - 1 for m in simhash.masks(radius)]
    assert len(kept) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        bits = sum(1 << i for i in rng.sample(range(64), radius))
        assert any(not m & bits for m in kept)


def plain_print(text, size):
    for c in range(65, 91):
        text = (text or "").replace(chr(c), chr(c + 32))
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def test_fingerprints(spark):
    rows = odd_documents(spark).collect()
    prints, _ = simhash._fingerprints(pa.array([r.text for r in rows]), 3)
    assert prints.tolist() == [plain_print(r.text, 3) for r in rows]


def plain_components(prints, radius):
    n = len(prints)
    values = np.array(prints, np.uint64)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[:i]) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("radius,most", [(3, 2048), (3, 64), (7, 64)])
def test_links_against_all_pairs(spark, radius, most):
    """Dense clusters, so that full buckets are cut into runs."""
    rng = random.Random(radius)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        few = rng.sample(range(64), 14)
        for _ in range(40):
            prints.add(centre ^ sum(1 << b for b in rng.sample(few, rng.randint(0, 6))))
    prints = sorted(prints | {rng.getrandbits(64) for _ in range(100)} | {0})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p, p, 0) for p in signed], "node long, fingerprint long, n_shingles long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(nodes, radius=radius, most=most)).collect()}
    want = plain_components(prints, radius)
    mine, theirs = defaultdict(set), defaultdict(set)
    for p, w in zip(signed, want):
        mine[roots.get(p, p)].add(p)
        theirs[w].add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_near_duplicates(spark):
    docs = odd_documents(spark)
    rows = docs.collect()
    prints = [plain_print(r.text, 3) for r in rows]
    root = plain_components(prints, 3)
    first = defaultdict(list)
    for r, c in zip(rows, root):
        first[c] += [r.doc_id] if r.doc_id is not None else []
    want = sorted(str((r.doc_id, p - (1 << 64) if p >> 63 else p, min(first[c], default=None))) for r, p, c in zip(rows, prints, root))
    got = simhash.near_duplicates(docs).collect()
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_drop_near_duplicates(spark):
    """One row of each component stays, against fingerprints compared in pairs."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(800)]
    near = list(base)
    near[400] = "changed"
    other = [rng.choice(words) for _ in range(800)]
    texts = [base, base, near, other, base[:3], other[:3], base[:300]]
    rows = [(i, " ".join(t), 1) for i, t in enumerate(texts)] + [(7, None, 1), (8, "", 2), (3, " ".join(other), 3), (None, " ".join(other), 4)]
    rows += [(9, "only here once", 1), (9, "only here once", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint long")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    prints = [plain_print(t, 3) for _, t, _ in rows]
    want = defaultdict(list)
    for (i, _, _), c in zip(rows, plain_components(prints, 3)):
        want[c].append((i is None, i or 0))
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert got == sorted(min(v) for v in want.values()) and len(got) == 7
    docs = odd_documents(spark)
    assert simhash.drop_near_duplicates(docs).columns == docs.columns
    assert simhash.drop_near_duplicates(empty_documents(spark)).count() == 0


def test_clashing_columns(spark):
    docs = odd_documents(spark).withColumns({"fingerprint": F.lit("x"), "n_shingles": F.lit("y")})
    assert simhash.fingerprints(docs, shingle=3).columns == docs.columns
    assert simhash.near_duplicates(docs).count() == docs.count()
