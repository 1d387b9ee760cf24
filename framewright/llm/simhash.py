"""SimHash near duplicates with covering locality-sensitive hashing.

Every bit of a 64-bit fingerprint is given a non-zero vector of ``radius + 1`` bits. A mask
``a_v``, for a non-zero vector v, keeps the bits whose vector has an odd product with v.
At most ``radius`` differing bits have vectors that do not span the whole space, so some v is
orthogonal to all of them: under its mask both fingerprints are equal. The ``2**(radius+1) - 1``
masks are the tables, and every pair within the radius collides in at least one.

Distinct fingerprints are the nodes, so exact copies cost one aggregation. A bucket is compared
in memory and gives a spanning forest of its links, never all pairs. A bucket of more than
about ``most`` nodes is cut into runs, and every two runs are compared in a block of their own,
so that no task holds such a bucket and no link is lost. Full buckets are foreseen from a
sample of the nodes; the sample decides only where the work is done.

``drop_near_duplicates`` keeps one document of each component.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.llm.texts import slices, words_of
from framewright.session import stage

_BIT_OF = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def _vectors(radius: int) -> list[int]:
    """A vector of radius + 1 bits for each of the 64 bits, so that masks keep about half of them.

    Up to 63 values are dealt out in turn. For more, the vectors are the 6 digits of the bit's
    number, a one and a bent function of the digits, for which masks keep 28 to 36 bits, or all.
    """
    if radius < 6:
        return [1 + i % (2 ** (radius + 1) - 1) for i in range(64)]
    if radius > 7:
        raise ValueError("masks are made for a radius of at most 7")
    digits = [[i >> d & 1 for d in range(6)] for i in range(64)]
    bent = [x[0] & x[1] ^ x[2] & x[3] ^ x[4] & x[5] for x in digits]
    return [i | 64 | (bent[i] << 7 if radius == 7 else 0) for i in range(64)]


def masks(radius: int) -> list[int]:
    """The covering masks over 64 bits, as signed 64-bit numbers."""
    vectors = _vectors(radius)
    kept = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]
    return [m - (1 << 64) if m >> 63 else m for m in sorted(set(kept))]


def _fingerprints(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = words_of(texts, encode=False)
    count = np.diff(words.of_text)
    lengths = words.ends - words.starts
    before = np.concatenate([[0], np.cumsum(lengths)])
    solid = np.zeros(len(words.data) + 1, np.int8)
    solid[words.starts] = 1
    solid[words.ends] -= 1
    packed = words.data[np.cumsum(solid[:-1], dtype=np.int8).astype(bool)]
    joined = memoryview(np.insert(packed, before[1:], 32).tobytes())
    begin = before[:-1] + np.arange(len(lengths))
    end = begin + lengths
    shingles = np.where(count, np.maximum(1, count - size + 1), 0)
    prints = np.zeros(len(texts), np.uint64)
    column = (np.arange(8) * 256).astype(np.int16)
    for doc in np.flatnonzero(shingles):
        first, n = words.of_text[doc], int(shingles[doc])
        a = begin[first : first + n].tolist()
        b = end[first + min(size, count[doc]) - 1 : first + count[doc]].tolist()
        hashes = np.fromiter((digest(joined[i:j], 42) for i, j in zip(a, b)), np.uint64, n)
        seen = np.bincount((hashes.view(np.uint8).reshape(n, 8) + column).ravel(), minlength=2048).reshape(8, 256)
        ones = (seen @ _BIT_OF).ravel()
        prints[doc] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
    return prints, shingles


def fingerprints(docs: DataFrame, *, shingle: int, text: str = "text") -> DataFrame:
    """All rows and columns, with ``fingerprint`` (64 bits as a signed number) and ``n_shingles``.

    Shingles are ``shingle`` words joined by blanks, repeats included; a text of fewer words is
    one shingle; a text without words, or null, has fingerprint 0. A bit is 1 if it is set in
    over half of the shingles' XXH64 (seed 42). Columns of these two names are replaced.
    """
    docs = docs.drop("fingerprint", "n_shingles")
    schema = T.StructType(docs.schema.fields + [T.StructField("fingerprint", T.LongType()), T.StructField("n_shingles", T.LongType())])

    def run(batches):
        for part in slices(batches, text):
            prints, shingles = _fingerprints(part.column(text), shingle)
            yield pa.RecordBatch.from_arrays(part.columns + [pa.array(prints.view(np.int64)), pa.array(shingles)], names=schema.names)

    return docs.mapInArrow(run, schema)


def spanning(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each node's component, for links a-b between nodes below size."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _near(group: np.ndarray, prints: np.ndarray, sizes: np.ndarray, radius: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of one group; rows are ordered by group. Step k compares each row
    with the k-th after it, for all groups at once."""
    left, right = [], []
    at, step = np.arange(len(group)), 1
    while True:
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        near = np.bitwise_count(prints[at] ^ prints[at + step]) <= radius
        if ratio:
            low, high = np.minimum(sizes[at], sizes[at + step]), np.maximum(sizes[at], sizes[at + step])
            # one changed word alters several shingles: short texts must agree in every bit
            short = low * (1 - ratio) < 2
            near &= (low >= ratio * high) & (~short | ((prints[at] == prints[at + step]) & (low == high)))
        left.append(at[near])
        right.append(at[near] + step)
        step += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def links(nodes: DataFrame, *, radius: int, ratio: float = 0.0, most: int = 2048) -> DataFrame:
    """``a, b``: links that connect all nodes within the radius, directly or through others.

    ``nodes`` has node (unique), fingerprint and n_shingles. With ``ratio``, linked nodes' numbers
    of shingles differ by no more than that ratio too.
    """
    tables = F.explode(F.array(*map(F.lit, masks(radius)))).alias("mask")
    rows = nodes.select("node", "fingerprint", "n_shingles", tables)
    rows = rows.withColumn("key", F.col("fingerprint").bitwiseAND(F.col("mask")))
    rate = 16
    sample = rows.where(F.pmod(F.xxhash64("node"), F.lit(rate)) == 0).groupBy("mask", "key").agg((F.count("*") * rate).alias("n"))
    full = stage(sample.where(F.col("n") * 2 > most).select("mask", "key", F.ceil(F.col("n") * 3 / most).alias("runs")), "full")
    block = F.lit(0).cast("long")
    if not full.isEmpty():
        rows = rows.join(full, ["mask", "key"], "left").withColumn("runs", F.coalesce("runs", F.lit(1)))
        mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col("runs"))
        rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("runs") - 1)))
        block = F.least("mine", "other") * F.col("runs") + F.greatest("mine", "other")
    rows = rows.select("node", "fingerprint", "n_shingles", "mask", "key", block.alias("block"))
    dealt = rows.repartition("mask", "key", "block").sortWithinPartitions("mask", "key", "block")
    return dealt.mapInArrow(_compare(radius, ratio), "a long, b long").distinct()


def _compare(radius: int, ratio: float, at_once: int = 200_000):
    """A spanning forest of the links in each bucket, or in each two runs of a full one."""

    def forest(node, prints, sizes, new):
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        node, group = node[several], group[several]
        a, b = _near(group, prints[several].view(np.uint64), sizes[several], radius, ratio)
        ids, place = np.unique(np.concatenate([node[a], node[b]]), return_inverse=True)
        root = spanning(len(ids), place[: len(a)], place[len(a) :])
        inner = np.flatnonzero(root != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[inner]), pa.array(ids[root[inner]])], names=["a", "b"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += batch.num_rows
            if rows < at_once:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            new = _new(columns)
            cut = int(np.flatnonzero(new)[-1])
            if cut:
                yield forest(*(c[:cut] for c in columns[:3]), new[:cut])
            held, rows = [[c[cut:] for c in columns]], len(new) - cut
        if rows:
            columns = [np.concatenate(c) for c in zip(*held)]
            yield forest(*columns[:3], _new(columns))

    return run


def _new(columns) -> np.ndarray:
    """Marks the first row of each bucket."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for column in columns[3:]:
        new[1:] |= column[1:] != column[:-1]
    return new


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of some edge ``a, b``; root is the smallest node reachable.

    Rounds of large star (larger neighbours go to the smallest neighbour) and small star
    (smaller neighbours too) until nothing changes. The smallest neighbour is an aggregate that
    is joined back, so a hub's neighbours are never gathered.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = stage(edges.where("a <> b").select(low.alias("b"), high.alias("a")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = stage(small.where("a <> b").distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def groups(prints: DataFrame, *, radius: int, ratio: float = 0.0, key: str = "doc_id", most: int = 2048) -> DataFrame:
    """``fingerprint, n_shingles, node, group, first``: one row per distinct node.

    ``prints`` has key, fingerprint and n_shingles. Without ``ratio`` texts of one fingerprint are
    one node whatever their length. ``group`` names the component, ``first`` is the smallest key
    in it; null if all its keys are.
    """
    sizes = F.col("n_shingles") if ratio else F.lit(0).cast("long")
    node = _node(ratio)
    nodes = prints.withColumn("n_shingles", sizes).groupBy("fingerprint", "n_shingles").agg(F.min(key).alias("own"))
    nodes = stage(nodes.withColumn("node", node), "nodes")
    roots = components(links(nodes, radius=radius, ratio=ratio, most=most))
    named = nodes.join(roots, "node", "left").withColumn("group", F.coalesce("root", "node"))
    first = named.groupBy("group").agg(F.min("own").alias("first"))
    return named.join(first, "group").select("fingerprint", "n_shingles", "node", "group", "first")


def _node(ratio: float) -> Column:
    return F.xxhash64("fingerprint", "n_shingles") if ratio else F.col("fingerprint")


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 3, key: str = "doc_id", text: str = "text", most: int = 2048) -> DataFrame:
    """``key, fingerprint, component_id`` (fingerprint: signed 64 bits), one row per document.

    component_id is the smallest key reachable over fingerprints that differ in at most
    ``radius`` bits, itself included. Null texts and texts without words have fingerprint 0 and
    are linked like others; null keys are kept and never the smallest; repeated rows and equal
    keys are documents of their own; other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    prints = stage(fingerprints(rows, shingle=shingle).drop("text"), "fingerprints")
    named = groups(prints, radius=radius, key="key", most=most).select("fingerprint", "first")
    return prints.join(named, "fingerprint").select(F.col("key").alias(key), "fingerprint", F.col("first").alias("component_id"))


def drop_near_duplicates(
    docs: DataFrame, *, shingle: int = 3, radius: int = 3, key: str = "doc_id", text: str = "text", most: int = 2048
) -> DataFrame:
    """The documents, one of each component of ``near_duplicates``: that of the smallest key.

    Columns and their order stay. Null keys come after all others; of rows equal in key and text
    one stays; texts without words, and null texts, form one group. A row is named by two 64-bit
    hashes of its key and text, so that texts are not copied while components are worked out.
    """
    names = docs.columns
    clear = {n: f"own_{i}" for i, n in enumerate(names)}
    rows = docs.select(*[F.col(n).alias(m) for n, m in clear.items()])
    own, content = F.col(clear[key]), F.col(clear[text]).cast("string")
    named = {"id_a": F.xxhash64(own, content), "id_b": F.xxhash64(content, F.lit(7), own)}
    prints = fingerprints(rows.select(own.alias("key"), content.alias("text"), *[v.alias(k) for k, v in named.items()]), shingle=shingle)
    prints = stage(prints.drop("text").groupBy("key", "id_a", "id_b", "fingerprint", "n_shingles").agg(F.count("*").alias("n")), "fingerprints")
    group = groups(prints, radius=radius, key="key", most=most).select("fingerprint", "group")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "id_a", "id_b", "n")
    best = prints.groupBy("fingerprint").agg(F.min(order).alias("best")).join(group, "fingerprint").groupBy("group").agg(F.min("best").alias("best"))
    kept = stage(best.select("best.id_a", "best.id_b", "best.n"), "kept")
    rows = rows.withColumns(named)
    found = rows.join(kept.where("n = 1"), ["id_a", "id_b"], "left_semi").select(*clear.values())
    again = kept.where("n > 1")
    if not again.isEmpty():
        one = rows.join(again, ["id_a", "id_b"], "left_semi").groupBy("id_a", "id_b").agg(F.any_value(F.struct(*clear.values())).alias("x"))
        found = found.unionByName(one.select("x.*"))
    return found.select(*[F.col(m).alias(n) for n, m in clear.items()])
