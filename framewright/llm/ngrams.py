"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Words are named by their place among the sorted XXH64 hashes of all training words, pairs of
words by a one-to-one mixing of both places into 64 bits. The model is a folder of arrays that
every worker can open: sorted word hashes with counts, and sorted pair names with counts, both
cut at ranges of the hash so that no array grows with a frequent word. Workers map them into
memory and look up each distinct word and pair of a slice once.

Counting runs in three shuffles: words; pairs, packed per task and range and already summed
there, so that a frequent word or pair sends one number per task; and, from the summed pairs,
what each word needs as a context and as a continuation. Tasks write their arrays under another
name and rename them, so a task that is lost or runs twice leaves one whole file.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.llm.texts import slices, words_of
from framewright.session import scratch_path

END = np.uint64(1)  # the name of the end of a text among word hashes
BEGIN = np.uint64((1 << 32) - 1)  # the context of a text's first word
UNKNOWN = np.uint64((1 << 32) - 2)
_PAIRS_AT_ONCE = 4_000_000


def mix(pair: np.ndarray) -> np.ndarray:
    """A one-to-one map of 64-bit numbers that spreads them evenly."""
    x = pair ^ pair >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """A whole file or none, whichever attempt of a task ends first."""
    path = os.path.join(folder, name)
    part = f"{path}.{TaskContext.get().taskAttemptId()}"
    with open(part, "wb") as out:
        np.save(out, array)
    os.replace(part, path)


def open_folder(path: str) -> str:
    """The folder as a local path; workers map files, so it must be a mounted one."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"{path} cannot be mapped into memory; name a folder that is mounted on every worker")
    return parsed.path


class Model:
    """The arrays of a folder. ``bits`` is the number of leading hash bits that name a range."""

    def __init__(self, folder: str):
        with open(os.path.join(folder, "model.json")) as f:
            about = json.load(f)
        self.bits, self.pair_bits = about["bits"], about["pair_bits"]
        self.first = np.array(about["first"], np.int64)
        self.tokens, self.distinct, self.discounts, self.low = about["tokens"], about["distinct"], about["discounts"], about["low"]
        self.folder, self.maps = folder, {}

    def array(self, name: str) -> np.ndarray:
        if name not in self.maps:
            path = os.path.join(self.folder, f"{name}.npy")
            self.maps[name] = np.load(path, mmap_mode="r") if os.path.getsize(path) > 200 else np.load(path)
        return self.maps[name]

    def _ranges(self, keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
        """The ranges that sorted keys fall into."""
        bounds = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        for part in np.flatnonzero(np.diff(bounds)).tolist():
            yield part, slice(bounds[part], bounds[part + 1])

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The places of words; UNKNOWN for others."""
        order = np.argsort(hashes, kind="stable")
        keys = hashes[order]
        out = np.full(len(keys), UNKNOWN, np.uint64)
        for part, own in self._ranges(keys, self.bits):
            words = self.array(f"words-{part}")
            if len(words):
                at = np.minimum(np.searchsorted(words, keys[own]), len(words) - 1)
                out[own] = np.where(words[at] == keys[own], (self.first[part] + at).astype(np.uint64), UNKNOWN)
        found = np.empty_like(out)
        found[order] = out
        return found

    def of_words(self, name: str, places: np.ndarray) -> np.ndarray:
        """Values of words by place, 0 for unknown ones; rows of several values are kept."""
        part = np.searchsorted(self.first, places.astype(np.int64), side="right") - 1
        part[places >= UNKNOWN] = -1
        wide = (6,) if name == "stats" else ()
        out = np.zeros((len(places), *wide), np.int64)
        for p in np.unique(part[part >= 0]).tolist():
            mine = part == p
            out[mine] = self.array(f"{name}-{p}")[places[mine].astype(np.int64) - self.first[p]]
        return out

    def pair_counts(self, pairs: np.ndarray) -> np.ndarray:
        names = mix(pairs)
        order = np.argsort(names)
        keys = names[order]
        out = np.zeros(len(keys), np.int64)
        for part, own in self._ranges(keys, self.pair_bits):
            known = self.array(f"pairs-{part}")
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[own]), len(known) - 1)
                out[own] = np.where(known[at] == keys[own], self.array(f"counts-{part}")[at], 0)
        found = np.empty_like(out)
        found[order] = out
        return found

    def score(self, words, rows: int) -> dict[str, np.ndarray]:
        """Per text: n_tokens, n_known, base_score, score."""
        of_distinct = self.places(words.hashes())
        count = np.diff(words.of_text)
        ends = np.cumsum(count + 1) - 1
        place = np.insert(of_distinct[words.codes], words.of_text[1:], self.places(np.array([END]))[0])
        before = np.empty_like(place)
        before[1:] = place[:-1]
        before[np.concatenate([[0], ends[:-1] + 1]) if rows else []] = BEGIN
        distinct, code = np.unique(place, return_inverse=True)
        seen = self.of_words("unigrams", distinct)
        stats = self.of_words("stats", distinct)
        base = np.log10((seen + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))
        # continuation level, interpolated with a share for each word and one for all unknown
        d = np.array([0.0, *self.low["discounts"]])
        cc = stats[:, 5]
        low = (np.maximum(cc - d[np.minimum(cc, 3)], 0) + self.low["mass"] / (self.distinct + 1)) / max(self.low["total"], 1)
        if not self.low["total"]:
            low = np.full(len(distinct), 1 / (self.distinct + 1))
        pairs, pair_code = np.unique(before << np.uint64(32) | place, return_inverse=True)
        n = self.pair_counts(pairs)
        context, after = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
        own = np.zeros((len(pairs), 6), np.int64)
        own[context == BEGIN] = self.begin
        inner = context != BEGIN
        own[inner] = stats[np.searchsorted(distinct, context[inner])]
        total = own[:, 4]
        d = np.array([0.0, *self.discounts])
        kept = own[:, 1:4] @ d[1:]
        back = low[np.searchsorted(distinct, after)]
        p = np.where(total > 0, (np.maximum(n - d[np.minimum(n, 3)], 0) + kept * back) / np.maximum(total, 1), back)
        logs = np.log10(p)[pair_code]
        if not rows:
            return {k: np.zeros(0) for k in ("n_tokens", "n_known", "base_score", "score")}
        starts = np.concatenate([[0], ends[:-1] + 1])
        return {
            "n_tokens": count + 1,
            "n_known": np.add.reduceat((seen > 0)[code].astype(np.int64), starts),
            "base_score": np.add.reduceat(base[code], starts),
            "score": np.add.reduceat(logs, starts),
        }

    @property
    def begin(self) -> np.ndarray:
        return self.array("begin")


@lru_cache(maxsize=2)
def load(folder: str) -> Model:
    return Model(folder)


def discounts(n: list[int]) -> list[float]:
    """The three discounts from how many counts are 1, 2, 3 and 4 (Chen and Goodman)."""
    n1, n2, n3, n4 = (max(0, x) for x in n)
    if not n1 or not n2:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.0]
    return [min(max(x, 0.05), i + 0.95) for i, x in enumerate(found)]


def train(docs: DataFrame, *, text: str = "text", folder: str | None = None) -> str:
    """Counts a model over the texts of ``docs`` and returns its folder.

    A-Z are lower-cased; a text is its words and one end; a null text is empty. Other columns and
    keys are not read. An empty table gives a model that knows no word.
    """
    spark = docs.sparkSession
    folder = open_folder(folder or scratch_path(spark, "ngrams"))
    os.makedirs(folder)
    rows = docs.select(F.col(text).cast("string").alias("text"))

    def count_words(batches):
        keys, counts, texts = [], [], 0

        def out():
            k, c = _summed(np.concatenate([*keys, np.array([END])]), np.concatenate([*counts, np.array([texts])]))
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names=["h", "n"])

        for part in slices(batches, "text", 8 << 20):
            words = words_of(part.column("text"))
            keys.append(words.hashes())
            counts.append(np.bincount(words.codes, minlength=len(words.distinct)))
            texts += part.num_rows
            if sum(map(len, keys)) > 2_000_000:
                yield out()
                keys, counts, texts = [], [], 0
        if texts:
            yield out()

    # the range of a word is the leading bits of its hash; ranges grow in number with the text
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    bits = max(6, int(size // 30_000_000).bit_length())
    pair_bits = max(6, int(size // 12_000_000).bit_length())
    range_of = F.shiftrightunsigned("h", 64 - bits)
    counted = rows.mapInArrow(count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))

    def write_words(batches):
        held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
        if not held:
            return
        h, n, part = (np.concatenate(c) for c in zip(*held))
        h = h.view(np.uint64)
        order = np.argsort(h)
        h, n, part = h[order], n[order], part[order]
        for p in np.unique(part).tolist():
            mine = part == p
            _save(folder, f"words-{p}.npy", h[mine])
            _save(folder, f"unigrams-{p}.npy", n[mine])
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([int(mine.sum())]), pa.array([int(n[mine].sum())])], names=["part", "words", "tokens"])

    written = counted.withColumn("part", range_of).repartition(1 << bits, "part").mapInArrow(write_words, "part long, words long, tokens long")
    # one row per range
    sizes = np.zeros((1 << bits, 2), np.int64)
    for r in written.collect():
        sizes[r.part] = r.words, r.tokens
    _fill(folder, [f"{n}-{p}" for p in np.flatnonzero(sizes[:, 0] == 0) for n in ("words", "unigrams")])
    first = np.concatenate([[0], np.cumsum(sizes[:, 0])])
    about = {"bits": bits, "pair_bits": pair_bits, "first": first.tolist(), "tokens": int(sizes[:, 1].sum()), "distinct": int(first[-1])}
    if about["distinct"] >= int(UNKNOWN):
        raise ValueError("more different words than places")
    _about(folder, about | {"discounts": [0.5] * 3, "low": {"discounts": [0.5] * 3, "mass": 0.0, "total": 0}}, "words.json")

    def count_pairs(batches):
        model = Model.__new__(Model)
        model.bits, model.first, model.folder, model.maps = bits, first, folder, {}
        held, rows_held = [], 0
        end = model.places(np.array([END]))[0]

        def out():
            pairs, counts = _summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            part = mix(pairs) >> np.uint64(64 - pair_bits)
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange((1 << pair_bits) + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(bounds))
            blobs = [[a[order[bounds[p] : bounds[p + 1]]].astype(t).tobytes() for p in full] for a, t in ((pairs, "<u8"), (counts, "<u4"))]
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int64))] + [pa.array(b, pa.binary()) for b in blobs], names=["part", "pairs", "counts"])

        for piece in slices(batches, "text", 8 << 20):
            words = words_of(piece.column("text"))
            place = np.insert(model.places(words.hashes())[words.codes], words.of_text[1:], end)
            before = np.empty_like(place)
            before[1:] = place[:-1]
            stops = np.cumsum(np.diff(words.of_text) + 1)
            before[np.concatenate([[0], stops[:-1]])] = BEGIN
            held.append(_summed(before << np.uint64(32) | place))
            rows_held += len(held[-1][0])
            if rows_held > _PAIRS_AT_ONCE:
                yield out()
                held, rows_held = [], 0
        if held:
            yield out()

    def sum_pairs(batches):
        held: dict[int, list] = {}
        for b in batches:
            for row in b.to_pylist():
                held.setdefault(row["part"], []).append((np.frombuffer(row["pairs"], "<u8"), np.frombuffer(row["counts"], "<u4").astype(np.int64)))
        for p, parts in held.items():
            pairs, n = _summed(np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts]))
            parts.clear()
            names = mix(pairs)
            order = np.argsort(names)
            _save(folder, f"pairs-{p}.npy", names[order])
            _save(folder, f"counts-{p}.npy", n[order].astype(np.uint32) if n.max(initial=0) < 1 << 32 else n[order])
            context, after = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
            where, at = np.unique(np.concatenate([context, after]), return_inverse=True)
            stats = np.zeros((len(where), 6), np.int64)
            of_context = at[: len(pairs)]
            for k, mine in ((1, n == 1), (2, n == 2), (3, n >= 3)):
                stats[:, k] = np.bincount(of_context[mine], minlength=len(where))
            stats[:, 4] = np.bincount(of_context, n, len(where)).astype(np.int64)
            stats[:, 5] = np.bincount(at[len(pairs) :], minlength=len(where))
            owner = np.searchsorted(first, where.astype(np.int64), side="right") - 1
            owner[where == BEGIN] = -1
            ones = [int((n == k).sum()) for k in (1, 2, 3, 4)]
            for o in np.unique(owner).tolist():
                mine = owner == o
                body = [where[mine].astype("<u4").tobytes(), stats[mine, 1:].astype("<u8" if n.sum() >> 32 else "<u4").tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o]), pa.array([body[0]], pa.binary()), pa.array([body[1]], pa.binary()), pa.array([ones if o == owner[0] else [0] * 4], pa.list_(pa.int64()))],
                    names=["owner", "words", "stats", "ones"],
                )

    packed = rows.mapInArrow(count_pairs, "part long, pairs binary, counts binary").repartition(1 << pair_bits, "part")
    stats = packed.mapInArrow(sum_pairs, "owner long, words binary, stats binary, ones array<long>")

    def write_stats(batches):
        held: dict[int, np.ndarray] = {}
        ones = np.zeros(4, np.int64)
        for b in batches:
            for row in b.to_pylist():
                o, where = row["owner"], np.frombuffer(row["words"], "<u4").astype(np.int64)
                values = np.frombuffer(row["stats"], "<u4" if len(row["stats"]) == 20 * len(where) else "<u8").reshape(-1, 5).astype(np.int64)
                length = 1 if o < 0 else int(first[o + 1] - first[o])
                table = held.setdefault(o, np.zeros((length, 6), np.int64))
                table[np.zeros(len(where), int) if o < 0 else where - first[o], 1:] += values
                ones += row["ones"]
        low, total = np.zeros(5, np.int64), 0
        for o, table in held.items():
            small = table if table.max(initial=0) >> 32 else table.astype(np.uint32)
            _save(folder, "begin.npy" if o < 0 else f"stats-{o}.npy", table[0] if o < 0 else small)
            cc = table[:, 5] if o >= 0 else np.zeros(0, np.int64)
            low += [*((cc == k).sum() for k in (1, 2, 3, 4)), (cc >= 3).sum()]
            total += int(cc.sum())
        owners = [int(o) for o in held]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.list_(pa.int64())) for v in (owners, ones.tolist(), low.tolist(), [total])], names=["owners", "ones", "low", "total"])

    kinds = T.StructType([T.StructField(n, T.ArrayType(T.LongType())) for n in ("owners", "ones", "low", "total")])
    done = stats.repartition(1 << bits, "owner").mapInArrow(write_stats, kinds).collect()
    owners = {o for r in done for o in r.owners}
    _fill(folder, [f"stats-{p}" for p in range(1 << bits) if p not in owners] + ([] if -1 in owners else ["begin"]))
    _fill(folder, [f"{n}-{p}" for p in range(1 << pair_bits) for n in ("pairs", "counts") if not os.path.exists(os.path.join(folder, f"{n}-{p}.npy"))])
    ones, low = (np.sum([x for x in v], axis=0, dtype=np.int64) for v in zip(*((r.ones, r.low) for r in done))) if done else (np.zeros(4, int), np.zeros(5, int))
    d = discounts(low[:4].tolist())
    about |= {
        "discounts": discounts(ones.tolist()),
        "low": {"discounts": d, "mass": float(d[0] * low[0] + d[1] * low[1] + d[2] * low[4]), "total": sum(r.total[0] for r in done)},
    }
    _about(folder, about, "model.json")
    return folder


def _fill(folder: str, names: list[str]) -> None:
    """Empty arrays for ranges that hold nothing."""
    for name in names:
        empty = np.zeros(6, np.int64) if name == "begin" else np.zeros((0, 6), np.int64) if name.startswith("stats") else np.zeros(0, np.uint64)
        np.save(os.path.join(folder, f"{name}.npy"), empty)


def _about(folder: str, about: dict, name: str) -> None:
    with open(os.path.join(folder, name), "w") as out:
        json.dump(about, out)


def score(docs: DataFrame, folder: str, *, text: str = "text") -> DataFrame:
    """All rows and columns with n_tokens, n_known, train_tokens, base_score, score and perplexity.

    Scores are log10 probabilities of the text and its end. Unknown words share the mass of one
    word; a null or empty text is an end alone. Clashing columns are replaced.
    """
    more = {"n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType(), "perplexity": T.DoubleType()}
    names = [n for n in docs.columns if n not in more]
    schema = T.StructType([docs.schema[n] for n in names] + [T.StructField(n, t) for n, t in more.items()])

    def run(batches):
        model = load(folder)
        for part in slices(batches, text, 8 << 20):
            found = model.score(words_of(part.column(text)), part.num_rows)
            n = found["n_tokens"]
            extra = [pa.array(n), pa.array(found["n_known"]), pa.array(np.full(len(n), model.tokens)), pa.array(found["base_score"]), pa.array(found["score"]), pa.array(10 ** (-found["score"] / n))]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + extra, names=schema.names)

    return docs.select(*names).mapInArrow(run, schema)
