"""Benchmark passages in documents by the q-gram lemma.

Benchmark items are cut into overlapping patterns of n bytes. If a stretch of a document is
within e edits of a pattern, the two share at least ``n - q + 1 - q * e`` q-grams whose
diagonals (place in the document less place in the pattern) differ by at most e. Shared q-grams
are counted in overlapping bands of diagonals, wide enough that one band holds every such
match; bands that reach the bound are verified by alignment within the band.

Texts in which too few known q-grams lie close together for any match are passed over at once.
Documents are read where they lie, without a shuffle. The benchmark goes to the workers in
blocks of bounded size, one pass over the documents for each.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.llm.texts import buffer_of, slices

BLOCK_BYTES = 2 << 20
_TABLE_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[9, 10, 11, 12, 13]] = 32


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """The q bytes from each place as a number; the last q - 1 places have none."""
    if len(data) < q:
        return np.zeros(0, np.uint64)
    wide = np.append(data, np.zeros(8, np.uint8))
    two = wide[:-1].astype(np.uint16) | wide[1:].astype(np.uint16) << 8
    four = two[:-2].astype(np.uint32) | two[2:].astype(np.uint32) << 16
    eight = four[:-4].astype(np.uint64) | four[4:].astype(np.uint64) << np.uint64(32)
    return eight[: len(data) - q + 1] & np.uint64((1 << 8 * q) - 1)


class Patterns:
    """The q-grams of all patterns, sorted, with the patterns and places they come from."""

    def __init__(self, items: list[tuple], q: int, length: int, edits_in: int):
        self.q, self.item, self.text, self.edits, self.start = q, [], [], [], []
        for item, text in items:
            data = _PLAIN[np.frombuffer((text or "").strip().encode(), np.uint8)]
            starts = list(range(0, max(1, len(data) - length + 1), length // 2))
            if len(data) > length and starts[-1] + length < len(data):
                starts.append(len(data) - length)
            for start in starts:
                own = data[start : start + length]
                if len(own) >= q:
                    self.item.append(item)
                    self.text.append(own)
                    self.start.append(start)
                    self.edits.append(min(len(own) // edits_in, (len(own) - q) // q))
        self.size = np.array([len(t) for t in self.text], np.int64)
        self.allowed = np.array(self.edits, np.int64)
        self.bound = self.size - q + 1 - q * self.allowed
        codes = [grams(t, q) for t in self.text]
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.pattern = np.repeat(np.arange(len(codes)), [len(c) for c in codes])[order]
        self.place = np.concatenate([np.arange(len(c)) for c in codes])[order] if codes else order
        self.code, self.first = np.unique(code[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(code)))
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self._slot(self.code)] = True
        self.width = max(16, 2 * int(self.allowed.max(initial=0)))

    @staticmethod
    def _slot(code: np.ndarray) -> np.ndarray:
        return (code * _MIX) >> np.uint64(64 - _TABLE_BITS)

    def regions(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Patterns and bands of diagonals with enough shared q-grams: pattern, low, high."""
        none = np.zeros(0, np.int64)
        if not len(self.code):
            return none, none, none
        code = grams(data, self.q)
        at = np.flatnonzero(self.table[self._slot(code)])
        known = np.minimum(np.searchsorted(self.code, code[at]), len(self.code) - 1)
        same = self.code[known] == code[at]
        at, known = at[same], known[same]
        n = self.count[known]
        if not len(n):
            return none, none, none
        post = np.repeat(self.first[known] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pattern, place = self.pattern[post], self.place[post]
        diagonal = np.repeat(at, n) - place + (1 << 20)
        band = diagonal // self.width
        # a band reaches ``allowed`` diagonals into the next one
        early = diagonal % self.width < self.allowed[pattern]
        key = np.concatenate([pattern << 40 | band, pattern[early] << 40 | (band[early] - 1)])
        # a pattern's q-gram counts once in a band, however often a text repeats it
        order = np.lexsort((np.concatenate([place, place[early]]), key))
        key, place = key[order], np.concatenate([place, place[early]])[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (place[1:] != place[:-1])])
        key, shared = np.unique(key[fresh], return_counts=True)
        pattern, band = key >> 40, key & (1 << 40) - 1
        full = shared >= self.bound[pattern]
        pattern, low = pattern[full], band[full] * self.width - (1 << 20)
        return pattern, low, low + self.width - 1 + self.allowed[pattern]

    def dense(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts that may hold a match: as many places with a known q-gram as the least bound, so
        close together as one match lies. The whole buffer is looked at once."""
        if not len(self.code):
            return np.zeros(0, np.int64)
        code = grams(data, self.q)
        at = np.flatnonzero(self.table[self._slot(code)])
        known = np.minimum(np.searchsorted(self.code, code[at]), len(self.code) - 1)
        at = at[self.code[known] == code[at]]
        text = np.searchsorted(offsets, at, side="right") - 1
        inside = at + self.q <= offsets[text + 1]
        at, text = at[inside], text[inside]
        need = int(self.bound.min()) - 1
        if len(at) <= need:
            return np.zeros(0, np.int64)
        reach = int((self.size + self.allowed).max()) - self.q
        close = (at[need:] - at[: len(at) - need] <= reach) & (text[need:] == text[: len(text) - need])
        return np.unique(text[need:][close])

    def align(self, data: np.ndarray, pattern: int, low: int, high: int) -> tuple[int, int, int] | None:
        """Edits, start and end of the best match that stays on the diagonals low to high."""
        text, most = self.text[pattern], int(self.allowed[pattern])
        whole = data[max(0, low) : high + len(text)].tobytes().find(text.tobytes())
        if whole >= 0:
            return 0, max(0, low) + whole, max(0, low) + whole + len(text)
        if most == 0:
            return None
        # cell k of row i: place low - most + k + i of the document; starts are free
        cells = high - low + 1 + 2 * most
        base = low - most
        cost, begin = np.zeros(cells, np.int64), base + np.arange(cells)
        far = len(text) + 1
        outside = (begin < 0) | (begin > len(data))
        cost[outside] = far
        steps = np.arange(cells)
        for i, byte in enumerate(text):
            place = base + i + steps
            inside = (place >= 0) & (place < len(data))
            change = np.ones(cells, np.int64)
            change[inside] = data[place[inside]] != byte
            change[~inside] = far
            new = cost + change
            drop = np.append(cost[1:], far) + 1
            take = drop < new
            new = np.where(take, drop, new)
            source = np.where(take, np.append(begin[1:], 0), begin)
            # bytes of the document that the pattern lacks: the cheapest cell before, and the way from it
            lead = np.minimum.accumulate(new - steps)
            origin = np.maximum.accumulate(np.where(new - steps == lead, steps, 0))
            cost, begin = new[origin] + steps - origin, source[origin]
            cost[(base + i + 1 + steps < 0) | (base + i + 1 + steps > len(data))] = far
        best = int(np.argmin(cost))
        if cost[best] > most:
            return None
        return int(cost[best]), int(begin[best]), base + len(text) + best

    def matches(self, data: np.ndarray) -> list[tuple]:
        """(item, edits, start, end) of every verified pattern."""
        out = []
        for pattern, low, high in zip(*(x.tolist() for x in self.regions(data))):
            if found := self.align(data, pattern, low, high):
                out.append((self.item[pattern], *found))
        return out


def _blocks(benchmark: DataFrame, item: str, text: str, **options):
    """Indexes of bounded blocks of the benchmark."""
    rows = benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).cast("string").alias("text")).where("text is not null")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = int(total // BLOCK_BYTES) + 1
    for block in range(count):
        own = rows if count == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block)
        yield benchmark.sparkSession.sparkContext.broadcast(Patterns(sorted(own.collect(), key=str), **options))


def passages(
    docs: DataFrame, benchmark: DataFrame, *, q: int = 8, length: int = 60, edits_in: int = 12, key: str = "doc_id", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """``key, item, n_patterns, least_edits, start_byte, end_byte``: items found in documents.

    A pattern is ``length`` bytes, one edit is allowed for every ``edits_in`` of them; a shorter
    item is one pattern. A stretch of at least 1.5 patterns of an item holds a whole one. Case of
    A-Z and kind of white space make no difference. start_byte and end_byte bound all matches
    of the item in the UTF-8 text. Items of fewer than ``q`` bytes, null items and null or empty texts match
    nothing; null keys and repeated rows are kept, each a document of its own; other columns are
    ignored.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType
    numbers = ("item", "n_patterns", "least_edits", "start_byte", "end_byte")
    schema = T.StructType([T.StructField("key", kind)] + [T.StructField(n, T.LongType()) for n in numbers])

    def search(shared):
        def run(batches):
            for part in slices(batches, "text"):
                data, offsets = buffer_of(part.column("text"))
                data = _PLAIN[data]
                out, row = [], []
                for i in shared.value.dense(data, offsets).tolist():
                    found = shared.value.matches(data[offsets[i] : offsets[i + 1]])
                    for name in sorted({f[0] for f in found}, key=str):
                        own = [f[1:] for f in found if f[0] == name]
                        out.append((name, len(own), min(f[0] for f in own), min(f[1] for f in own), max(f[2] for f in own)))
                        row.append(i)
                columns = [pa.array([o[k] for o in out], pa.int64()) for k in range(5)]
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(row, pa.int64()))] + columns, names=schema.names)

        return run

    found = [rows.mapInArrow(search(b), schema) for b in _blocks(benchmark, item, text, q=q, length=length, edits_in=edits_in)]
    return reduce(DataFrame.unionByName, found).withColumnsRenamed({"key": key, "item": item})


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, q: int = 8, length: int = 60, edits_in: int = 12, text: str = "text", item: str = "item_id") -> DataFrame:
    """Documents without any passage of the benchmark; columns and order of columns stay."""

    def clean(shared):
        def run(batches):
            for part in slices(batches, text):
                data, offsets = buffer_of(part.column(text))
                data = _PLAIN[data]
                keep = np.ones(part.num_rows, bool)
                for i in shared.value.dense(data, offsets).tolist():
                    keep[i] = not shared.value.matches(data[offsets[i] : offsets[i + 1]])
                yield part.filter(pa.array(keep))

        return run

    for shared in _blocks(benchmark, item, text, q=q, length=length, edits_in=edits_in):
        docs = docs.mapInArrow(clean(shared), docs.schema)
    return docs
