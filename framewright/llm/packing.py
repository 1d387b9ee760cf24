"""Sum-of-squares packing of token ids into fixed windows.

One pass without a shuffle: every task tokenises its documents and packs them on its own.
Full windows are cut off a document first. The rest, of length r, goes into the fill level h
for which the sum of squared counts of partially filled windows grows least, among "a new
window" and the levels that still have room for it; of equal growth the fullest level is
taken. ``levels[h]`` counts the open windows of level h, so a choice is one array expression
over the levels. Windows that stay open at the end of a task are filled up from the emptiest
ones by cutting those; what is then left, less than a window, is cut into windows whose
lengths are powers of two, which need no padding.

Memory: one slice of text and at most ``max_open`` open windows. A lost task is run again and
gives the same rows, as windows depend on the partition alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.llm.texts import encoder, slices

Piece = tuple[int, int, np.ndarray, int]  # row of the document, start, ids, the document's tokens


class SumOfSquares:
    """Places pieces into windows; closed windows are lists of pieces that fill them."""

    def __init__(self, window: int, max_open: int = 4096):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.count = 0

    def level_for(self, length: int) -> int:
        """The level to raise by ``length``; 0 opens a window."""
        window, levels = self.window, self.levels
        growth = 2 * (levels[length : window + 1] - levels[: window - length + 1]) + 2
        growth[0] = 2 * levels[length] + 1
        growth[-1] = 1 - 2 * levels[window - length]  # a filled window is no longer partial
        growth[1:][levels[1 : window - length + 1] == 0] = np.iinfo(np.int64).max
        return len(growth) - 1 - int(np.argmin(growth[::-1]))

    def place(self, piece: Piece) -> list[Piece] | None:
        """Adds a piece shorter than a window; a window that it fills is returned."""
        length = len(piece[2])
        level = self.level_for(length)
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            self.count -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + length == self.window:
            return pieces
        self.open[level + length].append(pieces)
        self.levels[level + length] += 1
        self.count += 1
        return None

    def close(self) -> Iterator[list[Piece]]:
        """Fills the open windows from the emptiest ones; the last is cut at powers of two."""
        left = [w for level in self.open for w in level]
        self.open = [[] for _ in range(self.window)]
        self.levels[:] = 0
        self.count = 0
        low, high = 0, len(left) - 1
        while low <= high:
            target = left[high]
            room = self.window - sum(len(p[2]) for p in target)
            while room and low < high:
                row, start, ids, tokens = left[low].pop()
                if len(ids) > room:
                    left[low].append((row, start, ids[:-room], tokens))
                    start, ids = start + len(ids) - room, ids[-room:]
                target.append((row, start, ids, tokens))
                room -= len(ids)
                low += not left[low]
            if room:
                yield from _powers(target, self.window)
            else:
                yield target
            high -= 1


def _powers(pieces: list[Piece], window: int) -> Iterator[list[Piece]]:
    rest = sum(len(p[2]) for p in pieces)
    pieces = pieces[::-1]
    while rest:
        size = 1 << (min(rest, window).bit_length() - 1)
        rest -= size
        out = []
        while size:
            row, start, ids, tokens = pieces.pop()
            if len(ids) > size:
                pieces.append((row, start + size, ids[size:], tokens))
                ids = ids[:size]
            out.append((row, start, ids, tokens))
            size -= len(ids)
        yield out


def pack(
    docs: DataFrame, *, vocabulary: str, end_id: int, window: int = 2048, key: str = "doc_id", text: str = "text", max_open: int = 4096
) -> DataFrame:
    """One row per piece of a document: ``key, start, length, doc_tokens, sequence_id, offset,
    sequence_length, ids`` (ids: binary, little-endian unsigned 32-bit).

    A null text is empty and gives the end id alone; null and repeated keys are kept, each row
    is a document of its own; other columns are ignored; an empty table gives no rows.
    ``sequence_id`` is unique over the table. Only the last sequences of a task are shorter
    than ``window``, and their lengths are powers of two.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType
    schema = T.StructType(
        [T.StructField("key", kind)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset", "sequence_length")]
        + [T.StructField("ids", T.BinaryType())]
    )

    def run(batches):
        packer, encode = SumOfSquares(window, max_open), encoder(vocabulary)
        task = TaskContext.get().partitionId() << 36
        made = 0
        out: list[list] = [[] for _ in range(8)]
        size = 0

        def emit(pieces):
            nonlocal made, size
            total, offset = sum(len(p[2]) for p in pieces), 0
            for name, start, ids, tokens in pieces:
                values = (name, start, len(ids), tokens, task + made, offset, total, ids.astype("<u4").tobytes())
                for column, value in zip(out, values):
                    column.append(value)
                offset += len(ids)
                size += 4 * len(ids)
            made += 1

        def batch():
            nonlocal size
            arrow = pa.RecordBatch.from_arrays(
                [pa.array(out[0], keys)] + [pa.array(c, pa.int64()) for c in out[1:7]] + [pa.array(out[7], pa.binary())],
                names=schema.names,
            )
            for column in out:
                column.clear()
            size = 0
            return arrow

        keys = None
        for part in slices(batches, "text", 4 << 20):
            keys = part.schema.field("key").type
            ids, bounds = encode(part.column("text"), end_id)
            names = part.column("key").to_pylist()
            for i, name in enumerate(names):
                own = ids[bounds[i] : bounds[i + 1]]
                whole = len(own) // window * window
                for start in range(0, whole, window):
                    emit([(name, start, own[start : start + window], len(own))])
                if whole < len(own):
                    # a copy, so that an open window does not hold the whole slice's ids
                    if filled := packer.place((name, whole, own[whole:].copy(), len(own))):
                        emit(filled)
                    if packer.count >= max_open:
                        for pieces in packer.close():
                            emit(pieces)
                if size >= 8 << 20:
                    yield batch()
        for pieces in packer.close():
            emit(pieces)
        if out[0]:
            yield batch()

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
