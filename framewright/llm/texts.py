"""Words and token ids of Arrow batches, without a Python step per word.

A batch's texts are one buffer of UTF-8 bytes. Words are found in it with array
operations, and each distinct word of the batch is handled once: hashed, looked up or
tokenised. Memory is bounded by ``SLICE_BYTES`` of text and one row.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# A blank may start a piece if what follows cannot be white space of any kind: a printing
# ASCII character or a lead byte under which Unicode has no white space.
_SOLID = np.zeros(256, dtype=bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xE1] = True
_SOLID[0xE4:0xF5] = True
_GRAPHIC = np.zeros(256, dtype=bool)
_GRAPHIC[0x21:0x7F] = True
# Lead bytes under which Unicode has characters that join others or count as white space.
_UNSURE = np.zeros(256, dtype=bool)
_UNSURE[[0xC2, 0xCC, 0xCD, 0xE1, 0xE2, 0xE3, 0xEF]] = True
_UNSURE[0xF0:] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".,!?;:")] = True


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of at most ``limit`` bytes of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: a worker waits for its next task with what it holds."""
    pa.default_memory_pool().release_unused()
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):  # another C library
        return
    trim(0)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes and their offsets (one more than rows); a null text is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if texts.offset or texts.buffers()[1] is None:
        texts = pa.concat_arrays([texts, pa.array([], pa.large_binary())])
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """The words of some texts. ``starts`` and ``ends`` are byte positions in ``data``."""

    codes: np.ndarray
    distinct: pa.Array
    of_text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def hashes(self) -> np.ndarray:
        """XXH64 of each distinct word."""
        import xxhash

        digest = xxhash.xxh64_intdigest
        return np.fromiter((digest(w, 42) for w in self.distinct.to_pylist()), np.uint64, len(self.distinct))


def words_of(texts: pa.Array, *, lower: bool = True, encode: bool = True) -> Words:
    """Words are runs of bytes other than blank, tab, line feed, \\x0b, \\x0c and return.

    ``of_text`` gives the first word of each text (one more than rows); ``codes`` point
    into ``distinct``.
    """
    data, offsets = buffer_of(texts)
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    of_text = np.searchsorted(starts, offsets)
    if lower:
        data = _LOWER[data]
    codes, distinct = np.zeros(0, np.int32), pa.array([], pa.binary())
    if encode:
        ends_in = np.zeros(len(starts) + 1, dtype=np.int32)
        np.cumsum(ends - starts, out=ends_in[1:])
        packed = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends_in), pa.py_buffer(data[solid])])
        encoded = packed.dictionary_encode()
        codes, distinct = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
    return Words(codes, distinct, of_text, starts, ends, data, offsets)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` of every i, one after another."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


@lru_cache(maxsize=4)
def encoder(path: str, remember: int = 600_000) -> Encoder:
    """The encoder of a vocabulary file; a worker keeps it from task to task."""
    return Encoder(path, remember)


#: Characters that may part pieces in one text for the tokenizer: a number or a line feed is
#: always split from what stands beside it. A vocabulary must give it one id.
_PARTS = ("\u00bd", "\u00b2", "\n")
_PROBES = ("a", " a", "'s", " 's", ".", " .", "1", "don't", " \u00e9t\u00e9", "\u65e5\u672c", "...", "(x)", "A", "#1")
_WORDS = ["a", " a", "Word", " word", " \u00dcBER", "\u00e9t\u00e9", "stra\u00dfe", " sttible", "OULYON", " \u00c0", "dont", " re"]
# Byte-level vocabularies write a byte as the printing Latin-1 character of its number, and the
# others, in order, as the characters from 256 on.
_PRINTING = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
_BYTE_LETTERS = np.arange(256).astype("<u4")
_BYTE_LETTERS[[b for b in range(256) if b not in _PRINTING]] = 256 + np.arange(256 - len(_PRINTING))
_BYTE_LETTERS[10] = 10  # parts the words


class Encoder:
    """Ids of whole texts, equal to encoding each text by itself.

    Texts are cut where the tokenizers used here always split them before the merges: before
    a blank that is followed by something solid, around a line feed between solid characters,
    and before a stop that follows an ASCII letter. Each distinct piece of a slice is encoded
    once and remembered. Beyond ``remember`` pieces half of them stay: first those that were met
    in several slices, then those met last, so that the many pieces that occur once go first.
    """

    def __init__(self, path: str, remember: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.remember = Tokenizer.from_file(path), remember
        self.tokenizer.encode_special_tokens = True
        self.seen, self.turn = pa.array([], pa.binary()), 0
        self.ids, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        # the slice in which a piece was met last; plus a large number if that was not the first
        self.used = np.zeros(0, np.int64)
        self.part, self.part_id = next(filter(None, map(self._parting, _PARTS)), (None, -1))
        self.spelling = self._spelling()

    def _parting(self, part: str) -> tuple[str, int] | None:
        """The character and its id, if it leaves pieces beside it as they are."""
        each = self._each([*_PROBES, part])
        if len(each[-1]) != 1:
            return None
        joined = self._each([part.join([*_PROBES, *_PROBES[::-1]])])[0]
        parted = [[]]
        for i in joined:
            parted.append([]) if i == each[-1][0] else parted[-1].append(i)
        return (part, each[-1][0]) if parted == each[:-1] + each[-2::-1] else None

    def _each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _flat(each: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(chain.from_iterable(each), np.uint32, int(lengths.sum())), lengths

    def _encode(self, pieces: list[str], together: int = 1000) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after another, and their numbers; the tokenizer is given many in one text."""
        ids, lengths = [], []
        for at in range(0, len(pieces), together):
            own = pieces[at : at + together]
            found = None
            if self.part and len(own) > 1:
                text = self.part.join(own)
                if text.count(self.part) == len(own) - 1:
                    joined = np.array(self._each([text])[0], np.uint32)
                    parts = np.flatnonzero(joined == self.part_id)
                    if len(parts) == len(own) - 1:
                        bounds = np.concatenate([[-1], parts, [len(joined)]])
                        found = np.delete(joined, parts), np.diff(bounds) - 1
            more, each = found or self._flat(self._each(own))
            ids.append(more)
            lengths.append(each)
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *lengths])

    def _spelling(self) -> tuple[bool, str] | None:
        """How a word of letters is handed to the model beneath: in lower case or not, and what
        becomes of a blank before it. None if that does not give the tokenizer's ids."""
        for lower, blank in ((False, "\u0120"), (True, "")):
            if self._spelled([w.encode() for w in _WORDS], lower, blank) == self._each(_WORDS):
                return lower, blank
        return None

    def _spelled(self, words: list[bytes], lower: bool, blank: str) -> list[list[int]]:
        text = b"\n".join(words)
        if lower:
            text = text.decode().lower().encode()
        data, letters = np.frombuffer(text, np.uint8), _BYTE_LETTERS.copy()
        letters[32] = ord(blank or "\0")
        model = self.tokenizer.model.tokenize
        written = letters[data if blank else data[data != 32]].tobytes().decode("utf-32-le").split("\n")
        return [[t.id for t in model(w)] for w in written]

    def _new(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers for pieces that are not remembered."""
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        data, bounds = buffer_of(pieces)
        first, size = bounds[:-1], np.diff(bounds)
        led = data[first] == 32
        # letters of ASCII and Latin-1, after one blank or none: a word that is never split
        after = np.zeros(len(data), bool)
        after[1:] = data[:-1] == 0xC3
        good = _LETTER[data] | (data == 0xC3) | after & (data != 0x97) & (data != 0xB7)
        good[first[led & (size > 1)]] = True
        words = np.logical_and.reduceat(good, first) & bool(self.spelling)
        # two blanks, or one at the end, may be split otherwise beside another piece
        blank = _SPACE[data] | ~_GRAPHIC[data] & (data < 128)
        blank[first[led & (size > 1)]] = False
        plain = ~words & ~np.logical_or.reduceat(blank | _UNSURE[data], first)
        rows = [np.flatnonzero(x) for x in (words, plain, ~words & ~plain)]
        own = [pieces.take(pa.array(r)) for r in rows]
        done = [self._flat(self._spelled(own[0].to_pylist(), *self.spelling))] if len(rows[0]) else []
        done.append(self._encode(own[1].cast(pa.string()).to_pylist()))
        done.append(self._flat(self._each(own[2].cast(pa.string()).to_pylist())))
        order = np.argsort(np.concatenate(rows), kind="stable")
        ids, lengths = (np.concatenate(x) for x in zip(*done))
        starts = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        return ids[spread(starts, lengths)], lengths

    def _keep(self, places: np.ndarray) -> None:
        starts = np.cumsum(self.lengths) - self.lengths
        self.seen = self.seen.take(pa.array(places))
        self.ids = self.ids[spread(starts[places], self.lengths[places])]
        self.lengths, self.used = self.lengths[places], self.used[places]

    def _remember(self, pieces: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        if len(self.seen) + len(pieces) > self.remember:
            half = max(0, min(self.remember // 2, self.remember - len(pieces)))
            self._keep(np.sort(np.argsort(-self.used, kind="stable")[:half]))
        taken = min(len(pieces), self.remember - len(self.seen))
        self.seen = pa.concat_arrays([self.seen, pieces.slice(0, taken)])
        self.ids = np.concatenate([self.ids, ids[: lengths[:taken].sum()]])
        self.lengths = np.concatenate([self.lengths, lengths[:taken]])
        self.used = np.concatenate([self.used, np.full(taken, self.turn)])

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end id after each text, and where each text's ids begin."""
        data, offsets = buffer_of(texts)
        cuts = _cuts(data, offsets)
        count = len(cuts) - 1
        ids, starts, lengths = self.ids, np.zeros(0, np.int64), np.zeros(0, np.int64)
        if count > 0:
            self.turn += 1
            pieces = pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])
            encoded = pieces.dictionary_encode()
            distinct = encoded.dictionary
            found = pc.index_in(distinct, value_set=self.seen)
            new = found.is_null().to_numpy(zero_copy_only=False)
            place = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            place[new] = len(self.seen) + np.arange(found.null_count)
            self.used[place[~new]] = self.turn + (1 << 40)
            unknown = distinct.filter(pa.array(new))
            more, sizes = self._new(unknown)
            ids, every = np.concatenate([self.ids, more]), np.concatenate([self.lengths, sizes])
            known = place[encoded.indices.to_numpy(zero_copy_only=False)]
            starts, lengths = (np.cumsum(every) - every)[known], every[known]
            self._remember(unknown, more, sizes)
        ids = ids[spread(starts, lengths)]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ends = before[np.searchsorted(cuts, offsets[1:])] if count > 0 else np.zeros(len(offsets) - 1, np.int64)
        bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
        return np.insert(ids, ends, np.uint32(end_id)), bounds


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin and end; every text's bounds are among them."""
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 1:
        solid_next = _SOLID[data[1:]]
        cut[:-2] = (data[:-1] == 32) & solid_next
        cut[1:-1] |= _STOP[data[1:]] & _LETTER[data[:-1]]
        line = (data[1:-1] == 10) & _GRAPHIC[data[:-2]] & solid_next[1:]
        cut[1:-2] |= line
        cut[2:-1] |= line
        # a blank or line feed at a text's end is followed by another text, not by a character
        last = offsets[1:][np.diff(offsets) > 1] - 1
        cut[last[_SPACE[data[last]]]] = False
    cut[offsets] = True
    return np.flatnonzero(cut)
