"""Secrets: fixed patterns, and a linear-chain conditional random field that adds spans.

Tokens are words. Each is tagged B (a secret begins), I (inside) or O. The score of a tag adds
weights of the token (kinds of characters, length, digits, changes of kind, a telling word in it,
signs of an assignment, its letters as one of IDENTITIES), of the tokens before and after it, and
of the file (how many of its words are not plain, and how many assign); further weights are for
pairs of tags. Features are worked out once per distinct word of a batch with array operations.

The field is fitted on a bounded sample: windows around matches of the fixed patterns, whose
tokens are B and I; the same windows with the telling word hidden, the cue cut off, or the value
rewritten in a wider alphabet, so that neither the cue nor the pattern's own shape is needed; and
windows elsewhere, above all around words that look odd and match nothing. Viterbi decoding leaves out tokens that are certain:
if O leads by more than all pairs of tags can make up for, no best path gives another tag
there. The runs between certain tokens are decoded exactly.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.llm.texts import slices, words_of
from framewright.session import stage

# The patterns that count as secrets, in the order in which they are listed.
PATTERNS = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
_FIND = {
    "assign": re.compile(PATTERNS["assign"], re.IGNORECASE | re.ASCII),
    "access": re.compile(PATTERNS["access"]),
    # the same runs as of the pattern, without stopping at each short one
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
_MAYBE = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=])|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""
_TELLING = r"(?i)passw|secret|token|api.?key|credential|bearer|auth|private|akia"

O, B, I = 0, 1, 2  # noqa: E741
SHAPE = 9  # features of a word
FIND_BYTES = 2 << 20  # of text tagged at once; scores of all its tokens take about 30 times that
IDENTITIES = 256  # classes of words by a hash of their letters, any case
WIDE = 112 + IDENTITIES + 4  # numbers that the features of one word can take
ODD = (0.0, 0.005, 0.02, 0.08, 0.3)  # steps of the share of words that are not plain
ASSIGNING = (0.0, 0.01, 0.05)  # steps of the share of words with the sign of an assignment
FILE = (len(ODD) + 1) * (len(ASSIGNING) + 1)

_KIND = np.zeros(256, np.uint8)  # 0 other
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[list(b"_-+/=")] = 4
_KIND[128:] = 5
_LETTER = np.zeros(256, np.uint64)  # any case of a letter alike
_LETTER[97:123] = _LETTER[65:91] = np.arange(1, 27)
_PLACE = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(16)], np.uint64)


def fixed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of the pattern, end) of all matches that are long enough."""
    out = []
    for order, (kind, pattern) in enumerate(_FIND.items()):
        for m in pattern.finditer(text):
            if len(m[2] if kind == "assign" else m[0]) >= LEAST[kind]:
                out.append((m.start(), order, m.end()))
    return sorted(out)


def shapes(distinct: pa.Array) -> np.ndarray:
    """Feature numbers of each word, below WIDE."""
    n = len(distinct)
    if not n:
        return np.zeros((0, SHAPE), np.int64)
    joined = pa.concat_arrays([distinct.cast(pa.large_binary()), pa.array([b""], pa.large_binary())])
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[: n + 1]
    kind = _KIND[np.frombuffer(joined.buffers()[2], np.uint8)[: offsets[n]]]
    starts, size = offsets[:-1], np.diff(offsets)
    count = [np.add.reduceat((kind == k).astype(np.int32), starts) for k in range(6)]
    change = np.zeros(len(kind), np.int32)
    change[1:] = kind[1:] != kind[:-1]
    change[starts] = 0
    changes = np.add.reduceat(change, starts)
    present = sum(((count[k] > 0).astype(np.int64) << (k - 1)) for k in range(1, 6))
    length = np.minimum(7, np.log2(size + 1).astype(np.int64))
    digits = np.ceil(4 * count[3] / size).astype(np.int64)
    upper = np.ceil(4 * count[2] / size).astype(np.int64)
    telling = pc.match_substring_regex(distinct, _TELLING).to_numpy(zero_copy_only=False).astype(np.int64)
    plain = (count[3] + count[4] == 0).astype(np.int64)
    alone = (size >= 16) * (1 + (count[1] + count[3] == size) + 2 * (count[2] + count[3] == size))
    bytes_ = np.frombuffer(joined.buffers()[2], np.uint8)[: offsets[n]]
    place = (np.arange(offsets[n]) - np.repeat(starts, size)) & 15
    identity = (np.add.reduceat(_LETTER[bytes_] * _PLACE[place], starts) >> np.uint64(56)).astype(np.int64) % IDENTITIES
    sign = (bytes_ == 61) | (bytes_ == 58)  # = and :
    at_end = sign[offsets[1:] - 1]
    letters = count[1] + count[2] > 0
    assigns = np.where(at_end, 1 + letters, 3 * np.logical_or.reduceat(sign, starts))
    columns = (present, 32 + length, 40 + digits, 46 + upper, 52 + np.minimum(15, changes), 68 + 2 * telling + plain, 72 + np.minimum(7, length) * 5 + np.minimum(4, alone), 112 + identity, 112 + IDENTITIES + assigns)
    return np.stack(columns, axis=1)


def file_features(features: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, whose words are those between two bounds: how many are not plain and how many assign, in steps."""
    if not len(codes):
        return np.zeros(len(bounds) - 1, np.int64)
    count = np.diff(bounds)

    def steps(flag: np.ndarray, edges: tuple) -> np.ndarray:
        so_far = np.concatenate([[0], np.cumsum(flag[codes])])
        return np.searchsorted(edges, (so_far[bounds[1:]] - so_far[bounds[:-1]]) / np.maximum(1, count))

    odd = steps(1 - (features[:, 5] & 1), ODD)
    assigning = steps(features[:, 8] > 112 + IDENTITIES, ASSIGNING)
    return np.where(count > 0, odd * (len(ASSIGNING) + 1) + assigning, 0)


@dataclass
class Field:
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    file: np.ndarray
    pairs: np.ndarray

    def emissions(self, features: np.ndarray, codes: np.ndarray, first: np.ndarray, files: np.ndarray) -> np.ndarray:
        """Scores of the tags of all tokens; ``first`` marks texts' first tokens."""
        own, left, right = (w[features].sum(axis=1) for w in (self.own, self.before, self.after))
        scores = own[codes] + self.file[files]
        scores[1:] += np.where(first[1:, None], 0, left[codes[:-1]])
        scores[:-1] += np.where(first[1:, None], 0, right[codes[1:]])
        return scores

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best tags of one text."""
        tags = np.zeros(len(scores), np.int8)
        most = 2 * (self.pairs.max() - self.pairs.min())
        open_ = scores[:, O] - scores[:, 1:].max(axis=1) <= most
        if not open_.any():
            return tags
        edge = np.diff(np.concatenate([[0], open_.astype(np.int8), [0]]))
        for start, stop in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            best = scores[start] + (self.pairs[O] if start else 0)
            back = []
            for t in range(start + 1, stop):
                ways = best[:, None] + self.pairs
                back.append(ways.argmax(axis=0))
                best = ways.max(axis=0) + scores[t]
            tag = int(np.argmax(best + (self.pairs[:, O] if stop < len(scores) else 0)))
            tags[stop - 1] = tag
            for t in range(stop - 2, start - 1, -1):
                tag = int(back[t - start][tag])
                tags[t] = tag
        return tags


# Alphabets of rewritten values, and what stands for a hidden word.
_ALPHABETS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.")
_HIDDEN = "name"


def _rewritten(value: str) -> str:
    """A value of 16 to 111 characters, half of them under 48, that depends on ``value`` alone."""
    digest = hashlib.shake_256(value.encode()).digest(114)
    alphabet = _ALPHABETS[digest[0] % len(_ALPHABETS)]
    size = 16 + digest[1] % (32 if digest[1] < 128 else 96)
    return "".join(alphabet[b % len(alphabet)] for b in digest[2 : 2 + size])


def _variants(text: str, start: int, kind: str, stop: int, around: int) -> list[tuple[str, int, int]]:
    """The surroundings of a match and of three changed forms of it: (text, start, end) each."""
    before, after = text[max(0, start - around) : start], text[stop : stop + around]
    whole = text[start:stop]
    word, value = "", whole
    if kind == "assign":
        m = _FIND[kind].match(whole)
        word, value = m[1], m[2]
    forms = [whole, value, _rewritten(value)]
    if word:
        forms += [_HIDDEN + whole[len(word) :], whole[: len(whole) - len(value)] + _rewritten(value)]
    return [(before + form + after, len(before), len(before) + len(form)) for form in forms]


def _windows(texts: list[str], reach: int, apart: int, odd: int = 6):
    """Windows of tokens with their tags: around matches and changed forms of them, around at most
    ``odd`` words a text that look like a value or tell of one but match nothing, and at regular places."""
    out = []
    kinds = list(PATTERNS)
    for text in texts:
        words = words_of(pa.array([text]), lower=False)
        features = shapes(words.distinct)
        place = np.cumsum((words.data & 0xC0) != 0x80)
        begin, end = place[words.starts] - 1, place[words.ends - 1]
        tags = np.zeros(len(begin), np.int8)
        spans = fixed_spans(text)
        for start, _, stop in spans:
            inside = np.flatnonzero((begin < stop) & (end > start))
            tags[inside] = I
            tags[inside[:1]] = B
        looks = features[words.codes]
        strange = np.flatnonzero((tags == O) & ((looks[:, 5] >= 70) | ((end - begin >= 8) & (looks[:, 5] == 68))))
        strange = strange[np.unique(np.linspace(0, len(strange) - 1, odd).astype(int))] if len(strange) else strange
        centres = np.concatenate([np.flatnonzero(tags == B), strange, np.arange(reach, len(tags), apart)])
        file = int(file_features(features, words.codes, np.array([0, len(words.codes)]))[0])
        for c in centres.tolist():
            cut = slice(max(0, c - reach), c + reach + 1)
            out.append((looks[cut], tags[cut], file))
        covered = 0
        for start, order, stop in spans:
            if start < covered:
                continue  # inside the match before
            covered = stop
            for changed, a, z in _variants(text, start, kinds[order], stop, 12 * reach)[1:]:
                own = words_of(pa.array([changed]), lower=False)
                at = np.cumsum((own.data & 0xC0) != 0x80)
                first, last = at[own.starts] - 1, at[own.ends - 1]
                marked = np.zeros(len(first), np.int8)
                for s, e in [(a, z), *((s, e) for s, _, e in fixed_spans(changed))]:
                    inside = np.flatnonzero((first < e) & (last > s))
                    marked[inside] = I
                inside = np.flatnonzero(marked == I)
                marked[inside[np.concatenate([[True], np.diff(inside) > 1])]] = B
                c = int(np.flatnonzero((first < z) & (last > a))[0])
                cut = slice(max(0, c - reach), c + reach + 1)
                out.append((shapes(own.distinct)[own.codes][cut], marked[cut], file))
    return out


def marginals(scores: np.ndarray, mask: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the tags of every token and of the tags of neighbours, given each window's
    scores; tokens that are masked, at a window's end, have none."""

    def scaled(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(x.sum(-1, keepdims=True), 1e-300)

    here = np.exp(scores - scores.max(2, keepdims=True))
    step = np.exp(pairs - pairs.max())
    ahead, behind = np.empty_like(here), np.ones_like(here)
    ahead[:, 0] = scaled(here[:, 0])
    for t in range(1, here.shape[1]):
        ahead[:, t] = scaled((ahead[:, t - 1] @ step) * here[:, t])
    for t in range(here.shape[1] - 2, -1, -1):
        behind[:, t] = np.where(mask[:, t + 1, None], scaled((here[:, t + 1] * behind[:, t + 1]) @ step.T), 1)
    joint = ahead[:, :-1, :, None] * step * (here * behind)[:, 1:, None, :]
    joint *= (mask[:, 1:] / np.maximum(joint.sum((2, 3)), 1e-300))[..., None, None]
    return scaled(ahead * behind) * mask[..., None], joint


def fit(windows: list, *, rounds: int = 150, penalty: float = 1e-3) -> Field:
    """The weights of greatest penalised likelihood, by gradient steps of adapted size."""
    n, width = len(windows), max((len(t) for _, t, _ in windows), default=1)
    rows = np.full((n, width, SHAPE), WIDE, np.int64)
    tags, mask = np.zeros((n, width), np.int64), np.zeros((n, width), bool)
    file = np.array([f for _, _, f in windows], np.int64)
    for i, (f, t, _) in enumerate(windows):
        rows[i, : len(t)], tags[i, : len(t)], mask[i, : len(t)] = f, t, True
    # equal tokens are worked out once
    kinds, place = np.unique(rows.reshape(-1, SHAPE), axis=0, return_inverse=True)
    place = place.reshape(n, width)
    sides = ((place, slice(None)), (place[:, :-1], slice(1, None)), (place[:, 1:], slice(None, -1)))
    parts = [np.zeros((WIDE + 1, 3)), np.zeros((WIDE + 1, 3)), np.zeros((WIDE + 1, 3)), np.zeros((FILE, 3)), np.zeros((3, 3))]
    if not n:
        parts[3][:, O] = 50.0
        return Field(*parts)
    gold = np.eye(3)[tags] * mask[..., None]
    both = mask[:, 1:]
    gold_pairs = np.einsum("nti,ntj->ij", gold[:, :-1] * both[..., None], gold[:, 1:] * both[..., None])
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    for step in range(1, rounds + 1):
        own, before, after, of_file, pairs = parts
        scores = np.zeros((n, width, 3)) + of_file[file][:, None]
        for weights, (tokens, at) in zip((own, before, after), sides):
            scores[:, at] += weights[kinds].sum(1)[tokens]
        expected, joint = marginals(scores, mask, pairs)
        rest = gold - expected
        slopes = []
        for tokens, at in sides:
            of_kind = [np.bincount(tokens.ravel(), rest[:, at, k].ravel(), len(kinds)) for k in range(3)]
            slope = np.stack([np.bincount(kinds.ravel(), np.repeat(g, SHAPE), WIDE + 1) for g in of_kind], axis=1)
            slope[WIDE] = 0
            slopes.append(slope)
        slopes.append(np.stack([np.bincount(file, rest[..., k].sum(1), FILE) for k in range(3)], axis=1))
        slopes.append(gold_pairs - joint.sum((0, 1)))
        for p, s, (m, v) in zip(parts, slopes, moments):
            s = s / n - penalty * p
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            p += 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(*parts)


def train(docs: DataFrame, *, sample: int = 600, reach: int = 8, apart: int = 400, most_parts: int = 50, key: str = "doc_id", text: str = "text") -> Field:
    """A field fitted on at most ``2 * sample`` documents: those of least hash with a match of a
    fixed pattern, and those without. Rows equal in key and length count as one, and a text gives
    at most ``most_parts`` parts of 4000 characters, spread evenly, so the sample is bounded."""
    rows = docs.select(F.col(text).cast("string").alias("text"), F.xxhash64(F.col(key), F.length(text)).alias("h")).where("text is not null")
    has = F.col("text").rlike(_MAYBE)
    # the hash up to which documents are taken is found without moving texts
    narrow = stage(rows.select("h", has.alias("has")), "secret-sample")
    low = -(1 << 63)
    tops = [narrow.where(w).select("h").distinct().orderBy("h").limit(sample).agg(F.coalesce(F.max("h"), F.lit(low))).first()[0] for w in (F.col("has"), ~F.col("has"))]
    near = rows.where(F.col("h") <= max(tops)).withColumn("has", has)
    chosen = near.where(F.col("h") <= F.when(F.col("has"), F.lit(tops[0])).otherwise(F.lit(tops[1]))).groupBy("h", "has").agg(F.min("text").alias("text"))
    last = "int(greatest(length(text) - 1, 0) / 4000)"
    parts = f"transform(sequence(0, {last}, 1 + int({last} / {most_parts})), i -> substring(text, i * 4000 + 1, 4000))"
    # a small table would be one task after its shuffle, and its windows are costly
    found = chosen.select(F.explode(F.expr(parts)).alias("text")).repartition(docs.sparkSession.sparkContext.defaultParallelism, "text")

    def run(batches):
        import pickle

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_windows(batch.column("text").to_pylist(), reach, apart))], pa.binary())], names=["w"])

    import pickle

    return fit([w for r in found.mapInArrow(run, "w binary").collect() for w in pickle.loads(r.w)])


def find(docs: DataFrame, field: Field, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``secrets``: an array of (kind, start, end), in code points, by start.

    Kinds are assign, access and hex for the fixed patterns and field for spans that only the
    random field finds; those that overlap a fixed one are left out. Null and empty texts have none;
    all columns stay, other columns are not read; repeated rows and null keys stay as they are. A
    column ``secrets`` is replaced.
    """
    docs = docs.drop("secrets")
    schema, run = _finder(docs, field, text, "secrets")
    return docs.mapInArrow(run, schema)


def _finder(docs: DataFrame, field: Field, text: str, name: str):
    """The schema and the step over batches of `find`; the spans are in the column ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType(docs.schema.fields + [T.StructField(name, T.ArrayType(span))])
    kinds = [*PATTERNS, "field"]
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        model = shared.value
        for part in slices(batches, text, FIND_BYTES):
            texts = part.column(text)
            maybe = pc.fill_null(pc.match_substring_regex(texts, _MAYBE), False).to_numpy(zero_copy_only=False)
            words = words_of(texts, lower=False)
            features = shapes(words.distinct)
            bounds = words.of_text
            first = np.zeros(len(words.codes) + 1, bool)
            first[bounds[:-1]] = True
            count = np.diff(bounds)
            files = file_features(features, words.codes, bounds)
            scores = model.emissions(features, words.codes, first[:-1], np.repeat(files, count)) if len(words.codes) else np.zeros((0, 3))
            most = 2 * (model.pairs.max() - model.pairs.min())
            open_ = np.concatenate([[0], np.cumsum(scores[:, O] - scores[:, 1:].max(axis=1) <= most)])
            work = maybe | (open_[bounds[1:]] > open_[bounds[:-1]])
            out = [[] for _ in range(part.num_rows)]
            for i in np.flatnonzero(work).tolist():
                value = texts[i].as_py()
                spans = fixed_spans(value) if maybe[i] else []
                own = slice(bounds[i], bounds[i + 1])
                tags = model.decode(scores[own])
                if tags.any():
                    data = words.data[words.offsets[i] : words.offsets[i + 1]]
                    place = np.cumsum((data & 0xC0) != 0x80)
                    begin = place[words.starts[own] - words.offsets[i]] - 1
                    end = place[words.ends[own] - words.offsets[i] - 1]
                    marked = np.flatnonzero(tags)
                    heads = [t for t in marked.tolist() if tags[t] == B or t == 0 or tags[t - 1] == O]
                    for head in heads:
                        tail = head
                        while tail + 1 < len(tags) and tags[tail + 1] == I:
                            tail += 1
                        a, b = int(begin[head]), int(end[tail])
                        if not any(s < b and a < e for s, k, e in spans if k < len(PATTERNS)):
                            spans.append((a, len(PATTERNS), b))
                out[i] = [{"kind": kinds[k], "start": s, "end": e} for s, k, e in sorted(spans)]
            yield pa.RecordBatch.from_arrays(part.columns + [pa.array(out, arrow)], names=schema.names)

    return schema, run


def mask_secrets(docs: DataFrame, *, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by ``mark``; overlapping spans are one. Columns and
    their order stay, whatever their names."""
    names = docs.columns
    spans_of = "spans of " + "".join(names)
    _, find_in = _finder(docs, train(docs, key=key, text=text), text, spans_of)

    # both steps in one worker: two in a row would keep two workers a task
    def run(batches):
        for part in find_in(batches):
            values = part.column(text).to_pylist()
            for i, spans in enumerate(part.column(spans_of).to_pylist()):
                if spans:
                    pieces, at = [], 0
                    for s in spans:
                        if s["end"] <= at:
                            continue
                        pieces += [] if s["start"] < at else [values[i][at : s["start"]], mark]
                        at = s["end"]
                    values[i] = "".join(pieces) + values[i][at:]
            columns = [pa.array(values, pa.string()) if n == text else part.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
