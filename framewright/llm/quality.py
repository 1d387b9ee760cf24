"""Quality by a regularised quadratic discriminant over statistics of whole texts.

Each text gives a vector of statistics: shares go through the arc sine of their root and sizes
through a logarithm, so that they spread more evenly. The rows of a label are described by a mean and a
covariance, worked out from sums over all labelled rows. A covariance is shrunk towards that of
both labels together and then towards a multiple of the unit matrix; its Cholesky factor is kept
with the model, so that a score costs one product with the inverse of the factor. The difference
of the two log densities becomes a probability by a logistic curve, fitted on labelled rows that
the covariances under trial have not seen; the strength of shrinking is the one with the least
loss there.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.llm.texts import slices, words_of
from framewright.session import stage

#: Shrinking under trial: towards the common covariance, and towards the unit matrix.
TOWARDS_COMMON = (0.02, 0.1, 0.3, 0.6)
TOWARDS_UNIT = (0.003, 0.03, 0.15)
#: Log-density differences count up to this size; cells of the table that the curve is fitted on.
MOST, CELLS = 200.0, 2000

_CLASS = np.zeros(256, np.uint8)
_CLASS[list(range(65, 91))] = 1
_CLASS[list(range(97, 123))] = 2
_CLASS[list(range(48, 58))] = 3
_CLASS[list(b"#*$%&|<>@\\^_~`{}[]+=/")] = 4
_CLASS[list(b"!?")] = 5
_CLASS[list(b".,;:'\"()-")] = 6
_CLASS[[32, 9, 10, 11, 12, 13]] = 7
_CLASS[list(range(0x80, 0xC0))] = 8
_CLASS[list(range(0xC0, 0x100))] = 9

NAMES = (
    "words", "word_length", "word_length_spread", "upper", "digits", "symbols", "calls", "stops", "beyond_ascii", "symbol_words", "call_words",
    "upper_words", "different_words", "commonest_word", "same_neighbours", "different_pairs", "lines", "repeated_lines",
)


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums between the bounds."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[bounds])


def _different(text: np.ndarray, value: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Different values of each text, and how often the commonest occurs."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    most = np.zeros(count, np.int64)
    np.maximum.at(most, text[first], np.diff(np.append(first, len(text))))
    return np.bincount(text[first], minlength=count), most


def statistics_of(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text; all zero for a text without words."""
    words = words_of(texts, lower=False)
    n = len(texts)
    classes = _CLASS[words.data]
    of = lambda *kinds: _per_text(np.isin(classes, kinds), words.offsets)
    upper, lower, digits, symbols, calls, stops, beyond = of(1), of(2), of(3), of(4), of(5), of(6), of(9)
    solid = np.maximum(upper + lower + digits + symbols + calls + stops + beyond, 1)
    count = np.diff(words.of_text)
    some = np.maximum(count, 1)
    text = np.repeat(np.arange(n), count)
    chars = np.concatenate([[0], np.cumsum(classes != 8, dtype=np.int64)])
    size = chars[words.ends] - chars[words.starts]
    total, squares = _per_text(size, words.of_text), _per_text(size * size, words.of_text)
    mean = total / some
    last = classes[words.ends - 1] if len(text) else np.zeros(0, np.uint8)
    ups = np.concatenate([[0], np.cumsum(classes == 1, dtype=np.int64)])
    lows = np.concatenate([[0], np.cumsum(classes == 2, dtype=np.int64)])
    shouted = (ups[words.ends] - ups[words.starts] >= 2) & (lows[words.ends] == lows[words.starts])
    different, commonest = _different(text, words.codes, n)
    same = np.zeros(len(text), bool)
    same[1:] = (words.codes[1:] == words.codes[:-1]) & (text[1:] == text[:-1])
    # pairs of neighbouring words: how many are met once only
    pair = words.codes[:-1].astype(np.int64) * (len(words.distinct) + 1) + words.codes[1:]
    inside = text[1:] == text[:-1]
    pairs, _ = _different(text[:-1][inside], pair[inside], n)
    breaks = np.flatnonzero(words.data == 10)
    lines, repeated = _lines(words, breaks, n)
    share = lambda part, whole: np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))
    per_word = lambda flags: share(_per_text(flags, words.of_text), some)
    found = [
        np.log1p(count), np.log1p(mean), np.log1p(np.sqrt(np.maximum(squares / some - mean * mean, 0))), share(upper, solid), share(digits, solid), share(symbols, solid),
        share(calls, solid), share(stops, solid), share(beyond, solid), per_word(last == 4), per_word(last == 5), per_word(shouted), share(different, some),
        share(commonest, some), per_word(same), share(pairs, some - 1), np.log1p(count / np.maximum(lines, 1)), share(repeated, lines),
    ]
    return np.where((count > 0)[:, None], np.stack(found, axis=1), 0.0)


def _lines(words, breaks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word in each text, and those of them that repeat an earlier one, by their words."""
    if not len(words.starts):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    text = np.repeat(np.arange(n), np.diff(words.of_text))
    line = np.searchsorted(breaks, words.starts)
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    # a line's words in order, as one number: a sum of mixed codes times their places
    place = np.arange(len(line)) - first[np.cumsum(new) - 1]
    with np.errstate(over="ignore"):
        mixed = (words.codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * (2 * place.astype(np.uint64) + np.uint64(0xBF58476D1CE4E5B9))
        whole = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), first)
    count = np.bincount(text[first], minlength=n)
    different, _ = _different(text[first], whole.view(np.int64), n)
    return count, count - different


def statistics(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, x``: the statistics of every row's text; a null text is empty."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["key"], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for part in slices(batches, "text"):
            found = statistics_of(part.column("text"))
            ends = np.arange(len(found) + 1, dtype=np.int32) * len(NAMES)
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))], names=["key", "x"])

    return rows.mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    """``share`` is the smoothed share of good rows; the rest is there if both labels were seen.
    ``whiten`` has the inverse Cholesky factor of each label's covariance, in units of ``scale``."""

    share: float
    scale: np.ndarray | None = None
    means: tuple[np.ndarray, ...] = ()
    whiten: tuple[np.ndarray, ...] = ()
    log_roots: tuple[float, ...] = ()
    slope: float = 0.0
    shift: float = 0.0
    shrink: tuple[float, float] = (0.0, 0.0)
    loss: float = 0.0

    def differences(self, x: np.ndarray) -> np.ndarray:
        """The log density of good rows less that of bad ones, up to ``MOST`` in size."""
        found = []
        for mean, whiten, log_root in zip(self.means, self.whiten, self.log_roots):
            z = ((x - mean) / self.scale) @ whiten.T
            found.append(-0.5 * np.einsum("ij,ij->i", z, z) - log_root)
        return np.clip(found[1] - found[0], -MOST, MOST)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.differences(x) + self.shift, -500, 500)))


def _matrix(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def _moments(labelled: DataFrame) -> dict[tuple[int, bool], np.ndarray]:
    """Sums of 1, x and x times x over the rows of each label, apart for rows on trial."""
    d = len(NAMES)

    def run(batches):
        for batch in batches:
            x, label, trial = _matrix(batch.column("x")), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "trial"))
            found = []
            for k, t in product((0, 1), (False, True)):
                own = x[(label == k) & (trial == t)]
                found.append((k, t, np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()]).tolist()))
            columns = [pa.array(c, k) for c, k in zip(zip(*found), (pa.int32(), pa.bool_(), pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "trial", "sums"])

    parts = labelled.mapInArrow(run, "label int, trial boolean, sums array<double>")
    rows = parts.select("label", "trial", F.posexplode("sums").alias("at", "sum")).groupBy("label", "trial", "at").agg(F.sum("sum").alias("sum")).collect()
    found = {k: np.zeros(1 + d + d * d) for k in product((0, 1), (False, True))}
    for r in rows:
        found[r.label, r.trial][r.at] = r.sum
    return found


def _described(sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, mean and covariance."""
    d, n = len(NAMES), sums[0]
    mean = sums[1 : d + 1] / n
    return n, mean, sums[d + 1 :].reshape(d, d) / n - np.outer(mean, mean)


def _discriminant(sums: list[np.ndarray], shrink: tuple[float, float], **more) -> Model:
    """The model of sums for labels 0 and 1, with covariances shrunk."""
    (n0, mean0, own0), (n1, mean1, own1) = map(_described, sums)
    common = (n0 * own0 + n1 * own1) / (n0 + n1)
    scale = np.sqrt(np.maximum(np.diag(common), 1e-8))
    to_common, to_unit = shrink
    whiten, log_roots = [], []
    for own in (own0, own1):
        mixed = ((1 - to_common) * own + to_common * common) / np.outer(scale, scale)
        mixed = (1 - to_unit) * mixed + to_unit * max(np.trace(mixed) / len(NAMES), 1e-6) * np.eye(len(NAMES))
        factor = np.linalg.cholesky((mixed + mixed.T) / 2)
        whiten.append(np.linalg.inv(factor))
        log_roots.append(float(np.log(np.diag(factor)).sum()))
    return Model((n1 + 1) / (n0 + n1 + 2), scale, (mean0, mean1), tuple(whiten), tuple(log_roots), shrink=shrink, **more)


def _curve(value: np.ndarray, bad: np.ndarray, good: np.ndarray) -> tuple[float, float, float]:
    """Slope, shift and mean loss of the logistic curve for counted values; its targets are
    smoothed by one row, so that labels that never mix give a finite slope."""
    high, low = (good.sum() + 1) / (good.sum() + 2), 1 / (bad.sum() + 2)
    weight = good + bad
    target = (good * high + bad * low) / np.maximum(weight, 1)
    slope, shift = 0.05, 0.0

    def loss_at(a, b):
        t = np.clip(a * value + b, -500, 500)
        return float((weight * (np.logaddexp(0, t) - target * t)).sum() / weight.sum())

    loss = loss_at(slope, shift)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * value + shift, -500, 500)))
        gradient = np.array([(weight * (p - target) * value).sum(), (weight * (p - target)).sum()])
        w = weight * p * (1 - p)
        curved = np.array([[(w * value * value).sum(), (w * value).sum()], [(w * value).sum(), w.sum()]]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(curved, gradient)
        while (new := loss_at(slope - step[0], shift - step[1])) > loss and np.abs(step).max() > 1e-12:
            step /= 2
        slope, shift, gain, loss = slope - step[0], shift - step[1], loss - new, new
        if gain < 1e-12:
            break
    return float(slope), float(shift), loss


def train(found: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality") -> Model:
    """The model of all labelled rows of ``found`` (what ``statistics`` gives).

    A key with several labels counts as its least; null keys and labels are left out. Rows whose
    key's hash falls in a quarter choose the shrinking and fit the curve. With fewer than two rows
    of a label in either part, every score is the share of good rows.
    """
    own = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("label in (0, 1)").groupBy("key").agg(F.min("label").alias("label"))
    trial = (F.pmod(F.xxhash64("key"), F.lit(4)) == 0).alias("trial")
    labelled = stage(found.join(own, "key").select("x", "label", trial), "labelled")
    sums = _moments(labelled)
    n0, n1 = (sums[k, False][0] + sums[k, True][0] for k in (0, 1))
    if min(s[0] for s in sums.values()) < 2:
        return Model((n1 + 1) / (n0 + n1 + 2))
    trials = [_discriminant([sums[k, False] for k in (0, 1)], s) for s in product(TOWARDS_COMMON, TOWARDS_UNIT)]
    shared = labelled.sparkSession.sparkContext.broadcast(trials)

    def run(batches):
        for batch in batches:
            x, label = _matrix(batch.column("x")), batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            for i, model in enumerate(shared.value):
                cell = np.rint((model.differences(x) + MOST) * (CELLS / (2 * MOST))).astype(np.int64)
                place, n = np.unique(2 * cell + label, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), i)), pa.array(place), pa.array(n)], names=["model", "place", "n"])

    counted = labelled.where("trial").mapInArrow(run, "model long, place long, n long").groupBy("model", "place").agg(F.sum("n").alias("n")).collect()
    table = np.zeros((len(trials), CELLS + 1, 2))
    for r in counted:
        table[r.model, r.place // 2, r.place % 2] = r.n
    value = np.arange(CELLS + 1) * (2 * MOST / CELLS) - MOST
    curves = [_curve(value, t[:, 0], t[:, 1]) for t in table]
    best = min(range(len(trials)), key=lambda i: (round(curves[i][2], 4), -i))
    slope, shift, loss = curves[best]
    return _discriminant([sums[k, False] + sums[k, True] for k in (0, 1)], trials[best].shrink, slope=slope, shift=shift, loss=loss)


def score(found: DataFrame, model: Model, *, key: str = "doc_id", least: float = 0.7) -> DataFrame:
    """``key, score, predicted`` of every row: the chance of label 1, and whether it is ``least`` or more."""
    shared = found.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = shared.value.scores(_matrix(batch.column("x")))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores), pa.array((scores >= least).astype(np.int32))], names=["key", "score", "predicted"])

    schema = T.StructType([found.schema["key"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return found.mapInArrow(run, schema).withColumnRenamed("key", key)


def rate(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", least: float = 0.7) -> DataFrame:
    """``key, score, predicted``: every text scored by a model of the labelled ones.

    A null text is empty, and a text without words has the vector zero; null and repeated keys
    are kept; other columns, and clashing ones, are ignored.
    """
    found = stage(statistics(docs, key=key, text=text), "statistics")
    return score(found, train(found, labels, key=key, label=label), key=key, least=least)
