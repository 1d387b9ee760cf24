"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a lexicon, with block-max
inverted indexes.

The lexicon holds words and beginnings of words that are far more frequent in toxic examples
than in others. It is chosen on a bounded sample of labelled documents, which are the examples
too, and cosines are taken over it alone, not over all words of a text: in texts where a few
words tell, all the others would decide which examples are near. Document
frequencies are counted over all documents. Examples lie in blocks; for every term and block
the greatest weight is kept, so a block's best possible cosine is known before its postings are
read, and blocks that cannot reach the k nearest are never opened. The k nearest are exact.

The vote is weighted by cosine and by how much of each class was sampled, and a monotone curve
fitted on votes of examples among the others turns it into a rate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.llm.texts import slices, words_of
from framewright.session import stage

BLOCK = 64
START = 5
_EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_=+/\\~`^@"


def terms_of(distinct: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The word without marks at its ends, and its first letters if it is longer."""
    words = pc.utf8_trim(distinct.cast(pa.string()), _EDGES)
    longer = pc.greater(pc.utf8_length(words), START)
    starts = pc.if_else(longer, pc.binary_join_element_wise("^", pc.utf8_slice_codeunits(words, 0, START), ""), None)
    return words, starts


def _texts(column: pa.Array) -> pa.Array:
    return column.cast(pa.string())


def _counts(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and number of every term in every text, ordered by row and term."""
    words = words_of(texts)
    n = np.int64(len(vocabulary))
    keys = []
    row = np.repeat(np.arange(len(texts)), np.diff(words.of_text))
    for terms in terms_of(words.distinct):
        place = pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        term = place[words.codes]
        hit = term >= 0
        keys.append(row[hit] * n + term[hit])
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key // max(n, 1), key % max(n, 1), count


@dataclass
class Index:
    """Examples by blocks. Postings of a term are ordered by example."""

    vocabulary: list[str]
    idf: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    first: np.ndarray
    example: np.ndarray
    value: np.ndarray
    none: tuple[float, float]
    blocks: list
    keys: pa.Array
    curve: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        values = (1 + np.log(counts)) * self.idf[terms]
        return values / np.sqrt((values**2).sum())

    def nearest(self, terms: np.ndarray, values: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest cosine above 0 (of equal ones the first), and the cosines."""
        bound = np.zeros(-(-len(self.label) // BLOCK))
        for t, v in zip(terms.tolist(), values.tolist()):
            ids, most = self.blocks[t]
            bound[ids] += v * most
        order = np.argsort(-bound, kind="stable")
        order = order[: int((bound > 0).sum())]
        found, cosine = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 8
        while at < len(order):
            if len(found) == k and bound[order[at]] < cosine[-1] - 1e-12:
                break
            opened = np.zeros(len(bound), bool)
            opened[order[at : at + step]] = True
            ids, parts = [], []
            for t, v in zip(terms.tolist(), values.tolist()):
                own = slice(self.first[t], self.first[t + 1])
                mine = opened[self.example[own] // BLOCK]
                ids.append(self.example[own][mine])
                parts.append(v * self.value[own][mine])
            ids, place = np.unique(np.concatenate(ids), return_inverse=True)
            dots = np.bincount(place, np.concatenate(parts), len(ids))
            keep = (ids != without) & (dots > 0)
            found, cosine = np.concatenate([found, ids[keep]]), np.concatenate([cosine, dots[keep]])
            best = np.lexsort((found, -cosine))[:k]
            found, cosine = found[best], cosine[best]
            at += step
            step *= 2
        return found, cosine

    def vote(self, found: np.ndarray, cosine: np.ndarray) -> float:
        """The share of toxic examples by cosine, with the rate of texts without terms as a start."""
        toxic, clean = self.none
        start = 0.5
        power = cosine * self.weight[found]
        return float(((power * self.label[found]).sum() + start * toxic / max(toxic + clean, 1e-9)) / (power.sum() + start))

    def score(self, vote: float) -> float:
        return float(np.interp(vote, *self.curve))


def _monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function of least squares, as points of a curve through its steps."""
    order = np.argsort(x, kind="stable")
    steps: list[list[float]] = []
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), w[order].tolist()):
        steps.append([b * c, c, a * c])
        while len(steps) > 1 and steps[-2][0] * steps[-1][1] >= steps[-1][0] * steps[-2][1]:
            last = steps.pop()
            steps[-1] = [p + q for p, q in zip(steps[-1], last)]
    return np.array([s[2] / s[1] for s in steps]), np.array([s[0] / s[1] for s in steps])


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    toxic: int = 6000,
    clean: int = 12000,
    vocabulary: int = 4000,
    z: float = 5.0,
    lift: float = 3.0,
    calibrate: int = 3000,
    k: int = 25,
    key: str = "doc_id",
    text: str = "text",
) -> Index:
    """An index from at most ``toxic`` and ``clean`` labelled documents of each class, those of least
    key hash. ``labels`` has key and toxic (0 or 1); a key of several labels takes the largest.

    At most ``vocabulary`` terms are chosen, by the difference of the classes in standard errors, of
    those ``lift`` times as frequent among toxic examples.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("key"), F.col("toxic").cast("int").alias("label")).dropna().groupBy("key").agg(F.max("label").alias("label"))
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    hashed = known.withColumn("h", F.xxhash64("key"))
    parts = [hashed.where(F.col("label") == c).orderBy("h", "key").limit(n) for c, n in ((1, toxic), (0, clean))]
    chosen = stage(parts[0].unionByName(parts[1]).drop("h"), "examples")
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    # one document for each key, so that the sample is bounded
    examples = stage(rows.join(chosen, "key").groupBy("key", "label").agg(F.min("text").alias("text")), "example-texts")

    def split(batches):
        for part in slices(batches, "text", 4 << 20):
            words = words_of(_texts(part.column("text")))
            label = part.column("label").to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(part.num_rows), np.diff(words.of_text))
            for terms in terms_of(words.distinct):
                encoded = terms.dictionary_encode()
                code = pc.fill_null(encoded.indices, -1).to_numpy(zero_copy_only=False)[words.codes]
                pair = np.unique(np.stack([code, row])[:, code >= 0], axis=1)
                both = [np.bincount(pair[0][label[pair[1]] == c], minlength=len(encoded.dictionary)) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([encoded.dictionary.cast(pa.string()), pa.array(both[0]), pa.array(both[1])], names=["term", "clean", "toxic"])

    counts = examples.mapInArrow(split, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n = {r.label: r.n for r in examples.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = max(n.get(1, 0), 1), max(n.get(0, 0), 1)
    pooled = (F.col("toxic") + F.col("clean")) / float(n1 + n0)
    error = F.sqrt(pooled * (1 - pooled) * (1.0 / n1 + 1.0 / n0)) + 1e-9
    gap = ((F.col("toxic") / float(n1) - F.col("clean") / float(n0)) / error).alias("gap")
    often = F.col("toxic") / float(n1) >= lift * (F.col("clean") + 0.5) / float(n0)
    ranked = counts.where(often & (F.col("toxic") >= 3) & (F.col("term") != "")).select("term", gap).where(F.col("gap") > z).orderBy(F.desc("gap"), "term").limit(vocabulary)
    terms = sorted(r.term for r in ranked.collect())
    shared = spark.sparkContext.broadcast(terms)

    def frequency(batches):
        names, seen, texts = pa.array(shared.value, pa.string()), np.zeros(len(shared.value), np.int64), 0
        for part in slices(batches, "text"):
            _, term, _ = _counts(_texts(part.column("text")), names)
            seen += np.bincount(term, minlength=len(seen))
            texts += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(seen))), pa.array(np.concatenate([[texts], seen]))], names=["term", "n"])

    # one row per term and task, summed before it is collected
    totals = {r.term: r.n for r in rows.select("text").mapInArrow(frequency, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    seen = np.array([totals.get(t, 0) for t in range(len(terms))], float)
    idf = np.log((1 + totals.get(-1, 0)) / (1 + seen)) + 1

    def vectors(batches):
        names = pa.array(shared.value, pa.string())
        for part in slices(batches, "text"):
            row, term, count = _counts(_texts(part.column("text")), names)
            ends = np.searchsorted(row, np.arange(part.num_rows + 1))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v)) for v in (term, count)]
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("label")] + lists, names=["key", "label", "terms", "counts"])

    kinds = T.StructType([examples.schema["key"], T.StructField("label", T.IntegerType())] + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("terms", "counts")])
    found = examples.mapInArrow(vectors, kinds).collect()
    share = {c: sizes.get(c, 0) / max(n.get(c, 0), 1) for c in (0, 1)}
    none = [sum(share[r.label] for r in found if not r.terms and r.label == c) for c in (1, 0)]
    # examples of one leading term lie together, so that blocks have few terms
    found = sorted((r for r in found if r.terms), key=lambda r: (max(r.terms, key=lambda t: (idf[t], t)), r.terms, r.key))
    label = np.array([r.label for r in found], float)
    index = Index(terms, idf, label, np.array([share[r.label] for r in found], float), *([None] * 3), tuple(none), [], pa.array([r.key for r in found]))
    own = [(np.array(r.terms), index.vector(np.array(r.terms), np.array(r.counts))) for r in found]
    term = np.concatenate([t for t, _ in own]) if own else np.zeros(0, np.int64)
    value = np.concatenate([v for _, v in own]) if own else np.zeros(0)
    example = np.repeat(np.arange(len(own)), [len(t) for t, _ in own])
    order = np.lexsort((example, term))
    index.example, index.value = example[order], value[order]
    index.first = np.searchsorted(term[order], np.arange(len(terms) + 1))
    for t in range(len(terms)):
        part = slice(index.first[t], index.first[t + 1])
        ids, start = np.unique(index.example[part] // BLOCK, return_index=True)
        index.blocks.append((ids, np.maximum.reduceat(index.value[part], start) if len(ids) else np.zeros(0)))
    picked = np.linspace(0, len(own) - 1, min(calibrate, len(own))).astype(int) if own else []
    votes = np.array([index.vote(*index.nearest(*own[i], k, without=i)) for i in picked])
    if len(votes):
        index.curve = _monotone(votes, label[picked], index.weight[picked])
    return index


def score(docs: DataFrame, index: Index, *, k: int = 25, limit: float = 0.7, text: str = "text") -> DataFrame:
    """All rows and columns, with ``score`` (0 to 1), ``predicted`` and ``evidence``: keys and cosines
    of the ``k`` nearest examples, the nearest first.

    Only the text is read. Texts without any term, null and empty ones among them, get the rate of
    such examples and have no neighbour; equal texts get equal scores. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)
    names = [n for n in docs.columns if n not in ("score", "predicted", "evidence")]
    fields = [docs.schema[n] for n in names]
    more = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("cosine", T.DoubleType())])))]
    schema = T.StructType(fields + more)

    def run(batches):
        keys = shared.value.keys.cast(pa.string())
        for part, scores, near in _scored(shared.value, batches, text, k):
            ends = np.concatenate([[0], np.cumsum([len(f) for f, _ in near])])
            found, cosine = (np.concatenate([np.zeros(0, kind), *x]) for kind, x in zip((np.int64, float), zip(*near)))
            pairs = pa.StructArray.from_arrays([keys.take(pa.array(found, pa.int64())), pa.array(cosine)], names=["key", "cosine"])
            extra = [pa.array(scores), pa.array((scores >= limit).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)]
            yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + extra, names=schema.names)

    return docs.select(*names).mapInArrow(run, schema)


_NONE = np.zeros(0, np.int64), np.zeros(0)


def _scored(model: Index, batches, text: str, k: int):
    """Slices of the batches with the scores of their rows and the nearest examples of each."""
    vocabulary = pa.array(model.vocabulary, pa.string())
    toxic, clean = model.none
    rest = toxic / (toxic + clean) if toxic + clean else 0.0
    seen: dict[bytes, tuple] = {}
    for part in slices(batches, text):
        row, term, count = _counts(_texts(part.column(text)), vocabulary)
        ends = np.searchsorted(row, np.arange(part.num_rows + 1))
        scores, near = np.full(part.num_rows, rest), [_NONE] * part.num_rows
        for i in np.flatnonzero(np.diff(ends)).tolist():
            own = slice(ends[i], ends[i + 1])
            name = term[own].tobytes() + count[own].tobytes()
            if name not in seen:
                if len(seen) > 20_000:
                    seen.clear()
                nearest = model.nearest(term[own], model.vector(term[own], count[own]), k)
                seen[name] = model.score(model.vote(*nearest)), nearest
            scores[i], near[i] = seen[name]
        yield part, scores, near


def drop_toxic(docs: DataFrame, labels: DataFrame, *, limit: float = 0.7, k: int = 25, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that score below ``limit``; columns and their order stay."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, k=k, key=key, text=text))

    def run(batches):
        for part, scores, _ in _scored(shared.value, batches, text, k):
            yield part.filter(pa.array(scores < limit))

    return docs.mapInArrow(run, docs.schema)
