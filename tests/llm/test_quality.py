"""Statistics, model and scores against plain computations, and accuracy on rows held out."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framewright.llm import quality, queries
from tests.llm.cases import empty_documents, odd_documents


def plain_statistics(text):
    """The same figures, word by word."""
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return dict.fromkeys(quality.NAMES, 0.0)
    n = len(words)
    share = lambda part, whole: math.asin(math.sqrt(min(1, part / max(whole, 1))))
    symbols, calls, stops = "#*$%&|<>@\\^_~`{}[]+=/", "!?", ".,;:'\"()-"
    kinds = {
        "upper": lambda c: "A" <= c <= "Z", "lower": lambda c: "a" <= c <= "z", "digits": lambda c: c in "0123456789", "symbols": lambda c: c in symbols,
        "calls": lambda c: c in calls, "stops": lambda c: c in stops, "beyond_ascii": lambda c: ord(c) > 127,
    }
    of = {k: sum(map(f, text)) for k, f in kinds.items()}
    solid = sum(of.values())
    sizes = [len(w) for w in words]
    mean = sum(sizes) / n
    lines = [x for x in (re.findall(r"[^\x20\x09-\x0D]+", line) for line in text.split("\n")) if x]
    pairs = list(zip(words, words[1:]))
    shouted = [w for w in words if sum("A" <= c <= "Z" for c in w) >= 2 and not any("a" <= c <= "z" for c in w)]
    return {
        "words": math.log1p(n), "word_length": math.log1p(mean), "word_length_spread": math.log1p(math.sqrt(max(0, sum(s * s for s in sizes) / n - mean * mean))),
        **{k: share(of[k], solid) for k in ("upper", "digits", "symbols", "calls", "stops", "beyond_ascii")},
        "symbol_words": share(sum(w[-1] in symbols for w in words), n), "call_words": share(sum(w[-1] in calls for w in words), n), "upper_words": share(len(shouted), n),
        "different_words": share(len(set(words)), n), "commonest_word": share(Counter(words).most_common(1)[0][1], n), "same_neighbours": share(sum(a == b for a, b in pairs), n),
        "different_pairs": share(len(set(pairs)), n - 1), "lines": math.log1p(n / len(lines)), "repeated_lines": share(len(lines) - len(set(map(tuple, lines))), len(lines)),
    }


def test_statistics(spark):
    rows = odd_documents(spark).collect()
    texts = [r.text for r in rows] + ["A!! BB!! CC!!", "a### b$$$\na### b$$$\n\na###", "x x x x", "control \x01 sign"]
    got = quality.statistics_of(pa.array(texts))
    for text, own in zip(texts, got):
        want = plain_statistics(text)
        if "\x01" in (text or "") or "\x0b" in (text or ""):
            continue  # characters of no class
        assert dict(zip(quality.NAMES, own)) == pytest.approx(want, abs=1e-9), text
    assert quality.statistics_of(pa.array([], pa.string())).shape == (0, len(quality.NAMES))


def written(rng, good):
    words = ["the", "river", "runs", "below", "an", "old", "mill", "where", "two", "roads", "meet", "again", "today"]
    own = [rng.choice(words) for _ in range(rng.randint(20, 120))]
    if not good:
        kind = rng.randrange(3)
        own = [f"{w}{rng.choice(['###', '$$$'])}" for w in own] if kind == 0 else [w.upper() + "!!" for w in own] if kind == 1 else own[:1] * len(own)
    return " ".join(own) + "."


def labelled(spark, n=400):
    rng = random.Random(3)
    rows = [(i, written(rng, i % 4 > 0), int(i % 4 > 0)) for i in range(n)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"), {r[0]: r[2] for r in rows}


def test_model(spark):
    """Means, covariances and densities against NumPy over the same rows."""
    docs, labels, of = labelled(spark)
    found = quality.statistics(docs)
    model = quality.train(found, labels)
    rows = found.collect()
    x, y = np.array([r.x for r in rows]), np.array([of[r.key] for r in rows])
    common = sum((y == k).sum() * np.cov(x[y == k].T, bias=True) for k in (0, 1)) / len(y)
    scale = np.sqrt(np.maximum(np.diag(common), 1e-8))
    a, b = model.shrink
    want = []
    for k in (0, 1):
        mixed = ((1 - a) * np.cov(x[y == k].T, bias=True) + a * common) / np.outer(scale, scale)
        mixed = (1 - b) * mixed + b * np.trace(mixed) / len(scale) * np.eye(len(scale))
        z = (x - x[y == k].mean(axis=0)) / scale
        want.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(mixed), z) - 0.5 * np.linalg.slogdet(mixed)[1])
    assert model.differences(x) == pytest.approx(np.clip(want[1] - want[0], -quality.MOST, quality.MOST), rel=1e-6, abs=1e-6)
    scored = {r.doc_id: r for r in quality.score(found, model).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored.values())
    assert sum(scored[i].predicted == k for i, k in of.items()) >= 0.98 * len(of)


def test_curve_of_labels_that_never_mix():
    value = np.linspace(-10, 10, 21)
    slope, shift, loss = quality._curve(value, (value < 0) * 50.0, (value > 0) * 50.0)
    assert 0 < slope < 100 and abs(shift) < 10 and loss < 0.2


def test_odd_inputs(spark):
    docs, labels, _ = labelled(spark)
    odd = odd_documents(spark).withColumns({"x": F.lit("y"), "label": F.lit(1), "trial": F.lit(2)})
    every = docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text").unionByName(odd, allowMissingColumns=True)
    moved = labels.select((F.col("doc_id") + 1000).alias("doc_id"), "quality")
    moved = moved.unionByName(moved.where("doc_id < 1010")).unionByName(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int"))
    got = quality.rate(every, moved)
    assert got.count() == every.count() and got.where("score is null or isnan(score) or score < 0 or score > 1").isEmpty()
    assert quality.rate(empty_documents(spark), labels).count() == 0
    none = quality.rate(odd, labels.limit(0)).collect()
    assert len(none) == odd.count() and {r.score for r in none} == {0.5}
    one = quality.rate(docs, labels.where("quality = 1")).select("score").distinct().collect()
    assert len(one) == 1 and one[0].score > 0.99


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="needs the driver's tables")
def test_held_out(spark):
    """Accuracy of the registered query on labelled rows that it never learns from."""
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.QUERIES["op11_quadratic_discriminant"](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    own = [r for r in got if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.held_out for r in own)
    good, bad = ([r.predicted for r in own if labels[r.doc_id] == k] for k in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05
