"""The model against a direct computation with dictionaries."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from framewright.llm import ngrams
from tests.llm.cases import empty_documents, odd_documents


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def plain_model(texts):
    words, pairs = Counter(), Counter()
    for text in texts:
        own = tokens(text)
        words.update(own)
        pairs.update(zip(["<begin>", *own], own))
    classes = lambda counts: [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    d2 = [0.0, *ngrams.discounts(classes(pairs.values()))]
    behind, ahead = Counter(b for _, b in pairs), defaultdict(list)
    for (a, _), n in pairs.items():
        ahead[a].append(n)
    d1 = [0.0, *ngrams.discounts(classes(behind.values()))]
    total, mass = sum(behind.values()), sum(d1[min(c, 3)] for c in behind.values())

    def low(b):
        return (max(behind[b] - d1[min(behind[b], 3)], 0) + mass / (len(words) + 1)) / total

    def p(a, b):
        own = ahead.get(a)
        if not own:
            return low(b)
        n = pairs[a, b]
        return (max(n - d2[min(n, 3)], 0) + sum(d2[min(c, 3)] for c in own) * low(b)) / sum(own)

    return words, p


def test_scores(spark):
    docs = odd_documents(spark)
    learn = docs.where(F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)))
    words, p = plain_model([r.text for r in learn.collect()])
    got = ngrams.score(docs, ngrams.train(learn)).collect()
    total, distinct = sum(words.values()), len(words)
    for r in got:
        own = tokens(r.text)
        assert r.n_tokens == len(own) and r.train_tokens == total
        assert r.n_known == sum(words[w] > 0 for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((words[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own), rel=1e-9)
        assert r.score == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(["<begin>", *own], own)), rel=1e-9)
    known = [*words, "never seen"]
    for a in ("<begin>", "alpha", "never seen"):
        assert sum(p(a, b) for b in known) == pytest.approx(1)


def test_empty(spark):
    model = ngrams.train(empty_documents(spark))
    assert ngrams.score(empty_documents(spark), model).count() == 0
    assert all(math.isfinite(r.score) for r in ngrams.score(odd_documents(spark), model).collect())


def test_folder_must_be_mounted():
    with pytest.raises(ValueError):
        ngrams.open_folder("hdfs://store/model")
