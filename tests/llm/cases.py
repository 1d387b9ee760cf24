"""Documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key long, part long, score double, shard int"


def odd_documents(spark, seed: int = 1):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma's", "délta", "x", "Σίγμα", "日本", "1234", "don't"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [None, "", " ", "\n\n", "a", "tab\tand \x0bcontrol", "  two  blanks \n three   ", line(3), line(40), line(40), "same text here", "same text here"]
    texts += ["\n".join(line(rng.randint(0, 12)) for _ in range(rng.randint(1, 20))) for _ in range(30)] + [line(20_000), "y" * 30_000]
    rows = [(i, t, "en", f"src{i % 3}", 7, 5, 6, 1.5, 9) for i, t in enumerate(texts)]
    rows += [(None, "no key", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    rows += [rows[8], rows[8], rows[1]]
    return spark.createDataFrame(rows, COLUMNS)


def empty_documents(spark):
    return spark.createDataFrame([], COLUMNS)
