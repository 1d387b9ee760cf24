"""Quality rules and cross-document line frequency, in column functions only.

The text is read twice: a pass hashes the normalised lines of each document, and another counts
the base figures and drops the frequent lines. Texts that are equal within a host count once. A
line found in more different texts of a host than the limits allow is boilerplate there; it stays in one of
these texts (that of the smallest hash) and is removed from the others. A document that loses
more than the given part of its words is depleted. What is removed is worked out on hashes; a text is
moved to them only if the text without its lines is asked for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.session import stage

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def short_hash(value: Column) -> Column:
    """60 bits of a digest."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 15), 16, 10).cast("long")


def words_in(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def repeated_words(words: Column, size: int = 5) -> Column:
    """Words that lie in a window of ``size`` words found twice or more."""

    def positions(windows):
        same = lambda k, w: F.coalesce(F.get(windows, k)["h"] == w["h"], F.lit(False))
        twice = F.filter(windows, lambda w, k: same(k - 1, w) | same(k + 1, w))
        return F.array_sort(F.transform(twice, lambda w: w["p"]))

    def covered(places):
        start = F.struct(F.lit(-size).alias("last"), F.lit(0).cast("long").alias("sum"))
        step = lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(F.lit(size), p - a["last"])).alias("sum"))
        return F.aggregate(places, start, step, lambda a: a["sum"])

    each = F.transform(
        F.sequence(F.lit(1), F.size(words) - (size - 1)),
        lambda i: F.struct(F.xxhash64(F.slice(words, i, F.lit(size))).alias("h"), i.alias("p")),
    )
    return F.when(F.size(words) <= size, F.lit(0).cast("long")).otherwise(covered(let(F.array_sort(each), positions)))


def line_rules(
    docs: DataFrame, *, host: str = "source", key: str = "doc_id", text: str = "text", most: int = 20, few: int = 5, share: float = 0.2, depleted: float = 0.5
) -> DataFrame:
    """One row per document: key, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, removed_words, kept, text.

    ``text`` is the text without its frequent lines; the other lines stay as they are, in their
    order. ``removed_words`` counts what it lacks; the base figures are those of the whole text.

    A line is frequent in a host if it is in more than ``most`` of its different texts, whatever
    the host's size; and also if it is in more than ``few`` and in more than ``share`` of them. A
    null text has no words, so it fails the base rules; a null host is a host of its own; null
    and repeated keys are kept; other columns are ignored.
    """
    content = F.coalesce(F.col("text"), F.lit(""))
    name = F.coalesce(F.concat(F.lit("h"), "host"), F.lit("")).alias("name")
    rows = docs.select(F.col(key).alias("key"), F.col(host).cast("string").alias("host"), F.col(text).cast("string").alias("text"))
    rows = rows.select("key", "host", "text", name, short_hash(content).alias("hash"))
    normal = lambda x: F.trim(F.lower(F.regexp_replace(x, r"[\x20\x09\x0B-\x0D]+", " ")))
    line = lambda x: F.struct(short_hash(x).alias("line"), F.size(F.split(x, " ")).cast("long").alias("words"))
    lines = F.transform(F.filter(F.transform(F.split(content, "\n"), normal), lambda x: x != ""), line)
    gone = removed(rows.select("name", "hash", lines.alias("lines")), most=most, few=few, share=share)

    with_word = let(F.filter(F.split(content, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    figures = rows.withColumn("all_words", words_in(content)).select(
        "key", "host", "name", "hash", "text",
        F.size("all_words").cast("long").alias("n_words"),
        F.char_length(F.concat_ws("", "all_words")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(content, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        with_word.cast("long").alias("n_dup_lines"),
        repeated_words(F.col("all_words")).alias("n_repeat_words"),
    )
    stays = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("gone", short_hash(normal(x))))
    clean = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = figures.join(gone, ["name", "hash"], "left").withColumns({"base_failed": failed, "removed_words": F.coalesce("removed", F.lit(0))})
    kept = ~F.col("base_failed") & (F.col("removed_words") <= depleted * F.col("n_words"))
    base = [F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words")]
    return judged.select(F.col("key").alias(key), F.col("host").alias(host), *base, kept.alias("kept"), clean.alias(text))


def removed(hashed: DataFrame, *, most: int, few: int, share: float) -> DataFrame:
    """``name, hash, removed, gone``: for texts that lose lines, how many words and which lines.

    ``hashed`` has name (the host), hash (of the text) and lines (hash and words of each).
    """
    hashed = stage(hashed, "lines")
    texts = hashed.groupBy("name", "hash").agg(F.any_value("lines").alias("lines"))
    texts = stage(texts.select("name", "hash", F.explode("lines").alias("x")).groupBy("name", "hash", "x.line").agg(F.sum("x.words").alias("words")), "text-lines")
    sizes = hashed.select("name", "hash").distinct().groupBy("name").agg(F.count("*").alias("texts"))
    counts = texts.groupBy("name", "line").agg(F.count("*").alias("n"), F.min("hash").alias("first")).where(F.col("n") > few)
    often = counts.join(sizes, "name").where((F.col("n") > most) | (F.col("n") > share * F.col("texts"))).select("name", "line", "first")
    gone = texts.join(stage(often, "frequent-lines"), ["name", "line"]).where("hash <> first")
    return stage(gone.groupBy("name", "hash").agg(F.sum("words").alias("removed"), F.collect_list("line").alias("gone")), "removed")
