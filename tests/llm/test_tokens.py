"""Packing, coded token files and shards against direct computations."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from framewright.llm import ans, packing, sharding
from framewright.llm.texts import Encoder, words_of
from framewright.session import scratch_path
from tests.llm.cases import empty_documents, odd_documents

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(path, texts, end_id):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id] for t in texts]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_whole_text_encoding(path):
    rng = random.Random(3)
    alphabet = " \n\n..,AB\ta'b1é  ñ!日́Σ\x1c"
    texts = [None, "", "<|endoftext|> x", "x "] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    ids, bounds = Encoder(path)(pa.array(texts), 7)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == plain_ids(path, texts, 7)


def test_encoder_with_little_memory_of_pieces():
    rng = random.Random(4)
    encode = Encoder(WORD, remember=40)
    for _ in range(20):
        texts = [" ".join(rng.choice("the cat Sat dogs é 12 run").strip() + str(rng.randint(0, 30)) for _ in range(12)) for _ in range(3)]
        ids, bounds = encode(pa.array(texts), 7)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == plain_ids(WORD, texts, 7)


def test_words():
    words = words_of(pa.array([None, "a B\x0b c", "", "  ", "A"]))
    assert [words.distinct[c].as_py() for c in words.codes] == [b"a", b"b", b"c", b"a"]
    assert words.of_text.tolist() == [0, 0, 3, 3, 3, 4]


def check_packing(docs, window):
    rows = docs.collect()
    got = packing.pack(docs, vocabulary=WORD, end_id=1, window=window).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    want = defaultdict(list)
    for row, ids in zip(rows, plain_ids(WORD, [r.text for r in rows], 1)):
        want[row.doc_id].append(ids)
    assert sum(r.length for r in got) == sum(len(i) for v in want.values() for i in v)
    for key, documents in want.items():
        if len(documents) == 1:
            own = sorted(pieces[key], key=lambda r: r.start)
            assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist() == documents[0]
            assert all(r.doc_tokens == len(documents[0]) for r in own)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and r.length == len(r.ids) // 4 > 0
            at += r.length
        assert at == own[0].sequence_length and (at == window or at & (at - 1) == 0)


@pytest.mark.parametrize("window", [1, 7, 64, 2048])
def test_packing(spark, window):
    check_packing(odd_documents(spark), window)


def test_packing_empty(spark):
    assert packing.pack(empty_documents(spark), vocabulary=WORD, end_id=1).count() == 0


def test_level_choice_is_the_least_sum_of_squares():
    rng = random.Random(5)
    packer = packing.SumOfSquares(24)
    for _ in range(2000):
        length = rng.randint(1, 23)
        squares = lambda c: int((c[1:24] ** 2).sum())
        options = {}
        for level in [0] + [h for h in range(1, 25 - length) if packer.levels[h]]:
            counts = packer.levels.copy()
            counts[level] -= 1 if level else 0
            counts[level + length] += 1
            options[level] = squares(counts)
        chosen = packer.level_for(length)
        assert options[chosen] == min(options.values())
        packer.place((0, 0, np.zeros(length, np.uint32), length))


def test_coder_round_trip():
    rng = np.random.default_rng(2)
    ids = (rng.zipf(1.3, 70_000) % 5000).astype(np.uint32)
    tokens, counts = np.unique(ids, return_counts=True)
    freq = ans.frequencies(counts)
    assert freq.sum() == 1 << ans.SCALE and freq.min() >= 1
    coder = ans.Coder(tokens.astype(np.int64), freq)
    for n in (0, 1, 5, 999, 70_000):
        for lanes, stride in ((1, 3), (64, 10), (1024, 128)):
            stream, kept = coder.encode(ids[:n], lanes, stride)
            assert (coder.decode(n, lanes, stride, kept, stream) == ids[:n]).all()
    p = counts / counts.sum()
    assert len(stream) < 1.03 * 70_000 * -(p * np.log2(p)).sum() / 8 + 8


@pytest.mark.parametrize("block", [50, 1 << 19])
def test_token_files(spark, block):
    docs = odd_documents(spark)
    path = scratch_path(spark, "test-rans")
    ans.write_tokens(docs, path, vocabulary=BYTE, end_id=2, block_tokens=block)
    got = sorted(ans.read_tokens(spark, path).collect(), key=lambda r: r.start)
    rows = docs.collect()
    want = defaultdict(list)
    for row, ids in zip(rows, plain_ids(BYTE, [r.text for r in rows], 2)):
        want[row.doc_id].append(ids)
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)
    at, found = 0, defaultdict(list)
    for r in got:
        assert r.start == at
        at += r.n_tokens
        found[r.doc_id].append(np.frombuffer(r.ids, "<u4").tolist())
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_damaged_block_raises(spark):
    path = scratch_path(spark, "test-rans")
    ans.write_tokens(odd_documents(spark), path, vocabulary=BYTE, end_id=2)
    import pyspark.sql.functions as F

    blocks = spark.read.parquet(f"{path}/blocks").withColumn("stream", F.concat("stream", F.lit(b"\x01\x02\x03\x04")))
    blocks.write.parquet(f"{path}-bad/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{path}-bad/table")
    with pytest.raises(Exception, match="damaged"):
        ans.read_tokens(spark, f"{path}-bad").collect()


def test_token_files_empty(spark):
    path = scratch_path(spark, "test-rans")
    ans.write_tokens(empty_documents(spark), path, vocabulary=BYTE, end_id=2)
    assert ans.read_tokens(spark, path).count() == 0


def test_shards(spark):
    docs = odd_documents(spark)
    weights, grown = dict.fromkeys(range(8), 1.0), dict.fromkeys(range(9), 1.0)
    got = sharding.assign(docs, weights, grown=grown).collect()
    rows = docs.collect()
    crc = lambda t: zlib.crc32((t or "").encode())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(r.doc_id), len((r.text or "").encode()) + 1, crc(r.text)) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})
    assert sharding.assign(empty_documents(spark), weights).count() == 0


def test_weights_set_the_shares(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id").selectExpr("doc_id", "'t' as text")
    got = dict(sharding.assign(rows, {0: 1.0, 1: 3.0}).groupBy("shard").count().collect())
    assert abs(got[1] / 20_000 - 0.75) < 0.02
    with pytest.raises(ValueError):
        sharding.assign(rows, {0: 0.0})
