"""Token ids as files coded with a static range asymmetric numeral system (rANS).

One frequency table, counted over the whole corpus, is shared by all blocks. A block holds
the ids of whole documents and is coded on its own: id t of a block belongs to lane
``t % lanes``, every lane has a 64-bit state, and all lanes write 32-bit words to one stream.
Every ``stride`` steps the states and the place in the stream are kept, so that a decoder can
start there; `decode` runs all parts of a block side by side. Each block has checksums of its
stream and of its ids.

Files (Parquet, so that writes are committed whole and lost tasks leave nothing):

* ``table``: token, frequency. Frequencies sum to 2**SCALE and are at least 1.
* ``blocks``: part, block, first, n_tokens, doc_ids, doc_tokens, lanes, stride, checkpoints,
  stream, stream_crc32, ids_crc32. Parts ascend by document, blocks within a part too, and
  ``first`` counts the ids of the part before the block.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.texts import encoder, slices
from framewright.session import stage

SCALE = 20
LANES = 1024
STRIDE = 128
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_MASK = np.uint64((1 << SCALE) - 1)
_SHIFT = np.uint64(SCALE)


def frequencies(counts: np.ndarray, total: int = 1 << SCALE) -> np.ndarray:
    """Counts scaled to sum to ``total``, each at least 1; all must be positive."""
    if len(counts) > total // 2:
        raise ValueError(f"{len(counts)} different tokens do not fit a table of {total}")
    scaled = np.maximum(1, np.floor(counts / counts.sum() * total)).astype(np.int64)
    order = np.argsort(-scaled, kind="stable")
    excess = int(scaled.sum()) - total
    if excess < 0:
        scaled[order[0]] -= excess
    while excess > 0:
        cut = np.minimum(scaled[order] - 1, np.ceil(scaled[order] / scaled.sum() * excess).astype(np.int64))
        cut = np.minimum(cut, np.maximum(0, excess - (np.cumsum(cut) - cut)))
        scaled[order] -= cut
        excess -= int(cut.sum())
    return scaled


class Coder:
    """Codes and decodes blocks with one table of (token, frequency)."""

    def __init__(self, tokens: np.ndarray, freq: np.ndarray):
        size = int(tokens.max()) + 1 if len(tokens) else 1
        self.freq, self.first = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[tokens] = freq
        self.first[tokens] = np.cumsum(freq) - freq
        self.token_at = np.repeat(tokens.astype(np.uint32), freq)

    def encode(self, ids: np.ndarray, lanes: int, stride: int) -> tuple[bytes, bytes]:
        """The stream and the checkpoints (per part: states, then the place in the stream)."""
        state = np.full(lanes, _LOW, np.uint64)
        words, written, kept = [], 0, []
        steps = -(-len(ids) // lanes)
        for step in range(steps - 1, -1, -1):
            now = ids[step * lanes : (step + 1) * lanes]
            f, x = self.freq[now], state[: len(now)]
            over = x >= f << np.uint64(63 - SCALE)
            out = x[over]
            if len(out):
                words.append((out & np.uint64(0xFFFFFFFF)).astype("<u4"))
                written += len(out)
                x[over] = out >> _WORD
            quotient = x // f
            state[: len(now)] = (quotient << _SHIFT) + (x - quotient * f) + self.first[now]
            if step % stride == 0:
                kept.append((state.copy(), written))
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
        places = [np.append(s, np.uint64(written - w)) for s, w in kept[::-1]]
        return stream.tobytes(), np.concatenate(places).astype("<u8").tobytes() if places else b""

    def decode(self, n: int, lanes: int, stride: int, checkpoints: bytes, stream: bytes) -> np.ndarray:
        """The ids; all parts between checkpoints advance together."""
        if not n:
            return np.zeros(0, np.uint32)
        kept = np.frombuffer(checkpoints, "<u8").reshape(-1, lanes + 1)
        state, place = kept[:, :lanes].copy(), kept[:, lanes].astype(np.int64)
        words = np.append(np.frombuffer(stream, "<u4"), np.uint32(0)).astype(np.uint64)
        out = np.zeros((len(kept), stride, lanes), np.uint32)
        starts = np.arange(len(kept)) * stride * lanes
        for step in range(min(stride, -(-n // lanes))):
            slot = state & _MASK
            token = self.token_at[slot]
            out[:, step] = token
            state = self.freq[token] * (state >> _SHIFT) + slot - self.first[token]
            # lanes beyond the last id were never coded at this step
            live = starts[:, None] + step * lanes + np.arange(lanes) < n if step * lanes + starts[-1] + lanes > n else True
            need = (state < _LOW) & live
            rank = np.cumsum(need, axis=1)
            take = np.minimum(place[:, None] + rank - 1, len(words) - 1)[need]
            state[need] = (state[need] << _WORD) | words[take]
            place += rank[:, -1]
        return out.reshape(-1)[:n]


def write_tokens(
    docs: DataFrame, path: str, *, vocabulary: str, end_id: int, block_tokens: int = 1 << 19, key: str = "doc_id", text: str = "text"
) -> None:
    """Writes the ids of all documents, in ascending order of the key, below ``path``.

    A null text is empty and gives the end id alone; null keys come first; rows of one key are
    all kept, ordered by text hash; other columns are ignored; an empty table gives no blocks.
    A block is closed once it holds ``block_tokens`` ids, so it may exceed that by one document.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # the hash and the counter only spread and order rows of equal keys
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.pmod(F.monotonically_increasing_id(), F.lit(64))]
    rows = rows.repartitionByRange(*order).sortWithinPartitions("key", F.xxhash64("text"))

    def tokenise(batches):
        encode, part = encoder(vocabulary), TaskContext.get().partitionId()
        names, sizes, held, count, block, first = [], [], [], 0, 0, 0

        def close():
            ids = np.concatenate(held).astype("<u4") if held else np.zeros(0, "<u4")
            columns = [[part], [block], [first], [count], [names], [sizes], [ids.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _RAW.values())], names=list(_RAW))

        for piece in slices(batches, "text", 8 << 20):
            ids, bounds = encode(piece.column("text"), end_id)
            keys, at = piece.column("key").to_pylist(), 0
            while at < len(keys):
                stop = min(len(keys), max(at + 1, int(np.searchsorted(bounds, bounds[at] + block_tokens - count))))
                names += keys[at:stop]
                sizes += np.diff(bounds[at : stop + 1]).tolist()
                held.append(ids[bounds[at] : bounds[stop]])
                count += len(held[-1])
                at = stop
                if count >= block_tokens:
                    yield close()
                    names, sizes, held, first, count, block = [], [], [], first + count, 0, block + 1
        if names:
            yield close()

    raw = "part long, block long, first long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, ids binary"
    staged = stage(rows.mapInArrow(tokenise, raw), "tokens", compression="zstd")

    def count_ids(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                more = np.bincount(np.frombuffer(ids.as_py(), "<u4"))
                counts = np.pad(counts, (0, max(0, len(more) - len(counts))))
                counts[: len(more)] += more
        token = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(counts[token])], names=["token", "n"])

    # at most one row per token of the vocabulary
    counted = staged.select("ids").mapInArrow(count_ids, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).orderBy("token").toPandas()
    tokens = counted["token"].to_numpy(np.int64)
    freq = frequencies(counted["n"].to_numpy(np.int64)) if len(tokens) else np.zeros(0, np.int64)
    spark = docs.sparkSession
    spark.createDataFrame(list(zip(tokens.tolist(), freq.tolist())), "token long, frequency long").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast((tokens, freq))

    def code(batches):
        coder = Coder(*shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[row].as_py(), "<u4")
                lanes = min(LANES, max(1, len(ids) // 64))
                stream, kept = coder.encode(ids, lanes, STRIDE)
                own = [pa.array(v, pa.int64()) for v in ([lanes], [STRIDE], [zlib.crc32(stream)], [zlib.crc32(ids.tobytes())])]
                yield pa.RecordBatch.from_arrays(
                    batch.slice(row, 1).columns[:6] + own[:2] + [pa.array([kept], pa.binary()), pa.array([stream], pa.binary())] + own[2:],
                    names=[f.strip().split(" ")[0] for f in _BLOCKS.split(",")],
                )

    staged.mapInArrow(code, _BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


_RAW = {
    "part": pa.int64(), "block": pa.int64(), "first": pa.int64(), "n_tokens": pa.int64(),
    "doc_ids": pa.list_(pa.int64()), "doc_tokens": pa.list_(pa.int64()), "ids": pa.binary(),
}
_BLOCKS = (
    "part long, block long, first long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, lanes long, stride long, "
    "checkpoints binary, stream binary, stream_crc32 long, ids_crc32 long"
)


def read_tokens(spark: SparkSession, path: str, *, key: str = "doc_id") -> DataFrame:
    """One row per document from files of `write_tokens`: ``key, start, n_tokens, ids``.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian unsigned
    32-bit integers. A block whose checksums differ raises.
    """
    table = spark.read.parquet(f"{path}/table").orderBy("token").toPandas()
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    # one row per task of the write, however long the parts are
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("own")).orderBy("part").toPandas()
    before = dict(zip(sizes["part"], (sizes["own"].cumsum() - sizes["own"]).tolist()))
    shared = spark.sparkContext.broadcast((table["token"].to_numpy(np.int64), table["frequency"].to_numpy(np.int64), before))

    def decode(batches):
        tokens, freq, before = shared.value
        coder = Coder(tokens, freq)
        for batch in batches:
            for row in batch.to_pylist():
                if zlib.crc32(row["stream"]) != row["stream_crc32"]:
                    raise ValueError(f"stream of block {row['part']}/{row['block']} is damaged")
                ids = coder.decode(row["n_tokens"], row["lanes"], row["stride"], row["checkpoints"], row["stream"])
                raw = ids.astype("<u4").tobytes()
                if zlib.crc32(raw) != row["ids_crc32"]:
                    raise ValueError(f"ids of block {row['part']}/{row['block']} are damaged")
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                own = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.append(0, 4 * ends).astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(before[row["part"]] + row["first"] + starts), pa.array(sizes), own],
                    names=[key, "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(decode, f"`{key}` long, start long, n_tokens long, ids binary")
