"""Shared helpers: whole-batch word splitting and hashing, packed blocks, hand-off tables.

Tasks work on Arrow batches with numpy. What a task sends to another one goes as *blocks*: arrays
sorted and compressed into one binary per bucket, so a shuffle moves a few bytes per value and
Spark still partitions, sorts and retries the work.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession

from shelfwise.session import checkpoint_dir

# White space that separates words: [\x20\x09-\x0D].
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# A-Z to a-z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict[str, np.ndarray] = {}

CHUNK_BYTES = 1 << 21


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i <= n (kept for the next call)."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, 1 << 18)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit (one per seed)."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: p[i] covers data[:i]."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def row_prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """Prefix hashes of every row of a byte matrix; equal beginnings have equal hashes."""
    up, _ = powers(rows.shape[1])
    out = np.zeros((len(rows), rows.shape[1] + 1), dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[rows] * up[: rows.shape[1]], axis=1, out=out[:, 1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each data[start:end], equal wherever the same bytes stand."""
    _, down = powers(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_LANES = 1 << 20


def lane_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each data[start:end]: every 8 bytes are mixed with their number, the results added and
    mixed with the length. Unlike a polynomial modulo 2**64, no repetitive text cancels out. Spans are taken
    some at a time, so memory follows ``_LANES``, not the data."""
    out = np.zeros(len(start), dtype=np.uint64)
    lanes = np.maximum(1, (end - start + 7) >> 3)
    upto = np.cumsum(lanes)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + _LANES, side="right")))
        own = lanes[at:stop]
        first = np.cumsum(own) - own
        number = np.arange(int(own.sum())) - np.repeat(first, own)
        place = np.repeat(start[at:stop], own) + 8 * number
        words = np.ascontiguousarray(windows[place]).view(np.uint64).reshape(-1)
        words &= _MASKS[np.clip(np.repeat(end[at:stop], own) - place, 0, 8)]
        words = mix(words ^ mix(number.astype(np.uint64), seed + 1), seed + 2)
        out[at:stop] = np.add.reduceat(words, first) + (end[at:stop] - start[at:stop]).astype(np.uint64)
        at = stop
    return mix(out, seed + 3)


class Chunk:
    """Some rows of one Arrow batch: ids (0 for null) and the bytes of their texts behind one another."""

    __slots__ = ("data", "first", "ids", "offsets", "rows")

    def __init__(self, ids, data, offsets, first, rows):
        self.ids, self.data, self.offsets, self.first, self.rows = ids, data, offsets, first, rows


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def text_chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Rows of (id, text) batches in runs of at most ``limit`` bytes (a longer text alone)."""
    for batch in batches:
        ids = pc.fill_null(batch.column(0), 0).to_numpy(zero_copy_only=False)  # whole numbers stay exact beside a null
        data, offsets = text_bytes(batch.column(1))
        row = 0
        while row < len(ids):
            last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
            last = min(last, len(ids))
            begin, end = offsets[row], offsets[last]
            yield Chunk(ids[row:last], data[begin:end], offsets[row : last + 1] - begin, row, batch)
            row = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; no word crosses a row's end."""
    inside = ~SPACE[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and row of every word of A-Z lower-cased texts."""
    start, end, row = word_spans(data, offsets)
    return lane_hashes(LOWER[data], start, end, 1), row


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed binary; bytes of equal weight stand together."""
    head, body = [], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head.append(struct.pack("<cBq", a.dtype.kind.encode(), a.dtype.itemsize, len(a)))
        body.append(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() if len(a) else b"")
    return struct.pack("<B", len(arrays)) + b"".join(head) + zstandard.compress(b"".join(body), 1)


def unpack(block: bytes) -> list[np.ndarray]:
    block = memoryview(block)
    count, at, heads = block[0], 1, []
    for _ in range(count):
        heads.append(struct.unpack_from("<cBq", block, at))
        at += struct.calcsize("<cBq")
    body = np.frombuffer(zstandard.decompress(block[at:]), dtype=np.uint8)
    out, at = [], 0
    for kind, width, length in heads:
        planes = body[at : at + width * length].reshape(width, length)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(np.dtype(f"{kind.decode()}{width}")))
        at += width * length
    return out


def deltas(sorted_values: np.ndarray) -> np.ndarray:
    """First value, then differences (unsigned), for packing sorted values."""
    out = sorted_values.copy()
    out[1:] -= sorted_values[:-1]
    return out


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by range of the hash, so sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def slices(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, begin, end) of each run in sorted buckets."""
    edges = np.flatnonzero(np.diff(buckets)) + 1
    for begin, end in zip(np.r_[0, edges], np.r_[edges, len(buckets)], strict=True):
        if end > begin:
            yield int(buckets[begin]), int(begin), int(end)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many ``_`` before it as none of the columns needs (case apart)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches of at most 1,000 rows for this session: texts are long, workers small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= 1000:
        spark.conf.set(name, "1000")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hand_off(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under spark.checkpoint.dir and read it back: the lineage ends here
    and a lost executor costs a reread."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")
