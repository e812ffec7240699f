"""Blocks of whole documents, and packed sets of 64-bit keys that blocks send to buckets.

Several operators ask, for millions of hashed windows, how often (or where first) each
occurs in the whole corpus. A block (a bounded run of whole documents, dealt by a hash)
sends each bucket (a range of the hash space) one row with its sorted distinct keys as
delta byte planes; the bucket answers with one value per key in the same order. A key
that a third of the corpus holds costs one entry per block, so no bucket gets hot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.ipc  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestream.llm import words as W

BLOCK_BYTES = 8 << 20


def block_count(df: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, least: int | None = None) -> int:
    """Blocks for ``df``: in proportion to the bytes of text; ``least`` at least (one per
    shuffle partition if not given)."""
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    if least is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-int(total) // block_bytes))


def blocked(df: DataFrame, id_col: str, text: str, n: int) -> DataFrame:
    """``df`` dealt into ``n`` blocks by id and text; column ``block`` holds the number."""
    block = F.pmod(F.xxhash64(id_col, text), F.lit(n)).cast("int")
    return df.withColumn("block", block).repartition(n, "block")


#: Bytes of rows that a task gathers before it deals them to blocks; copies of one key that stay together.
GATHER_BYTES, TOGETHER = 16 << 20, 16


def packed_blocks(df: DataFrame, key: str, n: int) -> DataFrame:
    """``df`` without ``key`` dealt into ``n`` blocks, as rows (block, payload): those rows of a block that meet in one
    map task travel as one compressed Arrow stream (see ``unpacked``). Rows of one key (a long) are spread: by
    task, and within a task in runs of ``TOGETHER``, so that a key with a third of all rows fills no block."""
    names = [c for c in df.columns if c != key]

    def deal(batches):
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            tab = pa.Table.from_batches(held).combine_chunks()
            keys = tab.column(key).to_numpy().view(np.uint64)
            _, code = np.unique(keys, return_inverse=True)
            order = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.diff(code[order], prepend=-1))
            copy = np.empty(len(code), np.int64)
            copy[order] = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
            run = np.where(copy < TOGETHER, 0, (number << 24) + copy // TOGETHER).astype(np.uint64)
            block = (W.mix(W.mix(keys + np.uint64(task)) + run) % np.uint64(n)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            block, tab = block[order], tab.select(names).take(pa.array(order))
            cut = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block)).tolist()
            for a, b in zip(cut, cut[1:]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, tab.schema) as out:
                    out.write_table(tab.slice(a, b - a))
                data = sink.getvalue()
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block[a]], pa.int32()),
                    "payload": pa.array([data.size.to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)], pa.binary())})

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= GATHER_BYTES:
                yield from flush()
                number, held, size = number + 1, [], 0
        if any(b.num_rows for b in held):
            yield from flush()
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(deal, "block int, payload binary").repartition(n, "block")


def unpacked(payloads: pa.ChunkedArray) -> pa.Table:
    """The rows of ``packed_blocks``."""
    parts = []
    for p in payloads:
        data = p.as_buffer()
        size = int.from_bytes(data.slice(0, 8).to_pybytes(), "little")
        parts.append(pa.ipc.open_stream(pa.decompress(data.slice(8), size, "zstd")).read_all())
    return pa.concat_tables(parts)


def pack(x: np.ndarray) -> bytes:
    """Unsigned integers as byte planes; planes above the highest used byte are left out."""
    x = x.astype("<u8", copy=False)
    if not len(x):
        return b""
    planes = (int(x.max()).bit_length() + 7) // 8
    return bytes([planes]) + x.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n and data[0]:
        out[:, :data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], n).T
    return out.reshape(-1).view("<u8")


def pack_counts(x: np.ndarray) -> bytes:
    """Counts that are mostly 0, 1 or 2: two bits each, larger ones after them."""
    x = x.astype(np.uint64, copy=False)
    small = np.minimum(x, 3).astype(np.uint8)
    return np.packbits(small & 1).tobytes() + np.packbits(small >> 1).tobytes() + pack(x[small == 3])


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    size = (n + 7) // 8
    bits = [np.unpackbits(np.frombuffer(data, np.uint8, size, k * size), count=n) for k in (0, 1)]
    out = (bits[0] + 2 * bits[1]).astype(np.uint64)
    large = np.flatnonzero(out == 3)
    out[large] = unpack(data[2 * size:], len(large))
    return out


def pack_sorted(keys: np.ndarray) -> bytes:
    """The first key, then the gaps as byte planes. Gaps are spread over few bits of the highest plane, which is
    compressed; the planes below are noise."""
    planes = pack(np.diff(keys))
    high = len(planes) - len(keys) + 1
    if high <= 0:
        return keys[:1].tobytes() + planes
    return keys[:1].tobytes() + planes[:high] + pa.compress(planes[high:], "zstd", asbytes=True)


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    if n < 2 or not data[8]:
        return np.full(n, np.frombuffer(data, np.uint64, 1)[0]) if n else np.empty(0, np.uint64)
    high = 9 + (data[8] - 1) * (n - 1)
    planes = data[8:high] + pa.decompress(data[high:], n - 1, "zstd", asbytes=True)
    return np.cumsum(np.concatenate((np.frombuffer(data, np.uint64, 1), unpack(planes, n - 1))), dtype=np.uint64)


def bucket_bounds(keys: np.ndarray, buckets: int, bits: int = 64) -> np.ndarray:
    """Places that cut sorted ``keys`` of so many bits into ``buckets`` equal ranges."""
    lows = np.array([(b << bits) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, lows), [len(keys)]))


def join_fields(*fields: bytes) -> bytes:
    return b"".join(len(f).to_bytes(8, "little") + f for f in fields)


def split_fields(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at:at + 8], "little")
        out.append(data[at + 8:at + 8 + size])
        at += 8 + size
    return out
