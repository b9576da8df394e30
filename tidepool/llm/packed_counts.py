"""Counts of hashed keys over all rows, with little to shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

COUNT_BITS = 40               # keys are counted by this many bits of their hash
_FLUSH = 4_000_000


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and their counts, small: zstandard over byte planes of the
    gaps, and the counts above 1."""
    import zstandard
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    more = np.flatnonzero(counts > 1)
    head = np.array([len(keys), len(more)], "<u8").tobytes()
    body = gaps.T.tobytes() + more.astype("<u4").tobytes() + counts[more].astype("<u8").tobytes()
    return head + zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard
    n, m = np.frombuffer(blob[:16], "<u8").astype(int)
    raw = zstandard.ZstdDecompressor().decompress(blob[16:])
    gaps = np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T
    keys = np.cumsum(np.ascontiguousarray(gaps).view("<u8").reshape(-1), dtype=np.uint64)
    counts = np.ones(n, np.int64)
    counts[np.frombuffer(raw, "<u4", m, 8 * n)] = np.frombuffer(raw, "<u8", m, 8 * n + 4 * m)
    return keys, counts


def key_counts(rows: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
               buckets: int, least: int) -> DataFrame:
    """(token, n) of the keys (the top COUNT_BITS of a 64-bit hash) that at
    least ``least`` rows have; ``keys_of`` gives the distinct keys of each row
    of a batch. Each task counts its own rows and sends one sorted, packed run
    of keys to each bucket, so a key of very many rows costs an entry a task."""
    drop = np.uint64(64 - COUNT_BITS)
    bits = max(1, (buckets - 1).bit_length())

    def count(batches):
        held, size = [], 0

        def runs():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            bucket = keys >> np.uint64(COUNT_BITS - bits)
            ends = np.searchsorted(bucket, np.arange((1 << bits) + 1, dtype=np.uint64))
            some = np.flatnonzero(ends[1:] > ends[:-1])
            return pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)),
                 pa.array([_pack(keys[ends[b]:ends[b + 1]], n[ends[b]:ends[b + 1]]) for b in some], pa.binary())],
                names=["bucket", "run"])

        for b in batches:
            for t in keys_of(b):
                held.append(np.unique(t >> drop))
                size += len(t)
                if size >= _FLUSH:
                    yield runs()
                    held, size = [], 0
        if size:
            yield runs()

    def merge(t: pa.Table) -> pa.Table:
        runs = [_unpack(x) for x in t.column("run").to_pylist()]
        keys, at = np.unique(np.concatenate([k for k, _ in runs]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([c for _, c in runs])).astype(np.int64)
        often = n >= least
        return pa.table({"token": keys[often].astype(np.int64), "n": n[often]})

    return (rows.mapInArrow(count, "bucket int, run binary")
            .groupBy("bucket").applyInArrow(merge, "token long, n long"))
