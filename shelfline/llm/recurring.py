"""Keys that occur with two or more payloads anywhere in a table, found with one shuffle.

Tasks send packed arrays instead of rows. A key that recurs within a task is sent on once for it; its
other payloads are known to recur and travel to arbitrary buckets, so a key that a third of the table
holds puts no more than a row per task into one bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfline.llm.common import partitions

#: entries a task holds before it sends them
FLUSH = 2_000_000
_ALONE, _FIRST_OF_KNOWN, _KNOWN = 0, 1, 2
_SENT = "bucket int, keys binary, a binary, b binary, state binary"
FOUND = "key bigint, a bigint, b int"
Entries = tuple[np.ndarray, np.ndarray, np.ndarray]


def recurring(source: DataFrame, entries: Callable[[pa.RecordBatch], Iterator[Entries]]) -> DataFrame:
    """(key, a, b): the distinct entries whose key has at least two distinct payloads (a, b).

    `entries` gives arrays of keys (uint64), a (int64) and b (int32) for a batch of `source`.
    """
    buckets = partitions(source.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Entries] = []
        size = 0
        for batch in batches:
            for entry in entries(batch):
                held.append(entry)
                size += len(entry[0])
                if size >= FLUSH:
                    yield from _packed(held, buckets)
                    held, size = [], 0
        if size:
            yield from _packed(held, buckets)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task's bucket range is as large as the shuffle partitions make it
        parts: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("keys", "a", "b", "state"))):
                parts.append(tuple(np.frombuffer(x.as_py(), t) for x, t in zip(
                    row, (np.uint64, np.int64, np.int32, np.uint8))))
        if not parts:
            return
        keys, a, b, state = (np.concatenate(x) for x in zip(*parts))
        del parts
        known = state == _KNOWN
        yield from _rows(keys[known], a[known], b[known])
        keys, a, b, state = (x[~known] for x in (keys, a, b, state))
        order = np.lexsort((b, a, keys))
        keys, a, b, state = keys[order], a[order], b[order], state[order]
        new = _starts(keys, a, b)
        flag = np.maximum.reduceat(state, np.flatnonzero(new)) if len(keys) else state
        keys, a, b = keys[new], a[new], b[new]
        group = np.cumsum(_starts(keys)) - 1
        keep = (np.bincount(group)[group] > 1) | (np.bincount(group, flag)[group] > 0) if len(keys) else np.zeros(0, bool)
        yield from _rows(keys[keep], a[keep], b[keep])

    # known entries may repeat what another task knows: one payload can be held by several
    return source.mapInArrow(send, _SENT).repartitionById(buckets, "bucket").mapInArrow(settle, FOUND)


def _starts(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for x in columns:
        out[1:] |= x[1:] != x[:-1]
    return out


def _rows(keys: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 500_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(keys), step):
        yield pa.RecordBatch.from_arrays([
            pa.array(keys[i:i + step].view(np.int64)), pa.array(a[i:i + step]), pa.array(b[i:i + step])],
            names=["key", "a", "b"])


def _packed(held: list[Entries], buckets: int) -> Iterator[pa.RecordBatch]:
    keys, a, b = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((b, a, keys))
    keys, a, b = keys[order], a[order], b[order]
    new = _starts(keys, a, b)
    keys, a, b = keys[new], a[new], b[new]
    first = _starts(keys)
    group = np.cumsum(first) - 1
    several = np.bincount(group)[group] > 1
    state = np.where(several, np.where(first, _FIRST_OF_KNOWN, _KNOWN), _ALONE).astype(np.uint8)
    bucket = (keys % np.uint64(buckets)).astype(np.int32)
    bucket[state == _KNOWN] = np.arange(int((state == _KNOWN).sum())) % buckets
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    cuts = [order[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:])]
    full = [i for i, cut in enumerate(cuts) if len(cut)]
    for i in range(0, len(full), 16):
        some = full[i:i + 16]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32())] + [pa.array([x[cuts[j]].tobytes() for j in some], pa.binary())
                                            for x in (keys, a, b, state)],
            names=["bucket", "keys", "a", "b", "state"])
