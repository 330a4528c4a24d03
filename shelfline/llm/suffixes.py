"""Repeated byte strings by distributed suffix sorting.

A suffix is worth sorting only if the 100 bytes at its start, or a window of 100 bytes around it, may
occur elsewhere. Anchors make that sparse: in every window the gram of 32 bytes with the lowest hash is
one, so equal windows hold equal anchors. Anchors whose gram recurs in the corpus keep their suffix.

Those suffixes are range-partitioned by their leading bytes with sampled splitters; ties go on by
document and place, so a passage that a third of the corpus shares is spread over as many buckets as it
fills. Each bucket sorts its suffixes by multikey quicksort, eight bytes a key, which also gives the
common prefixes of neighbours. For every way a window can lie around its anchor, suffixes that agree to
the right are neighbours, and those of them that agree to the left as well hold the same window; all but
the first are repeats. A run of neighbours that reaches the edge of a bucket may go on in the next, so the
first holders of its windows are compared across buckets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import landed, partitions, sieved
from shelfline.llm.recurring import recurring

LENGTH, GRAM = 100, 32
#: suffixes in a bucket
BUCKET = 40_000


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows of the texts, and the hashes of their grams."""
    n, width = len(data), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - gram + 1)
    hashes = W.span_hash(W.prefix_sums(data), at, at + gram)
    # the lowest hash of each window, by doubling the stretch it covers
    low, covered = hashes, 1
    while covered < width:
        step = min(covered, width - covered)
        low = np.minimum(low[:len(low) - step], low[step:])
        covered += step
    # windows that cross from one text into the next do not count
    whole = np.zeros(n + 1, np.int64)
    np.add.at(whole, offsets[:-1], 1)
    np.add.at(whole, np.maximum(offsets[1:] - length + 1, offsets[:-1]), -1)
    inside = np.cumsum(whole)[:len(low)] > 0
    low = np.where(inside, low, np.uint64(0))
    # a place is an anchor if a window that holds it has its hash as the lowest
    high, covered = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)]), 1
    while covered < width:
        step = min(covered, width - covered)
        high = np.maximum(high[:len(high) - step], high[step:])
        covered += step
    chosen = np.flatnonzero((high[:len(hashes)] == hashes) & (hashes != 0))
    return chosen, hashes[chosen]


def _entries(length: int, gram: int):
    def entries(batch: pa.RecordBatch):
        ids = batch.column("row_id").to_numpy()
        for first, _, data, offsets in W.slices(batch.column("text")):
            place, hashes = anchors(data, offsets, length, gram)
            text = np.searchsorted(offsets, place, "right") - 1
            yield hashes, ids[first + text], (place - offsets[text]).astype(np.int32)
    return entries


_SUFFIX = "row_id bigint, doc_id bigint, place int, suffix binary, before binary"


def _cut(length: int, gram: int):
    """The suffix at each given place, and the bytes before it, nearest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = length - gram
        for batch in batches:
            rows, docs, at, suffix, before = [], [], [], [], []
            for row, doc, text, places in zip(*(batch.column(c).to_pylist() for c in ("row_id", "doc_id", "text", "places"))):
                raw = (text or "").encode()
                rows += [row] * len(places)
                docs += [doc] * len(places)
                at += places
                suffix += [raw[i:i + length] for i in places]
                before += [raw[max(0, i - left):i][::-1] for i in places]
                if len(rows) > 20_000:
                    yield _batch(rows, docs, at, suffix, before)
                    rows, docs, at, suffix, before = [], [], [], [], []
            yield _batch(rows, docs, at, suffix, before)
    return run


def _batch(*columns: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)],
                                      names=["row_id", "doc_id", "place", "suffix", "before"])


def _padded(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    table = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in values), np.uint8).reshape(len(values), width)
    return table, np.array([len(x) for x in values], np.int64)


def multikey_sort(table: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows as byte strings, and the common prefix of each with the one before it.

    Rows that agree so far form groups; each round sorts the groups by their next eight bytes and splits
    them where those differ, and groups of one drop out.
    """
    n, width = table.shape
    keys = table if width % 8 == 0 else np.pad(table, ((0, 0), (0, 8 - width % 8)))
    keys = np.ascontiguousarray(keys).view(">u8").astype(np.uint64)
    order, group, active = np.arange(n), np.zeros(n, np.int64), np.arange(n)
    # order[i] is the row at position i, group[i] the first position of the group it is in
    for depth in range(keys.shape[1]):
        if not len(active):
            break
        rows = order[active]
        by = np.lexsort((keys[rows, depth], group[active]))
        order[active] = rows[by]
        key, own = keys[order[active], depth], group[active]
        new = np.ones(len(active), bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        group[active] = active[np.flatnonzero(new)][np.cumsum(new) - 1]
        size = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1]
        active = active[size > 1]
    if len(active):  # equal bytes: shorter strings, which were filled up, come first
        by = np.lexsort((lengths[order[active]], group[active]))
        order[active] = order[active][by]
    sorted_rows, sorted_lengths = table[order], lengths[order]
    common = np.zeros(n, np.int64)
    if n > 1:
        step = max(1, 4_000_000 // max(width, 1))
        for lo in range(1, n, step):
            hi = min(n, lo + step)
            differ = sorted_rows[lo:hi] != sorted_rows[lo - 1:hi - 1]
            common[lo:hi] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        common[1:] = np.minimum(common[1:], np.minimum(sorted_lengths[1:], sorted_lengths[:-1]))
    return order, common


_SETTLED = "row_id bigint, doc_id bigint, start int, stop int, window binary"


def _settle(length: int, gram: int):
    """Stretches of repeated window starts [start, stop), and the first holders at the bucket's edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        row = np.concatenate([b.column("row_id").to_numpy() for b in parts])
        doc = pa.chunked_array([b.column("doc_id") for b in parts]).combine_chunks()
        doc_at = np.where(doc.is_null().to_numpy(zero_copy_only=False), np.iinfo(np.int64).min, doc.fill_null(0).to_numpy())
        place = np.concatenate([b.column("place").to_numpy() for b in parts]).astype(np.int64)
        table, right = _padded([x for b in parts for x in b.column("suffix").to_pylist()], length)
        before, left = _padded([x for b in parts for x in b.column("before").to_pylist()], length - gram)
        del parts
        order, common = multikey_sort(table, right)
        row, doc_at, place, table, right, before, left = (x[order] for x in (row, doc_at, place, table, right, before, left))
        doc = doc.take(pa.array(order))
        n = len(row)
        rank = np.empty(n, np.int64)
        rank[np.lexsort((place, row, doc_at))] = np.arange(n)
        repeated = np.zeros((length - gram + 1, n), bool)
        edges: list[tuple[int, int]] = []
        back = np.zeros(n, np.uint64)  # hash of the bytes before, as far as the window reaches
        for reach in range(length - gram + 1):
            if reach:
                back = W.mix(back * W.BASE + before[:, reach - 1].astype(np.uint64) + np.uint64(1))
            depth = length - reach
            run_id = np.cumsum(common < depth)
            fits = np.flatnonzero((left >= reach) & (right >= depth))
            if not len(fits):
                continue
            key = W.mix(back[fits] * W.BASE + run_id[fits].astype(np.uint64))
            by = np.lexsort((rank[fits], key))
            new = np.ones(len(by), bool)
            new[1:] = key[by][1:] != key[by][:-1]
            repeated[reach, fits[by[~new]]] = True
            holders = fits[by[new]]
            for i in holders[(run_id[holders] == run_id[0]) | (run_id[holders] == run_id[-1])].tolist():
                edges.append((i, reach))
        # the window that reaches r bytes before the anchor starts there: runs over r are runs of starts
        flips = np.diff(np.pad(repeated.T.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        who, lo = np.nonzero(flips == 1)
        _, hi = np.nonzero(flips == -1)
        for i in range(0, len(who), 100_000):
            w, a, b = who[i:i + 100_000], lo[i:i + 100_000], hi[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([
                pa.array(row[w]), doc.take(pa.array(w)), pa.array((place[w] - b + 1).astype(np.int32)),
                pa.array((place[w] - a + 1).astype(np.int32)), pa.nulls(len(w), pa.binary())],
                names=["row_id", "doc_id", "start", "stop", "window"])
        for i in range(0, len(edges), 50_000):
            some = edges[i:i + 50_000]
            at = np.array([e for e, _ in some])
            start = place[at] - np.array([r for _, r in some])
            digests = [hashlib.blake2b(before[e, :r][::-1].tobytes() + table[e, :length - r].tobytes(), digest_size=16).digest()
                       for e, r in some]
            yield pa.RecordBatch.from_arrays([
                pa.array(row[at]), doc.take(pa.array(at)), pa.array(start.astype(np.int32)),
                pa.array((start + 1).astype(np.int32)), pa.array(digests, pa.binary())],
                names=["row_id", "doc_id", "start", "stop", "window"])
    return run


def _kept(length: int):
    """What is left of each text without the bytes under its repeated windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, digests, kept = [], [], [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                raw = (text or "").encode()
                pieces, at, cut, n = [], 0, 0, 0
                end = -1
                for start, stop in sorted((r["start"], r["stop"]) for r in runs or ()):
                    lo, hi = start, stop - 1 + length
                    if lo > end:
                        n += 1
                        pieces.append(raw[at:lo])
                        cut += hi - lo
                    elif hi > end:
                        cut += hi - end
                    else:
                        continue
                    end = at = max(end, hi)
                pieces.append(raw[max(at, 0):])
                rest = b"".join(pieces)
                removed.append(cut)
                spans.append(n)
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            yield pa.RecordBatch.from_arrays([
                batch.column("row_id"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
                names=["row_id", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def repeats_removed(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes; null where nothing
    was removed) of every row of `documents`.

    Removed is every byte under a string of `length` bytes that also starts earlier: at a smaller doc_id,
    or in the same document before. Null text is empty; a null id counts as smaller than any. Rows that
    repeat an id are documents of their own, one after the other in the order of their text's hash; rows
    that repeat id and text too are one document, and each of them gets that document's result.
    """
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(F.col("doc_id").cast("bigint"), F.xxhash64("doc_id", "text").alias("row_id"), "text")
    listed = landed(docs.select("doc_id", "row_id", F.sha2(text, 256).alias("digest"),
                                F.octet_length(text).cast("bigint").alias("n_bytes")), "listed")
    # what a copy holds occurs before it, so copies need no search
    first = listed.groupBy("digest").agg(F.min(F.struct("doc_id", "row_id")).alias("first"))
    placed = listed.join(first, "digest").withColumn("is_first", F.col("row_id") == F.col("first.row_id")).drop("first")
    placed = landed(placed, "placed")

    found = recurring(docs.select("row_id", "text"), _entries(length, gram))
    places = found.groupBy(F.col("a").alias("row_id")).agg(F.collect_set("b").alias("places"))
    wanted = landed(places.join(placed.where("is_first").select("row_id").distinct(), "row_id", "left_semi"), "places")
    suspects = landed(docs.join(wanted.hint("shuffle_hash"), "row_id"), "suspects")
    # rows that repeat id and text are one document
    several = placed.where("is_first").groupBy("row_id").count().where("count > 1")
    suspects = suspects if several.isEmpty() else landed(suspects.dropDuplicates(["row_id"]), "suspects-once")

    n = suspects.agg(F.sum(F.size("places"))).first()[0] or 0
    suffixes = suspects.mapInArrow(_cut(length, gram), _SUFFIX)
    buckets = max(partitions(spark), math.ceil(n / BUCKET))
    settled = landed(suffixes.repartitionByRange(buckets, "suffix", "before", "doc_id", "row_id", "place")
                     .mapInArrow(_settle(length, gram), _SETTLED), "settled")

    edges = settled.where(F.col("window").isNotNull())
    holder = F.struct("doc_id", "row_id", "start")
    earliest = edges.groupBy("window").agg(F.min(holder).alias("earliest"))
    late = edges.join(earliest, "window").where(~holder.eqNullSafe(F.col("earliest")))
    runs = (settled.where(F.col("window").isNull()).select("row_id", "start", "stop")
            .unionByName(late.select("row_id", "start", "stop")).distinct()
            .groupBy("row_id").agg(F.collect_list(F.struct("start", "stop")).alias("runs")))
    runs = landed(runs, "runs")
    # most suspects turn out to hold no repeat; their text need not be shuffled again
    cut = sieved(suspects.select("row_id", "text"), runs, "row_id").join(runs, "row_id").mapInArrow(
        _kept(length), "row_id bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")

    whole = (~F.col("is_first")) & (F.col("n_bytes") >= length)
    none = F.lit("").cast("binary")
    return placed.join(cut, "row_id", "left").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.sha2(none, 256)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(whole, none).otherwise(F.col("kept")).alias("kept"))
