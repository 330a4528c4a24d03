"""Benchmark passages in documents, found by multi-pattern search over words (Wu and Manber).

The patterns are the windows of consecutive words of the benchmark items. For each pattern length a
table holds, for every block of two words that occurs in a pattern, how far the search may move on
when a window of the text ends in that block; any other block lets it skip almost the whole window.
Where the shift is zero, the bucket of patterns with that last block is opened and each of them is
compared with the text word by word (as 64-bit word hashes). All texts of a slice are searched in
step: every piece of text has its own cursor, and one array operation moves all of them.
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
from shelfline.llm.common import landed, named_back, neutral

WINDOW = 10
BLOCK = 2
#: pairs of pattern and item that are broadcast at a time, about 100 bytes each
PATTERNS_AT_ONCE = 200_000
_PIECE = 512
_FOUND = "doc_id bigint, text_key binary, n_words bigint, hits array<struct<first:int,last:int>>, items array<bigint>"


def patterns(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, pattern): the distinct windows of each item, as the bytes of their word hashes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id")
            for first, last, data, offsets in W.slices(batch.column("text")):
                hashes, bounds = W.hashed_words(data, offsets, W.WORDY)
                item, found = [], []
                for row in range(first, last):
                    own = hashes[bounds[row - first]:bounds[row - first + 1]]
                    size = min(window, len(own))
                    if size and ids[row].is_valid:
                        cuts = {own[i:i + size].tobytes() for i in range(len(own) - size + 1)}
                        item += [ids[row].as_py()] * len(cuts)
                        found += cuts
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(found, pa.binary())],
                                                 names=["item_id", "pattern"])
    return benchmark.select(F.col("item_id").cast("bigint"), "text").mapInArrow(
        cut, "item_id bigint, pattern binary").distinct()


class Table:
    """Patterns of one length: the shift of each block, and the patterns by their last block."""

    def __init__(self, rows: np.ndarray, items: np.ndarray):
        self.length = rows.shape[1]
        self.block = min(BLOCK, self.length)
        last = W.run_hash(rows.ravel(), self.block)[np.arange(len(rows)) * self.length + self.length - self.block]
        order = np.argsort(last, kind="stable")
        self.rows, self.items, self.last = rows[order], items[order], last[order]
        blocks, shifts = [], []
        for end in range(self.block, self.length + 1):
            at = np.arange(len(rows)) * self.length + end - self.block
            blocks.append(W.run_hash(rows.ravel(), self.block)[at])
            shifts.append(np.full(len(rows), self.length - end))
        blocks, shifts = np.concatenate(blocks), np.concatenate(shifts)
        order = np.lexsort((shifts, blocks))
        self.blocks, first = np.unique(blocks[order], return_index=True)
        self.shifts = shifts[order][first]

    def search(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the last word, row of the pattern) of every occurrence."""
        m, b = self.length, self.block
        ends = [np.arange(lo + m - 1, hi, _PIECE) for lo, hi in zip(bounds[:-1], bounds[1:]) if hi - lo >= m]
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        stops = np.concatenate([np.minimum(e + _PIECE, hi) for e, hi in zip(
            ends, (hi for lo, hi in zip(bounds[:-1], bounds[1:]) if hi - lo >= m))])
        cursor = np.concatenate(ends)
        block_at = W.run_hash(hashes, b)
        places, rows = [], []
        while len(cursor):
            here = block_at[cursor - b + 1]
            at = np.minimum(np.searchsorted(self.blocks, here), len(self.blocks) - 1)
            known = self.blocks[at] == here
            shift = np.where(known, self.shifts[at], m - b + 1)
            found = shift == 0
            if found.any():
                end, key = cursor[found], here[found]
                lo, hi = np.searchsorted(self.last, key, "left"), np.searchsorted(self.last, key, "right")
                place = np.repeat(end, hi - lo)
                row = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange(len(place))
                for i in range(m):
                    keep = hashes[place - m + 1 + i] == self.rows[row, i]
                    place, row = place[keep], row[keep]
                places.append(place)
                rows.append(row)
            cursor = cursor + np.maximum(shift, 1)
            going = cursor < stops
            cursor, stops = cursor[going], stops[going]
        return (np.concatenate(places), np.concatenate(rows)) if places else (
            np.zeros(0, np.int64), np.zeros(0, np.int64))


def tables(pairs: list) -> list[Table]:
    by_length: dict[int, list] = {}
    for item, pattern in pairs:
        by_length.setdefault(len(pattern) // 8, []).append((item, pattern))
    return [Table(np.frombuffer(b"".join(p for _, p in rows), np.uint64).reshape(len(rows), length),
                  np.array([i for i, _ in rows], np.int64)) for length, rows in sorted(by_length.items())]


def _search(docs: DataFrame, known: list[Table]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hits, items = [], [], []
            for first, last, data, offsets in W.slices(batch.column("text")):
                hashes, bounds = W.hashed_words(data, offsets, W.WORDY)
                counts.append(np.diff(bounds))
                got: dict[int, tuple[list, set]] = {}
                for each in sent.value:
                    ends, rows = each.search(hashes, bounds)
                    owner = np.searchsorted(bounds, ends, "right") - 1
                    for doc, end, row in zip(owner.tolist(), ends.tolist(), rows.tolist()):
                        own = got.setdefault(doc, ([], set()))
                        own[0].append((end - each.length + 1 - int(bounds[doc]), end + 1 - int(bounds[doc])))
                        own[1].add(int(each.items[row]))
                for doc in range(last - first):
                    own = got.get(doc, ([], set()))
                    hits.append([{"first": a, "last": b} for a, b in merged(own[0])])
                    items.append(sorted(own[1]))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"),
                pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                pa.array(hits, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                pa.array(items, pa.list_(pa.int64()))], names=["doc_id", "text_key", "n_words", "hits", "items"])
    return docs.mapInArrow(find, _FOUND)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [tuple(x) for x in out]


def occurrences(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                at_once: int = PATTERNS_AT_ONCE) -> DataFrame:
    """One row per row of documents: doc_id, n_words, hits (runs of words inside occurrences, end
    exclusive, disjoint and sorted), items (sorted ids of items with an occurring window).

    Null or wordless texts and null ids of documents give a row without hits or are kept as they are;
    items without words or id never match; repeated items and documents are independent rows; an
    empty benchmark hits nothing. Patterns beyond `at_once` are searched in further passes whose
    results are merged, so what is broadcast is bounded whatever the benchmark's size.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("bigint"), "text")
    pairs = landed(patterns(benchmark, window), "patterns")
    passes = max(1, math.ceil(pairs.count() / at_once))
    if passes == 1:
        return _search(docs.withColumn("text_key", F.lit(None).cast("binary")),
                       tables(pairs.collect())).drop("text_key")
    keyed = docs.withColumn("text_key", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    found = []
    for step in range(passes):
        some = pairs.where(F.pmod(F.xxhash64("pattern", "item_id"), F.lit(passes)) == step).collect()
        found.append(landed(_search(keyed, tables(some)), f"found-{step}"))
    whole = found[0].select("doc_id", "text_key", "n_words")
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    hits = (hits.where(F.size("items") > 0).distinct().groupBy("doc_id", "text_key")
            .agg(F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_set("items")).alias("items")))
    run = "array<struct<first:int,last:int>>"
    union = F.aggregate(F.array_sort("hits"), F.lit(None).cast(run), lambda acc, x: F.when(
        acc.isNull(), F.array(x)).when(
        x["first"] <= F.element_at(acc, -1)["last"],
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["first"].alias("first"),
            F.greatest(F.element_at(acc, -1)["last"], x["last"]).alias("last"))))).otherwise(F.concat(acc, F.array(x))))
    joined = whole.join(hits, whole.doc_id.eqNullSafe(hits.doc_id) & (whole.text_key == hits.text_key), "left")
    return joined.select(
        whole.doc_id, "n_words", F.coalesce(union, F.array().cast(run)).alias("hits"),
        F.coalesce(F.array_sort(F.array_distinct("items")), F.array().cast("array<bigint>")).alias("items"))


def report(found: DataFrame) -> DataFrame:
    """Counts and a digest of what `occurrences` found."""
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda acc, x: acc + (x["last"] - x["first"]))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def item_digest(items: list[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def without_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns, whatever their names.

    Whole rows pass through the search, so no join brings text and finding together again. Null, empty and
    wordless texts stay, repeated rows are judged alike; an empty benchmark removes nothing, an empty table
    gives an empty one.
    """
    return named_back(_filtered(neutral(docs, F.col("text").alias("content")), patterns(benchmark, window)), docs)


def _filtered(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    pairs = landed(pairs, "patterns")
    passes = max(1, math.ceil(pairs.count() / PATTERNS_AT_ONCE))
    clean = docs
    for step in range(passes):
        some = pairs.where(F.pmod(F.xxhash64("pattern", "item_id"), F.lit(passes)) == step).collect()
        sent = docs.sparkSession.sparkContext.broadcast(tables(some))

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for first, last, data, offsets in W.slices(batch.column("content")):
                    hashes, bounds = W.hashed_words(data, offsets, W.WORDY)
                    for each in sent.value:
                        ends, _ = each.search(hashes, bounds)
                        good[first + np.searchsorted(bounds, ends, "right") - 1] = False
                yield batch.filter(pa.array(good))
        clean = clean.mapInArrow(keep, docs.schema)
        if step + 1 < passes:
            clean = landed(clean, f"clean-{step}")
    return clean
