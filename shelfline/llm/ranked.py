"""Ranked lexical search over posting lists in geometric blocks.

The index is dealt over shards of documents. In a shard every term of the queries has its posting list, and
each list is clustered by how alike its documents are: the documents of a block are those nearest to one of
the list's pivots. A block stores the largest impact of every term over its documents, coordinate by
coordinate, so that query times summary bounds the score of each of them. A block is opened only if that
bound reaches the score a document needs, and the documents of open blocks are scored exactly. Lists of a few
documents are blocks of one, whose summary is the document itself and is not stored again.

Terms are ordered from heaviest to lightest. A document is looked for in the list of the heaviest query term
it holds, so the bound of a block counts that term and lighter ones only: what a heavier term would add is
found in that term's list. Long lists of light terms are therefore skipped almost whole.

All tasks of a search share a first bound: the k-th best score among the documents of a few shards, which the
k-th best of all documents cannot fall below.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import landed, new_path

K = 20
#: documents of a block, and of a shard at most; a shard's table of impacts has at most this many cells
BLOCK, SHARD, CELLS = 64, 2048, 1 << 23
#: shorter lists are blocks of one document
FEW = 32
#: shards of one file of the index: some ten megabytes
SHARDS_PER_FILE = 8
#: distinct terms of the queries that are searched for at a time; a single longer query is searched alone
TERMS_AT_ONCE = 1 << 16
#: directions in which documents of a list are compared
SKETCH = 32
#: one shard in so many gives the first bounds
SEED = 16

_VECTORS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
#: arrays of a shard, each stored as the bytes of its values: a task's reader then handles a shard in a few pieces
_ARRAYS = {"bounds": np.int32, "columns": np.int32, "impacts": np.int32, "terms": np.int32, "list_blocks": np.int32,
           "block_docs": np.int32, "docs": np.int32, "block_columns": np.int32, "summary_columns": np.int32,
           "summary": np.float32}
_INDEX = "shard bigint, ids array<bigint>, " + ", ".join(f"{name} binary" for name in _ARRAYS)


def query_terms(queries: DataFrame) -> DataFrame:
    """(query, item_id, term, times): the distinct terms of every row of queries, as hashes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in W.slices(batch.column("text")):
                hashes, bounds = W.hashed_words(data, offsets, W.WORDY)
                owner = np.repeat(np.arange(first, last), np.diff(bounds))
                pairs, times = np.unique(np.rec.fromarrays([owner, hashes.view(np.int64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query").take(pa.array(pairs.f0)), batch.column("item_id").take(pa.array(pairs.f0)),
                     pa.array(pairs.f1), pa.array(times)], names=["query", "item_id", "term", "times"])
    rows = queries.select(F.monotonically_increasing_id().alias("query"), F.col("item_id").cast("bigint").alias("item_id"), "text")
    return rows.mapInArrow(cut, "query bigint, item_id bigint, term bigint, times bigint")


def vectors(documents: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a word: its number of words, and how often it holds
    which of `terms` (sorted hashes, given back as places in them)."""
    sent = documents.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        for batch in batches:
            for first, last, data, offsets in W.slices(batch.column("text")):
                hashes, bounds = W.hashed_words(data, offsets, W.WORDY)
                n = np.diff(bounds)
                owner = np.repeat(np.arange(last - first), n)
                hashes = hashes.view(np.int64)
                at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                known = wanted[at] == hashes
                pairs, tfs = np.unique(owner[known] * len(wanted) + at[known], return_counts=True)
                ends = np.searchsorted(pairs, np.arange(last - first + 1) * len(wanted)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (pairs % len(wanted), tfs)]
                rows = pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array(n, pa.int64()), *lists],
                                                  names=["doc_id", "n", "terms", "tfs"])
                yield rows.filter(pa.array(n > 0))
    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(count, _VECTORS)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Shard:
    """Documents with their impacts, and the clustered posting lists over them."""

    def __init__(self, columns: np.ndarray, impacts: np.ndarray, bounds: np.ndarray, width: int):
        self.table = np.zeros((len(bounds) - 1, width), np.float32)     # impacts stay below 2^24
        self.table[np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), columns] = impacts

    def lists(self, weights: np.ndarray, block: int) -> dict[str, np.ndarray]:
        """Every list from heavy to light terms: blocks of documents alike, and their summaries."""
        signs = np.where(W.mix(np.arange(self.table.shape[1] * SKETCH, dtype=np.uint64)) & np.uint64(1), 1, -1)
        sketch = self.table @ (signs.reshape(-1, SKETCH) * weights[:, None]).astype(np.float32)
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-30)
        holding = self.table > 0
        terms, list_blocks, block_docs, docs, block_columns, columns, values = [], [], [], [], [], [], []
        for term in np.flatnonzero(holding.any(axis=0)):
            own = np.flatnonzero(holding[:, term])
            if len(own) < FEW:
                terms.append(term)
                list_blocks.append(len(own))
                block_docs.append(np.ones(len(own), np.int64))
                docs.append(own)
                block_columns.append(np.zeros(len(own), np.int64))
                continue
            starts = np.zeros(1, np.int64)
            if len(own) > block:
                pivots = own[np.arange(0, len(own), block)]
                nearest = np.argmax(sketch[own] @ sketch[pivots].T, axis=1)
                order = np.argsort(nearest, kind="stable")
                own, nearest = own[order], nearest[order]
                first = np.searchsorted(nearest, nearest)
                starts = np.flatnonzero((np.arange(len(own)) - first) % block == 0)
            summary = np.maximum.reduceat(self.table[own, term:], starts, axis=0)
            row, column = np.nonzero(summary)
            terms.append(term)
            list_blocks.append(len(starts))
            block_docs.append(np.diff(np.append(starts, len(own))))
            docs.append(own)
            block_columns.append(np.bincount(row, minlength=len(starts)))
            columns.append(column + term)
            values.append(summary[row, column])
        whole = lambda parts: np.concatenate(parts) if parts else np.zeros(0)
        made = {"terms": np.array(terms), "list_blocks": np.array(list_blocks), "block_docs": whole(block_docs), "docs": whole(docs),
                "block_columns": whole(block_columns), "summary_columns": whole(columns), "summary": whole(values)}
        return {name: array.astype(_ARRAYS[name]) for name, array in made.items()}


def index(found: DataFrame, place: np.ndarray, weights: np.ndarray, documents: int, length: int,
          block: int = BLOCK) -> DataFrame:
    """One row per shard of `vectors`: impacts of its documents, blocks and summaries of its lists.

    `place` gives each term its column (-1: weightless), `weights` the weight of each column, falling.
    """
    width = max(len(weights), 1)
    size = max(1, min(SHARD, CELLS // width))
    sent = found.sparkSession.sparkContext.broadcast((place, weights))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weights = sent.value

        def shard(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            terms, tfs = (rows.column(c).combine_chunks() for c in ("terms", "tfs"))
            lengths = np.asarray(terms.value_lengths())
            owner = np.repeat(np.arange(len(rows)), lengths)
            column, tf = place[terms.flatten().to_numpy()], tfs.flatten().to_numpy().astype(np.int64)
            m = 75 + (25 * rows.column("n").to_numpy() * documents) // length
            impact = (10 ** 9 * tf) // (1000 * tf + 12 * m[owner])
            keep = (column >= 0) & (impact > 0)
            owner, column, impact = owner[keep], column[keep], impact[keep]
            order = np.lexsort((column, owner))
            owner, column, impact = owner[order], column[order], impact[order]
            bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
            made = Shard(column, impact, bounds, width).lists(weights, block)
            ids = rows.column("doc_id").combine_chunks()
            name = zlib.crc32(ids.fill_null(0).to_numpy().tobytes())
            made |= {"bounds": bounds, "columns": column, "impacts": impact}
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int64()), pa.ListArray.from_arrays(np.array([0, len(ids)], np.int32), ids),
                 *(pa.array([made[n].astype(kind).tobytes()], pa.binary()) for n, kind in _ARRAYS.items())],
                names=["shard", "ids", *_ARRAYS])
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            while sum(b.num_rows for b in waiting) >= size:
                rows = pa.Table.from_batches(waiting)
                yield shard(rows.slice(0, size))
                waiting = rows.slice(size).to_batches()
        if sum(b.num_rows for b in waiting):
            yield shard(pa.Table.from_batches(waiting))
    return found.where(F.size("terms") > 0).mapInArrow(build, _INDEX)


class Best:
    """The k best documents of every query so far; equal scores by id, those without id last."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least = k, least.copy()
        none = np.zeros(0, np.int64)
        self.rows = [(none, none, none.astype(bool)) for _ in least]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        good = scores >= max(1, self.least[query])
        s, i, n = (np.concatenate(x) for x in zip(self.rows[query], (scores[good], ids[good], nameless[good])))
        order = np.lexsort((i, n, -s))[:self.k]
        self.rows[query] = s[order], i[order], n[order]
        if len(order) == self.k:
            self.least[query] = max(self.least[query], s[order[-1]])


def _scored(row: dict[str, np.ndarray], nameless: np.ndarray, asked: np.ndarray, best: Best) -> int:
    """Searches one shard for all queries; returns how many documents of open blocks were scored."""
    width = asked.shape[1]
    bounds = row["bounds"]
    table = np.zeros((len(bounds) - 1, width), np.float32)
    table[np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), row["columns"]] = row["impacts"]
    block_at = np.concatenate([[0], np.cumsum(row["list_blocks"])])
    doc_at = np.concatenate([[0], np.cumsum(row["block_docs"])])
    column_at = np.concatenate([[0], np.cumsum(row["block_columns"])])
    wanted = np.zeros((len(asked), len(bounds) - 1), bool)
    for at, term in enumerate(row["terms"].tolist()):
        holders = np.flatnonzero(asked[:, term])
        if not len(holders):
            continue
        first, last = block_at[at], block_at[at + 1]
        inside = slice(column_at[first], column_at[last])
        counted = term + np.flatnonzero(asked[holders, term:].any(axis=0))
        if inside.start == inside.stop:
            summary = table[np.ix_(row["docs"][doc_at[first]:doc_at[last]], counted)].astype(np.float64)
        else:
            whole = np.zeros((last - first, width - term), np.float32)
            whole[np.repeat(np.arange(last - first), row["block_columns"][first:last]),
                  row["summary_columns"][inside] - term] = row["summary"][inside]
            summary = whole[:, counted - term].astype(np.float64)
        # in doubles, so with room for their rounding
        bound = summary @ asked[np.ix_(holders, counted)].T * (1 + 1e-9)
        block, query = np.nonzero((bound >= np.maximum(best.least[holders], 1)))
        many = row["block_docs"][first + block]
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        wanted[np.repeat(holders[query], many), row["docs"][np.repeat(doc_at[first + block], many) + step]] = True
    for query in np.flatnonzero(wanted.any(axis=1)):
        docs, columns = np.flatnonzero(wanted[query]), np.flatnonzero(asked[query])
        scores = table[np.ix_(docs, columns)].astype(np.int64) @ asked[query, columns].astype(np.int64)
        best.add(query, scores, row["ids"][docs], nameless[docs])
    return int(wanted.sum())


def search(shards: DataFrame, asked: np.ndarray, names: np.ndarray, least: np.ndarray, k: int = K) -> DataFrame:
    """(query, doc_id, score): for every task and query the k best documents that reach `least`.

    asked: weight times occurrences of every column in every query; names: what queries are called.
    """
    sent = shards.sparkSession.sparkContext.broadcast((asked, names, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, names, least = sent.value
        best = Best(least, k)
        for batch in batches:
            for at in range(batch.num_rows):
                ids = batch.column("ids")[at].values
                row = {n: np.frombuffer(batch.column(n)[at].as_buffer(), kind) for n, kind in _ARRAYS.items()}
                row["ids"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
                _scored(row, np.asarray(ids.is_null()), asked, best)
        for query, (scores, ids, nameless) in enumerate(best.rows):
            if len(scores):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(scores), names[query])), pa.array(ids, pa.int64(), mask=nameless), pa.array(scores)],
                    names=["query", "doc_id", "score"])
    return shards.mapInArrow(run, "query bigint, doc_id bigint, score bigint")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, with their rank."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(documents: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK,
           terms_at_once: int = TERMS_AT_ONCE, seed: int = SEED) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of queries its k documents of highest score above 0.

    Every row of documents is a document; null, empty and wordless texts are none. Equal scores rank by
    ascending doc_id, null ids last; repeated ids are ranked each on its own. Every row of queries is asked
    on its own, also repeated and null item_ids; queries without terms in the corpus have no rows. Other
    columns are left out, empty tables give an empty result. Queries are searched for in parts of
    `terms_at_once` terms, which bounds what is broadcast; every part reads the documents once.
    """
    spark = documents.sparkSession
    terms = landed(query_terms(queries), "query-terms")
    parts = max(1, math.ceil(terms.count() / terms_at_once))
    found = []
    for part in range(parts):
        some = terms.where(F.pmod(F.xxhash64("query"), F.lit(parts)) == part).select("query", "term", "times").toArrow()
        query, term, times = (some.column(c).to_numpy() for c in ("query", "term", "times"))
        if not len(term):
            continue
        found += _part(documents, query, term, times, k, block, seed, part)
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    items = terms.select("query", "item_id").distinct()
    return _first(whole, k).join(items, "query").select("item_id", "rank", "doc_id", "score")


def _part(documents: DataFrame, query: np.ndarray, term: np.ndarray, times: np.ndarray, k: int, block: int,
          seed: int, part: int) -> list[DataFrame]:
    known = np.unique(term)
    counted = landed(vectors(documents, known), f"vectors-{part}")
    total = counted.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    if not total.n:
        return []
    held = counted.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
    weights = np.zeros(len(known), np.int64)
    weights[held.column("t").to_numpy()] = [weight(total.n, h) for h in held.column("count").to_pylist()]
    heavy = np.argsort(-weights, kind="stable")[:int((weights > 0).sum())]
    place = np.full(len(known), -1, np.int64)
    place[heavy] = np.arange(len(heavy))
    if not len(heavy):
        return []
    names, row = np.unique(query, return_inverse=True)
    column = place[np.searchsorted(known, term)]
    asked = np.zeros((len(names), len(heavy)))
    inside = column >= 0
    asked[row[inside], column[inside]] = times[inside] * weights[heavy][column[inside]]
    built = index(counted, place, weights[heavy], total.n, total.l, block)
    path = new_path(counted.sparkSession, f"index-{part}")
    built.write.option("maxRecordsPerFile", SHARDS_PER_FILE).option("compression", "zstd").parquet(path)
    shards = counted.sparkSession.read.schema(built.schema).parquet(path)
    least = np.zeros(len(names), np.int64)
    first = F.pmod("shard", F.lit(seed)) == 0
    begun = landed(search(shards.where(first), asked, names, least, k), f"seed-{part}")
    for r in _first(begun, k).where(F.col("rank") == k).select("query", "score").collect():
        least[np.searchsorted(names, r["query"])] = r["score"]
    return [begun, search(shards.where(~first), asked, names, least, k)]
