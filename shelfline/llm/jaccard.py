"""Exact Jaccard links over word shingles by a token-group matrix.

Documents with equal shingle sets are one class. Classes that share their rarest recurring shingles are
partitioned around the most typical of them and compared with it, which joins most near copies. What is
left is searched exactly: classes of like size that hold the same widespread shingle, or are already
connected, form groups, and the matrix holds the tokens of every group's union with the first place they
take in a member. Groups count the tokens they share up to the places that their sizes leave open; pairs
with too few stay closed, and the others are opened. A class that shares enough with an opened group's union
is compared with all its members at once.

A shingle that recurs in many classes meets as many groups as its classes fill, not as many as there are
classes: groups grow with the square root of what they divide, so the pairs of them grow in proportion.

Only the smallest quarter of a set (in an order that puts common shingles last) can be needed to notice
a partner at 0.75, so only that prefix is shuffled for all documents, and whole sets only for classes with
a group to open. Shingles and classes are known by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import bitmap, components, in_bitmap, landed, named_back, neutral, partitions, sieved
from shelfline.llm.recurring import recurring

SHINGLE = 5
PERCENT = 75
#: members of a group: at least, and at most; between them the square root of the classes that are divided
GROUP, LARGEST_GROUP = 64, 1024
#: tokens a group's members hold together, where one of them does not hold more alone
GROUP_TOKENS = 4_000_000
#: a shingle in so many components gathers its classes, connected or not
HUB = 8
#: queries compared with one copy of a group
QUERIES = 4096
#: shingles are counted in stretches of so many; those seen twice in a stretch, this often altogether, are
#: common. They are told to tasks as a bitmap of bounded size, and the most common also by name. Being
#: common only puts a shingle later in the order; it never affects a result.
STRETCH, COMMON_FROM, COMMON_BITS, MOST_COMMON = 2_000_000, 8, 1 << 25, 50_000
#: shingles a class is partitioned by
KEYS = 3
#: sizes in a group differ by less than this factor
BAND = 1.05
#: how much of the prefixes is compared between groups: 0 for the least that shows any partner, 1 for all
REACH = 0.25
#: near copies share most of their prefix; classes that do not wait for the exact search
LIKELY = 0.3
#: added to the hash of a sequence too short for a shingle, by its length
_SHORT = W.mix(np.arange(1, 64, dtype=np.uint64))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for first, last, data, offsets in W.slices(texts):
        hashes, bounds = W.hashed_words(data, offsets, W.SPACED)
        runs = W.run_hash(hashes, size)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if hi - lo >= size:
                yield np.unique(runs[lo:hi - size + 1])
            elif hi > lo:
                # a shorter sequence is one shingle, kept apart from the longer ones by its length
                yield W.mix(W.run_hash(hashes[lo:hi], hi - lo) + _SHORT[hi - lo])
            else:
                yield np.zeros(0, np.uint64)


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Tokens that a set of n must share with any partner."""
    return -(-percent * n // 100)


class _Group:
    """The sets of a group's members as one sorted array of tokens with their owners, and what is connected."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]):
        self.members = [(cls, comp) for cls, comp, _ in members]
        self.sizes = np.array([len(x) for _, _, x in members])
        tokens = np.concatenate([x for _, _, x in members])
        owners = np.repeat(np.arange(len(members), dtype=np.int32), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.owners = owners[order]
        self.union, self.starts = np.unique(tokens[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(tokens))
        self.parents: dict[int, int] = {}

    def links(self, cls: int, comp: int, tokens: np.ndarray, percent: int) -> Iterator[int]:
        """Members that the set links with, but for those whose component is connected with its own already."""
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        at = at[self.union[at] == tokens]
        if len(at) < least_overlap(len(tokens), percent):
            return
        lengths = self.ends[at] - self.starts[at]
        places = np.repeat(self.starts[at] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        same = np.bincount(self.owners[places], minlength=len(self.members))
        for i in np.flatnonzero(100 * same >= percent * (len(tokens) + self.sizes - same)).tolist():
            other, at_other = self.members[i]
            one, two = self._root(comp), self._root(at_other)
            if one != two:
                self.parents[one] = two
                yield other

    def _root(self, comp: int) -> int:
        while (up := self.parents.get(comp, comp)) != comp:
            self.parents[comp] = comp = self.parents.get(up, up)
        return comp


def _measure(size: int):
    """A row per document (token null), and rows (token, n) of shingles that recur in a stretch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = {}, 0
        for batch in batches:
            ns, ids = [], []
            for tokens in shingle_sets(batch.column("text"), size):
                ns.append(len(tokens))
                ids.append(set_id(tokens) if len(tokens) else None)
                if len(tokens) and ids[-1] not in held:  # copies of one set count once
                    held[ids[-1]] = tokens
                    weight += len(tokens)
                if weight >= STRETCH:
                    yield _common(held)
                    held, weight = {}, 0
            nothing = pa.nulls(len(ns), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(ids, pa.int64()), pa.array(ns, pa.int64()),
                 nothing], names=["doc_id", "row_key", "cls", "n", "token"])
        if held:
            yield _common(held)
    return run


def _common(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    tokens, counts = np.unique(np.concatenate(list(held.values())), return_counts=True)
    keep = counts > 1
    n = int(keep.sum())
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
         pa.array(counts[keep].astype(np.int64)), pa.array(tokens[keep].view(np.int64))],
        names=["doc_id", "row_key", "cls", "n", "token"])


def _prefix(tokens: np.ndarray, percent: int, common: np.ndarray, known: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The part of a set that must meet a partner's, in order: by rank (0 rare, 1 common, then the most
    common by their counts), then by hash."""
    ranks = in_bitmap(common, tokens).astype(np.int32)
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        ranks = np.where(known[at] == tokens, rank[at], ranks).astype(np.int32)
    return tokens[np.lexsort((tokens, ranks))[:len(tokens) - least_overlap(len(tokens), percent) + 1]]


def _prefixes(size: int, percent: int, common):
    """Entries (token, class, place in the order) of all prefixes."""
    def entries(batch: pa.RecordBatch):
        for tokens in shingle_sets(batch.column("text"), size):
            if len(tokens):
                own = _prefix(tokens, percent, *common.value)
                yield own, np.full(len(own), set_id(tokens)), np.arange(len(own), dtype=np.int32)
    return entries


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(set_id(x), x) for x in shingle_sets(batch.column("text"), size) if len(x)]
            for i in range(0, len(found), 500):
                some = found[i:i + 500]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _ in some], pa.int64()), pa.array([x.tobytes() for _, x in some], pa.binary())],
                    names=["cls", "tokens"])
    return run


def _opened(percent: int):
    """Links of queries to members of their group, that connect all components between which there are any;
    a query with too few tokens in the group's union is not compared with its members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members, group = None, [], None
        for batch in batches:
            a, b = [], []
            for g, s, q, cls, comp, blob in zip(*(batch.column(c) for c in ("grp", "salt", "query", "cls", "comp", "tokens"))):
                if (g.as_py(), s.as_py()) != at:
                    at, members, group = (g.as_py(), s.as_py()), [], None
                tokens = np.frombuffer(blob.as_py(), np.uint64)
                if not q.as_py():
                    members.append((cls.as_py(), comp.as_py(), tokens))
                    continue
                group = group or _Group(members)
                for other in group.links(cls.as_py(), comp.as_py(), tokens, percent):
                    a.append(cls.as_py())
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _roots(links: DataFrame, rows: int) -> DataFrame:
    return components(links, rows=rows).select(F.col("id").alias("cls"), F.col("component").alias("comp"))


def _between(links: DataFrame, known: DataFrame) -> DataFrame:
    """Links of classes as links of their components, each once."""
    at_a = known.select(F.col("cls").alias("a"), F.col("comp").alias("comp_a"))
    at_b = known.select(F.col("cls").alias("b"), F.col("comp").alias("comp_b"))
    return links.join(at_a, "a").join(at_b, "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct()


def linked_documents(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of documents: doc_id, n_shingles, cls (hash of the shingle set, null if empty) and
    component_id, the smallest doc_id reachable over links of at least `percent`, itself included.

    Null, empty and wordless texts have no shingles and link with nothing. Rows that repeat an id are
    documents of their own; rows without id take part and take their component's smallest id (null if
    it has none). An empty table gives an empty result.
    """
    return _placed(documents, size, percent).select("doc_id", "n_shingles", "component_id", "cls")


def _placed(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """As `linked_documents`, with row_key (hash of id and text) and kept_key, that of the row that stands for
    the component: the smallest id, then the smallest key, rows without id last. Null without shingles."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("bigint"), F.xxhash64("doc_id", "text").alias("row_key"), "text")
    n_parts = partitions(spark)
    measured = landed(docs.mapInArrow(
        _measure(size), "doc_id bigint, row_key bigint, cls bigint, n bigint, token bigint"), "measured")
    rows = measured.where(F.col("token").isNull()).drop("token")
    classes = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("head"), F.min("row_key").alias("row_key"), F.first("n").alias("n"))

    common = spark.sparkContext.broadcast(_common_shingles(measured))
    meeting = landed(recurring(docs.select("text"), _prefixes(size, percent, common)).select(
        F.col("key").alias("token"), F.col("a").alias("cls"), F.col("b").alias("place")).distinct(), "meeting")

    met = meeting.groupBy("cls").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("place", "token"))), 1, KEYS)["token"].alias("keys"),
        F.count("*").alias("shared"))
    n_meeting = meeting.count()
    near = landed(met.join(classes, "cls"), "near", rows=n_meeting + measured.count())
    links = _to_typical(docs, near, size, percent, n_parts)
    n_near = near.count()
    known = near.join(_roots(links, links.count()), "cls", "left").select(
        "cls", "n", "row_key", F.coalesce("comp", "cls").alias("comp"))
    known = landed(known, "known", rows=n_near)

    more = _across(docs, meeting, known, size, percent, n_parts, n_meeting)
    # the later links only join components already found, which stand for their classes
    merged = _roots(_between(more, known), more.count() + n_near).select(F.col("cls").alias("comp"), F.col("comp").alias("whole"))
    comp = known.select("cls", "comp").join(merged, "comp", "left").select("cls", F.coalesce("whole", "comp").alias("comp"))
    placed = classes.select("cls", "head").join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    least = placed.groupBy("comp").agg(F.min("head").alias("least"))
    by_class = placed.join(least, "comp").select("cls", F.col("least.doc_id").alias("component_id"), F.col("least.row_key").alias("kept_key"))
    return rows.join(by_class, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "cls",
        "row_key", "kept_key")


def _to_typical(docs: DataFrame, near: DataFrame, size: int, percent: int, n_parts: int) -> DataFrame:
    """Links of likely near copies to the most typical class with one of their keys: that of which the
    largest share of the prefix recurs, as an original's does among its edited copies."""
    likely = near.where(F.col("shared") >= LIKELY * (1 - percent / 100) * F.col("n"))
    keyed = likely.select("cls", "n", "row_key", (F.col("shared") / F.col("n")).alias("share"), F.explode("keys").alias("key"))
    typical = keyed.groupBy("key").agg(F.max(F.struct("share", "cls", "n", "row_key")).alias("top"))
    pairs = keyed.join(typical, "key").where(F.col("cls") != F.col("top.cls")).where(
        100 * F.least("n", "top.n") >= percent * F.greatest("n", "top.n"))
    pairs = landed(pairs.select("cls", "row_key", F.col("top.cls").alias("grp"), F.col("top.row_key").alias("g_key")).distinct(), "pairs",
                   rows=KEYS * near.count())
    members = pairs.select(F.col("grp").alias("cls"), F.col("grp").alias("comp"), "grp").distinct()
    rows = pairs.select("row_key").unionByName(pairs.select(F.col("g_key").alias("row_key")))
    queries = pairs.select("cls", F.col("cls").alias("comp"), "grp")
    return _links(queries, members, _sets_of(docs, rows, size), percent, n_parts, "links-0")


def _links(queries: DataFrame, members: DataFrame, sets: DataFrame, percent: int, n_parts: int, name: str) -> DataFrame:
    """Compares the classes of `queries` (cls, comp, grp) with the `members` (cls, comp, grp) of their groups. A
    group with many queries is dealt out several times, so no task holds more than a share of them."""
    salts = queries.groupBy("grp").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("salts"))
    asked = (queries.join(salts, "grp").select("cls", "comp", "grp", F.pmod(F.xxhash64("cls"), F.col("salts")).cast("int").alias("salt"))
             .withColumn("query", F.lit(True)))
    held = (members.join(salts, "grp")
            .select("cls", "comp", "grp", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
            .withColumn("query", F.lit(False)))
    rows = asked.unionByName(held).join(sets, "cls").repartition(n_parts, "grp", "salt")
    return landed(rows.sortWithinPartitions("grp", "salt", "query").select("grp", "salt", "query", "cls", "comp", "tokens")
                  .mapInArrow(_opened(percent), "a bigint, b bigint"), name)


def _sets_of(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(cls, tokens) of the given classes, from the text of the row that stands for each."""
    wanted = classes.select("row_key").distinct()
    texts = sieved(docs.select("row_key", "text"), wanted, "row_key")
    texts = texts.join(wanted.hint("shuffle_hash"), "row_key", "left_semi").select("text")
    return texts.mapInArrow(_sets(size), "cls bigint, tokens binary")


def _common_shingles(measured: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bitmap of common shingles, and the most common of them, sorted by hash, with ranks by count."""
    counted = landed(measured.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("n").alias("n"))
                     .where(F.col("n") >= COMMON_FROM), "common")
    named = counted.orderBy(F.desc("n"), "token").limit(MOST_COMMON).toArrow().column("token").to_numpy()
    tokens = named[::-1].copy().view(np.uint64)
    order = np.argsort(tokens)
    return bitmap(counted, "token", COMMON_BITS), tokens[order], np.arange(2, len(tokens) + 2, dtype=np.int32)[order]


def _across(docs: DataFrame, meeting: DataFrame, known: DataFrame, size: int, percent: int, n_parts: int,
            n_meeting: int) -> DataFrame:
    """Links between classes that are not yet connected, at least one for every such pair of components
    that has any."""
    placed = meeting.join(known.select("cls", "comp"), "cls")
    foreign = (placed.groupBy("token", "comp").agg(F.lit(1).alias("one")).groupBy("token").agg(F.count("*").alias("comps"))
               .where("comps > 1"))
    placed = landed(placed.join(foreign, "token").select("token", "cls", "place", "comps"), "placed",
                    rows=n_meeting)
    n_placed = placed.count()
    members = landed(_grouped(placed, known), "members", rows=n_placed)
    groups = members.groupBy("grp").agg(
        F.min("n").cast("int").alias("lo"), F.max("n").cast("int").alias("hi"), F.min("comp").alias("from"),
        F.max("comp").alias("to"), F.count("*").cast("int").alias("size"), F.max("shared").cast("int").alias("most"))
    matrix = landed(placed.join(members.select("cls", "grp"), "cls").groupBy("token", "grp").agg(F.min("place").alias("place"))
                    .join(groups, "grp"), "matrix", rows=n_placed)

    # Partners of x and y tokens share at least m = share / (1 + share) * (x + y) of them. For any k, at least
    # k of those are among the first x - m + k of the one and the first y - m + k of the other; both lie
    # within the prefixes while k - 1 is at most m - share * max(x, y), so either holds as many foreign tokens
    # in its prefix. The bounds of a group take the place of x and y.
    share = percent / 100
    left, right = (matrix.select("token", *(F.col(c).alias(f"{c}_{side}") for c in (
        "grp", "place", "lo", "hi", "from", "to", "size", "most"))) for side in "ab")
    lo_a, hi_a, lo_b, hi_b = (F.col(c) for c in ("lo_a", "hi_a", "lo_b", "hi_b"))
    spare = F.greatest(F.lit(0.0), (lo_a + lo_b) * (share / (1 + share)) - share * F.greatest(hi_a, hi_b) - 1e-6)
    more = F.floor(spare * REACH)
    met = (left.join(right, "token")
           .where((F.col("grp_a") < F.col("grp_b")) & (F.least("from_a", "from_b") < F.greatest("to_a", "to_b"))
                  & (hi_b >= share * lo_a - 1e-6) & (hi_a >= share * lo_b - 1e-6) & (F.least("most_a", "most_b") > F.floor(spare))
                  & (F.col("place_a") <= (hi_a - share * lo_b) / (1 + share) + more + 1e-6)
                  & (F.col("place_b") <= (hi_b - share * lo_a) / (1 + share) + more + 1e-6))
           .groupBy("grp_a", "grp_b").agg(F.count("*").alias("shared"), F.first(more).alias("more"),
                                          F.first(F.col("size_a") <= F.col("size_b")).alias("a_asks"))
           .where(F.col("shared") > F.col("more")))
    # the smaller group asks the larger one, and a group of several components itself
    asking = met.select(F.when(F.col("a_asks"), F.col("grp_a")).otherwise(F.col("grp_b")).alias("asks"),
                        F.when(F.col("a_asks"), F.col("grp_b")).otherwise(F.col("grp_a")).alias("grp"))
    asking = asking.unionByName(groups.where(F.col("from") < F.col("to")).select(F.col("grp").alias("asks"), "grp"))
    queries = landed(asking.join(members.select("cls", "comp", F.col("grp").alias("asks")), "asks")
                     .select("cls", "comp", "grp"), "queries")
    held = landed(members.select("cls", "comp", "grp").join(queries.select("grp").distinct(), "grp", "left_semi"), "held",
                  rows=n_placed)
    wanted = queries.select("cls").unionByName(held.select("cls")).distinct().join(known.select("cls", "row_key"), "cls")
    return _links(queries, held, _sets_of(docs, wanted, size), percent, n_parts, "links-2")


def _grouped(placed: DataFrame, known: DataFrame) -> DataFrame:
    """The classes of `placed` with comp, n, shared (their foreign tokens) and grp. Classes of like size, so that
    a group's bounds are close to its members', which hold the same most widespread shingle or else are
    connected, are dealt to groups."""
    hub = F.when(F.col("comps") >= HUB, F.struct("comps", "token"))
    kinds = placed.groupBy("cls").agg(F.count("*").alias("shared"), F.max(hub)["token"].alias("hub")).join(known, "cls")
    kinds = kinds.select("cls", "comp", "n", "shared", F.xxhash64(
        F.col("hub").isNull(), F.coalesce("hub", "comp"), F.floor(F.log("n") / F.log(F.lit(BAND)))).alias("kind"))
    counts = kinds.groupBy("kind").agg(F.count("*").alias("count"), F.max("n").alias("longest"))
    each = F.greatest(F.lit(1.0), F.least(F.greatest(F.sqrt("count"), F.lit(GROUP)), F.lit(LARGEST_GROUP),
                                          GROUP_TOKENS / F.col("longest")))
    return kinds.join(counts, "kind").select("cls", "comp", "n", "shared", F.xxhash64(
        "kind", F.pmod(F.xxhash64("cls"), F.ceil(F.col("count") / each))).alias("grp"))


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Of every component exactly one row stays, with all columns, whatever their names: that of the smallest
    id, of rows that repeat it the one whose id and text have the smallest hash, and of rows equal in both the
    one whose columns come first (with a map among them, as JSON). A row without id stays only if no row of its
    component has one. Null, empty and wordless texts have no shingles and stay, all of them. An empty table
    gives an empty one."""
    found = landed(_placed(docs, size, percent).where(F.col("kept_key").isNotNull()).select("row_key", "kept_key"), "kept")
    gone = found.where("row_key <> kept_key").select(F.col("row_key").alias("key")).distinct()
    again = landed(found.where("row_key = kept_key").groupBy(F.col("row_key").alias("key")).agg(F.count("*").alias("n"))
                   .where("n > 1").select("key"), "again")
    keyed = neutral(docs, F.xxhash64("doc_id", "text").alias("key"))
    if again.isEmpty():
        return named_back(keyed.join(gone, "key", "left_anti"), docs)
    single = keyed.join(gone.unionByName(again), "key", "left_anti").drop("key")
    copies = sieved(keyed, again, "key").join(again.hint("shuffle_hash"), "key", "left_semi")
    row = F.struct(*single.columns)
    order = F.to_json(row) if "map<" in docs.schema.simpleString() else row
    first = copies.groupBy("key").agg(F.min_by(row, order).alias("row")).select("row.*")
    return named_back(single.unionByName(first), docs)
