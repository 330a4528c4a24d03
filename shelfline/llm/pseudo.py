"""Language-model scores by masked pseudo-likelihood.

A small network reads the two words on either side of a position, each with its class, and predicts the
word there by a hierarchical softmax: first its class, then the way down a Huffman tree of the class, whose
branches start from the corpus frequencies. The leaves are the words of the vocabulary and, for all others,
buckets by length and hash; within a bucket a word has its corpus frequency. The product is a distribution
over all words, and the sum of its logarithms over every position of a document is the document's score.

Word counts cover the whole corpus and are kept whole as a written table. The most frequent words are told
to every task; a document's other words get their frequency by a join on the word. The network is trained in numpy where the documents are: each task
starts from the same weights, masks a fixed share of the positions of all its documents in turn, and hands
back its weights; they are averaged by the number of positions (those of a word or branch by how often the
task met it), and the next round starts from the mean.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import landed

#: most frequent words, told to every task; the frequencies of the others are joined
VOCABULARY = 8192
#: classes: one for each of the most frequent words, some that hold the other known words by frequency,
#: and some that hold all other words by length
SINGLE, BY_FREQUENCY, BY_LENGTH = 32, 24, 8
CLASSES = SINGLE + BY_FREQUENCY + BY_LENGTH
#: buckets of the words beyond the vocabulary, by class
BUCKETS = 256
_LENGTHS = np.array([4, 6, 8, 10, 13, 17, 25])
REACH, HIDDEN = 2, 16
#: share of positions masked in a round, rounds, positions per step, and step size
MASKED, ROUNDS, BATCH, RATE = 0.15, 2, 512, 0.5
#: step size of the vectors of words and branches, divided by the root of their squared steps so far
SPARSE_RATE, _FIRST = 0.1, 0.01
#: positions scored at a time
SCORED = 16_384
#: bits of a hash by which a known word is looked up
_SLOT = 17
_EDGE = CLASSES  # the context class beyond either end of a document


def length_class(lengths: np.ndarray) -> np.ndarray:
    return SINGLE + BY_FREQUENCY + np.searchsorted(_LENGTHS, lengths, "right")


@dataclass
class Tree:
    """Binary trees over the entries of each class; a branch leads to one side with a log odds of `bias`
    where nothing is known of the context."""
    starts: np.ndarray  # of each entry's way in the two following, and the end
    nodes: np.ndarray
    signs: np.ndarray
    bias: np.ndarray  # by node

    @cached_property
    def leans(self) -> np.ndarray:
        """Log odds of each turn of the ways where nothing is known of the context."""
        return self.signs * self.bias[self.nodes]

    def ways(self, entry: np.ndarray) -> tuple[np.ndarray, ...]:
        """Nodes, signs and leans of the ways to the entries, one after the other, and which of the entries each is of."""
        start = np.take(self.starts, entry)
        lengths = np.take(self.starts, entry + 1) - start
        begin = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum())) + np.repeat(start - begin, lengths)
        return *(np.take(x, at) for x in (self.nodes, self.signs, self.leans)), np.repeat(np.arange(len(entry)), lengths)


def huffman(classes: np.ndarray, mass: np.ndarray) -> Tree:
    """Frequent entries have short ways; ties are broken by place."""
    up, side, bias = np.full(2 * len(classes), -1), np.zeros(2 * len(classes), np.float32), []
    for c in np.unique(classes).tolist():
        heap = [(m, i) for i, m in zip(np.flatnonzero(classes == c).tolist(), mass[classes == c].tolist())]
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            node = len(classes) + len(bias)
            up[[i, j]], side[[i, j]] = node, (1, -1)
            bias.append(math.log(a / b))
            heapq.heappush(heap, (a + b, node))
    starts, nodes, signs = [0], [], []
    for i in range(len(classes)):
        while up[i] >= 0:
            nodes.append(up[i] - len(classes))
            signs.append(side[i])
            i = up[i]
        starts.append(len(nodes))
    return Tree(np.array(starts), np.array(nodes, np.int64), np.array(signs, np.float32), np.array(bias, np.float32))


@dataclass
class Vocabulary:
    words: np.ndarray  # hashes, sorted
    classes: np.ndarray  # of the known words
    log_known: np.ndarray  # log probability of a known word within its class
    log_unknown: np.ndarray  # of a word within its class that the corpus does not hold, by class
    tree: Tree  # over the known words, then the buckets
    log_leaf: np.ndarray  # log probability at a leaf of the tree, but for the count of a word in a bucket

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class and log probability within it of every word, and the number of words before each text. To that
        of a word beyond the known ones the logarithm of its count is still to be added (`rare`)."""
        classes, inside, bounds, _, _ = self.parsed(data, offsets)
        return classes, inside, bounds

    @property
    def entries(self) -> int:
        return len(self.log_leaf)

    @cached_property
    def class_of(self) -> np.ndarray:
        """Class of every entry, and of the edge of a text, which comes after them."""
        buckets = np.repeat(np.arange(SINGLE + BY_FREQUENCY, CLASSES), BUCKETS)
        return np.concatenate([self.classes, buckets, [_EDGE]])

    @cached_property
    def _slots(self) -> tuple[np.ndarray, np.ndarray]:
        """The first known word with each beginning of a hash, and whether there are more."""
        slots, first, n = np.unique(self.words >> np.uint64(64 - _SLOT), return_index=True, return_counts=True)
        place, shared = np.zeros(1 << _SLOT, np.int32), np.zeros(1 << _SLOT, bool)
        place[slots], shared[slots] = first, n > 1
        return place, shared

    def parsed(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """As `encode`, with the hash of every word and its entry; those from `len(self.words)` on are buckets."""
        bounds, hashes, entries = self.entered(data, offsets)
        return self.class_of[entries], self.inside(entries), bounds, hashes, entries

    def inside(self, entries: np.ndarray) -> np.ndarray:
        """Log probability of entries within their classes by frequency alone."""
        return np.concatenate([self.log_known, self.log_unknown[self.class_of[len(self.words):-1]]])[entries]

    def entered(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of words before each text, and the hash and the entry of every word."""
        lower = W.LOWER[data]
        starts, ends, bounds = W.words(lower, offsets, W.WORDY)
        hashes = W.span_hash(W.prefix_sums(lower), starts, ends)
        if len(self.words):
            place, shared = self._slots
            slot = (hashes >> np.uint64(64 - _SLOT)).view(np.int64)
            entries = np.take(place, slot).astype(np.int64)
            other = np.flatnonzero(np.take(self.words, entries) != hashes)
            more = other[np.take(shared, slot[other])]
            at = np.minimum(np.searchsorted(self.words, hashes[more]), len(self.words) - 1)
            entries[more] = at
            other = other[np.take(self.words, entries[other]) != hashes[other]]
        else:
            entries, other = np.zeros(len(hashes), np.int64), np.arange(len(hashes))
        beyond = length_class(ends[other] - starts[other]) - SINGLE - BY_FREQUENCY
        entries[other] = len(self.words) + beyond * BUCKETS + (hashes[other] % np.uint64(BUCKETS)).astype(np.int64)
        return bounds, hashes, entries


def count_words(docs: DataFrame) -> DataFrame:
    """(word, length, n): how often each word occurs in all texts; counted in tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, data, offsets in W.slices(batch.column("text")):
                lower = W.LOWER[data]
                starts, ends, _ = W.words(lower, offsets, W.WORDY)
                held.append((W.span_hash(W.prefix_sums(lower), starts, ends), ends - starts))
                size += len(starts)
                if size >= 2_000_000:
                    yield _counted(held)
                    held, size = [], 0
        if size:
            yield _counted(held)
    return docs.select("text").mapInArrow(run, "word bigint, length int, n bigint").groupBy("word").agg(
        F.max("length").alias("length"), F.sum("n").alias("n"))


def _counted(held: list) -> pa.RecordBatch:
    hashes, lengths = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(hashes)  # a word has one length, whichever of its places comes first
    words = hashes[order]
    first = _firsts(words)
    n = np.diff(first, append=len(words))
    return pa.RecordBatch.from_arrays([pa.array(words[first].view(np.int64)), pa.array(lengths[order[first]].astype(np.int32)), pa.array(n.astype(np.int64))],
                                      names=["word", "length", "n"])


def vocabulary(docs: DataFrame, size: int = VOCABULARY, counts: DataFrame | None = None) -> Vocabulary:
    """The `size` most frequent words; `counts` are the written counts of all words, if there are any yet."""
    counts = landed(count_words(docs), "word-counts") if counts is None else counts
    top = counts.orderBy(F.desc("n"), "word").limit(size).toArrow()
    words, n = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy().astype(float)
    classes = np.arange(len(words))
    rest = len(words) - SINGLE
    if rest > 0:  # classes of the same mass, by falling frequency
        mass = np.cumsum(n[SINGLE:])
        classes[SINGLE:] = SINGLE + np.minimum((mass - n[SINGLE:]) / mass[-1] * BY_FREQUENCY, BY_FREQUENCY - 1).astype(int)
    total = np.bincount(classes, n, CLASSES)
    log_known = np.log(n / total[classes]) if len(words) else n
    # tokens beyond the vocabulary by class, and one more for the words that the corpus does not hold
    bucket = F.lit(SINGLE + BY_FREQUENCY)
    for limit in _LENGTHS.tolist():
        bucket = bucket + F.when(F.col("length") >= limit, 1).otherwise(0)
    rest = np.zeros((CLASSES, BUCKETS))
    place = F.pmod(F.col("word"), F.lit(BUCKETS)).cast("int")
    for r in counts.groupBy(bucket.alias("c"), place.alias("b")).agg(F.sum("n").alias("n")).collect():
        rest[r.c, r.b] = r.n
    if len(words):
        np.subtract.at(rest, (length_class(top.column("length").to_numpy()), (words % np.uint64(BUCKETS)).astype(np.int64)), n)
    order = np.argsort(words)
    beyond = rest[SINGLE + BY_FREQUENCY:].ravel() + 1 / BUCKETS
    tree = huffman(np.concatenate([classes[order], np.repeat(np.arange(SINGLE + BY_FREQUENCY, CLASSES), BUCKETS)]),
                   np.concatenate([n[order], beyond]))
    return Vocabulary(words[order], classes[order], log_known[order], -np.log(rest.sum(axis=1) + 1),
                      tree, np.concatenate([np.zeros(len(words)), -np.log(beyond)]))


def _sigmoid_log(x: np.ndarray) -> np.ndarray:
    return np.minimum(x, np.float32(0)) - np.log1p(np.exp(-np.abs(x)))


def _in_order(at: np.ndarray, places: int) -> np.ndarray:
    """Stable order of places; small numbers are sorted by their digits."""
    return np.argsort(at.astype(np.uint16) if places <= 1 << 16 else at, kind="stable")


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each value of an ordered array begins."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def _sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows from each place to the next; most are a single row."""
    sizes = np.diff(first, append=len(rows))
    total, several = np.take(rows, first, axis=0), sizes > 1
    if several.any():
        rows = np.take(rows, np.flatnonzero(np.repeat(several, sizes)), axis=0)
        sizes = sizes[several]
        total[several] = np.add.reduceat(rows, np.cumsum(sizes) - sizes, axis=0)
    return total


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def _line_sums(z: np.ndarray) -> np.ndarray:
    """Sums over the first axis in the order in which numpy adds up a row of `CLASSES`."""
    z = z.reshape(-1, 8, z.shape[1]).sum(axis=0)
    z = z[::2] + z[1::2]
    z = z[::2] + z[1::2]
    return z[0] + z[1]


class Network:
    """Sum of embeddings by position, tanh, a softmax over classes, and a logistic unit at every branch.

    Without entries it predicts classes only, and a word has its frequency within its class.
    """

    def __init__(self, weights: np.ndarray | None = None, entries: int = 0, nodes: int = 0):
        sides = 2 * REACH
        shapes = [(sides, CLASSES + 1, HIDDEN), (HIDDEN, CLASSES), (CLASSES,),
                  (sides, entries + 1 if entries else 0, HIDDEN), (nodes, HIDDEN)]
        sizes = [math.prod(s) for s in shapes]
        if weights is None:
            rng = np.random.default_rng(7)
            weights = np.concatenate([rng.normal(0, 0.3, sizes[0]), rng.normal(0, 0.1, sizes[1]), np.zeros(sum(sizes[2:]))])
        self.entries = entries
        self.weights = weights.astype(np.float32)
        cuts = np.cumsum(sizes)[:-1]
        self.embed, self.out, self.bias, self.words, self.nodes = (
            x.reshape(s) for x, s in zip(np.split(self.weights, cuts), shapes))
        # squared steps of the vectors of words, one side after the other, and of branches
        self.squares = [np.full(x.size // HIDDEN, _FIRST, np.float32) for x in (self.words, self.nodes)]

    def hidden(self, context: np.ndarray, around: np.ndarray | None = None) -> np.ndarray:
        """From the classes on both sides, and the entries."""
        total = np.take(self.embed[0], context[:, 0], axis=0)
        for i in range(1, context.shape[1]):
            total += np.take(self.embed[i], context[:, i], axis=0)
        if around is not None:
            for i in range(around.shape[1]):
                total += np.take(self.words[i], around[:, i], axis=0)
        return np.tanh(total)

    def sides(self, class_of: np.ndarray) -> list[np.ndarray]:
        """What each entry adds on each side, with its class: one table a side, for a network that is done."""
        return [embed[class_of] + (words if self.entries else 0) for embed, words in zip(self.embed, self.words)]

    def log_probability(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        z = self.out.T @ h.T + self.bias[:, None]  # a class a line
        z -= z.max(axis=0)
        own = z[target, np.arange(len(target))]
        return own - np.log(_line_sums(np.exp(z, out=z)))

    def log_within(self, h: np.ndarray, entry: np.ndarray, tree: Tree) -> np.ndarray:
        """Log probability of entries within their classes: all go down their ways in step, the longest ways first."""
        start = np.take(tree.starts, entry)
        lengths = np.take(tree.starts, entry + 1) - start
        order = _in_order(lengths.max(initial=0) - lengths, len(tree.starts))
        h, start, total = np.take(h, order, axis=0), start[order], np.zeros(len(entry))
        left = len(entry) - np.cumsum(np.bincount(lengths))  # those that go on after so many turns
        for turn, n in enumerate(left[:-1].tolist()):
            way = start[:n] + turn
            x = _dots(np.take(self.nodes, np.take(tree.nodes, way), axis=0), h[:n])
            total[:n] += _sigmoid_log(np.take(tree.signs, way) * x + np.take(tree.leans, way))
        out = np.empty(len(entry))
        out[order] = total
        return out

    def step(self, context: np.ndarray, target: np.ndarray, around: np.ndarray, ways: tuple[np.ndarray, ...],
             rate: float = RATE) -> None:
        """One step from the classes and entries on both sides, the classes between, and the `Tree.ways` to the entries there."""
        n, sides = context.shape
        h = self.hidden(context, around)
        p = self.out.T @ h.T + self.bias[:, None]  # a class a line
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= _line_sums(p)
        p[target, np.arange(n)] -= 1
        p /= n
        p = p.T.copy()
        back = p @ self.out.T
        node, sign, lean, owner = ways
        if len(node):
            at, ours = np.take(self.nodes, node, axis=0), np.take(h, owner, axis=0)
            x = sign * _dots(at, ours) + lean
            slope = (-sign * np.exp(_sigmoid_log(-x)))[:, None]
            first = _firsts(owner)
            at *= slope
            back[owner[first]] += np.add.reduceat(at, first, axis=0) / n
            ours *= slope
            self._sparse(self.nodes, self.squares[1], node, ours)
        back *= 1 - h * h
        self.out -= rate * (h.T @ p)
        self.bias -= rate * p.sum(axis=0)
        # all sides at once: the vectors of one follow those of the other
        place = (context + np.arange(sides) * (CLASSES + 1)).T.ravel()
        order = _in_order(place, sides * (CLASSES + 1))
        place = place[order]
        first = _firsts(place)
        self.embed.reshape(-1, HIDDEN)[place[first]] -= rate * _sums(np.take(back, order % n, axis=0), first)
        place = (around + np.arange(sides) * self.words.shape[1]).T.ravel()
        self._sparse(self.words.reshape(-1, HIDDEN), self.squares[0], place, back * n)

    @staticmethod
    def _sparse(vectors: np.ndarray, squares: np.ndarray, at: np.ndarray, slope: np.ndarray) -> None:
        """A step of the vectors at the given places, each with a step size of its own; slopes are used again
        from the first on where there are more places."""
        order = _in_order(at, len(vectors))
        at = at[order]
        first = _firsts(at)
        own, total = at[first], _sums(np.take(slope, order % len(slope), axis=0), first)
        size = np.take(squares, own) + _dots(total, total) / total.shape[1]
        squares[own] = size
        total *= SPARSE_RATE
        total /= np.sqrt(size)[:, None]
        vectors[own] = np.take(vectors, own, axis=0) - total


def neighbours(entries: np.ndarray, bounds: np.ndarray, edge: int, at: np.ndarray | None = None) -> np.ndarray:
    """Entries on both sides of the given positions of a slice, or of all, with a mark for what lies outside the document."""
    texts = np.repeat(np.arange(1, len(bounds)), np.diff(bounds))  # each text has edges before it, and the last behind it
    place = np.arange(len(entries)) + REACH * texts
    padded = np.full(len(entries) + REACH * len(bounds), edge, np.int64)
    padded[place] = entries
    place = place if at is None else place[at]
    return np.stack([padded[place + shift] for shift in (*range(-REACH, 0), *range(1, REACH + 1))], axis=1)


_WEIGHTS = [f"w{k}" for k in range(HIDDEN)]


def _trainer(words: Vocabulary, start: np.ndarray, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen, tree = Network(start.copy(), words.entries, len(words.tree.bias)), 0, words.tree
        # how often each entry stood on each side, and between
        beside, between = np.zeros(net.words.shape[:2], np.int64), np.zeros(words.entries, np.int64)
        for batch in batches:
            for _, _, data, offsets in W.slices(batch.column("text")):
                bounds, _, entries = words.entered(data, offsets)
                classes = words.class_of[entries]
                # masked positions follow from the place and what stands there, so a lost task repeats itself
                drawn = W.mix(np.arange(len(classes), dtype=np.uint64) * W.BASE + classes.astype(np.uint64) + np.uint64(turn << 32))
                at = np.flatnonzero((drawn >> np.uint64(11)).astype(np.float64) / 2 ** 53 < MASKED)
                at = at[np.argsort(drawn[at], kind="stable")]
                around, target, entry = neighbours(entries, bounds, words.entries, at), classes[at], entries[at]
                context = words.class_of[around]
                *turns, owner = tree.ways(entry)
                cuts = np.searchsorted(owner, np.arange(0, len(at) + BATCH, BATCH))
                for i, lo, hi in zip(range(0, len(at), BATCH), cuts[:-1].tolist(), cuts[1:].tolist()):
                    some = slice(i, i + BATCH)
                    net.step(context[some], target[some], around[some], (*(x[lo:hi] for x in turns), owner[lo:hi] - i))
                seen += len(at)
                between += np.bincount(entry, minlength=words.entries)
                for side, stood in zip(beside, around.T):
                    side += np.bincount(stood, minlength=len(side))
        if seen:
            vectors = net.weights.reshape(-1, HIDDEN)
            node, *_, owner = tree.ways(np.arange(words.entries))
            met = np.concatenate([beside.ravel(), np.bincount(node, between[owner], len(tree.bias)).astype(np.int64)])
            met = np.concatenate([np.full(len(vectors) - len(met), seen), met])
            rows = np.flatnonzero(met)
            by_met = vectors[rows].astype(np.float64) * met[rows, None]
            yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), pa.array(met[rows].astype(np.float64)),
                                              *[pa.array(x) for x in by_met.T.copy()]], names=["i", "n", *_WEIGHTS])
    return run


def trained(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Network:
    net = Network(None, words.entries, len(words.tree.bias))
    for turn in range(rounds):
        # one row per vector comes back, whatever the number of tasks
        mean = (docs.select("text").mapInArrow(_trainer(words, net.weights, turn), ", ".join(["i int", "n double", *[f"{w} double" for w in _WEIGHTS]]))
                .groupBy("i").agg(*[(F.sum(w) / F.sum("n")).alias(w) for w in _WEIGHTS]).toArrow())
        if mean.num_rows:
            vectors = net.weights.reshape(-1, HIDDEN).copy()
            vectors[mean.column("i").to_numpy()] = np.stack([mean.column(w).to_numpy() for w in _WEIGHTS], axis=1)
            net = Network(vectors.ravel(), words.entries, len(words.tree.bias))
    return net


def score_texts(net: Network, words: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and summed log probability of each text of a slice, without the counts of words beyond the known ones."""
    n, total, _ = _scored(net, net.sides(words.class_of), words, data, offsets)
    return n, total


def _scored(net: Network, sides: list[np.ndarray], words: Vocabulary, data: np.ndarray, offsets: np.ndarray):
    """As `score_texts`, with the words beyond the known ones: text, word and how often it occurs there."""
    bounds, hashes, entries = words.entered(data, offsets)
    classes, total = words.class_of[entries], np.zeros(len(entries) + 1)
    around = neighbours(entries, bounds, words.entries)
    for i in range(0, len(classes), SCORED):
        at = slice(i, min(i + SCORED, len(classes)))
        h = np.take(sides[0], around[at, 0], axis=0)
        for k in range(1, len(sides)):
            h += np.take(sides[k], around[at, k], axis=0)
        np.tanh(h, out=h)
        within = net.log_within(h, entries[at], words.tree) + words.log_leaf[entries[at]] if net.entries else words.inside(entries[at])
        total[at.start + 1:at.stop + 1] = net.log_probability(h, classes[at]) + within
    at = np.flatnonzero(entries >= len(words.words))
    text, word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[at], hashes[at]
    # by text, then by the first bits of the hash: words that agree in those may be given in several rows, which add up to the same
    order = np.argsort((text.astype(np.uint64) << np.uint64(44)) | (word >> np.uint64(20)))
    text, word = text[order], word[order]
    first = np.flatnonzero(np.r_[np.ones(min(len(at), 1), bool), (text[1:] != text[:-1]) | (word[1:] != word[:-1])])
    return np.diff(bounds), np.diff(np.cumsum(total)[bounds]), (text[first], word[first], np.diff(np.r_[first, len(at)]))


_ARROW = pa.schema([(c, pa.float64() if c == "score" else pa.int64()) for c in ("uid", "doc_id", "n_words", "score", "word", "times")])
_SCORES = "uid bigint, doc_id bigint, n_words bigint, score double, word bigint, times bigint"


def scores(documents: DataFrame, size: int = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, score (summed log probability) and mean_score of every row of `documents`.

    Null, empty and wordless texts have score 0 and a null mean. Repeated rows are trained on and scored
    each; an empty table gives no rows. Averages add up floating-point numbers in the order in which tasks
    end, so scores of two runs agree to about six digits.
    """
    docs = documents.select(F.col("doc_id").cast("bigint"), "text")
    counts = landed(count_words(docs), "word-counts")
    words = vocabulary(docs, size, counts)
    net = trained(docs, words, rounds)
    sent = documents.sparkSession.sparkContext.broadcast((net.weights, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document (word null), and its words beyond the known ones, once each."""
        weights, known = sent.value
        own = Network(weights, known.entries, len(known.tree.bias))
        sides = own.sides(known.class_of)
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, last, data, offsets in W.slices(batch.column("text")):
                n, total, (text, word, times) = _scored(own, sides, known, data, offsets)
                nothing, none = pa.nulls(len(n), pa.int64()), pa.nulls(len(word), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid + np.arange(len(n))), batch.column("doc_id").slice(first, last - first), pa.array(n.astype(np.int64)),
                     pa.array(total), nothing, nothing], schema=_ARROW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid + text), none, none, pa.nulls(len(word), pa.float64()), pa.array(word.view(np.int64)),
                     pa.array(times.astype(np.int64))], schema=_ARROW)
                uid += len(n)
    scored = landed(docs.mapInArrow(run, _SCORES), "scored")
    # the logarithm of 1 adds nothing, so words that occur once need no partner
    rest = (scored.where(F.col("word").isNotNull()).select("uid", "word", "times")
            .join(counts.where("n > 1").select("word", "n"), "word")
            .groupBy("uid").agg(F.sum(F.col("times") * F.log("n")).alias("rest")))
    score = F.col("score") + F.coalesce("rest", F.lit(0.0))
    return scored.where(F.col("word").isNull()).join(rest, "uid", "left").select(
        "doc_id", "n_words", score.alias("score"), F.when(F.col("n_words") > 0, score / F.col("n_words")).alias("mean_score"))
