"""Toxicity by multiple-instance learning: labels mark documents, the model scores sentences.

A sentence's probability is a logistic function of the telling words and beginnings of words in it; a
document's is the noisy-or of its sentences. The weights are fitted so that the noisy-or meets the document labels, which
leaves sentence scores that locate what made a document toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import fold, landed
from shelfline.llm.quality import SAMPLE, training_rows

THRESHOLD = 0.5
#: words of the model, at most, and the least significance of one
WORDS, LEAST_Z = 512, 4.0
#: lengths in bytes of the beginnings of words that count as features beside the words themselves
BEGINNINGS = (4, 5, 6, 7)
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


@dataclass(frozen=True)
class Model:
    bias: float
    words: np.ndarray  # hashes, sorted
    weights: np.ndarray

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known words, and which they are."""
        if not len(self.words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        found = np.flatnonzero(self.words[at] == hashes)
        return found, at[found]


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of their beginnings, and for each the word it belongs to."""
    sums = W.prefix_sums(data)
    hashes, owner = [W.span_hash(sums, starts, ends)], [np.arange(len(starts))]
    for size in BEGINNINGS:
        longer = np.flatnonzero(ends - starts > size)
        # told apart from a word of the same letters
        hashes.append(W.mix(W.span_hash(sums, starts[longer], starts[longer] + size) ^ W.BASE))
        owner.append(longer)
    return np.concatenate(hashes), np.concatenate(owner)


class Sentences:
    """Sentences of the texts of a slice: those between sentence ends that hold a word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        lower = W.LOWER[data]
        starts, ends, self.bounds = W.words(lower, offsets, W.WORDY)
        self.hashes, self.word = features(lower, starts, ends)
        breaks = np.cumsum(_ENDS[data])
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))
        new = np.ones(len(starts), bool)
        if len(starts):
            at = breaks[starts]
            new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        self.of_word = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        self.text = text[first]
        self.start = starts[first]
        self.end = ends[np.append(first[1:], len(starts)) - 1] if len(starts) else first
        self.counts = np.bincount(self.text, minlength=len(offsets) - 1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def telling_words(rows: DataFrame) -> np.ndarray:
    """Hashes of the features whose share of documents differs most between the labels, by the difference
    of the shares over its deviation. Counted over all given rows; word counts are combined in tasks before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_numpy()
            for first, last, data, offsets in W.slices(batch.column("text")):
                lower = W.LOWER[data]
                starts, ends, bounds = W.words(lower, offsets, W.WORDY)
                hashes, word = features(lower, starts, ends)
                text = np.repeat(np.arange(first, last), np.diff(bounds))[word]
                order = np.lexsort((hashes, text))
                h, t = hashes[order], text[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
                own, place = np.unique(h[new], return_inverse=True)
                label = labels[t[new]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own.view(np.int64)),
                    pa.array(np.bincount(place, label == 0, len(own)).astype(np.int64)),
                    pa.array(np.bincount(place, label == 1, len(own)).astype(np.int64))], names=["word", "n0", "n1"])
    size = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    counts = rows.select("text", "label").mapInArrow(count, "word bigint, n0 bigint, n1 bigint").groupBy("word").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    n1, n0 = float(max(size.get(1, 0), 1)), float(max(size.get(0, 0), 1))
    share = (F.col("n0") + F.col("n1") + 0.5) / (n0 + n1 + 1)
    z = (F.col("n1") / n1 - F.col("n0") / n0) / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    best = (counts.where("n0 + n1 >= 5").withColumn("z", F.abs(z)).where(F.col("z") >= LEAST_Z)
            .orderBy(F.desc("z"), "word").limit(WORDS).select("word").collect())
    return np.sort(np.array([r.word for r in best], np.int64).view(np.uint64))


def _instances(words: np.ndarray):
    """Per text: label, sentences without known words, and (sentence, word) pairs of the others."""
    model = Model(0.0, words, np.zeros(len(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in W.slices(batch.column("text")):
                found = Sentences(data, offsets)
                place, word = model.known(found.hashes)
                sentence = found.of_word[found.word[place]]
                pairs = np.unique(np.stack([sentence, word], axis=1), axis=0) if len(place) else np.zeros((0, 2), np.int64)
                owner = found.text[pairs[:, 0]] if len(pairs) else np.zeros(0, np.int64)
                cuts = np.searchsorted(owner, np.arange(last - first + 1))
                full = [len(np.unique(pairs[lo:hi, 0])) for lo, hi in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, last - first), batch.column("label").slice(first, last - first),
                    pa.array((found.counts - np.array(full)).astype(np.int64)),
                    pa.array([pairs[lo:hi].astype(np.int32).tobytes() for lo, hi in zip(cuts[:-1], cuts[1:])], pa.binary())],
                    names=["doc_id", "label", "plain", "pairs"])
    return run


def fit(labels: np.ndarray, plain: np.ndarray, pairs: list[np.ndarray], n_words: int, steps: int = 400,
        rate: float = 0.1, decay: float = 1e-4) -> tuple[float, np.ndarray]:
    """Weights that maximise the likelihood of the labels under noisy-or, by Adam on all rows."""
    doc, sentence, word, seen = [], [], [], 0
    for i, own in enumerate(pairs):
        if len(own):
            _, place = np.unique(own[:, 0], return_inverse=True)
            sentence.append(place + seen)
            word.append(own[:, 1])
            doc.append(np.full(place.max() + 1, i))
            seen += place.max() + 1
    doc = np.concatenate(doc) if doc else np.zeros(0, np.int64)
    sentence = np.concatenate(sentence) if sentence else np.zeros(0, np.int64)
    word = np.concatenate(word) if word else np.zeros(0, np.int64)
    y, n = labels.astype(float), max(len(labels), 1)
    theta = np.zeros(n_words + 1)
    theta[-1] = -5.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(sentence, theta[word], seen)
        p, p0 = sigmoid(z), sigmoid(theta[-1:])[0]
        none = np.bincount(doc, np.log1p(-p), len(y)) + plain * np.log1p(-p0)
        odds = np.exp(none) / np.maximum(-np.expm1(none), 1e-12)
        push = np.where(y == 1, -odds, 1.0)  # times p: the gradient of the loss in a sentence's z
        by_sentence = push[doc] * p
        gradient = np.append(np.bincount(word, by_sentence[sentence], n_words),
                             by_sentence.sum() + (push * plain).sum() * p0) / n
        gradient[:-1] += decay * theta[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return float(theta[-1]), theta[:-1]


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = landed(training_rows(docs, labels, "toxic", sample), "toxic-training")
    words = telling_words(rows)
    got = rows.mapInArrow(_instances(words), "doc_id bigint, label int, plain bigint, pairs binary").orderBy(
        "doc_id", "pairs").limit(sample).toArrow()
    pairs = [np.frombuffer(x.as_py(), np.int32).reshape(-1, 2) for x in got.column("pairs")]
    bias, weights = fit(got.column("label").to_numpy(), got.column("plain").to_numpy(), pairs, len(words))
    return Model(bias, words, weights)


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in W.slices(batch.column("text")):
                found, p = sentence_scores(model, data, offsets)
                n = last - first
                none = np.bincount(found.text, np.log1p(-p), n)
                worst_start, worst_end, worst = np.full(n, -1), np.full(n, -1), np.zeros(n)
                order = np.lexsort((-np.arange(len(p)), p))  # the last written is the highest, then the earliest
                letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                begin = letters[offsets[:-1]]
                text = found.text[order]
                worst[text] = p[order]
                worst_start[text] = letters[found.start[order]] - begin[text]
                worst_end[text] = letters[found.end[order]] - begin[text]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, n), pa.array(-np.expm1(none) + 0.0),
                    pa.array(np.bincount(found.text[p >= THRESHOLD], minlength=n).astype(np.int64)),
                    pa.array(worst_start.astype(np.int64)), pa.array(worst_end.astype(np.int64)), pa.array(worst)],
                    names=["doc_id", "score", "n_offending", "worst_start", "worst_end", "worst_score"])
    return run


def sentence_scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[Sentences, np.ndarray]:
    found = Sentences(data, offsets)
    place, word = model.known(found.hashes)
    pairs = np.unique(np.stack([found.of_word[found.word[place]], word], axis=1), axis=0) if len(place) else np.zeros((0, 2), np.int64)
    z = model.bias + np.bincount(pairs[:, 0], model.weights[pairs[:, 1]], len(found.start))
    return found, sigmoid(z)


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, sentences at or above one half, and the span (code
    points, -1 without words) and score of the worst one. Null, empty and wordless texts score 0.

    Without usable labels no word is known and only the bias remains."""
    model = trained(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _scored(model), "doc_id bigint, score double, n_offending bigint, worst_start bigint, worst_end bigint, worst_score double")
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                       "n_offending", "worst_start", "worst_end", "worst_score")


def offending_sentences(docs: DataFrame, model: Model, least: float = THRESHOLD) -> DataFrame:
    """(doc_id, sentence, score) of every sentence at or above `least`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in W.slices(batch.column("text")):
                found, p = sentence_scores(model, data, offsets)
                keep = np.flatnonzero(p >= least)
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(first + found.text[keep])),
                    pa.array([raw[s:e].decode() for s, e in zip(found.start[keep], found.end[keep])], pa.string()),
                    pa.array(p[keep])], names=["doc_id", "sentence", "score"])
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, sentence string, score double")
