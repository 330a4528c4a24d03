"""Text quality by a sparse ensemble of rules (rule ensembles after Friedman and Popescu).

Statistics of each text are computed in tasks. On a bounded sample of labelled rows, shallow boosted
trees are grown over them; every path from a root becomes a conjunction of thresholds; a logistic model
with lasso penalty weighs the rules, and most weights become zero. What is left is compiled into one
Spark column expression over the statistics, so scoring is plain SQL.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm import words as W
from shelfline.llm.common import fold, landed

#: labelled rows the model is fitted on at most, taken by the hash of their id
SAMPLE = 20_000
THRESHOLD = 0.3

FEATURES = ("n_words", "mean_word", "long_words", "upper", "digit", "symbol", "exclaim", "stop", "pipe", "space", "lines",
            "distinct_words", "repeated_lines", "repeated_runs", "symbol_words", "upper_words", "beyond_ascii", "punctuated")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*@^~<>{}[]\\=+_"]] = True
_RUN = 5


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(sums[offsets])


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of distinct hashes of each text."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=len(bounds) - 1)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text; shares lie between 0 and 1, a text without words has zeros."""
    size = np.maximum(np.diff(offsets), 1)
    starts, ends, bounds = W.words(data, offsets, W.SPACED)
    lower = W.LOWER[data]
    sums = W.prefix_sums(lower)
    hashes = W.span_hash(sums, starts, ends)
    count = np.diff(bounds)
    n = np.maximum(count, 1)
    lengths = ends - starts

    def in_words(flags: np.ndarray) -> np.ndarray:
        """Share of the words of each text that hold any flagged byte."""
        total = np.concatenate([[0], np.cumsum(flags)])
        return _per_text(total[ends] > total[starts], bounds) / n

    def share(flags: np.ndarray) -> np.ndarray:
        return _per_text(flags, offsets) / size

    upper = _UPPER[data]
    upper_total = np.concatenate([[0], np.cumsum(upper)])
    shouted = (upper_total[ends] - upper_total[starts] >= 2) & (2 * (upper_total[ends] - upper_total[starts]) >= lengths)
    line_starts, line_ends, line_bounds = W.words(data, offsets, np.arange(256) != 10)
    n_lines = np.maximum(np.diff(line_bounds), 1)
    lines = W.span_hash(sums, line_starts, line_ends)
    runs = W.run_hash(hashes, _RUN)
    run_hi = np.clip(bounds[1:] - _RUN + 1, bounds[:-1], None)
    inside = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(inside, bounds[:-1], 1)
    np.add.at(inside, run_hi, -1)
    own = np.flatnonzero(np.cumsum(inside)[:len(runs)] > 0)
    run_bounds = np.searchsorted(own, bounds)
    n_runs = np.maximum(np.diff(run_bounds), 1)
    last = data[np.maximum(ends - 1, 0)] if len(ends) else np.zeros(0, np.uint8)
    columns = (
        np.log1p(count),
        _per_text(lengths, bounds) / n,
        _per_text(lengths > 12, bounds) / n,
        share(upper),
        share(_DIGIT[data]),
        share(_SYMBOL[data]),
        share(data == ord("!")),
        share(data == ord(".")),
        share(data == ord("|")),
        share(~W.SPACED[data]),
        n_lines / n,
        _distinct(hashes, bounds) / n,
        1 - _distinct(lines, line_bounds) / n_lines,
        1 - _distinct(runs[own], run_bounds) / n_runs,
        in_words(_SYMBOL[data]),
        _per_text(shouted, bounds) / n,
        share(data >= 128),
        _per_text(np.isin(last, [ord(c) for c in ".,;:!?"]), bounds) / n,
    )
    table = np.column_stack([np.asarray(c, np.float64) for c in columns])
    table[count == 0] = 0
    return table


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and one column f_<feature> per statistic, for every row."""
    names = [f"f_{name}" for name in FEATURES]
    rows = docs.select(*keep, F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [statistics(data, offsets) for _, _, data, offsets in W.slices(batch.column("__text"))]
            values = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [pa.array(np.ascontiguousarray(x)) for x in values.T],
                names=[*keep, *names])
    schema = T.StructType([rows.schema[name] for name in keep] + [T.StructField(n, T.DoubleType()) for n in names])
    return rows.mapInArrow(run, schema)


# --- trees, rules and weights; all on the bounded sample ---

Condition = tuple[int, float, bool]  # feature, threshold, above
Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Ensemble:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule, weight in self.rules:
            z += weight * holds(rule, x)
        return 1 / (1 + np.exp(-z))

    def column(self) -> Column:
        """The same score as an expression over the f_ columns."""
        z = F.lit(self.bias)
        for rule, weight in self.rules:
            test = F.lit(True)
            for feature, threshold, above in rule:
                value = F.col(f"f_{FEATURES[feature]}")
                test = test & ((value > threshold) if above else (value <= threshold))
            z = z + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for feature, threshold, above in rule:
        out &= (x[:, feature] > threshold) if above else (x[:, feature] <= threshold)
    return out


def _best_split(x: np.ndarray, gradient: np.ndarray, rows: np.ndarray, cuts: list[np.ndarray], least: int):
    best = (1e-9, None)
    total, n = gradient[rows].sum(), len(rows)
    for feature, own in enumerate(cuts):
        if not len(own):
            continue
        bucket = np.searchsorted(own, x[rows, feature], "left")
        counts = np.cumsum(np.bincount(bucket, minlength=len(own) + 1))[:-1]
        sums = np.cumsum(np.bincount(bucket, gradient[rows], minlength=len(own) + 1))[:-1]
        right = n - counts
        fine = (counts >= least) & (right >= least)
        if fine.any():
            gain = np.where(fine, sums ** 2 / np.maximum(counts, 1) + (total - sums) ** 2 / np.maximum(right, 1) - total ** 2 / n, 0)
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (gain[i], (feature, float(own[i])))
    return best[1]


def _grow(x, gradient, rows, cuts, depth, least, path: Rule, rules: set, value: np.ndarray) -> None:
    """Adds the path of every node below the root to `rules`, and the leaf means to `value`."""
    split = _best_split(x, gradient, rows, cuts, least) if depth else None
    if path:
        rules.add(path)
    if split is None:
        value[rows] = gradient[rows].mean() if len(rows) else 0
        return
    feature, threshold = split
    above = x[rows, feature] > threshold
    for side in (False, True):
        _grow(x, gradient, rows[above == side], cuts, depth - 1, least, (*path, (feature, threshold, side)), rules, value)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 0.002, steps: int = 400) -> Ensemble:
    """Boosted trees give the rules, a lasso logistic model their weights. Rows of one label, and rows that no
    split tells apart (too few, or all alike), give the share of the labels."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2)
    constant = Ensemble(float(np.log(share / (1 - share))), ())
    if n == 0 or y.min() == y.max():
        return constant
    cuts = []
    for feature in range(x.shape[1]):
        own = np.unique(np.quantile(x[:, feature], np.linspace(0, 1, 65)[1:-1]))
        cuts.append(own[own < x[:, feature].max()])
    rules: set[Rule] = set()
    z = np.zeros(n)
    # both labels weigh the same while rules are sought
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(trees):
        gradient = balance * (y - 1 / (1 + np.exp(-z)))
        value = np.zeros(n)
        _grow(x, gradient, np.arange(n), cuts, depth, max(5, n // 500), (), rules, value)
        z += 2 * value
    if not rules:
        return constant
    ordered = sorted(rules)
    table = np.column_stack([holds(r, x) for r in ordered]).astype(np.float64)
    scale = np.maximum(table.std(axis=0), 0.05)
    weights, bias = _lasso(table / scale, y, penalty, steps)
    kept = [(r, float(w / s)) for r, w, s in zip(ordered, weights, scale) if w]
    return Ensemble(float(bias), tuple(kept))


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient for mean logistic loss plus penalty times the absolute weights."""
    n, m = x.shape
    rate = 4 / (np.linalg.norm(x, 2) ** 2 / n + 1)
    w = v = np.zeros(m)
    b = c = float(np.log(y.mean() / (1 - y.mean())))
    t = 1.0
    for _ in range(steps):
        residual = 1 / (1 + np.exp(-(x @ v + c))) - y
        step = v - rate * (x.T @ residual) / n
        new = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        new_b = c - rate * residual.mean()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, c = new + (before - 1) / t * (new - w), new_b + (before - 1) / t * (new_b - b)
        w, b = new, new_b
    return w, b


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, label) of labelled rows outside fold 0, at most `sample` of them by hash of the id.

    Ids without text, labels other than 0 and 1, and ids with contradicting labels are left out."""
    one = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
           .where(F.col("label").isin(0, 1) & (fold(F.col("doc_id")) != 0))
           .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
           .where("label = most").drop("most"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.col("text").isNotNull())
    return own.join(F.broadcast(chosen), "doc_id")


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    rows = landed(with_statistics(training_rows(docs, labels, "quality", sample), "doc_id", "label"), "training")
    # bounded: `sample` ids of a few numbers each; repeated ids beyond that are left out
    got = rows.orderBy("doc_id", *[f"f_{name}" for name in FEATURES]).limit(sample).toArrow()
    x = np.column_stack([got.column(f"f_{name}").to_numpy() for name in FEATURES]) if got.num_rows else np.zeros((0, len(FEATURES)))
    return fit(x, got.column("label").to_numpy().astype(np.float64))


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted for every row; a null or empty text is scored as one without words.

    Without any usable label every score is one half; with labels of one kind only, their share."""
    model = trained(docs, labels, sample)
    rows = with_statistics(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), "doc_id")
    score = model.column()
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), score.alias("score"),
                       (score >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows whose predicted label is 1, with all their columns, whatever their names.

    Null and empty texts are judged as texts without words; repeated rows and ids each on their own. An empty
    table gives an empty one; without labels that tell texts apart all rows stay or all go, by their share."""
    model = trained(docs, labels, sample)
    names = {f.name: f"c{i}" for i, f in enumerate(docs.schema)}
    # columns travel under neutral names, so that none of theirs can clash with a statistic's
    renamed = docs.select(*[F.col(f"`{k}`").alias(v) for k, v in names.items()], F.col("text"))
    rows = with_statistics(renamed, *names.values())
    return rows.where(model.column() >= THRESHOLD).select(*[F.col(v).alias(k) for k, v in names.items()])
