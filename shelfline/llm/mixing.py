"""Mixing documents to target domain weights with soft membership, in DataFrame operations only.

A naive Bayes model learned from labelled rows gives every document a probability for each domain. A
document of t tokens then counts as t times that probability towards a domain, and nonnegative rates are
fitted so that the expected token totals of the domains meet their targets, or miss them by the least sum
of squares: proximal Newton steps on the dual. Steps are summed and the sum is cut off at zero, so the rates
stay one short expression over the documents however many steps there are, and a step is one aggregation to
a few numbers.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import landed, neutral

#: labelled rows the classifier is fitted on at most, and the words it uses
SAMPLE, WORDS = 4_000, 64
#: residuals are shares of all target tokens: below CLOSE a target is met, above MISSED a warning tells so;
#: the ridge falls to RIDGE, and a fit that needs more aggregations than STEPS is an error
STEPS, CLOSE, MISSED, RIDGE = 1000, 1e-9, 1e-6, 1e-8
#: wanted share of each domain (quality, toxicity) of the mixture's tokens
TARGETS: Mapping[str, float] = {"q1t0": 0.92, "q1t1": 0.02, "q0t0": 0.05, "q0t1": 0.01}
#: tokens of the mixture by tokens of the corpus
SIZE = 0.8

#: shares of characters above which a text has a trait; traits are features like words
_TRAITS = {"<marks>": ("[#$%&*]", 0.02), "<shouts>": ("!!", 0.01), "<bars>": (r" \|", 0.02), "<capitals>": ("[A-Z][A-Z]", 0.1)}


def label_domain() -> Column:
    """Domain of a row of `labels`; null where a label is missing or is not 0 or 1."""
    q, t = F.col("quality").cast("int"), F.col("toxic").cast("int")
    return F.when(q.isin(0, 1) & t.isin(0, 1), F.concat(F.lit("q"), q, F.lit("t"), t))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _traits(text: Column) -> Column:
    size = F.greatest(F.length(text), F.lit(1))
    return F.filter(F.array(*[F.when(F.regexp_count(text, F.lit(p)) > share * size, F.lit(name))
                              for name, (p, share) in _TRAITS.items()]), lambda x: x.isNotNull())


class Classifier:
    """Naive Bayes over the presence of telling words and traits."""

    def __init__(self, domains: list[str], prior: np.ndarray, features: list[str], present: np.ndarray):
        """`present`: probability of each feature in each domain, features by domains."""
        self.domains, self.features = domains, features
        self.base = np.log(prior) + np.log1p(-present).sum(axis=0)
        self.weights = np.log(present) - np.log1p(-present)

    def posteriors(self, found: Column) -> list[Column]:
        """Probabilities by domain, from an array column of the features present."""
        z = []
        for k in range(len(self.domains)):
            total = F.lit(float(self.base[k]))
            if self.features:
                weight = F.create_map(*[F.lit(x) for f, w in zip(self.features, self.weights[:, k]) for x in (f, float(w))])
                total = F.aggregate(found, total, _adder(weight))
            z.append(total)
        # each against the others: no exponential of a large number
        return [1 / sum((F.exp(F.least(other - own, F.lit(700.0))) for other in z), F.lit(0.0)) for own in z]


def _adder(weight: Column):
    return lambda acc, x: acc + F.element_at(weight, x)


def learned(docs: DataFrame, labels: DataFrame, domains: list[str], sample: int = SAMPLE, n_words: int = WORDS,
            domain: Column | None = None) -> Classifier:
    """Fitted on at most `sample` labelled rows, taken by the hash of their id. An id with several labels
    in `labels` counts once, with its smallest domain; domains never seen keep their smoothed share."""
    domain = label_domain() if domain is None else domain
    chosen = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), domain.alias("domain"))
              .where(F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.col("text").isNotNull())
    rows = landed(own.join(F.broadcast(chosen), "doc_id").select(
        "domain", F.array_distinct(F.concat(_words(F.col("text")), _traits(F.col("text")))).alias("found")), "domains")
    sizes = {r.domain: r.n for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    size = np.array([sizes.get(k, 0) for k in domains], float)
    total = size.sum()
    counts = rows.select("domain", F.explode("found").alias("f")).groupBy("f").agg(
        *[F.sum(F.when(F.col("domain") == k, 1).otherwise(0)).alias(f"n{i}") for i, k in enumerate(domains)])
    everywhere = sum((F.col(f"n{i}") for i in range(len(domains))), F.lit(0))

    def z(i: int) -> Column:
        """Log odds of the feature in one domain against the others, over their deviation."""
        a, b = F.col(f"n{i}") + 0.5, everywhere - F.col(f"n{i}") + 0.5
        c, d = F.lit(float(size[i])) + 1 - a, F.lit(float(total - size[i])) + 1 - b
        return F.abs(F.log(a * d / (b * c)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d))
    seen = [i for i in range(len(domains)) if 0 < size[i] < total]
    found = []
    if seen:
        best = F.greatest(F.lit(0.0), *[z(i) for i in seen])
        found = (counts.where(everywhere >= 5).withColumn("z", best).where("z >= 4")
                 .orderBy(F.desc("z"), "f").limit(n_words).collect())
    present = np.array([[(r[f"n{i}"] + 0.1) / (size[i] + 0.2) for i in range(len(domains))] for r in found]).reshape(-1, len(domains))
    return Classifier(domains, (size + 1) / (total + len(domains)), [r.f for r in found], np.clip(present, 1e-4, 1 - 1e-4))


def memberships(docs: DataFrame, model: Classifier, *keep: str) -> DataFrame:
    """The kept columns, `tokens` and p_0, p_1, ... per row; a text without words has no tokens."""
    words = docs.select(*keep, _words(F.col("text")).alias("__words"), _traits(F.coalesce("text", F.lit(""))).alias("__traits"))
    known = F.array(*[F.lit(f) for f in model.features]) if model.features else F.array().cast("array<string>")
    found = words.select(*keep, F.size("__words").cast("bigint").alias("tokens"),
                         F.array_intersect(F.concat("__words", "__traits"), known).alias("__found"))
    return found.select(*keep, "tokens", *[p.alias(f"p_{k}") for k, p in enumerate(model.posteriors(F.col("__found")))])


class NotFitted(RuntimeError):
    """The fit did not come to its tolerance."""


def _least(measured: Callable, k: int, steps: int, strict: bool) -> tuple[np.ndarray, np.ndarray]:
    """The sum of all steps, and the residual there. `measured` gives, at a sum of steps, the value of the
    dual, the residual (its falling slope) and the Gram matrix (its curvature).

    The dual is convex. Each round finds its least value with a ridge around the result of the round before,
    by Newton steps shortened until the value does not rise, and the ridge is a tenth of the last. Where the
    targets can be met the residual vanishes; else it comes to the least one.
    """
    taken, ridge, left = np.zeros(k), 1e-2, steps
    value, residual, gram = measured(taken)
    while np.abs(residual).max() >= CLOSE:
        centre = taken
        while True:
            slope = ridge * (taken - centre) - residual
            # rounding of large sums of steps is allowed for
            if np.abs(slope).max() <= CLOSE / 10 + 1e-14 * np.abs(taken).max():
                break
            move = -np.linalg.solve(gram + ridge * np.eye(k), slope)
            here, size = value + ridge / 2 * ((taken - centre) ** 2).sum(), 1.0
            while True:
                if not left and not strict:
                    return taken, residual
                if not left:
                    raise NotFitted(f"rates are not fitted after {steps} steps; residuals {residual.tolist()} of the total")
                left -= 1
                at = taken + size * move
                new_value, new, new_gram = measured(at)
                along = float((ridge * (at - centre) - new) @ move)
                # by convexity the value has fallen if it still falls here
                if along <= 0 or new_value + ridge / 2 * ((at - centre) ** 2).sum() <= here + 1e-4 * size * float(slope @ move):
                    break
                if size < 1e-12 and not strict:
                    return taken, residual
                if size < 1e-12:
                    raise NotFitted(f"no step lessens the residuals {residual.tolist()} of the total")
                size *= min(max(float(slope @ move) / (float(slope @ move) - along), 0.1), 0.5)
            taken, value, residual, gram = at, new_value, new, new_gram
        if ridge <= RIDGE:
            break
        ridge /= 10
    return taken, residual


def fitted_rates(members: DataFrame, targets: list[float], steps: int = STEPS, strict: bool = True) -> tuple[Column, list[float]]:
    """The rate of each row as an expression over p_0, p_1, ..., and the residual by domain, in tokens.

    `targets` are token totals. From equal rates the sum of all steps is subtracted, and what falls below
    zero is cut off. Among all rates that meet the targets these are the closest to equal ones. For targets
    out of reach the sum of squared residuals, as shares of all target tokens, is the least there is, but
    for RIDGE / 2 times the mean squared distance of the best rates from equal ones, by tokens.
    If `steps` aggregations do not suffice it raises NotFitted, or, not `strict`, gives the best rates found.
    """
    k = len(targets)
    p = [F.col(f"p_{i}") for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    goal = np.array(targets, float)
    scale = max(goal.sum(), 1.0)
    total = float(members.agg(F.sum("tokens")).first()[0] or 0)
    start = float(goal.sum() / total) if total else 0.0

    def rate(steps_taken: np.ndarray) -> Column:
        return F.greatest(F.lit(0.0), F.lit(start) - sum((F.lit(float(m)) * x for m, x in zip(steps_taken, p)), F.lit(0.0)))

    def measured(steps_taken: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        at = members.select("tokens", *p, rate(steps_taken).alias("rate"))
        weight = F.when(F.col("rate") > 0, F.col("tokens")).otherwise(0)
        got = at.agg(*[F.sum(F.col("rate") * F.col("tokens") * x) for x in p],
                     *[F.sum(weight * p[i] * p[j]) for i, j in pairs],
                     F.sum(F.col("rate") * F.col("rate") * F.col("tokens"))).first()
        gram = np.zeros((k, k))
        for (i, j), value in zip(pairs, got[k:-1]):
            gram[i, j] = gram[j, i] = (value or 0.0) / scale
        value = (got[-1] or 0.0) / 2 / scale + float(steps_taken @ goal) / scale
        return value, (np.array(got[:k], float) - goal) / scale, gram

    if not total:
        return rate(np.zeros(k)), [0.0] * k
    taken, residual = _least(measured, k, steps, strict)
    return rate(taken), [float(x) * scale for x in residual]


def _rates(members: DataFrame, targets: Mapping[str, float], size: float) -> Column:
    """The fitted rate; a warning names the domains whose targets are missed, out of reach or not fitted."""
    goal = _goal(members, targets, size)
    rate, residual = fitted_rates(members, goal, strict=False)
    missed = [f"{d} by {x:+.6g} of {g:.6g} tokens" for d, x, g in zip(sorted(targets), residual, goal) if abs(x) > MISSED * max(sum(goal), 1.0)]
    if missed:
        warnings.warn(f"targets out of reach, missed least: {', '.join(missed)}", stacklevel=3)
    return rate


def mixed(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, size: float = SIZE) -> DataFrame:
    """doc_id, source, tokens, a probability p_<domain> per domain and the `rate` of every row of `docs`.

    Null and wordless texts have no tokens; their rate, like any, follows from their probabilities.
    Repeated rows count as often as they occur. Without documents there are no rows. Without labels every
    domain is equally likely everywhere, and the rates are equal.
    """
    domains = sorted(targets)
    model = learned(docs, labels, domains)
    rows = landed(memberships(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), model, "doc_id", "source"), "members")
    rate = _rates(rows, targets, size)
    return rows.select("doc_id", "source", "tokens", *[F.col(f"p_{i}").alias(f"p_{d}") for i, d in enumerate(domains)],
                       rate.alias("rate"))


def _goal(rows: DataFrame, targets: Mapping[str, float], size: float) -> list[float]:
    total = rows.agg(F.sum("tokens")).first()[0] or 0
    whole = math.fsum(targets.values())
    return [size * total * targets[d] / whole for d in sorted(targets)]


def with_rates(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, size: float = SIZE) -> DataFrame:
    """All rows and columns of `docs`, whatever their names, with `mix_rate` added. An input column of that
    name is replaced. Nulls, empty texts, repeated rows and empty tables as in `mixed`."""
    docs = docs.drop("mix_rate")
    model = learned(docs, labels, sorted(targets))
    # probabilities only, from one pass; the rows themselves are not written again
    plain = neutral(docs)
    members = memberships(neutral(docs, F.col("text")).select("text", F.struct(*plain.columns).alias("__row")), model, "__row")
    slim = landed(members.drop("__row"), "members")
    rate = _rates(slim, targets, size)
    rows = members.select("__row.*", rate.alias("rate"))
    return rows.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(docs.schema)], F.col("rate").alias("mix_rate"))
