"""Mixing to target weights over soft domains, in DataFrame expressions only.

A domain is what the labelled table says about a document; most documents have no label, so
each gets a posterior over the domains from a naive Bayes classifier: a few numbers about
its shape and, per domain, how many of the domain's typical words it holds, each number in
a few bins. The classifier sees at most ``SAMPLE_ROWS`` labelled documents (those with the
smallest hash of their id; one half gives the typical words, the other the bin counts).
Only ids, the ``LEXICON`` words of each domain and bin counts reach the driver.

Document d with t tokens (words) and posterior p gives domain k an expected r t p_k tokens at
rate r. The rates are least squares, nearest to 1 in the norm that weighs a document by its tokens,
with the squared miss of a target weighed ``1 / COMPROMISE`` times as much, in parts of the domain's
present tokens: at multipliers y the
best rate is 1 - p y, projected on 0 .. ``MAX_RATE``, so the state is one number a domain. Each step
of the projected gradient (sum of r t p - T, scaled by G = sum of t p p' over the documents inside
the bounds) is one aggregation of a written table of (t, p); a step that does not lower the objective
enough is halved, and the steps end where the gradient is 0, so they cannot diverge. Targets out of
reach are missed, with a warning, not chased by rates without bound. A rate above 1 repeats a
document, its fraction is decided by a hash of id and text.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.llm.store import scratch, written

SAMPLE_ROWS = 20_000
LEXICON = 100
STEPS = 60
TOLERANCE = 1e-6
MAX_RATE = 100.0
MISSED = 0.01
COMPROMISE = 1e-5

DOMAIN = "case when toxic = 1 then 'toxic' when quality = 0 then 'low' when quality = 1 then 'good' end"
TARGETS = {"good": 0.85, "low": 0.10, "toxic": 0.05}

_NOT_LETTERS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_BINS = 12


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _bin(x: Column, scale: float) -> Column:
    return F.least(F.greatest(F.floor(F.coalesce(x, F.lit(0.0)) * scale), F.lit(0)), F.lit(_BINS - 1)).cast("int")


def _numbers(docs: DataFrame, lexicon: Mapping[str, list[str]]) -> DataFrame:
    """``docs`` with __t (tokens) and __f (an array of bin numbers)."""
    text = _text(F.col("text"))
    cut = docs.withColumn("__w", F.array_remove(F.split(F.lower(text), _NOT_LETTERS), "")).withColumn("__d", F.array_distinct("__w"))
    tokens = F.size(F.array_remove(F.split(text, r"[\x09-\x0D\x20]+"), ""))
    cut = cut.withColumn("__t", tokens.cast("double")).withColumn("__l", F.length(F.array_join("__w", "")).cast("double"))
    words, size, letters = F.size("__w"), F.length(text), F.col("__l")
    numbers = [
        _bin(F.log2(F.col("__t") + 1), 0.8),
        _bin(1 - F.try_divide(letters + F.col("__t"), size), 24),
        _bin(F.try_divide(F.size("__d"), words), _BINS - 0.001),
        _bin(F.try_divide(letters, words), 1.0),
        _bin(F.try_divide(F.size(F.split(text, "[A-Z]")) - 1, letters), 24),
    ]
    for listed in lexicon.values():
        known = F.array(*[F.lit(w) for w in listed]) if listed else F.array().cast("array<string>")
        hits = F.size(F.array_intersect("__d", known))
        numbers.append(_bin(F.log2(hits + F.lit(1.0)), 2.0))
    return cut.withColumn("__f", F.array(*numbers)).drop("__w", "__d", "__l")


def _lexicon(sample: DataFrame, domains: list[str], sizes: Mapping[str, int]) -> dict[str, list[str]]:
    """Per domain, its ``LEXICON`` words of highest count times log ratio."""
    words = sample.select(
        "domain", F.explode(F.array_distinct(F.array_remove(F.split(F.lower(_text(F.col("text"))), _NOT_LETTERS), ""))).alias("word")
    )
    counts = words.groupBy("word").agg(
        *[F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"n{i}") for i, d in enumerate(domains)]
    )
    total = sum(sizes.values())
    out = {}
    counts = written(counts, "mixing-words")
    every = sum((F.col(f"n{i}") for i in range(len(domains))), F.lit(0))
    for i, d in enumerate(domains):
        n = F.col(f"n{i}")
        ratio = F.log((n + 0.5) / (sizes[d] + 1.0)) - F.log((every - n + 0.5) / (total - sizes[d] + 1.0))
        best = counts.filter(n >= 2).select("word", (n * ratio).alias("g")).filter("g > 0")
        out[d] = [r[0] for r in best.orderBy(F.desc("g"), "word").limit(LEXICON).collect()]
    return out


class SoftDomains:
    """The classifier: posteriors over ``domains`` as DataFrame expressions."""

    def __init__(self, domains: list[str], lexicon: dict[str, list[str]], log_prior: list[float], log_bins: np.ndarray):
        self.domains, self.lexicon, self.log_prior, self.log_bins = domains, lexicon, log_prior, log_bins

    def posteriors(self, docs: DataFrame) -> DataFrame:
        """``docs`` with __t (tokens) and __p (array of posteriors in the order of ``domains``)."""
        numbered = _numbers(docs, self.lexicon)
        logs = []
        for i in range(len(self.domains)):
            total = F.lit(self.log_prior[i])
            for j, row in enumerate(self.log_bins[i]):
                table = F.array(*[F.lit(float(v)) for v in row])
                total = total + F.get(table, F.get("__f", F.lit(j)))
            logs.append(total)
        return (
            numbered.withColumn("__g", F.array(*logs))
            .withColumn("__g", F.transform("__g", lambda g: F.exp(g - F.array_max("__g"))))
            .withColumn("__p", F.transform("__g", lambda g: g / F.aggregate("__g", F.lit(0.0), lambda a, b: a + b)))
            .drop("__f", "__g")
        )


def learn(docs: DataFrame, labels: DataFrame, domain: str = DOMAIN, rows: int = SAMPLE_ROWS) -> SoftDomains | None:
    """Fit on at most ``rows`` labelled documents; None if no document has a domain."""
    marks = labels.select("doc_id", F.expr(domain).alias("domain")).filter("domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    chosen = docs.select("doc_id").distinct().join(marks, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = written(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``rows`` rows of two short columns
        .groupBy("doc_id", "domain").agg(F.min("text").alias("text"))  # one text per doc_id
        .select("text", "domain", (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 0).alias("first")),
        "mixing-sample",
    )
    sizes = {(r[0], r[1]): r[2] for r in sample.groupBy("domain", "first").count().collect()}
    domains = sorted({d for d, _ in sizes})
    if not domains:
        return None
    lexicon = _lexicon(sample.filter("first"), domains, {d: sizes.get((d, True), 0) for d in domains})
    binned = _numbers(sample.filter("not first"), lexicon).select("domain", F.posexplode("__f").alias("feature", "bin"))
    counts = np.ones((len(domains), 5 + len(domains), _BINS))  # add-one smoothing
    for d, f, b, n in binned.groupBy("domain", "feature", "bin").count().collect():
        counts[domains.index(d), f, b] += n
    prior = np.array([sizes.get((d, False), 0) + sizes.get((d, True), 0) + 1.0 for d in domains])
    return SoftDomains(
        domains, lexicon, [float(v) for v in np.log(prior / prior.sum())], np.log(counts / counts.sum(axis=2, keepdims=True))
    )


def _rate(y: list[float]) -> Column:
    """The rate of a row at the multipliers ``y``: 1 less its share of them, projected on the bounds."""
    move = sum((F.get("__p", F.lit(k)) * v for k, v in enumerate(y)), F.lit(0.0))
    return F.least(F.lit(MAX_RATE), F.greatest(F.lit(0.0), 1.0 - move))


def solve(soft: DataFrame, domains: list[str], targets: Mapping[str, float]) -> tuple[list[float], float]:
    """The multipliers of the rates for rows (__t, __p), and the largest share of all tokens by which
    a domain then misses its target.

    The rates are the nearest to 1 (least squares, weighted by tokens) whose expected domain tokens
    meet the targets, up to the compromise of both squared errors and as far as rates between 0
    and ``MAX_RATE`` can. Targets of domains without any token are dropped and the others scaled
    up; without tokens the rates are 1.
    """
    k = len(domains)
    p = [F.get("__p", F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def measured(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Expected tokens per domain, G of the rows inside the bounds, and the rows' part of the objective."""
        at = soft.withColumn("r", _rate([float(v) for v in y]))
        inside = F.when((F.col("r") > 0) & (F.col("r") < MAX_RATE), F.col("__t")).otherwise(0.0)
        # The conjugate of half the squared distance from 1 within the bounds.
        free = 1.0 - sum((q * float(v) for q, v in zip(p, y)), F.lit(0.0))
        part = F.col("__t") * (F.col("r") * free - F.col("r") * F.col("r") / 2)
        row = at.agg(*[F.sum(F.col("r") * F.col("__t") * q) for q in p], *[F.sum(inside * p[i] * p[j]) for i, j in pairs], F.sum(part)).first()
        numbers = [v or 0.0 for v in row]
        gram = np.zeros((k, k))
        for (i, j), v in zip(pairs, numbers[k:-1]):
            gram[i, j] = gram[j, i] = v
        return np.array(numbers[:k]), gram, numbers[-1]

    y = np.zeros(k)
    have, gram, part = measured(y)
    total = have.sum()
    want = np.array([max(targets.get(d, 0.0), 0.0) for d in domains]) * (have > 1e-9 * max(total, 1e-300))
    if total <= 0 or want.sum() <= 0:
        return [], 0.0
    want = want / want.sum() * total
    # The objective stays bounded where the targets cannot be met; a miss weighs by what the domain
    # holds at present, so one of few tokens is not passed over.
    soften = COMPROMISE * np.maximum(have, 1e-9 * total)
    objective = lambda part, y: part + want @ y + soften @ (y * y) / 2
    for _ in range(STEPS):
        slope = want - have + soften * y
        if (abs(slope) <= TOLERANCE * np.maximum(want, soften / COMPROMISE)).all():
            break
        # Full step of the rows inside the bounds; with none inside, of all rows.
        scale = gram if np.trace(gram) > 1e-9 * total else total * np.eye(k)
        step = -np.linalg.solve(scale + np.diag(soften), slope)
        size, now = 1.0, objective(part, y)
        while True:
            tried = np.array([float(f"{v:.12g}") for v in y + size * step])
            have_t, gram_t, part_t = measured(tried)
            # Taken only if it lowers the objective enough, else halved.
            if objective(part_t, tried) <= now + 1e-4 * size * (slope @ step) + 1e-12 * abs(now) or size < 1e-6:
                break
            size /= 2
        y, have, gram, part = tried, have_t, gram_t, part_t
    return [float(v) for v in y], float(abs(have - want).max() / total)


def rates(
    docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, domain: str = DOMAIN
) -> DataFrame:
    """``docs`` (doc_id, text, ...) with __t, __p, rate and copies for every row.

    The expected tokens of the copies meet ``targets`` (shares of the present number of tokens)
    as far as nonnegative rates can. Null or empty text: 0 tokens, which count nowhere; its
    rate follows from its posterior like any other. No labelled document, or no token:
    rate 1. Rates never exceed ``MAX_RATE``; a target that is missed by more than ``MISSED`` of all
    tokens gives a warning. Rows of the same doc_id and text get the same rate and copies. Columns named
    rate or copies, or beginning with two underscores, are replaced.
    """
    with scratch():  # sample and word counts go once the model is here
        model = learn(docs, labels, domain)
    if model is None:
        none = F.array().cast("array<double>")
        out = docs.withColumn("__t", F.lit(0.0)).withColumn("__p", none).withColumn("rate", F.lit(1.0))
    else:
        # Written with the rows: the classifier runs once, and the plans of the steps and of the
        # rates stay small.
        scored = written(model.posteriors(docs), "mixing-posteriors")
        multipliers, missed = solve(scored.select("__t", "__p"), model.domains, targets)
        if missed > MISSED:
            warnings.warn(f"the mixture misses a target by {missed:.3f} of all tokens: no rates up to {MAX_RATE:g} meet it", stacklevel=2)
        out = scored.withColumn("rate", _rate(multipliers))
    # Decided by id and text, so rows that share an id (or have none) are not all left out together.
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text"), F.lit("mixing")), F.lit(1 << 40)) / float(1 << 40)
    whole = F.floor("rate")
    return out.withColumn("copies", (whole + (part < F.col("rate") - whole).cast("int")).cast("int"))


def mixed(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, domain: str = DOMAIN) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with their own columns."""
    names = docs.columns
    given = docs.toDF(*[f"c{i}" for i in range(len(names))])
    work = given.select(
        F.struct(*given.columns).alias("row"), F.col(f"c{names.index('doc_id')}").alias("doc_id"), F.col(f"c{names.index('text')}").alias("text")
    )
    out = rates(work, labels, targets, domain).filter("copies > 0")
    again = out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return again.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)])
