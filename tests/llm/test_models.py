"""Label samples under a hot id, the mixing solver against brute force, precision of vectors."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lastmile.llm import mixing, qalsh, quality, toxicity


def test_label_samples_take_one_row_per_id(spark):
    """A third of all rows under one id: the bound holds and other documents are still sampled."""
    rows = [(i, f"text number {i} with some words") for i in range(200)] + [(7, f"again {j}") for j in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(200)], "doc_id bigint, quality int, toxic int")
    texts = docs.withColumn("fold", F.lit(True))
    marks = labels.select("doc_id", "toxic")
    sample = toxicity._chosen(texts, marks, "fold", 50)
    assert sample.count() == 50
    assert toxicity._chosen(texts, marks, "fold", 1000).count() == 200
    seen = []
    original = quality.fit
    quality.fit = lambda x, y: seen.append(len(y)) or original(x, y)
    try:
        quality.learn(docs, labels, F.lit(True), rows=60)
    finally:
        quality.fit = original
    assert seen == [60]
    assert mixing.learn(docs, labels, rows=80) is not None


def _brute(t, p, want, soften):
    """The rates by many small steps of the projected gradient, straight from the objective."""
    r = np.ones(len(t))
    root = np.sqrt(soften)
    scale = 1.0 + np.linalg.eigvalsh((p * t[:, None]).T @ p / root[:, None] / root).max()
    momentum, old = 1.0, r
    z = r
    for _ in range(200_000):
        grad = (z - 1) + p @ (((z * t) @ p - want) / soften)  # in the norm that weighs a row by t
        new = np.clip(z - grad / scale, 0, mixing.MAX_RATE)
        nxt = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        z, old, momentum = new + (momentum - 1) / nxt * (new - old), new, nxt
    return old


@pytest.mark.parametrize(
    "shares", [(0.6, 0.3, 0.1), (0.05, 0.90, 0.05), (0.02, 0.90, 0.08), (0.98, 0.01, 0.01)], ids=["mild", "hard", "harder", "one"]
)
def test_solver_meets_targets_and_brute_force(spark, shares):
    rng = np.random.default_rng(11)
    p = rng.dirichlet([1.0, 0.7, 0.5], 300)
    t = rng.integers(0, 400, 300).astype(float)
    soft = spark.createDataFrame([(float(a), [float(x) for x in b]) for a, b in zip(t, p)], "__t double, __p array<double>")
    domains = ["a", "b", "c"]
    y, missed = mixing.solve(soft, domains, dict(zip(domains, shares)))
    rate = np.clip(1 - p @ np.array(y), 0, mixing.MAX_RATE)
    have = (rate * t) @ p / t.sum()
    assert missed == pytest.approx(abs(have - shares).max(), abs=1e-6) and missed < 0.01
    soften = mixing.COMPROMISE * (t @ p)
    value = lambda r: (t * (r - 1) ** 2).sum() / 2 + (((r * t) @ p - np.array(shares) * t.sum()) ** 2 / soften).sum() / 2
    assert value(rate) <= value(_brute(t, p, np.array(shares) * t.sum(), soften)) * (1 + 1e-4)


def test_targets_out_of_reach_warn_and_stay_bounded(spark):
    """Every document is half of both domains: nothing can make a mix of 9 to 1."""
    docs = spark.createDataFrame([(10.0, [0.5, 0.5])] * 20, "__t double, __p array<double>")
    y, missed = mixing.solve(docs, ["a", "b"], {"a": 0.9, "b": 0.1})
    assert missed == pytest.approx(0.4, abs=0.01) and np.isfinite(y).all()


def test_scores_of_double_vectors_are_exact(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    df = df.withColumns({"score": F.lit("other"), "rank": F.lit(0), "query_id": F.lit(1)})
    out = qalsh.nearest(df, queries=F.col("vec_id") % 20 == 0, k=5).collect()
    assert len(out) == 15 and all(r.score == pytest.approx(float((x[r.query_id] * x[r.vec_id]).sum()), rel=1e-15) for r in out)


def test_toxicity_pair_model_against_plain_counts(spark):
    """The evidence of every word, from the definition: pairs once a document, three levels."""
    texts = [(f"the {w} fox {'runs over ' * (i % 4)}the {'grub' if i % 3 == 0 else 'dog'} snark", int(i % 3 == 0))
             for i, w in enumerate(["red", "blue", "old", "red"] * 9)] + [(None, 1), ("", 0), ("12 .", 1)]
    d = toxicity.DISCOUNT
    pairs = Counter()
    for text, c in texts:
        words = "".join(x if x.isalpha() else " " for x in text or "").split()
        pairs.update({(c, a, b) for a, b in zip([None, *words], words)})
    low, ctx, lost = Counter(), Counter(), Counter()
    for (c, a, b), n in pairs.items():
        low[c, b] += min(n, d)
        ctx[c, a] += n
        lost[c, a] += min(n, d)
    vocabulary = {b for _, b in low}
    total = {c: sum(low[c, b] for b in vocabulary) for c in (0, 1)}
    given = {c: sum(min(low[c, b], d) for b in vocabulary) for c in (0, 1)}

    def chance(c, a, b):
        shared = (sum(min(low[k, b], d) for k in (0, 1)) + 1) / (sum(given.values()) + len(vocabulary) + 1)
        lower = max(low[c, b] - d, 0) / total[c] + given[c] / total[c] * shared
        if not ctx[c, a]:
            return lower
        return max(pairs[c, a, b] - d, 0) / ctx[c, a] + lost[c, a] / ctx[c, a] * lower

    shift = np.log(given[1] / total[1] / (given[0] / total[0]))
    model = toxicity._models(spark.createDataFrame(texts, "text string, toxic int"))
    assert len(model.pairs) > 3
    for text in ("the red fox runs over the grub snark", "snark the dog", "grub blue unknown fox", "red"):
        words = text.split()
        want = [np.log(chance(1, a, b) / chance(0, a, b)) - shift if b in vocabulary else 0 for a, b in zip([None, *words], words)]
        assert np.allclose(model.of_words(*toxicity._words([text.encode()])), want, atol=1e-5)


def test_toxicity_sample_is_bounded_in_bytes(spark):
    texts = spark.createDataFrame([(i, "x" * 100, True) for i in range(50)], "doc_id bigint, text string, fold boolean")
    marks = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id bigint, toxic int")
    assert toxicity._chosen(texts, marks, "fold", 50, 1000).count() == 10
