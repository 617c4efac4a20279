"""Toxicity from class-conditional Kneser-Ney models of word pairs.

Two models, toxic and ordinary, give each word (a run of letters) a probability after the word
before it, interpolated over three levels. Each level takes ``DISCOUNT`` (or the whole count, if
less) from every count, and what it takes is, as in Kneser-Ney smoothing, both the mass of the
level below and the counts that it is built from:

* the pair: in how many of the class's training documents the word stands after that word. (A pair
  counts once a document: lines that one document repeats are no evidence about others. The
  discount is above one because one class has a fraction of the documents of the other.)
* the word: its continuation count in the class, what the pairs that end in it gave up;
* the word in both classes: what the two gave up, shared as backoff counts by both models, so
  an expression too rare to be told apart weighs alike in both; one is added to each word.

The evidence of a word is the log ratio of its two probabilities, less the constant that a
word unknown to both classes has, which is therefore no evidence. That of a text is the sum
over its words normalised by length (``LENGTH`` words are added, so that a few words cannot decide
by chance). Most words carry a little noise, so the parts that come from words above each
threshold of ``STRONG`` are further terms; a logistic curve over all of them gives the score.

Pairs are counted by tasks and merged by aggregations, at most ``TRAIN_ROWS`` labelled training
rows with at most ``TRAIN_BYTES`` of text together (those with the smallest hash of their id; the texts are
whole). No text reaches the driver, only the log ratios of words, and of the pairs above the discount
(the others equal their word's exactly), under 64-bit hashes. No word is dropped; each takes two bytes of
the sample at least, a pair sixteen, so the broadcast is bounded by the sample whatever the corpus. The curve is fitted on rows that gave no counts, at most
``CURVE_ROWS`` of them, a few numbers each. Only ids and labels of the chosen rows are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.store import scratch, written
from lastmile.llm.textops import LETTERS, Words, chunks, mix, text_once, utf8, with_fields

DISCOUNT = 3.0
STRONG = (1.0, 2.0, 3.0, 4.0)
LENGTH = 30
TRAIN_ROWS = 60_000
TRAIN_BYTES = 128 << 20
CURVE_ROWS = 20_000
_START = np.uint64(0)  # stands before the first word


def _words(docs: list[bytes]) -> tuple[Words, np.ndarray]:
    """The words of a chunk and the hash of the word before each."""
    w = Words([d.translate(LETTERS) for d in docs])
    before = np.concatenate((np.full(1, _START), w.hashes))[: len(w.hashes)]
    firsts = w.offsets[:-1][np.diff(w.offsets) > 0]
    before[firsts] = _START
    return w, before


def _pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0xD6E8FEB86659FD93) + word)


def _find(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key among the sorted ``known``, and whether it is there."""
    if not len(known):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


class Model:
    """Log ratios of the two models: ``words`` (sorted) with the ratio as a word and, as a context,
    that of the mass left to the lower level; ``pairs`` (sorted) with the ratio of the whole pair."""

    def __init__(self, words: np.ndarray, ratio: np.ndarray, left: np.ndarray, pairs: np.ndarray, pair_ratio: np.ndarray):
        by_word, by_pair = np.argsort(words), np.argsort(pairs)
        self.words, self.ratio, self.left = words[by_word], ratio[by_word], left[by_word]
        self.pairs, self.pair_ratio = pairs[by_pair], pair_ratio[by_pair]

    def of_words(self, w: Words, before: np.ndarray) -> np.ndarray:
        """The evidence of each word of a chunk."""
        if not len(self.words):
            return np.zeros(len(w.hashes))
        unique, where = np.unique(w.hashes, return_inverse=True)
        at, known = _find(unique, self.words)
        there = known[where]
        alone = np.where(known, self.ratio[at], 0.0)[where]
        after = np.concatenate(([0.0], np.where(known, self.left[at], 0.0)[where]))[: len(w.hashes)]
        start, has = _find(np.full(1, _START), self.words)
        after[before == _START] = self.left[start[0]] if has[0] else 0.0
        lower = np.where(there, alone + after, 0.0)
        at, known = _find(_pair(before, w.hashes), self.pairs)
        return np.where(known, self.pair_ratio[at], lower) if len(self.pairs) else lower


def evidence(texts: list[bytes], model: Model) -> np.ndarray:
    """Per text the log ratio of all words by length, then for each threshold that of the words
    above it by length, and its bounded sum. Zeros for a text without words."""
    out = np.zeros((len(texts), 1 + 2 * len(STRONG)))
    for first, docs in chunks(texts):
        w, before = _words(docs)
        value = model.of_words(w, before)
        a, b = w.offsets[:-1], w.offsets[1:]
        length = (b - a) + float(LENGTH)
        here = out[first : first + len(docs)]
        total = np.concatenate(([0.0], np.cumsum(value)))
        here[:, 0] = (total[b] - total[a]) / length
        for j, above in enumerate(STRONG):
            strong = np.concatenate(([0.0], np.cumsum(np.where(value > above, value, 0.0))))
            peak = strong[b] - strong[a]
            here[:, 1 + 2 * j] = peak / length
            here[:, 2 + 2 * j] = np.minimum(peak, 40) / 10
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(before, word, toxic, n) of the pairs of each chunk."""
    for batch in batches:
        toxic = batch.column(1).to_numpy()
        for first, docs in chunks(utf8(batch.column(0))):
            w, before = _words(docs)
            doc = np.repeat(np.arange(len(docs), dtype=np.uint64), np.diff(w.offsets))
            of = toxic[first : first + len(docs)][doc.astype(np.int64)]
            key = _pair(before, w.hashes)
            _, once = np.unique(mix(key + doc), return_index=True)
            for c in (0, 1):
                here = once[of[once] == c]
                _, at, n = np.unique(key[here], return_index=True, return_counts=True)
                at = here[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(before[at].view(np.int64)), pa.array(w.hashes[at].view(np.int64)),
                     pa.array(np.full(len(at), c, dtype=np.int32)), pa.array(n.astype(np.int64))],
                    names=["before", "word", "toxic", "n"],
                )


def _models(labelled: DataFrame) -> Model:
    """The log ratios of the two models from rows (text, toxic)."""
    both = (0, 1)
    pairs = written(
        labelled.select("text", "toxic").mapInArrow(_count, "before bigint, word bigint, toxic int, n bigint")
        .groupBy("before", "word")
        .agg(*[F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in both]),
        "toxicity-pairs",
    )
    kept = F.greatest("n0", "n1") > DISCOUNT
    words = written(
        pairs.groupBy("word").agg(
            *[F.sum(F.least(F.col(f"n{c}").cast("double"), F.lit(DISCOUNT))).alias(f"m{c}") for c in both]
        ).select("*", *[F.least(F.col(f"m{c}"), F.lit(DISCOUNT)).alias(f"d{c}") for c in both]),
        "toxicity-words",
    )
    known = words.agg(
        F.count(F.lit(1)).alias("v"), *[F.sum(x).alias(x) for x in ("m0", "m1", "d0", "d1")]
    ).first()
    none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.float32)
    if not known.v or not known.m0 or not known.m1:
        return Model(none[0], none[1], none[1], *none)
    shared = (F.col("d0") + F.col("d1") + 1) / (known.d0 + known.d1 + known.v + 1)
    rest = [known[f"d{c}"] / known[f"m{c}"] for c in both]
    shift = float(np.log(rest[1] / rest[0]))
    words = words.select(
        "word", *[(F.greatest(F.col(f"m{c}") - DISCOUNT, F.lit(0.0)) / known[f"m{c}"] + rest[c] * shared).alias(f"p{c}") for c in both]
    )
    over = [F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0)) for c in both]
    contexts = written(
        pairs.groupBy("before").agg(*[F.sum(f"n{c}").alias(f"t{c}") for c in both], *[F.sum(over[c]).alias(f"o{c}") for c in both])
        .select("before", "t0", "t1", *[F.when(F.col(f"t{c}") > 0, 1 - F.col(f"o{c}") / F.col(f"t{c}")).otherwise(1.0).alias(f"g{c}") for c in both]),
        "toxicity-contexts",
    )
    alone = (
        words.withColumnRenamed("word", "before").join(contexts, "before", "full")
        .select(
            "before", F.coalesce(F.log("p1") - F.log("p0") - shift, F.lit(0.0)).cast("float").alias("ratio"),
            F.coalesce(F.log("g1") - F.log("g0"), F.lit(0.0)).cast("float").alias("left"),
        )
        .toArrow()
    )
    lower = [F.col(f"g{c}") * F.col(f"p{c}") for c in both]
    here = [F.when(F.col(f"t{c}") > 0, over[c] / F.col(f"t{c}")).otherwise(0.0) + lower[c] for c in both]
    together = (
        pairs.filter(kept).join(words, "word").join(contexts, "before")
        .select("before", "word", (F.log(here[1]) - F.log(here[0]) - shift).cast("float").alias("ratio"))
        .toArrow()
    )
    word, before, after = [c.to_numpy().view(np.uint64) for c in (alone["before"], together["before"], together["word"])]
    return Model(
        word, alone["ratio"].to_numpy(), alone["left"].to_numpy(), _pair(before, after), together["ratio"].to_numpy()
    )


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the logistic curve (the last one is the offset), weakly penalised towards a
    fixed curve, so a single class or no row at all still gives one."""
    start = np.array([1.0, *[20.0, 0.8] * len(STRONG), -7.0])
    a, w = np.column_stack((x, np.ones(len(x)))), start.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -35, 35)))
        grad = a.T @ (p - y) + 1e-2 * (w - start)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w)), grad)
        step *= min(1.0, 20 / max(abs(step).max(), 1e-9))
        w = w - step
        if abs(step).max() < 1e-8:
            break
    return w


def _chosen(texts: DataFrame, marks: DataFrame, fold: str, rows: int, size: int = TRAIN_BYTES) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents of a fold, one text per doc_id (the
    smallest), however many rows share it; of these the first ones that hold ``size`` bytes together."""
    ids = (
        texts.filter(fold).select("doc_id").distinct().join(marks, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    of = texts.filter(fold).join(F.broadcast(ids), "doc_id")  # at most ``rows`` rows of two numbers
    found = written(of.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxicity-sample")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    sizes = found.select("doc_id", F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")).over(order).alias("bytes"))
    within = sizes.filter(F.col("bytes") <= size).select("doc_id")  # at most ``rows`` numbers, in one task
    return found.join(F.broadcast(within), "doc_id").select("text", "toxic")


def score(docs: DataFrame, labels: DataFrame, train: Column, calibrate: Column, passed: tuple[str, ...] = ()) -> DataFrame:
    """(passed columns, score) for every row of ``docs`` (doc_id, text); ``labels``: (doc_id, toxic).

    ``train`` marks the labelled rows of ``docs`` that give the counts, ``calibrate`` those
    that fit the curve. Null or empty text, or one without letters: the curve at evidence 0. A
    document labelled more than once counts as toxic if any of its labels is 1; null
    labels are ignored. Without labelled rows of both classes the evidence of every text is 0.
    Repeated rows stay repeated; other columns are not read. ``passed`` may hold ``text``; a passed
    column named score is an error.
    """
    spark = docs.sparkSession
    marks = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), train.alias("__train"), calibrate.alias("__calibrate")
    )
    with scratch():  # the counts go once the model is here
        model = spark.sparkContext.broadcast(_models(_chosen(texts, marks, "__train", TRAIN_ROWS)))
    width = 1 + 2 * len(STRONG)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = evidence(utf8(batch.column(0)), model.value)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x[:, j].copy()) for j in range(width)], batch.column(1)],
                names=[*[f"x{j}" for j in range(width)], "toxic"],
            )

    shape = ", ".join([*[f"x{j} double" for j in range(width)], "toxic int"])
    with scratch():
        found = _chosen(texts, marks, "__calibrate", CURVE_ROWS).mapInArrow(terms, shape)
        points = np.array([tuple(r) for r in found.collect()], dtype=np.float64).reshape(-1, width + 1)
    points = points[np.lexsort(points.T)]
    curve = _curve(points[:, :width], points[:, width])
    names = [*passed, "score"]
    src, text_at = text_once(docs, passed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = evidence(utf8(batch.column(text_at)), model.value) @ curve[:-1] + curve[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(passed))], pa.array(p)], names=names)

    return src.mapInArrow(run, with_fields(src, passed, "score double"))
