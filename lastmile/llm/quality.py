"""Quality scores from a generalised additive model with pairwise interactions.

Each text becomes a few numbers about its shape (``FEATURES``). A feature is cut into at most
``BINS`` bins at quantiles; the model is one look-up table per feature, and one per chosen
pair of features, so a score is the sum of a few table entries, for all texts of a batch
at once, put through the logistic function.

The tables are learnt by cyclic boosting: in turn for every feature, a shallow tree (up to
four leaves over the feature's bins) is fitted to the gradient of the logistic loss and a
fraction of it added to the table. Then the pairs whose joint bins explain most of what is left
get tables of their own, boosted the same way with trees of one cut in each direction.

Learning sees at most ``SAMPLE_ROWS`` labelled rows (those with the smallest hash of their id),
only their numbers; texts stay in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.llm.textops import Words, chunks, utf8, word_windows, with_fields

FEATURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "non_ascii", "distinct_words",
    "repeated_next", "repeated_windows", "words_per_line", "symbol_words", "marked_words", "longest_word",
)
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.15
SAMPLE_ROWS = 40_000

_SYMBOL = np.array([33 <= b < 127 and not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123) for b in range(256)])
_DIGIT = np.array([48 <= b < 58 for b in range(256)])
_UPPER = np.array([65 <= b < 91 for b in range(256)])
_LETTER = np.array([65 <= b < 91 or 97 <= b < 123 or b >= 128 for b in range(256)])


def features(texts: list[bytes]) -> np.ndarray:
    """(texts, FEATURES); zeros for a text without words."""
    out = np.zeros((len(texts), len(FEATURES)))
    for first, docs in chunks(texts):
        w = Words(docs)
        raw = np.frombuffer(b"\n".join(docs) + b"\n", dtype=np.uint8)
        at = w.doc_starts[:-1]
        per = lambda mask: np.add.reduceat(mask, at, dtype=np.int64)
        words = np.diff(w.offsets).astype(np.float64)
        some = np.maximum(words, 1)
        letters = np.maximum(per(_LETTER[raw]), 1)
        size = np.maximum(np.diff(w.doc_starts) - 1, 1)
        length = w.ends - w.starts
        run = lambda v: np.concatenate(([0], np.cumsum(v)))
        of_words = lambda v: (lambda c: c[w.offsets[1:]] - c[w.offsets[:-1]])(run(v))
        same = np.zeros(len(w.hashes), dtype=np.int64)
        same[1:] = w.hashes[1:] == w.hashes[:-1]
        heads = w.offsets[:-1][words > 0]
        same[heads] = 0
        symbol = _SYMBOL[raw]
        last, before = symbol[w.ends - 1], symbol[np.maximum(w.ends - 2, w.starts)]
        distinct, windows, longest = np.zeros(len(docs)), np.zeros(len(docs)), np.zeros(len(docs))
        for d in range(len(docs)):
            h = w.hashes[w.offsets[d] : w.offsets[d + 1]]
            if len(h):
                distinct[d] = len(np.unique(h)) / len(h)
                longest[d] = length[w.offsets[d] : w.offsets[d + 1]].max()
            if len(h) > 3:
                v = word_windows(h, 3)
                windows[d] = 1 - len(np.unique(v)) / len(v)
        f = np.stack([
            np.log1p(words), of_words(length) / some, per(_UPPER[raw]) / letters, per(_DIGIT[raw]) / size,
            per(symbol) / size, per(raw >= 128) / size, distinct, of_words(same) / some, windows,
            words / np.maximum(per(raw == 10), 1), of_words(symbol[w.starts] & last) / some,
            of_words(last & before & (length > 1)) / some, longest,
        ], axis=1)
        f[words == 0] = 0
        out[first : first + len(docs)] = f
    return out


@dataclass
class AdditiveModel:
    base: float
    edges: list[np.ndarray]                        # inner bin borders per feature
    tables: list[np.ndarray]                       # one value per bin
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]       # features and their table

    def parts(self) -> tuple:
        return self.base, self.edges, self.tables, self.pair_edges, self.pairs

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, j], side="right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], side="right") for p in self.pairs for j in p[:2]}
        for i, j, t in self.pairs:
            z += t[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best place to cut a row of bins in two, and what it gains (place 0: none)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    k = int(gain.argmax())
    return (float(gain[k]), k + 1) if gain[k] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value of every bin of a tree of depth two."""
    borders = [0, len(g)]
    for _ in range(2):
        new = []
        for a, b in zip(borders, borders[1:]):
            k = _cut(g[a:b], h[a:b])[1]
            if k:
                new.append(a + k)
        borders = sorted(borders + new)
    out = np.zeros(len(g))
    for a, b in zip(borders, borders[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree of one cut in each direction over a table of bins: gain and leaf values."""
    best, out = 0.0, np.zeros_like(g)
    whole = _gain(g.sum(), h.sum())
    for a in range(1, g.shape[0]):
        for b in range(1, g.shape[1]):
            parts = [(slice(0, a), slice(0, b)), (slice(0, a), slice(b, None)), (slice(a, None), slice(0, b)), (slice(a, None), slice(b, None))]
            sums = [(g[p].sum(), h[p].sum()) for p in parts]
            gain = sum(_gain(*s) for s in sums) - whole
            if gain > best:
                best, out = gain, np.zeros_like(g)
                for p, (gs, hs) in zip(parts, sums):
                    out[p] = gs / (hs + 1.0)
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Learn from rows of features and 0/1 labels. No rows: every score is one half; a single
    class: close to that class."""
    n, k = x.shape
    base = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    edges, pair_edges = [_edges(x[:, j], BINS) for j in range(k)], [_edges(x[:, j], PAIR_BINS) for j in range(k)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    at = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(k)]
    z = np.full(n, base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    if 0 < y.sum() < n:
        for _ in range(ROUNDS):
            for j in range(k):
                r, c = slope()
                size = len(tables[j])
                step = RATE * _tree(np.bincount(at[j], r, size), np.bincount(at[j], c, size))
                tables[j] += step
                z += step[at[j]]
    pairs = []
    if 0 < y.sum() < n:
        coarse = [np.searchsorted(pair_edges[j], x[:, j], side="right") for j in range(k)]
        r, c = slope()
        found = []
        for i, j in combinations(range(k), 2):
            shape = (len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)
            cell = coarse[i] * shape[1] + coarse[j]
            count = shape[0] * shape[1]
            gain, _ = _cross(np.bincount(cell, r, count).reshape(shape), np.bincount(cell, c, count).reshape(shape))
            found.append((gain, i, j, cell, shape))
        for _, i, j, cell, shape in sorted(found, key=lambda f: (-f[0], f[1], f[2]))[:PAIRS]:
            pairs.append([i, j, np.zeros(shape), cell])
        for _ in range(PAIR_ROUNDS):
            for pair in pairs:
                shape, cell = pair[2].shape, pair[3]
                r, c = slope()
                count = shape[0] * shape[1]
                step = RATE * _cross(np.bincount(cell, r, count).reshape(shape), np.bincount(cell, c, count).reshape(shape))[1]
                pair[2] += step
                z += step.ravel()[cell]
    return AdditiveModel(base, edges, tables, pair_edges, [(i, j, t) for i, j, t, _ in pairs])


def learn(docs: DataFrame, labels: DataFrame, train: Column, rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """Fit on the labelled documents of ``docs`` with ``train`` true, at most ``rows`` of them, one text
    per doc_id (the smallest), however many rows share it."""
    marks = labels.filter("quality is not null").groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
    chosen = (
        docs.filter(train).select("doc_id").distinct().join(marks, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id", "quality")
    )
    labelled = docs.filter(train).select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id"  # at most ``rows`` rows of two numbers
    ).groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = features(utf8(b.column(0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(f[:, j].copy()) for j in range(len(FEATURES))] + [b.column(1)], names=[*FEATURES, "quality"]
            )

    schema = ", ".join(f"{n} double" for n in FEATURES) + ", quality int"
    found = labelled.select("text", "quality").mapInArrow(run, schema).toArrow()
    data = np.column_stack([found.column(i).to_numpy() for i in range(len(FEATURES) + 1)]).reshape(-1, len(FEATURES) + 1)
    data = data[np.lexsort(data.T)]
    return fit(data[:, :-1], data[:, -1])


def score(docs: DataFrame, labels: DataFrame, train: Column, passed: tuple[str, ...] = ()) -> DataFrame:
    """(passed columns, score) for every row of ``docs`` (doc_id, text); ``labels``: (doc_id, quality).

    Null, empty and wordless texts have all features 0 and are scored like any other. A
    document labelled more than once counts with its lowest label; null labels are ignored.
    Without labelled rows every score is 0.5. Repeated rows stay repeated; other columns
    are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, train).parts())
    names = [*passed, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = AdditiveModel(*model.value).score(features(utf8(batch.column(len(passed)))))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(passed))], pa.array(p)], names=names)

    src = docs.select(*passed, F.col("text").cast("string"))
    return src.mapInArrow(run, with_fields(src, passed, "score double"))
