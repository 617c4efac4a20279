"""Nearest neighbours by collision-counting hashing (query-aware, with virtual rehashing).

Largest inner products become smallest distances by one more coordinate: a vector x gets
sqrt(M - |x|^2) (M the largest squared norm), a query 0, so the squared distance is
|q|^2 + M - 2 <q, x>.

The vectors are dealt out to shards of about ``SHARD`` rows. A shard projects its vectors on
``PROJECTIONS`` random lines and keeps each line as a sorted array; that is the whole index.
A query opens a window of half-width R around its own projection on every line and counts,
for every vector, on how many lines it lies inside; vectors with ``THRESHOLD`` of all lines are
verified with their true distance. Then R grows (virtual rehashing: the windows widen, nothing
is hashed again, and only the new parts of the windows are counted) until the k-th verified
distance is at most R. R begins at ``START`` of a distance that the shard measures once: the median,
over ``PROBES`` of its vectors, of the distance to their k-th nearest among ``PROBED`` others, so few
steps are needed. A vector at distance R collides with a chance of 0.68 per line, so the share
of neighbours missed is that of a binomial below the threshold; verifying is a matrix product
and cheaper than counting, so lines are few and the threshold low. The windows end up
covering a whole shard if it has fewer than k vectors, so none is missed then.

Queries meet each shard in blocks of ``QUERY_BLOCK``; each shard returns its k best for each,
and the shards' lists are merged by an ordered window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm import vectors
from lastmile.llm.store import written

PROJECTIONS = 24
THRESHOLD = 0.54
GROWTH = 1.15
START = 0.9
PROBES, PROBED = 32, 2048
SHARD = 16384
QUERY_BLOCK = 4096


class Shard:
    """The sorted projection arrays of the rows of ``x``."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, largest: float):
        self.ids, self.x, self.largest = ids, x, largest
        square = (x * x).sum(axis=1)
        lines = np.random.default_rng(x.shape[1]).normal(size=(x.shape[1] + 1, PROJECTIONS))
        self.lines = lines[:-1]
        values = x @ self.lines + np.sqrt(np.maximum(largest - square, 0))[:, None] * lines[-1]
        order = np.argsort(values, axis=0, kind="stable")
        self.order = np.ascontiguousarray(order.T)
        self.sorted = np.ascontiguousarray(np.take_along_axis(values, order, axis=0).T)

    def first_radius(self, k: int) -> float:
        """A radius about which the k nearest of a vector lie, from a few of the shard's vectors."""
        n = len(self.x)
        probes = self.x[:: max(1, n // PROBES)][:PROBES]
        others = self.x[:: max(1, n // PROBED)]
        near = probes @ others.T
        # The k-th of the shard is about this one of the sample (itself included).
        nth = min(len(others) - 1, max(1, round(k * len(others) / n)))
        kth = np.partition(near, len(others) - 1 - nth, axis=1)[:, len(others) - 1 - nth]
        square = (probes * probes).sum(axis=1) + self.largest - 2 * kth
        return START * math.sqrt(max(float(np.median(square)), 1e-12 * self.largest))

    def search(self, q: np.ndarray, own: int, k: int, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the k best found, best first, ties to the smaller id; the first
        windows have half-width ``radius``."""
        n = len(self.ids)
        at = q @ self.lines
        base = float(q @ q) + self.largest
        need = math.ceil(THRESHOLD * PROJECTIONS)
        count = np.zeros(n, dtype=np.int64)
        best = np.full(n, -np.inf)
        low = high = np.array([np.searchsorted(s, v) for s, v in zip(self.sorted, at)])
        open_ = True
        while open_:
            new_low = np.array([np.searchsorted(s, v) for s, v in zip(self.sorted, at - radius)])
            new_high = np.array([np.searchsorted(s, v, side="right") for s, v in zip(self.sorted, at + radius)])
            new_low, new_high = np.minimum(new_low, low), np.maximum(new_high, high)
            parts = [o[a:b] for o, a, b in zip(self.order, new_low, low)]
            parts += [o[a:b] for o, a, b in zip(self.order, high, new_high)]
            count += np.bincount(np.concatenate(parts), minlength=n)
            low, high = new_low, new_high
            fresh = np.flatnonzero((count >= need) & np.isneginf(best))
            best[fresh] = self.x[fresh] @ q
            open_ = bool((low > 0).any() or (high < n).any())
            known = best[self.ids != own] if open_ else best
            if open_ and len(known) >= k:
                kth = np.partition(known, len(known) - k)[len(known) - k]
                if base - 2 * kth <= radius * radius:
                    break
            radius *= GROWTH
        use = (self.ids != own) & ~np.isneginf(best)
        found = np.flatnonzero(use)
        if len(found) > k:
            kth = np.partition(best[found], len(found) - k)[len(found) - k]
            found = found[best[found] >= kth - 1e-9]
        exact = (self.x[found] * q).sum(axis=1)
        top = np.lexsort((self.ids[found], -exact))[:k]
        return self.ids[found][top], exact[top]


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = vectors.rows(b.column(1))
        use = pa.array([i for i, v in enumerate(found) if v is not None], type=pa.int64())
        kept = [v for v in found if v is not None]
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(use), b.column(1).take(use), b.column(2).take(use),
             pa.array([len(v) for v in kept], type=pa.int32()), pa.array([float(v @ v) for v in kept], type=pa.float64())],
            names=["vec_id", "embedding", "is_query", "dims", "square"],
        )


def nearest(table: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest inner products found for every query.

    ``table``: (vec_id, embedding); ``queries`` marks the query rows; candidates are all rows
    with another vec_id. Rows with a null vec_id, and vectors that are null, empty, zero or hold null or
    non-finite components, take no part; vectors of different lengths do not meet. Ties go
    to the smaller vec_id. A query without candidates has no row. Other columns are not read.
    """
    # Components keep their precision: float stays float, everything else is read as double.
    kind = "array<float>" if table.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    src = table.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"),
        F.coalesce(queries, F.lit(False)).alias("is_query"),
    ).filter("vec_id is not null")
    valid = written(
        src.mapInArrow(_valid, f"vec_id bigint, embedding {kind}, is_query boolean, dims int, square double"),
        "qalsh-vectors",
    )
    sizes = valid.groupBy("dims").agg(
        F.max("square").alias("largest"), F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("shards"),
        F.ceil(F.count(F.when(F.col("is_query"), 1)) / QUERY_BLOCK).cast("int").alias("blocks"),
    ).filter("blocks > 0")
    sized = valid.join(F.broadcast(sizes), "dims")  # a row per vector length
    own = F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).cast("int")
    data = sized.select(
        "dims", own.alias("shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        "vec_id", "embedding", "largest",
    )
    asked = sized.filter("is_query").select(
        F.col("dims").alias("dims"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        block.alias("block"), F.col("vec_id").alias("vec_id"), F.col("embedding").alias("embedding"),
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({n: [] for n in names})
        stack = lambda f: np.stack([np.asarray(v, dtype=np.float64) for v in f["embedding"]])
        left = left.sort_values("vec_id", kind="stable")
        shard = Shard(left["vec_id"].to_numpy(), stack(left), float(left["largest"].iloc[0]))
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        radius = shard.first_radius(k)
        for i, q in zip(right["vec_id"].to_numpy(), stack(right)):
            out.append((i, *shard.search(q, i, k, radius)))
        return pd.DataFrame({
            "query_id": np.repeat([o[0] for o in out], [len(o[1]) for o in out]),
            "vec_id": np.concatenate([o[1] for o in out]), "score": np.concatenate([o[2] for o in out]),
        })

    place = ["dims", "shard", "block"]
    found = data.groupBy(*place).cogroup(asked.groupBy(*place)).applyInPandas(
        search, "query_id bigint, vec_id bigint, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
