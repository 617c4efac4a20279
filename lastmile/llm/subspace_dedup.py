"""Near-duplicate vectors by a subspace pigeonhole join.

Two unit vectors of cosine c are apart by 2 - 2c in squared distance, and a rotation changes no
distance. Cut the rotated vectors into blocks of ``BLOCK`` dimensions: if the whole squared
distance is at most D, some block's is at most D times the block's share of the dimensions.
So a linked pair is found in at least one block by a range join under that budget, and no
pair is lost.

The range join of a block sorts the vectors by their first block coordinate, so partners stand
within the budget's radius of each other, and compares block distances there; a pair within a
block's budget is verified on the whole original vectors in double precision, and counted only by
the first block whose budget it meets.

Equal vectors of a label are one class and are never paired. The classes of a label are dealt out as
tiles of at most ``TILE_ROWS`` rows and ``TILE_VALUES`` components, a tile against a tile per task, whatever
a hot label or a dense region holds; nothing is capped. All blocks of two tiles are joined in one task, so a
vector is sent once to every tile of its label and not once per block and cell. A task returns no pairs, whose number
grows with the square of a group: it returns, for every linked row, the number of its links and one row of
the same group, which is all that counts and components need.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm import vectors
from lastmile.llm.graph import connected_components
from lastmile.llm.store import scratch, written

BLOCK = 8
TILE_ROWS = 1 << 15
TILE_VALUES = 1 << 21
_SLACK = 1e-9
_STRIP = 256, 1024
_HELD = 1 << 16


def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def _budgets(dims: int, cosine: float) -> tuple[list[slice], np.ndarray]:
    blocks = [slice(i, min(i + BLOCK, dims)) for i in range(0, dims, BLOCK)]
    share = np.array([b.stop - b.start for b in blocks]) / dims
    return blocks, (2 - 2 * cosine) * share + _SLACK


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, key): the key of a row's class, null if it takes no part."""
    for b in batches:
        found = vectors.rows(b.column(2))
        keys = [
            hashlib.blake2b(v.tobytes() + b"|" + str(l).encode(), digest_size=16).digest()
            if v is not None and l is not None and i is not None else None
            for v, l, i in zip(found, b.column(1).to_pylist(), b.column(0).to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(keys, type=pa.binary()), b.column(2)],
            names=["vec_id", "label", "key", "embedding"],
        )


def _true(mask: np.ndarray) -> np.ndarray:
    """Flat places of a mask's true values, which are few: eight at a time."""
    flat = np.append(mask, np.zeros(-mask.size % 8, dtype=bool))
    words = np.flatnonzero(flat.view(np.uint64) != 0)
    p, q = np.nonzero(flat.reshape(-1, 8)[words])
    return words[p] * 8 + q


def _near(here: np.ndarray, left: np.ndarray, right: np.ndarray, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a row of ``left`` and one of ``right`` whose rows of ``here`` are within ``limit`` (squared), and a few more
    just beyond it. ``left`` and ``right`` are rows in the order of the first coordinate; if they are the same array, every pair
    comes once."""
    square = (here * here).sum(axis=1)
    one = np.ones(len(here))
    of_left = np.column_stack([-2 * here, square, one]).astype(np.float32)
    of_right = np.column_stack([here, one, square]).astype(np.float32)[right].T
    along = here[right, 0]
    reach = np.sqrt(max(limit, 0)) * (1 + _SLACK) + _SLACK
    high, wide = _STRIP
    found, n = [], 0
    for i in range(0, len(left), high):
        l = left[i : i + high]
        first, end = np.searchsorted(along, [here[l[0], 0] - reach, here[l[-1], 0] + reach])
        if left is right:
            first = i
        for k in range(first, end, wide):
            within = of_left[l] @ of_right[:, k : min(k + wide, end)] <= limit + 1e-5
            p, q = np.divmod(_true(within), within.shape[1])
            if left is right:
                later = q + k > p + i
                p, q = p[later], q[later]
            found.append((l[p], right[q + k]))
            n += len(p)
            if n >= _HELD:
                yield from _held(found)
                found, n = [], 0
    yield from _held(found)


def _held(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, so many at a time."""
    if found:
        a, b = (np.concatenate(x) for x in zip(*found))
        for n in range(0, len(a), _HELD):
            yield a[n : n + _HELD], b[n : n + _HELD]


def _joined(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``low``, which names a row of its group for every row, with the groups of ``a`` and ``b`` made one, pair by pair."""
    while True:
        x, y = low[a], low[b]
        apart = x != y
        if not apart.any():
            return low
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(low[low], low):
            low = low[low]


def _links(key: tuple, group: pa.Table, cosine: float) -> pa.Table:
    """(node, others, root) of every row of a tile pair that has a link in it: the sum of its partners' weights, and a node of its group."""
    dims, t, u = (k.as_py() for k in key[1:])
    x = group["embedding"].combine_chunks().flatten().to_numpy().reshape(-1, dims).astype(np.float64)
    node, weight, tile = (group[c].to_numpy() for c in ("node", "weight", "tile"))
    norm = np.linalg.norm(x, axis=1)
    turned = (x / norm[:, None]) @ rotation(dims)
    blocks, budget = _budgets(dims, cosine)
    others, low = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    for j, (s, limit) in enumerate(zip(blocks, budget)):
        here = np.ascontiguousarray(turned[:, s])
        order = np.argsort(here[:, 0], kind="stable")
        left = order[tile[order] == t]
        right = left if t == u else order[tile[order] == u]
        for a, b in _near(here, left, right, limit):
            for i in (j, *range(j)):  # within this block's budget, and in no block's before
                within = ((turned[a, blocks[i]] - turned[b, blocks[i]]) ** 2).sum(axis=1) <= budget[i]
                keep = within if i == j else ~within
                a, b = a[keep], b[keep]
            close = (x[a] * x[b]).sum(axis=1) / (norm[a] * norm[b]) >= cosine
            a, b = a[close], b[close]
            np.add.at(others, a, weight[b])
            np.add.at(others, b, weight[a])
            low = _joined(low, a, b)
    linked = np.flatnonzero(others)
    return pa.table({"node": node[linked], "others": others[linked], "root": node[low[linked]]})


def _weights(rows: DataFrame) -> DataFrame:
    """(key, weight) of the classes that share their node with another one: the rows of all of them."""
    classes = rows.filter("key is not null").groupBy("key").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    shared = classes.groupBy("node").agg(F.sum("copies").alias("weight"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return classes.join(shared.hint("merge"), "node").select("key", "weight")


def near_duplicates(table: DataFrame, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table`` (vec_id, embedding, label).

    Vectors link when their labels are equal and not null, their lengths are equal and their
    cosine is at least ``cosine``. Vectors that are null, empty, zero or hold null or non-finite
    components, and rows with a null vec_id, link with nothing (n_links 0, their own component).
    Equal vectors count as links of each other. Rows are expected to have distinct vec_id;
    rows that repeat one with the same vector count as links like any other copies. Other columns are
    not read.
    """
    src = table.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<float>").alias("embedding")
    )
    kind = src.schema["label"].dataType.simpleString()
    with scratch():
        keyed = written(
            src.mapInArrow(_classes, f"vec_id bigint, label {kind}, key binary, embedding array<float>"), "subspace-keyed"
        )
        rows = written(keyed.select("vec_id", "key"), "subspace-rows", keep=True)
        classes = written(
            keyed.filter("key is not null").groupBy("key").agg(
                F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"),
                F.first("label").alias("label"), F.first("embedding").alias("embedding"),
            ).join(_weights(rows).hint("merge"), "key", "left").withColumns(
                {"weight": F.coalesce("weight", "copies"), "dims": F.size("embedding")}
            ),
            "subspace-classes", keep=True,
        )
    place = ["label", "dims"]
    held = F.greatest(F.lit(1), F.least(F.lit(TILE_ROWS), F.floor(F.lit(TILE_VALUES) / F.col("dims"))))
    # At most a row for every full tile: that is what may be broadcast.
    large = classes.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > held).select(
        *place, F.ceil(F.col("n") / held).cast("int").alias("tiles")
    )
    tiles = F.coalesce("tiles", F.lit(1))
    spread = (
        classes.join(F.broadcast(large), place, "left")
        .select(*place, "node", "weight", "embedding", F.pmod(F.xxhash64("key"), tiles).cast("int").alias("tile"), tiles.alias("tiles"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumns({"t": F.least("tile", "other"), "u": F.greatest("tile", "other")})
        .drop("tiles", "other")
    )
    links = written(
        spread.groupBy(*place, "t", "u").applyInArrow(
            lambda key, g: _links(key, g, cosine), "node bigint, others bigint, root bigint"
        ),
        "subspace-links",
    )
    # A file's size says little of its rows here (roots and counts repeat), so no broadcast by it.
    degree = links.groupBy("node").agg(F.sum("others").alias("others")).hint("merge")
    labels = connected_components(links, "node", "root").hint("merge")
    named = (
        classes.select("key", "node", "copies")
        .join(degree, "node", "left")
        .join(labels, "node", "left")
        .select(
            "key", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    out = rows.join(named, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
