"""Near-duplicate documents by min-max hashing.

A document's set is its distinct word shingles (words as in ``textops``; fewer words than a
shingle has: the whole sequence as one shingle). Each of ``PERMUTATIONS`` hash functions is
evaluated once per shingle and yields two signature values, the minimum and the maximum,
so 64 evaluations give a 128-value signature. The values are cut into 32 bands of 4; two
sets of similarity 0.75 agree on no band with probability (1 - 0.75^4)^32 = 5e-6.

1. One pass over the texts gives per document the set size, a 128-bit hash of the whole
   set and the band hashes. Equal sets are one class from here on (copies are never paired).
2. Every band bucket with several classes compares each of its classes with one centre, the
   smallest class of the bucket: one pair per member, not all pairs. The links are confirmed
   on the full sets, and components are formed.
3. What is left are buckets whose classes are still in different components. Classes that such
   buckets connect form a cluster; a cluster's classes travel once, with their sets, to tasks that
   compare those of different components that share a band, on the full sets, and return
   only links that join components. A cluster of more than ``TILE_SHINGLES`` is dealt out as tiles,
   a tile against a tile per task. No bucket is capped.

Sets of a shingle are 64-bit hashes; classes are 128-bit hashes of the sorted set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.llm.graph import connected_components
from lastmile.llm.store import scratch, written
from lastmile.llm.textops import Words, chunks, mix, utf8, word_windows

PERMUTATIONS = 64
BAND_ROWS = 4
BANDS = 2 * PERMUTATIONS // BAND_ROWS
SHINGLE_WORDS = 5
SIMILARITY = (75, 100)  # at least 75 / 100
TILE_SHINGLES = 2_000_000  # of the classes of one task of the last step

_rng = np.random.default_rng(7)
_MULTIPLY = (_rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1))[:, None]
_ADD = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)[:, None]
_BLOCK = 1 << 15


def shingle_set(words: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a word-hash sequence."""
    if not len(words):
        return words
    return np.unique(word_windows(words, min(n, len(words))))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of the set under each permutation."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(PERMUTATIONS, 2**32 - 1, dtype=np.uint32)
    high = np.zeros(PERMUTATIONS, dtype=np.uint32)
    for i in range(0, len(x), _BLOCK):
        y = _MULTIPLY * x[i : i + _BLOCK] + _ADD
        low = np.minimum(low, y.min(axis=1))
        high = np.maximum(high, y.max(axis=1))
    return np.concatenate((low, high))


def bands(signatures: np.ndarray) -> np.ndarray:
    """(documents, BANDS) 64-bit band hashes. The rows of a band come from different
    permutations: half of them minima, half maxima."""
    half = PERMUTATIONS
    low, high = signatures[:, :half], np.roll(signatures[:, half:], -half // 6, axis=1)
    rows = np.concatenate((low, high), axis=1).reshape(len(signatures), BAND_ROWS, BANDS)
    out = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for j in range(BAND_ROWS):
        out = mix(out + rows[:, j, :].astype(np.uint64) + np.uint64(1))
    return out


_FEATURES = "row bigint, doc_id bigint, mark bigint, n_shingles bigint, key binary, bands array<bigint>"


def _features(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column(3))
        size, keys = np.zeros(len(texts), dtype=np.int64), [None] * len(texts)
        sigs = np.zeros((len(texts), 2 * PERMUTATIONS), dtype=np.uint32)
        for first, docs in chunks(texts):
            w = Words(docs)
            for d in range(len(docs)):
                s = shingle_set(w.hashes[w.offsets[d] : w.offsets[d + 1]], n)
                if len(s):
                    i = first + d
                    size[i] = len(s)
                    keys[i] = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    sigs[i] = signature(s)
        flat = bands(sigs).view(np.int64).ravel()
        listed = pa.ListArray.from_arrays(
            np.arange(0, len(flat) + 1, BANDS, dtype=np.int32), pa.array(flat)
        )
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in range(3)], pa.array(size), pa.array(keys, type=pa.binary()), listed],
            names=["row", "doc_id", "mark", "n_shingles", "key", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, docs in chunks(utf8(batch.column(0))):
            w = Words(docs)
            sets = [shingle_set(w.hashes[w.offsets[d] : w.offsets[d + 1]], n) for d in range(len(docs))]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            at = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            flat = pa.array(np.concatenate([np.sort(s.view(np.int64)) for s in sets]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, type=pa.binary()), pa.ListArray.from_arrays(at, flat)],
                names=["key", "shingles"],
            )


def _similar(shared: Column, na: Column, nb: Column, similarity: tuple[int, int]) -> Column:
    part, whole = similarity
    return whole * shared >= part * (na + nb - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(_similar(shared, F.size("sa"), F.size("sb"), similarity)).select("a", "b")


def _cluster_links(table: pa.Table, similarity: tuple[int, int]) -> pa.Table:
    """Links that join different components among the classes of one pair of tiles.

    Classes meet where they share a band; a pair is looked at in its first common band only, and
    not at all once its components are joined. The sets are compared in full.
    """
    part, whole = similarity
    keys = table.column("key").to_pylist()
    tile = table.column("tile").to_numpy()
    crossed = tile.min() != tile.max()
    names = table.column("component").to_pylist()
    number = {c: i for i, c in enumerate(dict.fromkeys(names))}
    root = np.array([number[c] for c in names])
    listed = table.column("shingles").combine_chunks()
    at, flat = listed.offsets.to_numpy(), listed.values.to_numpy()
    size = np.diff(at)
    grid = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(keys), BANDS)
    out: list[tuple[bytes, bytes]] = []
    for band in range(BANDS):
        order = np.argsort(grid[:, band], kind="stable")
        value = grid[order, band]
        borders = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1], [True])))
        for lo, hi in zip(borders[:-1][np.diff(borders) > 1], borders[1:][np.diff(borders) > 1]):
            run = order[lo:hi]
            for k, x in enumerate(run[:-1]):
                y = run[k + 1 :]
                y = y[(root[y] != root[x]) & (whole * np.minimum(size[x], size[y]) >= part * np.maximum(size[x], size[y]))]
                if crossed:
                    y = y[tile[y] != tile[x]]
                if band and len(y):
                    y = y[~(grid[y, :band] == grid[x, :band]).any(axis=1)]
                if not len(y):
                    continue
                n = size[y]
                ends = np.cumsum(n)
                place = np.arange(int(ends[-1])) + np.repeat(at[y] - (ends - n), n)
                mine = flat[at[x] : at[x + 1]]
                spot = np.searchsorted(mine, flat[place])
                spot[spot == len(mine)] = 0
                shared = np.add.reduceat((mine[spot] == flat[place]).astype(np.int64), ends - n)
                for z in y[whole * shared >= part * (size[x] + n - shared)]:
                    if root[z] != root[x]:
                        out.append((keys[x], keys[z]))
                        root[root == root[z]] = root[x]
    return pa.table({"a": pa.array([o[0] for o in out], type=pa.binary()), "b": pa.array([o[1] for o in out], type=pa.binary())})


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable by links. Null or empty text, or text
    without words: n_shingles 0, linked with nothing, its own component. Repeated rows
    stay repeated and share their component. A null doc_id takes part in links, but names no
    component unless it is alone (then null, kept). Other columns are not read.
    """
    out = _grouped(docs.select("doc_id", "text", F.lit(0).alias("row")), shingle_words, similarity)
    component = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def _grouped(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """(row, doc_id, mark, n_shingles, component, component_id) for every row of ``docs`` (row, doc_id,
    text). ``mark`` is a hash of the text; ``component`` is a class key, null without words."""
    part, whole = similarity
    text = F.col("text").cast("string")
    src = docs.select(
        F.col("row").cast("bigint").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("mark"), text.alias("text"),
    )
    features = written(src.mapInArrow(lambda it: _features(it, shingle_words), _FEATURES), "minmax-features")
    classes = written(
        features.filter(F.col("key").isNotNull()).groupBy("key").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("at"),
        ),
        "minmax-classes",
    )
    rows = classes.select(F.explode("bands").alias("band"), "key", "n")
    shared = (
        rows.groupBy("band")
        .agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("key", "n")).alias("centre"))
        .filter("members > 1")
        .select("band", F.col("centre.key").alias("a"), F.col("centre.n").alias("na"))
    )
    bucketed = written(rows.join(shared, "band"), "minmax-buckets")

    # The sets of every class that shares a bucket, read again from the texts; a class is found by
    # the id (which can be null) and the text hash of one of its rows.
    wanted = bucketed.select("key").distinct().join(classes.select("key", "at"), "key").select(
        F.col("at.doc_id").alias("at_id"), F.col("at.mark").alias("at_mark")
    ).distinct()
    sets = written(
        src.join(wanted, (F.col("mark") == F.col("at_mark")) & F.col("doc_id").eqNullSafe(F.col("at_id")), "left_semi")
        .select("text")
        .mapInArrow(lambda it: _sets(it, shingle_words), "key binary, shingles array<bigint>")
        .dropDuplicates(["key"]),
        "minmax-sets",
    )

    fits = whole * F.least("na", "n") >= part * F.greatest("na", "n")
    star = bucketed.filter((F.col("key") != F.col("a")) & fits).select("a", F.col("key").alias("b")).distinct()
    links = written(_confirmed(star, sets, similarity), "minmax-links")
    labels = connected_components(links)

    # Buckets that still hold several components: their classes, in clusters of classes that
    # such buckets connect, are compared inside tasks.
    named = bucketed.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key")
    )
    several = named.groupBy("band").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"), F.min("key").alias("first")
    ).filter("c0 != c1").select("band", "first")
    mixed = written(named.join(several, "band").select("key", "n", "component", "first").distinct(), "minmax-mixed")
    clusters = connected_components(mixed.select(F.col("key").alias("a"), F.col("first").alias("b")))
    members = (
        mixed.select("key", "n", "component").distinct()
        .join(clusters.select(F.col("node").alias("key"), F.col("component").alias("cluster")), "key")
    )
    tiles = members.groupBy("cluster").agg(F.ceil(F.sum(F.col("n") + BANDS) / TILE_SHINGLES).cast("int").alias("tiles"))
    placed = (
        members.join(tiles, "cluster").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("cluster", F.least("tile", "other").alias("t"), F.greatest("tile", "other").alias("u"), "tile", "key", "component")
    )
    more = written(
        placed.join(sets, "key").join(classes.select("key", "bands"), "key").groupBy("cluster", "t", "u").applyInArrow(
            lambda table: _cluster_links(table, similarity), "a binary, b binary"
        ),
        "minmax-links",
    )
    if not more.isEmpty():
        labels = connected_components(links.unionByName(more))

    rooted = classes.select("key", "doc_id").join(labels.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "doc_id", F.coalesce("component", "key").alias("component")
    )
    smallest = rooted.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named_classes = rooted.join(smallest, "component").select("key", "component", "component_id")
    return features.select("row", "doc_id", "mark", "n_shingles", "key").join(named_classes, "key", "left").drop("key")


def one_of_each(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` with all their columns, one row per component: the one with the
    smallest doc_id (a null one comes last; of several rows under that doc_id the one of the
    smallest text hash, then the first). Rows without words link with nothing and all stay."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    # Rows are known by a written number: ids can be null or repeated.
    rows = written(plain.withColumn("row", F.monotonically_increasing_id()), "minmax-rows")
    doc_id, text = (F.col(f"c{names.index(n)}").alias(n) for n in ("doc_id", "text"))
    # Features, buckets, sets and links are larger than the rows: they go once the components are written.
    with scratch():
        found = written(_grouped(rows.select("row", doc_id, text), **params).drop("component_id"), "minmax-found", keep=True)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark", "row")
    first = found.filter("component is not null").groupBy("component").agg(F.min(order).alias("first"))
    keep = first.select("first.row").unionByName(found.filter("component is null").select("row"))
    return rows.join(keep, "row", "left_semi").select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
