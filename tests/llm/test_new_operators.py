"""Substring removal, Merkle manifest and ranked search against brute force on odd input."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.llm import merkle, nra, substring

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


# -- 11: substring removal -------------------------------------------------------------
def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _brute_removed(rows, n=13):
    first = {}
    for doc_id, text in rows:
        w = _words(text)
        for i in range(len(w) - n + 1):
            if doc_id is not None:
                key = tuple(w[i : i + n])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = _words(text)
        gone = set()
        for i in range(len(w) - n + 1):
            if doc_id is not None and first[tuple(w[i : i + n])] < doc_id:
                gone.update(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def _check_removed(df):
    got = substring.without_repeats(df).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert _rows(got) == _brute_removed([(r.doc_id, r.text) for r in df.collect()])


def test_removal_odd_input(odd_docs):
    _check_removed(odd_docs)


def test_removal_planted(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(4000)] + ["Été", "x\x00y", "K"]
    passages = [list(rng.choice(vocabulary, n)) for n in (12, 13, 14, 25, 60, 200)]
    rows = []
    for i in range(300):
        w = list(rng.choice(vocabulary, rng.integers(0, 120)))
        for _ in range(rng.integers(0, 4)):
            p = passages[rng.integers(len(passages))]
            a = int(rng.integers(0, max(1, len(p) - 12)))
            at = int(rng.integers(0, len(w) + 1))
            w[at:at] = p[a : a + int(rng.integers(11, len(p) + 1))]
        rows.append((None if i % 50 == 49 else i // 2 if i % 7 == 0 else i, " ".join(w)))
    rows += [(1000 + i, "tick " * (5 + 7 * i) + "tock " * 20) for i in range(6)]  # windows that repeat within a run
    rows += [(500, rows[10][1])] * 40  # a hot id of one text
    _check_removed(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))


def test_removal_interface(spark, no_docs):
    p = " ".join(f"p{i}" for i in range(20))
    df = spark.createDataFrame([(1, f"a {p} b"), (2, f"c d {p}  e f"), (3, "c\n\nd")], "doc_id bigint, text string")
    out = {r.doc_id: r for r in substring.without_repeats(df, with_text=True).collect()}
    assert [tuple(s) for s in out[2].removed] == [(2, 20)] and out[2].kept_text == "c d e f"
    assert out[1].removed == [] and out[1].kept_text == f"a {p} b" and out[3].kept_text == "c d"
    assert substring.without_repeats(no_docs).count() == 0
    with pytest.raises(ValueError):
        substring.without_repeats(df, window=substring.GRAM)


def test_spans():
    assert substring.spans(np.array([5, 0, 1, 30, 13]), 13) == [(0, 26), (30, 13)]
    assert substring.spans(np.zeros(0, dtype=np.int64), 13) == []


# -- 12: Merkle manifest -----------------------------------------------------------------
def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, lower=False):
    values = [row.doc_id, row.source, row.lang, row.n_chars, row.text and row.text.translate(ASCII_LOWER) if lower else row.text]
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [_h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        out.append(nodes)
    return out


def _way(levels, i):
    for level in levels[:-1]:
        first = i - i % 16
        yield level[first : first + 16], i - first
        i //= 16


def _brute_manifest(rows):
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        mine = sorted((r for r in rows if r.source == s), key=lambda r: (r.doc_id is not None, r.doc_id or 0, _leaf(r)))
        trees[s] = mine, _levels([_leaf(r) for r in mine])
    top = _levels([trees[s][1][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        mine, levels = trees[s]
        for i, r in enumerate(mine):
            way = [*_way(levels, i), *_way(top, k)]
            proof = "".join("".join(run[:j] + run[j + 1 :]) for run, j in way)
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            folded = _leaf(r, lower=hit)
            for run, j in way:
                folded = _h(*run[:j], folded, *run[j + 1 :])
            out.append((r.doc_id, _leaf(r), levels[-1][0], top[-1][0], _h(proof), folded, folded == top[-1][0]))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_manifest_odd_input(odd_docs, no_docs):
    assert _rows(merkle.manifest(odd_docs)) == _brute_manifest(odd_docs.collect())
    assert merkle.manifest(no_docs).count() == 0


def test_manifest_hot_source_and_many_sources(spark):
    """A source over several blocks, one of exactly a block, lone leaves, and over 256 sources."""
    source = (
        F.when(F.col("id") < 4500, "hot").when(F.col("id") < 4500 + 4096, "block")
        .when(F.col("id") < 9200, F.concat(F.lit("S"), F.col("id").cast("string")))
    )
    df = spark.range(0, 9300, numPartitions=7).select(
        (F.col("id") * 7919 % 9311).alias("doc_id"), F.concat(F.lit("Text "), F.col("id").cast("string")).alias("text"),
        F.lit("en").alias("lang"), source.alias("source"), F.col("id").alias("n_chars"),
    )
    df = df.withColumn("doc_id", F.when(F.col("n_chars") % 10 < 4, 77).otherwise(F.col("doc_id")))  # a hot id
    got, want = _rows(merkle.manifest(df)), _brute_manifest(df.collect())
    assert got == want
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 256, 257, 300, 4096, 4097, 5000])
def test_positions_are_completion_order(n):
    order, done = [], {}

    def put(level, i):
        order.append((level, i))
        done[level] = i + 1
        count = -(-n // 16**level)
        if count > 1 and ((i + 1) % 16 == 0 or i + 1 == count):
            put(level + 1, i // 16)

    for i in range(n):
        put(0, i)
    assert [merkle.position(level, i, n) for level, i in order] == list(range(len(order)))


def test_log_is_the_postorder(spark):
    nodes = [(0, 300, i, f"{i:064x}") for i in range(300)] + [(1, 1, 0, "0" * 64)]
    out = merkle.log(spark.createDataFrame(nodes, "tree bigint, n bigint, i bigint, digest string")).orderBy("tree", "position").collect()
    assert [r.position for r in out if r.tree == 0] == list(range(300 + 19 + 2 + 1)) and out[-1].tree == 1
    levels = _levels([f"{i:064x}" for i in range(300)])
    assert all(r.digest == levels[r.level][r.i] for r in out if r.tree == 0)


# -- 13: ranked search -------------------------------------------------------------------
def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def _brute_search(docs, items, k=10):
    held = [Counter(_terms(t)) for _, t in docs]
    n = sum(bool(c) for c in held)
    total = sum(sum(c.values()) for c in held)
    df = Counter(t for c in held for t in c)
    out = []
    for item_id, text in dict.fromkeys(items):
        scored = []
        for (doc_id, _), c in zip(docs, held):
            m = 100 - 75 + (75 * sum(c.values()) * n) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in _terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


ITEMS = [
    (1, "one two"), (1, "one two"), (1, "été w3x1 w3x1 W3X1"), (2, None), (3, ""), (4, "%%% ..."),
    (5, "the Tail ENDOFTEXT 123 w31x5 w40x2"), (None, "one 456"), (6, "nowhere at all"),
]


def _check_search(spark, docs, items, k=10):
    got = nra.search(docs, spark.createDataFrame(items, "item_id bigint, text string"), k)
    assert _rows(got) == _brute_search([(r.doc_id, r.text) for r in docs.collect()], items, k)


def test_search_odd_input(spark, odd_docs, no_docs):
    _check_search(spark, odd_docs, ITEMS)
    _check_search(spark, odd_docs, ITEMS, k=1)
    _check_search(spark, odd_docs, [])
    _check_search(spark, no_docs, ITEMS)


def test_search_shards_and_blocks(spark, monkeypatch):
    """Many small shards and several blocks of items, with many equal scores."""
    monkeypatch.setattr(nra, "SHARD_DOCS", 64)
    monkeypatch.setattr(nra, "BLOCK_BYTES", 300)
    monkeypatch.setattr(nra, "FIRST_READ", 4)
    rng = np.random.default_rng(5)
    p = 1 / np.arange(1, 201)
    draw = lambda n: " ".join(f"t{x}" for x in rng.choice(200, n, p=p / p.sum()))
    rows = [(i if i % 9 else 33, draw(int(rng.integers(0, 40)))) for i in range(900)] + [(2000 + i, "t5 t6") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    _check_search(spark, docs, [(i, draw(int(rng.integers(1, 12)))) for i in range(40)] + [(50, "t5"), (51, "t6 t6 t5")])


def test_resolve_reads_no_further_than_needed():
    """With one outstanding document the tails of the lists stay unread."""
    docs = np.arange(50_000)
    impacts = np.concatenate(([10**6], np.arange(49_999, 0, -1)))
    read = []

    class Spy(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                read.append(key.stop)
            return super().__getitem__(key)

    best, score = nra.resolve([(docs.view(Spy), impacts), (docs, impacts)], 50_000, 1, docs)
    assert best.tolist() == [0] and score.tolist() == [2 * 10**6] and max(read) < 1000


def test_types_of_ids(spark):
    docs = spark.createDataFrame([("a", "red fox"), ("b", "red")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "red fox")], "item_id string, text string")
    out = nra.search(docs, items)
    assert [(r.item_id, r.rank, r.doc_id) for r in out.orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b")]
    assert out.schema["rank"].dataType == T.IntegerType()
