"""Ranked lexical search: no-random-access reads of impact-sorted postings.

The best ``k`` documents of every item by an integer score: a document's score for an item is
the sum, over the item's terms with repeats, of the term's impact in the document,
``weight * ((1000000000 * tf) div (1000 * tf + 8 * m))``, with ``weight`` and ``m`` from counts
over all documents (see ``weights`` and ``_lengths``). Impacts are never negative.

1. ``index``: each whole text is read once; a document keeps its length and, of the terms that
   the items ask for, how often each occurs. Written once.
2. Counts over the index: documents with a term, all their terms, documents of each term.
3. Shards of the index, at most ``SHARD_DOCS`` documents or ``SHARD_POSTINGS`` postings, whatever
   documents lie next to each other: a shard sorts the postings of each term by impact and answers
   every item by ``resolve``: all lists are read from the top, a stretch at a time, with a lower
   and an upper bound of every document's score, until the shard's best ``k`` are certain, ties
   and scores included. A document of the overall best ``k`` is among the best ``k`` of its shard.
4. The shards' answers are ranked per item (at most ``k`` rows a shard and item come together).

Items are taken in blocks of about ``BLOCK_BYTES`` of text, so what a task holds of them is
bounded however many there are. Terms are known by 64-bit hashes.

Null or empty text holds no term: such a document is never found and such an item finds nothing.
Documents that share an id or a text are ranked on their own, equal scores by ascending id with a
null id last. Repeated items (same id and text) count once; different texts under one item id are
searched and ranked apart. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from lastmile.llm.store import written
from lastmile.llm.textops import NO_TERM, Words, chunks, utf8

SHARD_DOCS = 16_384
SHARD_POSTINGS = 4 << 20
SHARD_CELLS = 64 << 20
BLOCK_BYTES = 4 << 20
FIRST_READ = 64  # postings of each list in the first stretch; each stretch is four times longer


def _terms(texts: list[bytes]) -> Words:
    return Words(texts, space=NO_TERM)


def index(docs: DataFrame, asked: np.ndarray) -> DataFrame:
    """(doc_id, n, slots, tfs): length in terms, and of the ``asked`` term hashes (sorted, distinct)
    those that occur, by their place in ``asked``, with their number of occurrences."""
    schema = T.StructType(
        [docs.schema["doc_id"], *T.StructType.fromDDL("n bigint, slots array<int>, tfs array<bigint>").fields]
    )
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in chunks(utf8(batch.column("text"))):
                words = _terms(held)
                hashes = words.hashes
                at = np.searchsorted(asked, hashes)
                hit = at < len(asked)
                hit[hit] = asked[at[hit]] == hashes[hit]
                doc = np.repeat(np.arange(len(held)), np.diff(words.offsets))
                pair, tf = np.unique(doc[hit] * max(len(asked), 1) + at[hit], return_counts=True)
                doc, slot = np.divmod(pair, max(len(asked), 1))
                ends = np.searchsorted(doc, np.arange(len(held) + 1)).astype(np.int32)
                columns = [
                    batch.column("doc_id").slice(first, len(held)),
                    pa.array(np.diff(words.offsets).astype(np.int64)),
                    pa.ListArray.from_arrays(ends, pa.array(slot.astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(read, schema)


def weights(found: np.ndarray, documents: int) -> np.ndarray:
    """Weight of each term that ``found`` documents hold, of ``documents`` with any term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in found], dtype=np.int64)


def _lengths(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """The length measure m of documents of ``n`` terms, in whole numbers of any size."""
    return np.array([25 + (75 * int(x) * documents) // terms for x in n], dtype=np.int64)


def resolve(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` of documents 0 .. ``size - 1`` with a score above 0: (documents, scores).

    ``lists``: per term, documents and their impacts, largest impact first. Equal scores rank by
    ``tie``, which differs for all documents. Every list is read in order; what a list may
    still add to a document that it has not shown is at most the impact at its head.
    """
    lower = np.zeros(size, dtype=np.int64)
    shown = np.zeros((len(lists), size), dtype=bool)
    heads = np.array([impacts[0] if len(impacts) else 0 for _, impacts in lists], dtype=np.int64)
    read, stretch = 0, FIRST_READ
    while True:
        for i, (docs, impacts) in enumerate(lists):
            part = docs[read : read + stretch]
            lower[part] += impacts[read : read + stretch]
            shown[i, part] = True
            heads[i] = impacts[read + stretch] if read + stretch < len(impacts) else 0
        read, stretch = read + stretch, stretch * 4
        kth = np.partition(lower, size - k)[size - k] if size > k else 0
        # Only these can still be among the best k, or are and may still grow.
        near = np.flatnonzero((lower + heads.sum() >= kth) & (lower + heads.sum() > 0))
        live = np.flatnonzero(heads)
        more = heads[live] @ ~shown[np.ix_(live, near)] if len(live) else np.zeros(len(near), dtype=np.int64)
        near, more = near[lower[near] + more >= kth], more[lower[near] + more >= kth]
        if not more.any():
            best = near[lower[near] > 0]
            best = best[np.lexsort((tie[best], -lower[best]))][:k]
            return best, lower[best]


def _answers(frame: DataFrame, questions: list[tuple[np.ndarray, np.ndarray]], ids: list, id_type: T.DataType,
             weight: np.ndarray, documents: int, terms: int, k: int) -> DataFrame:
    """Per shard and item, the shard's best documents: (item, item_id, doc_id, score)."""
    doc_field = frame.schema["doc_id"]
    schema = T.StructType(
        [
            T.StructField("item", T.IntegerType()),
            T.StructField("item_id", id_type),
            T.StructField("doc_id", doc_field.dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    item_ids = pa.array(ids, type=to_arrow_type(id_type))
    # The bounds of an item take a place per document and term: items of many terms get smaller shards.
    most = max(64, min(SHARD_DOCS, SHARD_CELLS // max(1, *(len(asked) for asked, _ in questions))))

    def answer(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        shard = pa.Table.from_batches(held).combine_chunks()
        n = shard.column("n").to_numpy()
        slots = shard.column("slots").combine_chunks()
        tf = shard.column("tfs").combine_chunks().flatten().to_numpy()
        doc = np.repeat(np.arange(len(n)), np.diff(slots.offsets.to_numpy()))
        slot = slots.flatten().to_numpy()
        length = _lengths(n, documents, terms)
        impact = weight[slot] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length[doc]))
        order = np.lexsort((-impact, slot))
        order = order[impact[order] > 0]
        doc, slot, impact = doc[order], slot[order], impact[order]
        starts = np.searchsorted(slot, np.arange(len(weight) + 1))
        by_id = np.lexsort((np.arange(len(n)), _rank(shard.column("doc_id"))))
        tie = np.empty(len(n), dtype=np.int64)
        tie[by_id] = np.arange(len(n))
        items, docs, scores = [], [], []
        for item, (asked, repeats) in enumerate(questions):
            lists = [
                (doc[starts[s] : starts[s + 1]], impact[starts[s] : starts[s + 1]] * r)
                for s, r in zip(asked, repeats)
                if starts[s] < starts[s + 1]
            ]
            if lists:
                best, score = resolve(lists, len(n), k, tie)
                items.append(np.full(len(best), item, dtype=np.int32))
                docs.append(best)
                scores.append(score)
        none = [np.zeros(0, dtype=np.int64)]
        item = pa.array(np.concatenate(items or none).astype(np.int32))
        columns = [
            item,
            item_ids.take(item),
            shard.column("doc_id").combine_chunks().take(pa.array(np.concatenate(docs or none))),
            pa.array(np.concatenate(scores or none)),
        ]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, postings = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, most // 4):
                part = batch.slice(at, most // 4)
                held.append(part)
                rows += part.num_rows
                postings += len(part.column("slots").flatten())
                if rows >= most or postings >= SHARD_POSTINGS:
                    yield answer(held)
                    held, rows, postings = [], 0, 0
        if rows:
            yield answer(held)

    return frame.mapInArrow(run, schema)


def _rank(ids: pa.ChunkedArray) -> np.ndarray:
    """Places of the ids in ascending order, a null last; equal ids share a place."""
    import pyarrow.compute as pc

    return pc.rank(ids.combine_chunks(), "ascending", null_placement="at_end", tiebreaker="min").to_numpy()


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text) of each item
    (item_id, text), all with a score above 0 if fewer, rank 1 the best."""
    spark = docs.sparkSession
    wanted = items.select("item_id", "text").distinct()
    id_type = items.schema["item_id"].dataType
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    answers = []
    for b in range(blocks):
        block = wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).filter(F.length("text") > 0)
        rows = block.orderBy("item_id", "text").collect()
        if not rows:
            continue
        words = _terms([r.text.encode() for r in rows])
        asked, place = np.unique(words.hashes, return_inverse=True)
        cuts = words.offsets[1:-1]
        questions = [np.unique(p, return_counts=True) for p in np.split(place, cuts)]
        frame = written(index(docs, asked), "nra-index")
        totals = frame.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
        found = np.zeros(len(asked), dtype=np.int64)
        for r in frame.select(F.explode("slots").alias("slot")).groupBy("slot").count().collect():
            found[r.slot] = r["count"]
        weight = weights(found, totals.documents)
        answers.append(
            _answers(frame, questions, [r.item_id for r in rows], id_type, weight, totals.documents, totals.terms or 1, k)
            .withColumn("block", F.lit(b))
        )
    if not answers:
        schema = T.StructType([T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType()),
                               T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.LongType())])
        return spark.createDataFrame([], schema)
    best = Window.partitionBy("block", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, answers).withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
