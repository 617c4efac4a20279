"""Removal of repeated passages by seed and extend.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``WINDOW`` consecutive words of one
document; it is a repeat if its words also start a window of a document with a smaller id. The
words that repeats cover go, so the passage stays only in the first document that has it.

1. Seeds. Of every window's ``GRAM``-word sequences the one of the smallest hash is its anchor
   (winnowing), the same wherever the window stands. Anchors of several documents are the seeds:
   counted with partial sums, then joined back to the documents that hold them.
2. Extension, both ways from a seed: the windows that share an anchor's place are one run, and
   runs of the same words form a class, kept by its first document; every further document of a
   class repeats the whole run. Runs that differ are compared window by window, one row per
   class however many documents hold it: a window whose first holder comes before the class's own
   first document is a repeat in all of them.
3. Maximal repeats: overlapping and adjoining repeats of a document join into its longest spans.

Nothing is done in pairs of documents, and no anchor, class or window is gathered in one task:
all are aggregated with partial minima and joined, where Spark splits hot keys. Runs and windows
are told apart by 64-bit hashes beside the 64-bit hash of their anchor.

A document without words has none to lose. Documents with a null id keep every word, and take none
from others. Documents that share an id take nothing from each other; repeated rows get the same
result each. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lastmile.llm.store import written
from lastmile.llm.textops import _BASE, Words, _power, chunks, mix, utf8, word_windows

WINDOW = 13
GRAM = 4


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of a chunk: their first words, documents and anchors' hashes.

    The anchor is the leftmost of the smallest hashes among the window's sequences of ``GRAM`` words.
    """
    grams = word_windows(words.hashes, GRAM)
    span = window - GRAM + 1
    count = max(len(words.hashes) - window + 1, 0)
    best = grams[:count].copy()
    for j in range(1, span):
        np.minimum(best, grams[j : j + count], out=best)
    doc = np.repeat(np.arange(len(words.offsets) - 1), np.diff(words.offsets))
    inside = np.flatnonzero(doc[:count] == doc[window - 1 :][:count])
    return inside, doc[inside], best[inside]


def _distinct(doc: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different anchors of each document, documents in order."""
    change = np.concatenate(([True], (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]))) if len(doc) else np.zeros(0, bool)
    doc, anchor = doc[change], anchor[change]
    order = np.lexsort((anchor, doc))
    doc, anchor = doc[order], anchor[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]))) if len(doc) else np.zeros(0, bool)
    return doc[new], anchor[new]


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _seeds(docs: DataFrame, window: int) -> DataFrame:
    """Every document's different anchors: (k, anchor)."""
    schema = T.StructType.fromDDL("k bigint, anchor bigint")
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in chunks(utf8(batch.column("text"))):
                words = Words(held, lower=False)
                _, doc, anchor = _anchors(words, window)
                doc, anchor = _distinct(doc, anchor)
                yield pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(doc + first)), _signed(anchor)], schema=arrow)

    return docs.select("k", "text").mapInArrow(read, schema)


def _runs(words: Words, window: int, seed_doc: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """The runs of windows of a chunk's documents whose anchor is among the document's seeds: their
    documents, and anchor, hash of the run, first word and windows."""
    place, doc, anchor = _anchors(words, window)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(doc)))
    # Documents and anchors meet by a hash of both; one hit too many would only be compared in vain.
    hit = np.isin(mix(anchor[head] ^ mix(doc[head].astype(np.uint64))), mix(seed ^ mix(seed_doc.astype(np.uint64))))
    head, within, length = head[hit], np.repeat(hit, length), length[hit]
    windows = word_windows(words.hashes, window)[place[within]]
    cuts = np.concatenate(([0], np.cumsum(length)))
    if len(head):
        # A run's hash: a polynomial over its windows in order.
        nth = np.arange(len(windows)) - np.repeat(cuts[:-1], length)
        code = np.add.reduceat(windows * _power(_BASE, int(length.max()))[nth], cuts[:-1]) + length.astype(np.uint64)
    else:
        code = windows
    return doc[head], [
        _signed(anchor[head]),
        _signed(mix(code)),
        pa.array((place[head] - words.offsets[doc[head]]).astype(np.int32)),
        pa.ListArray.from_arrays(cuts.astype(np.int32), _signed(windows)),
    ]


def _read_runs(docs: DataFrame, window: int) -> DataFrame:
    """Documents with their seeds (doc_id, k, text, seeds) to runs (doc_id, k, anchor, words, start, windows)."""
    schema = T.StructType(
        [docs.schema["doc_id"], *T.StructType.fromDDL("k bigint, anchor bigint, words bigint, start int, windows array<bigint>").fields]
    )
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in chunks(utf8(batch.column("text"))):
                words = Words(held, lower=False)
                seeds = batch.column("seeds").slice(first, len(held))
                seed = seeds.flatten().to_numpy().view(np.uint64)
                seed_doc = np.repeat(np.arange(len(held)), pc.list_value_length(seeds).to_numpy())
                doc, columns = _runs(words, window, seed_doc, seed)
                at = pa.array(doc + first)
                columns = [batch.column("doc_id").take(at), batch.column("k").take(at), *columns]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return docs.select("doc_id", "k", "text", "seeds").mapInArrow(read, schema)


def _kept(text: bytes, words: Words, d: int, gone: np.ndarray) -> bytes:
    """The words of document ``d`` of a chunk that are not ``gone``, joined by one space."""
    own = slice(words.offsets[d], words.offsets[d + 1])
    starts = (words.starts[own] - words.doc_starts[d])[~gone]
    ends = (words.ends[own] - words.doc_starts[d])[~gone]
    return b" ".join(text[a:b] for a, b in zip(starts.tolist(), ends.tolist()))


def spans(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal repeats (first word, number of words) of the windows that start at ``starts``."""
    if not len(starts):
        return []
    starts = np.unique(starts)
    new = np.flatnonzero(np.concatenate(([True], np.diff(starts) > window)))
    last = np.concatenate((new[1:], [len(starts)])) - 1
    return [(int(starts[a]), int(starts[b] - starts[a]) + window) for a, b in zip(new, last)]


def _repeats(runs: DataFrame) -> DataFrame:
    """(k, starts): where the repeated windows of each document start."""
    classes = written(
        runs.groupBy("anchor", "words").agg(F.min("doc_id").alias("first"), F.any_value("windows").alias("windows")),
        "repeat-classes",
    )
    # Only a seed with several classes can have a window in two of them.
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1").select("anchor")
    windows = classes.join(several, "anchor", "left_semi").select(
        "anchor", "words", "first", F.posexplode("windows").alias("at", "window")
    )
    holders = windows.groupBy("anchor", "window").agg(F.min("first").alias("holder"))
    shared = (
        windows.join(holders, ["anchor", "window"]).filter(F.col("holder") < F.col("first"))
        .groupBy("anchor", "words").agg(F.collect_set("at").alias("places"))
    )
    verdicts = written(
        classes.select("anchor", "words", "first").join(shared, ["anchor", "words"], "left"), "repeat-verdicts"
    )
    # A later document repeats the whole run; the first one what earlier classes hold.
    found = runs.select("doc_id", "k", "anchor", "words", "start", F.size("windows").alias("length")).join(
        verdicts, ["anchor", "words"]
    )
    places = F.when(F.col("doc_id") > F.col("first"), F.sequence(F.lit(0), F.col("length") - 1)).otherwise(F.col("places"))
    return (
        found.select("k", F.transform(places, lambda p: p + F.col("start")).alias("starts"))
        .filter(F.size("starts") > 0)
        .groupBy("k")
        .agg(F.array_distinct(F.flatten(F.collect_set("starts"))).alias("starts"))
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Per document (doc_id, text): doc_id, n_words, n_removed, kept_sha256, removed.

    ``removed`` lists the maximal repeats as (start, length) in words; ``with_text`` adds
    ``kept_text``, the words left, joined by one space.
    """
    if window <= GRAM:
        raise ValueError(f"windows need more than {GRAM} words")
    # k stands for the document: rows that share it have the same id and text, and one result.
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"))
    named = docs.filter(F.col("doc_id").isNotNull())
    anchors = _seeds(named, window)
    several = anchors.groupBy("anchor").count().filter("count > 1").select("anchor")
    seeds = written(
        anchors.join(several, "anchor").groupBy("k").agg(F.collect_set("anchor").alias("seeds")), "repeat-seeds"
    )
    runs = written(_read_runs(named.join(seeds, "k"), window), "repeat-runs")
    starts = written(_repeats(runs), "repeat-starts")
    schema = T.StructType(
        [docs.schema["doc_id"]]
        + T.StructType.fromDDL(
            "n_words bigint, n_removed bigint, kept_sha256 string, removed array<struct<start: int, length: int>>, kept_text string"
        ).fields
    )
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in chunks(utf8(batch.column("text"))):
                words = None
                rows = []
                for d, at in enumerate(batch.column("starts").slice(first, len(held)).to_pylist()):
                    if at:
                        words = words or Words(held, lower=False)
                        found = spans(np.array(at, dtype=np.int64), window)
                        gone = np.zeros(words.offsets[d + 1] - words.offsets[d], dtype=bool)
                        for start, length in found:
                            gone[start : start + length] = True
                        kept, size = _kept(held[d], words, d, gone), len(gone)
                    else:
                        own = held[d].split()  # at the six bytes that part words
                        found, kept, size = [], b" ".join(own), len(own)
                    spared = [{"start": s, "length": n} for s, n in found]
                    rows.append((size, sum(n for _, n in found), hashlib.sha256(kept).hexdigest(), spared, kept.decode() if with_text else None))
                columns = [batch.column("doc_id").slice(first, len(held))]
                columns += [pa.array(c, f.type) for c, f in zip(zip(*rows), list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    # A null id stands for no other document, whatever its k.
    joined = docs.join(starts, (docs["k"] == starts["k"]) & docs["doc_id"].isNotNull(), "left")
    out = joined.select("doc_id", "text", "starts").mapInArrow(cut, schema)
    return out if with_text else out.drop("kept_text")
