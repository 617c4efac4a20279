"""Language identification with language-bitmask n-gram filters.

Learning counts byte 4-grams of the letters of every labelled text by language, in one
pass with task-side merging. A language contains an n-gram if its relative frequency there
is at least ``SHARE`` of the n-gram's largest one, and at least ``FLOOR``: a language then holds
1 / ``FLOOR`` n-grams at most, so chance n-grams do not fill the filter as the corpus grows. Each contained n-gram sets its
languages' bits at ``HASHES`` slots of a Bloom filter of language masks, so one
look-up per hash answers for all languages at once: the AND of the masks names every
language that contains the n-gram (and, rarely, one that does not).

A text's hits per language are the popcounts of its n-grams' masks. Language ``l`` gets a
false hit with probability f = fill_l^HASHES, so its corrected share is
(hits / n-grams - f) / (1 - f); the largest share decides, ties go to the smaller name.
The filter has ``SLOTS`` masks of 64 languages a word, fewer where more languages would take it over
``FILTER_BYTES``, so it is broadcast whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.llm.store import scratch, written
from lastmile.llm.textops import LETTERS, Grams, Tally, chunks, mix, text_once, utf8, with_fields

GRAM = 4
SHARE = 0.2
FLOOR = 2e-6
SLOTS = 1 << 22
FILTER_BYTES = 64 << 20
HASHES = 3
MAX_LANGUAGES = 4096
UNDETERMINED = "und"

_ANY_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTERS = bytes(b for b in range(256) if 65 <= b <= 90 or 97 <= b <= 122)


def has_letter(text: bytes) -> bool:
    """True if the UTF-8 text has a character of Unicode category L."""
    if len(text.translate(None, _ASCII_LETTERS)) < len(text):
        return True
    return not text.isascii() and _ANY_LETTER.search(text.decode("utf-8", "replace")) is not None


def _grams(docs: list[bytes]) -> tuple[Grams, np.ndarray]:
    """Codes, and which of them count: no space but at the ends of an n-gram."""
    g = Grams(docs, GRAM, LETTERS, tail=b" ")
    use = g.inside.copy()
    for back in range(1, GRAM - 1):
        use &= g.byte(back) != 32
    return g, use


def filter_shape(languages: int) -> tuple[int, int]:
    """Words of a mask, and number of slots (a power of two)."""
    words, size = max(1, -(-languages // 64)), SLOTS
    while words * size * 8 > FILTER_BYTES:
        size //= 2
    return words, size


def slots(codes: np.ndarray, size: int) -> np.ndarray:
    """(HASHES, n) slot numbers of the n-grams."""
    h = mix(codes)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((h + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64) for i in range(HASHES)])


@dataclass
class LanguageFilter:
    languages: list[str]
    masks: np.ndarray       # (words, slots)
    false_hit: np.ndarray   # per language
    default: str            # the language with most learned text, for texts without a hit

    def parts(self) -> tuple:
        return self.languages, self.masks, self.false_hit, self.default

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and number of n-grams of each text."""
        names, score, counted = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
        if not self.languages:
            return names, score, counted
        kind = np.dtype(np.uint8 if len(self.languages) <= 8 else np.uint64)
        for first, docs in chunks(texts):
            g, use = _grams(docs)
            total = g.sums(use)
            counted[first : first + len(docs)] = total
            at = slots(g.codes[use], self.masks.shape[1])
            found, hits = np.zeros(len(g.codes), dtype=kind), []
            for w, masks in enumerate(self.masks):
                hit = np.full(at.shape[1], np.iinfo(kind).max, dtype=kind)
                for s in at:
                    hit &= masks[s]
                found[use] = hit
                hits += [g.sums((found >> kind.type(l)) & kind.type(1)) for l in range(min(64, len(self.languages) - 64 * w))]
            hits = np.stack(hits, 1)
            share = hits / np.maximum(total, 1)[:, None]
            share = np.clip((share - self.false_hit) / np.maximum(1 - self.false_hit, 1e-9), 0, 1)
            best = share.argmax(axis=1)
            for d, doc in enumerate(docs):
                if has_letter(doc):
                    score[first + d] = s = share[d, best[d]]
                    names[first + d] = self.languages[best[d]] if s > 0 else self.default
        return names, score, counted


def _count(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    number = {l: i for i, l in enumerate(languages)}
    tally, width = Tally(), np.uint64(MAX_LANGUAGES)
    for batch in batches:
        lang = np.array([number[l] for l in batch.column(1).to_pylist()], dtype=np.uint64)
        for first, docs in chunks(utf8(batch.column(0))):
            g, use = _grams(docs)
            of = np.repeat(lang[first : first + len(docs)], g.lengths + GRAM - 1)[: len(g.codes)]
            tally.add(g.codes[use] * width + of[use])
    keys, counts = tally.items()
    for i in range(0, len(keys), 100_000):
        k = keys[i : i + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array((k // width).astype(np.int64)), pa.array((k % width).astype(np.int32)), pa.array(counts[i : i + 100_000])],
            names=["code", "lang", "n"],
        )


def _set_bits(batches: Iterator[pa.RecordBatch], words: int, size: int) -> Iterator[pa.RecordBatch]:
    """(slot, word, mask) from (code, languages that contain it), merged within a batch."""
    for batch in batches:
        held = batch.column(1)
        lang = held.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(lang):
            continue
        codes = np.repeat(batch.column(0).to_numpy().astype(np.uint64), held.value_lengths().to_numpy())
        at = (slots(codes, size) * words + lang // 64).ravel()
        bit = np.tile(np.uint64(1) << (lang % 64).astype(np.uint64), HASHES)
        order = np.argsort(at)
        at, first = np.unique(at[order], return_index=True)
        mask = np.bitwise_or.reduceat(bit[order], first).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at // words), pa.array((at % words).astype(np.int32)), pa.array(mask)], names=["slot", "word", "mask"]
        )


def learn(docs: DataFrame, chosen: Column) -> LanguageFilter:
    """Learn from the rows of ``docs`` (text, lang) with ``chosen`` true, non-null lang and text.

    Of more than ``MAX_LANGUAGES`` values of lang, those with most rows are learnt (ties: the smaller).
    """
    train = docs.filter(chosen & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    kinds = train.groupBy("lang").count()
    top = kinds.orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    texts_of = {r[0]: r[1] for r in top[:MAX_LANGUAGES]}
    if len(top) > MAX_LANGUAGES:
        train = train.filter(F.col("lang").isin(list(texts_of)))
    languages = sorted(texts_of)
    words, size = filter_shape(len(languages))
    if not languages:
        return LanguageFilter([], np.zeros((words, size), dtype=np.uint8), np.zeros(0), UNDETERMINED)
    counts = written(
        train.mapInArrow(lambda it: _count(it, languages), "code bigint, lang int, n bigint")
        .groupBy("code", "lang").agg(F.sum("n").alias("n")),
        "langid-counts",
    )
    total = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("n")).collect()}  # a row per language
    totals = F.split(F.lit(",".join(str(total.get(i, 1)) for i in range(len(languages)))), ",").cast("array<double>")
    rated = counts.select("code", "lang", (F.col("n") / F.get(totals, F.col("lang"))).alias("rate"))
    by_code = rated.filter(F.col("rate") >= FLOOR).groupBy("code").agg(
        F.collect_list(F.struct("lang", "rate")).alias("of"), F.max("rate").alias("top")  # an entry per language
    )
    held = F.filter("of", lambda o: o["rate"] >= SHARE * F.col("top"))
    bits = (
        by_code.select("code", F.transform(held, lambda o: o["lang"]).alias("langs"))
        .mapInArrow(lambda it: _set_bits(it, words, size), "slot bigint, word int, mask bigint")
        .groupBy("slot", "word")
        .agg(F.bit_or("mask").alias("mask"))
    )
    rows = bits.toArrow()  # at most FILTER_BYTES of masks
    masks = np.zeros((words, size), dtype=np.uint64)
    masks[rows.column("word").to_numpy(), rows.column("slot").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    fill = np.array([((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
    default = max(languages, key=lambda l: (texts_of[l], l))
    if len(languages) <= 8:
        masks = masks.astype(np.uint8)
    return LanguageFilter(languages, masks, fill**HASHES, default)


def identify(docs: DataFrame, chosen: Column, passed: tuple[str, ...] = ()) -> DataFrame:
    """(passed columns, lang_pred, score, n_grams) for every row of ``docs`` (text, lang).

    ``n_grams`` is how many n-grams were asked for: a text of one-letter words has letters but no
    n-gram that counts, so its language is a guess. ``passed`` may hold ``text``. A passed column
    named like a result is an error.

    ``chosen`` marks the rows to learn from. Null, empty or letterless text: ``und``, score 0.
    A text with letters of which no n-gram is known: the language with most learned rows,
    score 0. Nothing to learn from: ``und``, score 0. Repeated rows stay repeated; columns
    other than text, lang and ``passed`` are not read.
    """
    with scratch():  # the counts go once the filter is here
        model = docs.sparkSession.sparkContext.broadcast(learn(docs, chosen).parts())
    names = [*passed, "lang_pred", "score", "n_grams"]
    src, text_at = text_once(docs, passed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, counted = LanguageFilter(*model.value).predict(utf8(batch.column(text_at)))
            own = [batch.column(i) for i in range(len(passed))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(lang, type=pa.string()), pa.array(score), pa.array(counted)], names=names)

    return src.mapInArrow(run, with_fields(src, passed, "lang_pred string, score double, n_grams bigint"))
