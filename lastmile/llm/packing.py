"""Packing token sequences by lexical retrieval.

Documents are encoded once and written with their row numbers. Document frequencies and lengths are
counted over all of them. Each document is led by its ``LEADS`` tokens of highest frequency times
inverse document frequency; documents are dealt by range and sorted by those, so documents that
are about the same tokens lie side by side wherever they were read, and a common first
token is divided by the next ones. About ``SHARD_TOKENS`` tokens of that order are a shard with a BM25
inverted index (term frequencies of the shard, statistics of all documents). Packing goes window by
window: the unused document of the smallest place is the seed of a window of ``WINDOW`` tokens; the
index returns the unused documents by falling BM25 score for the seed's tokens (tokens in more than
half of all documents have no positive weight and no postings), and they fill the window
greedily, so related documents share it. The last one is cut where the window ends, and its rest
begins the next window and is that one's seed. When nothing scores, unused documents follow in
order. So every window of a shard is full but its last, which is split into powers of two, so no
sequence needs padding.

A seed still asks its own shard only, not every document (the README has the measured share of
true neighbours found). A shard is bounded by its token count (or one very long document). The
number of a sequence holds its partition.

Token ids are those of the tokenizer file, and 1 after each document. The parts of the order are cut
at quantiles, by tokens, of a sample of documents; equal texts, which no order parts, are dealt over the
parts that their cuts span.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm.store import written
from lastmile.llm.textops import _BASE, mix

_CHECK = 0xD6E8FEB86659FD93
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)  # the first n of eight bytes

WINDOW = 2048
END = 1
LEADS = 4
SHARD_TOKENS = 1 << 20
PARTITION_TOKENS = 8 << 20  # several shards a task
SAMPLED = 200  # documents sampled a partition to find where the order is cut
CHUNK = 1 << 20  # characters encoded at a time
LONG = 64  # words of more bytes are told apart by a digest
ENCODED_ROWS = 1024  # documents of a batch whose texts and ids are held at a time
KEPT = 0.8  # used documents leave the index when no more than this share of it is unused
SPARSE = 32  # the index is a table of words by documents if one cell in so many is filled
CELLS = 1 << 23  # and the table has no more cells than that
K1 = 1.2
B = 0.75


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Pieces:
    """Token ids of the words that a tokenizer encodes one by one, remembered by two 64-bit keys.

    A direct-mapped table of ``SLOTS`` entries: what is not there is encoded and put in its place.
    ``encode`` gives the ids of a list of words, one after another, and how many each has.
    """

    SLOTS = 1 << 21
    IDS = 1 << 25  # the table starts anew beyond so many remembered ids

    def __init__(self, encode, kind: np.dtype):
        self.encode = encode
        self.kind = np.dtype(kind)
        self.reset()

    def reset(self) -> None:
        self.keys = np.zeros((2, self.SLOTS), dtype=np.uint64)
        self.entry = np.zeros(self.SLOTS, dtype=np.int32)
        # Where the ids of each entry end, in bytes; the first one is the end of a document.
        self.ends, self.entries = np.zeros(1 << 16, dtype=np.int32), 1
        self.ids, self.used = np.full(1 << 16, END, dtype=self.kind), 1
        self.ends[1] = self.kind.itemsize

    def look_up(self, h: np.ndarray, check: np.ndarray, pieces) -> np.ndarray:
        """The entry of each piece; ``pieces(i)`` lists the texts of some. Good until the next call."""
        if self.used > self.IDS:
            self.reset()
        slot = (mix(h + check * np.uint64(_BASE)) & np.uint64(self.SLOTS - 1)).astype(np.intp)
        entry = self.entry[slot]
        missing = np.flatnonzero((self.keys[0, slot] != h) | (self.keys[1, slot] != check))
        if len(missing):
            # One entry for equal pieces; pieces that only share a slot all get theirs here.
            order = missing[np.lexsort((check[missing], h[missing]))]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (h[order[1:]] != h[order[:-1]]) | (check[order[1:]] != check[order[:-1]])
            first = order[new]
            ids, sizes = self.encode(pieces(first))
            numbers = self.entries + np.arange(len(first), dtype=np.int32)
            self.ids = _longer(self.ids, self.used + len(ids))
            self.ids[self.used : self.used + len(ids)] = ids
            self.ends = _longer(self.ends, self.entries + len(first) + 1)
            self.ends[numbers + 1] = (self.used + np.cumsum(sizes)) * self.kind.itemsize
            self.used, self.entries = self.used + len(ids), self.entries + len(first)
            self.keys[0, slot[first]], self.keys[1, slot[first]] = h[first], check[first]
            self.entry[slot[first]] = numbers
            entry[order] = numbers[np.cumsum(new) - 1]
        return entry

    def take(self, entry: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
        """The bytes of the ids of all these entries, and where those of each begin, and the end."""
        held = pa.Array.from_buffers(pa.binary(), self.entries, [None, pa.py_buffer(self.ends), pa.py_buffer(self.ids)])
        _, offsets, data = held.take(pa.array(entry)).buffers()
        return data, np.frombuffer(offsets, dtype=np.int32, count=len(entry) + 1)


def _longer(a: np.ndarray, size: int) -> np.ndarray:
    return a if size <= len(a) else np.concatenate((a, np.zeros(size, dtype=a.dtype)))


def _keys(raw: bytes, width: int, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each piece of ``raw``, from byte ``at`` to ``ends``; ``width`` is that of a character.

    Eight bytes at a time; up to 16 bytes they tell pieces of one length apart for certain.
    """
    eight = np.ndarray(len(raw) + 1, dtype="<u8", buffer=raw + bytes(8), strides=(1,)).copy()
    size = ends - at
    h = eight[at] & _MASK[np.minimum(size, 8)]
    check = (size * 2 + (width - 1)).astype(np.uint64)
    more = np.flatnonzero(size > 8)
    for done in range(8, LONG, 8):
        if not len(more):
            return h, check
        left = size[more] - done
        word = eight[at[more] + done] & _MASK[np.minimum(left, 8)]
        h[more] = mix(h[more] * np.uint64(_BASE) + word)
        check[more] = mix(check[more] * np.uint64(_CHECK) + word)
        more = more[left > 8]
    for i in more.tolist():
        digest = hashlib.blake2b(raw[at[i] : ends[i]], digest_size=16, salt=bytes([width])).digest()
        h[i], check[i] = np.frombuffer(digest, dtype="<u8")
    return h, check


# The fast path covers characters up to here (Latin, Greek, Cyrillic, Armenian); texts with others,
# with apostrophes (contractions) or special tokens' strings take the tokenizer's own way.
_PLAIN = 0x0590


def _character_kinds() -> np.ndarray:
    """0 white space, 1 letter, 2 number, 3 other, by code point."""
    import regex

    kinds = np.full(_PLAIN, 3, dtype=np.uint8)
    for kind, pattern in ((1, r"\p{L}"), (2, r"\p{N}"), (0, r"\p{White_Space}")):
        kinds[[i for i in range(_PLAIN) if regex.match(pattern, chr(i))]] = kind
    return kinds


class Encoder:
    """Token ids of texts as the tokenizer file gives them, without added special tokens.

    Strings of special tokens in a text are those tokens, as for the tokenizer. Where the same
    vocabulary lies beside the file as byte ranks, texts are cut into the words of its pattern by
    numpy, and every different word is encoded once: the same ids several times faster.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.kind = np.uint16 if tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        ranks = path.removesuffix(".json") + ".tiktoken"
        self.pieces = None
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.words = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            self.line_end = self.words.encode_ordinary("\n")[0]
            self.pieces = Pieces(self._encode_words, self.kind)
            self.kinds = _character_kinds()

    def _plain(self, text: str) -> tuple[int, bytes] | None:
        """Bytes a character, and the text in them, if it can be cut into words."""
        if not text or self.pieces is None or "'" in text or any(s in text for s in self.special):
            return None
        try:
            return 1, text.encode("latin-1")
        except UnicodeEncodeError:
            if np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).max() < _PLAIN:
                return 2, text.encode("utf-16-le")
        return None

    def encode(self, text: str) -> np.ndarray:
        """The ids with the end id."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with the end id."""
        return _documents(self.encode_column(texts), np.dtype(self.kind))

    def encode_column(self, texts: list[str]) -> pa.Array:
        """The ids of each text, with the end id, as bytes."""
        rows: list[int] = []
        parts: list[pa.Array] = []
        held: dict[int, list[tuple[int, bytes]]] = {1: [], 2: []}
        size = {1: 0, 2: 0}

        def flush(width: int) -> None:
            rows.extend(i for i, _ in held[width])
            parts.append(self._encode_plain([raw for _, raw in held[width]], width))
            held[width], size[width] = [], 0

        others: list[int] = []
        for i, text in enumerate(texts):
            plain = self._plain(text)
            if plain is None:
                others.append(i)
                continue
            width, raw = plain
            held[width].append((i, raw))
            size[width] += len(raw)
            if size[width] > CHUNK * width:
                flush(width)
        for width in held:
            if held[width]:
                flush(width)
        ids = [[*(self.whole(texts[i]) if texts[i] else ()), END] for i in others]
        rows.extend(others)
        parts.append(pa.array([np.array(x, dtype=self.kind).tobytes() for x in ids], type=pa.binary()))
        return pa.concat_arrays(parts).take(pa.array(np.argsort(np.array(rows, dtype=np.int64))))

    def _encode_plain(self, texts: list[bytes], width: int) -> pa.Array:
        raw = b"".join(texts)
        begins = np.cumsum([0, *map(len, texts[:-1])]) // width
        start = self._starts(np.frombuffer(raw, dtype=f"<u{width}"), begins)
        at = np.flatnonzero(start) * width
        ends = np.append(at[1:], len(raw))
        coding = "latin-1" if width == 1 else "utf-16-le"

        def pieces(some: np.ndarray) -> list[str]:
            return [raw[a:b].decode(coding) for a, b in zip(at[some].tolist(), ends[some].tolist())]

        entry = self.pieces.look_up(*_keys(raw, width, at, ends), pieces)
        # After the pieces of each text comes entry 0, its end.
        bounds = np.append(np.searchsorted(at, begins[1:] * width), len(at))
        data, offsets = self.pieces.take(np.insert(entry, bounds, 0))
        ends = offsets[np.concatenate(([0], bounds + np.arange(1, len(texts) + 1)))]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), data])

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has. Words go together, parted by line ends,
        which the tokenizer's pattern leaves alone between them; white space goes word by word."""
        blank = np.array([w.isspace() for w in words], dtype=bool)
        together = [w for w, b in zip(words, blank) if not b]
        ids = self.words.encode_to_numpy("\n".join(together))
        cut = np.flatnonzero(ids == self.line_end)
        if len(cut) != len(together) - 1:
            blank[:], ids, cut = True, ids[:0], cut[:0]
        sizes = np.zeros(len(words), dtype=np.int64)
        if not blank.all():
            sizes[~blank] = np.diff(np.concatenate(([-1], cut, [len(ids)]))) - 1
        alone = [self.words.encode_ordinary(words[i]) for i in np.flatnonzero(blank)]
        own = np.array([len(x) for x in alone], dtype=np.int64)
        at = np.repeat(np.cumsum(sizes)[blank], own)  # ids of words before it
        sizes[blank] = own
        return np.insert(np.delete(ids, cut), at, [i for x in alone for i in x]), sizes

    def _starts(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Where words begin, by the pattern: runs of letters, numbers or other signs with one
        space before them; white space before that is a word, and so is white space at the end."""
        kind = self.kinds[codes]
        space = kind == 0
        begin = np.zeros(len(codes), dtype=bool)
        begin[begins] = True
        start = begin.copy()
        start[1:] |= kind[1:] != kind[:-1]
        # The last of white space before a word: on its own, or part of the word if it is a space.
        last = space[:-1] & ~space[1:] & ~begin[1:]
        start[:-1] |= last
        start[1:] &= ~(last & (codes[:-1] == 32))
        return start


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """The encoder of a worker: read once, and its words are remembered from task to task."""
    return Encoder(path)


def idf(df: np.ndarray, n: int) -> np.ndarray:
    """Weight of tokens that ``df`` of ``n`` documents hold: 0 in more than half of them, or in one."""
    weight = np.log((n - df + 0.5) / (df + 0.5))
    weight[df < 2] = 0  # a word of one document finds nobody
    return np.maximum(weight, 0)


class Index:
    """BM25 over a shard's documents: distinct tokens and, if given, how often they occur (else
    once), with the weights by token and the mean length of all documents (else of the shard)."""

    def __init__(
        self, terms: list[np.ndarray], lengths: np.ndarray, counts: list[np.ndarray] | None = None,
        weight: np.ndarray | None = None, mean: float | None = None,
    ):
        n = len(terms)
        doc = np.repeat(np.arange(n, dtype=np.int32), [len(t) for t in terms])
        word = np.concatenate(terms) if n else np.zeros(0, dtype=np.int64)
        tf = np.concatenate(counts).astype(np.float64) if counts else np.ones(len(word))
        # Token numbers are small: counted and renumbered by a table instead of a sort.
        held = np.bincount(word.astype(np.int64)) if len(word) else np.zeros(0, dtype=np.int64)
        names = np.flatnonzero(held)
        df = held[names]
        number = np.zeros(len(held), dtype=np.uint16 if len(names) <= 1 << 16 else np.int64)
        number[names] = np.arange(len(names))
        inverse = number[word]
        self.weight = idf(df, n) if weight is None else weight[names]
        useful = self.weight[inverse] > 0
        doc, inverse, tf = doc[useful], inverse[useful], tf[useful]
        if mean is None:
            mean = lengths.mean() if n else 1.0
        tf = tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / max(mean, 1e-9)))
        order = np.argsort(inverse, kind="stable")
        self.starts = np.searchsorted(inverse[order], np.arange(len(names) + 1))
        self.posting, self.value = doc[order].astype(np.intp), self.weight[inverse[order]] * tf[order]
        self.term = inverse.astype(np.int64)  # documents are in order already
        self.term_starts = np.searchsorted(doc, np.arange(n + 1))
        self.n, self.docs = n, np.arange(n)
        self._tabulate()

    def _tabulate(self) -> None:
        """The postings as a table, words by documents, if it is filled well enough: its rows are
        added faster than postings, and in the same order."""
        words, self.table = len(self.starts) - 1, None
        if 0 < words * len(self.docs) <= min(SPARSE * len(self.posting), CELLS):
            column = np.zeros(self.n, dtype=np.intp)
            column[self.docs] = np.arange(len(self.docs))
            self.table = np.zeros((words, len(self.docs)))
            self.table[np.repeat(np.arange(words), np.diff(self.starts)), column[self.posting]] = self.value

    def scores(self, seed: int) -> np.ndarray:
        """BM25 scores of all documents for the seed's words."""
        words = self.term[self.term_starts[seed] : self.term_starts[seed + 1]]
        if not len(words):
            return np.zeros(self.n)
        if self.table is not None:
            out = np.zeros(self.n)
            out[self.docs] = np.add.reduce(self.table[words], axis=0)
            return out
        spans = list(zip(self.starts[words].tolist(), self.starts[words + 1].tolist()))
        posting = np.concatenate([self.posting[a:b] for a, b in spans])
        return np.bincount(posting, np.concatenate([self.value[a:b] for a, b in spans]), self.n)

    def keep(self, docs: np.ndarray) -> None:
        """Leaves only the postings of the documents marked in ``docs``; the scores of others become 0."""
        kept = docs[self.posting]
        self.starts = np.concatenate(([0], np.cumsum(kept)))[self.starts]
        self.posting, self.value = self.posting[kept], self.value[kept]
        self.docs = np.flatnonzero(docs)
        self._tabulate()


def pack(lengths: np.ndarray, terms: list[np.ndarray], index: Index | None = None) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) of one shard."""
    if index is None:
        index = Index(terms, np.array([max(len(t), 1) for t in terms], dtype=np.float64))
    unused = np.ones(len(lengths), dtype=bool)
    indexed = len(lengths)
    first, rest = 0, None  # rest: (document, tokens already placed)
    sequences: list[list[tuple[int, int, int]]] = []
    while True:
        room, window, seed = WINDOW, [], None
        if rest is not None:
            seed, start = rest
        else:
            while first < len(lengths) and not unused[first]:
                first += 1
            if first == len(lengths):
                break
            seed, start = first, 0
            unused[seed] = False
        take = min(room, int(lengths[seed]) - start)
        window.append((seed, start, take))
        room -= take
        rest = (seed, start + take) if start + take < lengths[seed] else None
        if room:
            left = np.count_nonzero(unused)
            if left <= KEPT * indexed:
                index.keep(unused)
                indexed = left
            score = np.where(unused, index.scores(seed), 0)
            near = np.flatnonzero(score > 0)
            near = near[np.lexsort((near, -score[near]))]
            at = first
            for d in near:
                if not room:
                    break
                unused[d] = False
                take = min(room, int(lengths[d]))
                window.append((int(d), 0, take))
                room -= take
                rest = (int(d), take) if take < lengths[d] else None
            while room:
                while at < len(lengths) and not unused[at]:
                    at += 1
                if at == len(lengths):
                    break
                unused[at] = False
                take = min(room, int(lengths[at]))
                window.append((at, 0, take))
                room -= take
                rest = (at, take) if take < lengths[at] else None
        sequences.append(window)
    if sequences and sum(p[2] for p in sequences[-1]) < WINDOW:
        sequences.extend(_powers(sequences.pop()))
    return sequences


def _powers(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A short window cut into sequences whose sizes are powers of two."""
    out, left = [], sum(p[2] for p in window)
    queue = list(window)
    while left:
        size = 1 << (left.bit_length() - 1)
        room, part = size, []
        while room:
            d, start, length = queue.pop(0)
            take = min(room, length)
            part.append((d, start, take))
            if take < length:
                queue.insert(0, (d, start + take, length - take))
            room -= take
        out.append(part)
        left -= size
    return out


_SCHEMA = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _documents(column: pa.Array, kind: np.dtype) -> list[np.ndarray]:
    """The ids of each document; they travel as little-endian bytes, two or four to an id."""
    return [np.frombuffer(b, dtype=kind) for b in column.to_pylist()]


def _statistics(encoded: DataFrame, kind: np.dtype) -> tuple[np.ndarray, float, int]:
    """Weight by token, mean length and tokens of all documents (one number a token of the vocabulary)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _encoder.cache_clear()  # all is encoded: its memory goes
        n, df, total = 0, np.zeros(1, dtype=np.int64), 0
        for batch in batches:
            for ids in _documents(batch.column(0), kind):
                words = np.sort(ids[:-1])
                if len(words):
                    words = words[np.append(words[1:] != words[:-1], True)]
                    if words[-1] >= len(df):
                        df = np.concatenate((df, np.zeros(2 * int(words[-1]) + 1 - len(df), dtype=np.int64)))
                    df[words] += 1
                n, total = n + 1, total + len(ids)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([-2, -1], held))), pa.array(np.concatenate(([n, total], df[held])))], names=["token", "n"]
        )

    found = encoded.select("ids").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    token, number = found.column("token").to_numpy(), found.column("n").to_numpy()
    n, total = (int(number[token == x].sum()) for x in (-2, -1))
    df = np.zeros(max(token.max(initial=0), 0) + 1, dtype=np.int64)
    df[token[token >= 0]] = number[token >= 0]
    return np.stack((idf(df, n), df)), max((total - n) / n, 1.0) if n else 1.0, total


def leads(words: np.ndarray, counts: np.ndarray, weight: np.ndarray, df: np.ndarray) -> list[int]:
    """The tokens that say most about a document, each after its document frequency's rank: how
    many hold the first one, then the tokens; -1 where there are no more."""
    value, best = weight[words] * counts, []
    for _ in range(min(LEADS, len(words))):
        i = int(value.argmax())  # the smallest token of equal ones: ``words`` ascend
        if value[i] <= 0:
            break
        best.append(int(words[i]))
        value[i] = 0
    return [int(df[best[0]]) if best else -1, *best, *[-1] * (LEADS - len(best))]


def packed(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece of every row of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, and with ``with_ids`` the piece's ids.

    Null and empty text: the single id 1. Repeated rows are packed as often as they occur.
    A document longer than a window runs through several. Other columns are not read. ``path``
    is the tokenizer file, which every executor must have (default: the installed one).
    """
    place = path or tokenizer_path()
    spark = docs.sparkSession

    def width(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [np.dtype(_encoder(place).kind).itemsize] * batch.num_rows})

    # A worker tells it: the driver, which may hold many plans, reads no tokenizer.
    kind = np.dtype(f"<u{spark.range(1, numPartitions=1).mapInArrow(width, 'bytes bigint').first()[0]}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(place)
        for whole in batches:
            for at in range(0, whole.num_rows, ENCODED_ROWS):
                batch = whole.slice(at, ENCODED_ROWS)
                held = encoder.encode_column([text or "" for text in batch.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), held], names=["row", "doc_id", "ids"])

    src = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    encoded = written(src.mapInArrow(encode, "row bigint, doc_id bigint, ids binary"), "packing-ids")
    table, mean, total = _statistics(encoded, kind)
    partitions = max(1, total // PARTITION_TOKENS)
    model = spark.sparkContext.broadcast(table)

    def keys(batch: pa.RecordBatch) -> list[tuple]:
        """What documents are ordered by: their leads, then a number made of their ids; and that is
        followed by their length, for the quantiles."""
        weight, df = model.value
        found = _documents(batch.column("ids"), kind)
        return [(*leads(*np.unique(ids[:-1], return_counts=True), weight, df), zlib.crc32(ids.tobytes()), len(ids)) for ids in found]

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(keys(batch), type=pa.list_(pa.int64()))], names=["key"])

    # Where the order is cut: quantiles of a sample of documents, by their tokens.
    cuts: list[tuple] = []
    if partitions > 1:
        documents = encoded.count()
        some = encoded.sample(min(1.0, SAMPLED * partitions / documents), seed=7).select("ids")
        points = sorted(tuple(r.key) for r in some.mapInArrow(sampled, "key array<bigint>").collect())
        before = np.cumsum([p[-1] for p in points])
        at = np.searchsorted(before, [before[-1] * i / partitions for i in range(1, partitions)]) if points else []
        cuts = [points[i] for i in at]
    cut_at = spark.sparkContext.broadcast(cuts)

    def place_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = keys(batch)
            # A text that many documents repeat is the cut of several parts: its copies are dealt over them.
            part = [
                low if (low := bisect.bisect_left(cut_at.value, k)) == (high := bisect.bisect_right(cut_at.value, k)) else low + r % (high - low + 1)
                for k, r in zip(key, batch.column("row").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(part, pa.int32()), pa.array(key, pa.list_(pa.int64())), batch.column("row")],
                names=["doc_id", "ids", "part", "key", "row"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, sequence = TaskContext.get().partitionId(), 0
        held_rows: list = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            lengths = np.array([len(h) for h in held], dtype=np.int64)
            terms, counts = zip(*[np.unique(h[:-1], return_counts=True) for h in held])
            index = Index(list(terms), np.maximum(lengths - 1, 1).astype(np.float64), list(counts), model.value[0], mean)
            out: list[tuple] = []
            pieces = []
            for window in pack(lengths, list(terms), index):
                number, offset = (partition << 36) + sequence, 0
                sequence += 1
                for d, start, n in window:
                    ids = held[d][start : start + n]
                    out.append((held_rows[d], start, n, zlib.crc32(ids.astype("<u4").tobytes()), int(lengths[d]), number, offset))
                    if with_ids:
                        pieces.append(ids.astype(np.int64))
                    offset += n
            columns = [pa.array(c, type=pa.int64()) for c in zip(*out)]
            if with_ids:
                columns.append(pa.array(pieces, type=pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", *_COLUMNS, *["ids"] * with_ids])

        for batch in batches:
            for row, ids in zip(batch.column(0).to_pylist(), _documents(batch.column(1), kind)):
                held_rows.append(row)
                held.append(ids)
                size += len(ids)
                if size >= SHARD_TOKENS:
                    yield flush()
                    held_rows, held, size = [], [], 0
        if held:
            yield flush()

    led = encoded.mapInArrow(place_of, "doc_id bigint, ids binary, part int, key array<bigint>, row bigint")
    order = [*[F.get("key", F.lit(i)) for i in range(LEADS + 2)], F.col("doc_id"), F.col("row")]
    dealt = led.repartitionById(partitions, "part").sortWithinPartitions(*order)
    return dealt.select("doc_id", "ids").mapInArrow(run, f"doc_id bigint, {_SCHEMA}" + (", ids array<bigint>" if with_ids else ""))
