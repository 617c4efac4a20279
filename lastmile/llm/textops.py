"""Vectorised text helpers for tasks: whole documents of an Arrow batch at a time.

Documents are joined into chunks of about ``CHUNK`` bytes (a longer document is a chunk of
its own, never cut) and handled as byte arrays, so the cost per byte is a few numpy passes
and memory is bounded by the chunk and the longest document.

Words are the contract's ``[^\\x20\\x09-\\x0D]+`` over bytes, A-Z lower-cased. A word's
64-bit hash is a polynomial over random byte values modulo 2^64, finished by a mixer, the
same in every process. Null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 2 << 20
_SEP = b"\n"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# ASCII bytes other than digits and letters: what stands between the terms of a search.
NO_TERM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BYTE_VALUE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK + 4096), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= CHUNK + 4096:  # the powers of one very long document are not kept
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finisher of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null counts as empty."""
    return [b"" if b is None else b for b in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], size: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first document, UTF-8 bytes of consecutive documents)."""
    first, held, total = 0, [], 0
    for i, b in enumerate(texts):
        if held and total + len(b) > size:
            yield first, held
            first, held, total = i, [], 0
        held.append(b)
        total += len(b) + 1
    if held:
        yield first, held


class Words:
    """The words of the documents of one chunk, A-Z lower-cased unless ``lower`` is false.

    ``hashes``: uint64 per word, in order; document ``d`` has words
    ``offsets[d]:offsets[d + 1]``; ``starts``/``ends`` are byte places in ``data``.
    ``space`` says which bytes stand between words (the line feed must).
    """

    def __init__(self, docs: list[bytes], lower: bool = True, space: np.ndarray = _SPACE):
        raw = _SEP.join(docs) + _SEP
        raw = raw.lower() if lower else raw
        self.data = a = np.frombuffer(raw, dtype=np.uint8)
        lengths = np.fromiter(map(len, docs), dtype=np.int64, count=len(docs)) + 1
        self.doc_starts = np.concatenate(([0], np.cumsum(lengths)))
        space = space[a]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edges = np.concatenate(([0], edges))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.offsets = np.searchsorted(self.starts, self.doc_starts)
        if len(self.starts):
            run = np.cumsum(_BYTE_VALUE[a] * _power(_BASE, len(a)), dtype=np.uint64)
            total = run[self.ends - 1]
            head = self.starts > 0
            total[head] -= run[self.starts[head] - 1]
            self.hashes = mix(total * _power(_INVERSE, len(a))[self.starts])
        else:
            self.hashes = np.zeros(0, dtype=np.uint64)


def word_hash(word: bytes) -> int:
    """The hash that ``Words`` gives this (already lower-cased) word."""
    return int(Words([word]).hashes[0])


def word_windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (empty if there are fewer)."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for j in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j : len(hashes) - n + 1 + j]
    return mix(out)


def with_fields(df: DataFrame, passed: tuple[str, ...], more: str) -> T.StructType:
    """The schema of the passed columns of ``df``, followed by the fields of ``more`` (DDL).

    A passed column must not be named like one of those; such a name is an error.
    """
    fields = T.StructType.fromDDL(more).fields
    if clash := {f.name for f in fields} & set(passed):
        raise ValueError(f"passed columns named like results: {sorted(clash)}")
    return T.StructType([*[df.schema[c] for c in passed], *fields])


def text_once(docs: DataFrame, passed: tuple[str, ...]) -> tuple[DataFrame, int]:
    """The passed columns and the text of ``docs``, and where the text is: a text that is passed on
    is not sent to the tasks a second time."""
    if "text" in passed:
        return docs.select(*passed), passed.index("text")
    return docs.select(*passed, F.col("text").cast("string").alias("text")), len(passed)


def crc_remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % modulus


class Grams:
    """Codes of the ``n`` bytes that end at each place of each document of a chunk.

    A document is mapped through ``table`` (a byte for a byte) and followed by ``tail``; in
    front of it stand ``n - 1`` bytes ``pad``. ``codes`` holds one code per place, ``inside``
    says which places belong to a document, and ``sums`` adds values up by document.
    """

    def __init__(self, docs: list[bytes], n: int, table: bytes | None = None, pad: int = 32, tail: bytes = b""):
        gap = bytes([pad]) * (n - 1)
        if table is not None:
            docs = [d.translate(table) for d in docs]
        raw = gap + (tail + gap).join(docs) + tail
        self.bytes = a = np.frombuffer(raw, dtype=np.uint8)
        self.n = n
        count = len(a) - n + 1
        wide = a.astype(np.uint64)
        self.codes = wide[:count].copy()
        for j in range(1, n):
            self.codes <<= np.uint64(8)
            self.codes |= wide[j : j + count]
        self.lengths = np.fromiter(map(len, docs), dtype=np.int64, count=len(docs)) + len(tail)
        step = self.lengths + (n - 1)
        self.starts = np.concatenate(([0], np.cumsum(step)[:-1]))
        self.inside = np.ones(count, dtype=bool)
        ends = (self.starts + self.lengths)[:-1]
        for j in range(n - 1):
            self.inside[ends + j] = False

    def byte(self, back: int) -> np.ndarray:
        """The byte ``back`` places before each place's last byte."""
        at = self.n - 1 - back
        return self.bytes[at : at + len(self.codes)]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per document, the sum of ``values`` (along the first axis) over its places."""
        dtype = np.float64 if values.dtype.kind == "f" else np.int64
        end = np.zeros((1, *values.shape[1:]), dtype=values.dtype)
        return np.add.reduceat(np.concatenate((values, end)), self.starts, axis=0, dtype=dtype)


class Tally:
    """Counts of uint64 keys, merged as they come; memory follows the distinct keys."""

    LIMIT = 1 << 21

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.pending = 0

    def add(self, keys: np.ndarray) -> None:
        k, c = np.unique(keys, return_counts=True)
        self.merge(k, c)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts.astype(np.int64))
        self.pending += len(keys)
        if self.pending > self.LIMIT:
            self._compact()
            self.LIMIT = max(self.LIMIT, 2 * self.pending)

    def _compact(self) -> None:
        if len(self.keys) > 1:
            keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self.keys, self.counts = [keys[first]], [np.add.reduceat(counts, first)]
        self.pending = sum(map(len, self.keys))

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self._compact()
        return self.keys[0], self.counts[0]


# A-Z lower-cased, a-z and every byte of a non-ASCII character kept, the rest a space.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
