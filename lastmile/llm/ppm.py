"""Code lengths of documents by prediction by partial matching (PPM), and a word baseline.

The PPM model is a trie of byte contexts up to ``ORDER`` bytes, learnt from all training texts.
A byte is predicted in the longest context seen in training: with count c out of T there, and D
distinct bytes after it, its probability is c / (T + D); a byte not seen there escapes with D / (T + D)
to the context one byte shorter, where the bytes already offered by the longer one are
excluded from T and D, and so on down to a uniform choice among the bytes never seen. A text
ends with an end symbol (byte 0xFF, which UTF-8 never has) and starts in a context of zero bytes.

The baseline is the smoothed unigram log10 probability of the lower-cased words and the end.

Neither model is ever held whole. Documents are dealt to parts of about ``PART_BYTES`` of text by
their row, whatever their ids and texts repeat; the deal is written once, so that every later
reading agrees on it. A part's distinct words and distinct (ORDER + 1)-byte sequences go out with their
training counts (everything shorter follows from these), the counts are summed and the trie's
figures derived by aggregations and joins, and each part gets back the values of just its own words and
sequences, with which its documents are scored. All of it grows with the text, and no task
holds more than a part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.llm.store import written
from lastmile.llm.textops import Grams, Tally, Words, chunks, utf8, with_fields

ORDER = 4
PART_BYTES = 16 << 20
END_WORD = 0  # key of the end token; word hashes are not 0
_END = b"\xff"
_WORD, _GRAM = 0, 1


def _grams(docs: list[bytes]) -> Grams:
    return Grams(docs, ORDER + 1, pad=0, tail=_END)


def _distinct(key: tuple, table: pa.Table) -> pa.Table:
    """A part's distinct keys with their counts in training documents."""
    train = table.column("train").to_numpy(zero_copy_only=False)
    tally = {(_WORD, True): Tally(), (_WORD, False): Tally(), (_GRAM, True): Tally(), (_GRAM, False): Tally()}
    ends = int(train.sum())
    for first, docs in chunks(utf8(table.column("text").combine_chunks())):
        own = train[first : first + len(docs)]
        w = Words(docs)
        of = np.repeat(own, np.diff(w.offsets))
        g = _grams(docs)
        inside = np.repeat(own, g.lengths + ORDER)[: len(g.codes)]
        for yes in (True, False):
            tally[_WORD, yes].add(w.hashes[of == yes])
            tally[_GRAM, yes].add(g.codes[g.inside & (inside == yes)])
    kinds, keys, counts = [], [], []
    for kind in (_WORD, _GRAM):
        k, c = tally[kind, True].items()
        other, _ = tally[kind, False].items()
        merged = Tally()
        merged.merge(k, c)
        merged.merge(other, np.zeros(len(other), dtype=np.int64))
        if kind == _WORD:
            merged.merge(np.array([END_WORD], dtype=np.uint64), np.array([ends]))
        k, c = merged.items()
        kinds.append(np.full(len(k), kind, dtype=np.int32))
        keys.append(k.view(np.int64))
        counts.append(c)
    return pa.table({
        "part": pa.array(np.full(sum(map(len, keys)), key[0].as_py(), dtype=np.int32)),
        "kind": np.concatenate(kinds), "key": np.concatenate(keys), "n": np.concatenate(counts),
    })


def _log(part: Column, whole: Column) -> Column:
    """log10 of a share; null where it is not defined (such branches are not taken)."""
    return F.log10(F.try_divide(part, whole))


def _gram_values(grams: DataFrame) -> DataFrame:
    """(key, value): the log10 probability of the last byte of each sequence given the others.

    ``grams``: distinct (key, c) with c = 0 for sequences not seen in training.
    """
    level = {ORDER: grams.filter("c > 0").select("key", "c")}
    for j in range(ORDER - 1, -1, -1):  # sequences of j + 1 bytes: a context of j and a byte
        level[j] = level[j + 1].groupBy(F.col("key").bitwiseAND(256 ** (j + 1) - 1).alias("key")).agg(F.sum("c").alias("c"))
    zero = level[0].agg(F.sum("c"), F.count(F.lit(1))).first()
    t0, d0 = int(zero[0] or 0), int(zero[1])
    context = {}
    for j in range(1, ORDER + 1):
        # T and D of a context of j bytes, and what is left of the next shorter one after exclusion.
        low = level[j - 1].select(F.col("key").alias("low"), F.col("c").alias("lc"))
        own = level[j].withColumn("context", F.shiftright("key", 8)).withColumn("low", F.col("key").bitwiseAND(256**j - 1))
        sums = own.join(low, "low").groupBy("context").agg(
            F.sum("c").alias("t"), F.count(F.lit(1)).alias("d"), F.sum("lc").alias("gone")
        )
        if j == 1:
            sums = sums.withColumn("zt", F.lit(t0) - F.col("gone")).withColumn("zd", F.lit(d0) - F.col("d"))
        else:
            shorter = context[j - 1].select(F.col(f"x{j - 1}").alias("short"), F.col(f"t{j - 1}").alias("st"), F.col(f"d{j - 1}").alias("sd"))
            sums = sums.withColumn("short", F.col("context").bitwiseAND(256 ** (j - 1) - 1)).join(shorter, "short")
            sums = sums.withColumn("zt", F.col("st") - F.col("gone")).withColumn("zd", F.col("sd") - F.col("d"))
        context[j] = written(
            sums.select(F.col("context").alias(f"x{j}"), F.col("t").alias(f"t{j}"), F.col("d").alias(f"d{j}"),
                        F.col("zt").alias(f"zt{j}"), F.col("zd").alias(f"zd{j}")),
            f"ppm-context-{j}",
        )
    out = grams
    for j in range(ORDER, 0, -1):
        out = out.withColumn(f"x{j}", F.shiftright("key", 8).bitwiseAND(256**j - 1)).join(context[j], f"x{j}", "left")
    for j in range(ORDER - 1, -1, -1):
        counts = level[j].select(F.col("key").alias(f"g{j}"), F.col("c").alias(f"c{j}"))
        out = out.withColumn(f"g{j}", F.col("key").bitwiseAND(256 ** (j + 1) - 1)).join(counts, f"g{j}", "left")
    out = out.withColumn(f"c{ORDER}", F.when(F.col("c") > 0, F.col("c")))
    # From the shortest context up. plain[j]: nothing excluded; after[j]: escaped from context j + 1.
    never = F.lit(-math.log10(256 - d0) if d0 < 256 else 0.0)
    if t0 == 0:
        return grams.select("key", F.lit(-math.log10(256.0)).alias("value"))
    after = None
    value = F.when(F.col("c0") > 0, _log(F.col("c0"), F.lit(t0 + d0))).otherwise(math.log10(d0 / (t0 + d0)) + never)
    for j in range(1, ORDER + 1):
        left = F.col(f"zt{j}") + F.col(f"zd{j}")  # of the context of j - 1 bytes, after that of j
        lower_escape = never if j == 1 else after
        escaped = F.when(F.col(f"c{j - 1}") > 0, _log(F.col(f"c{j - 1}"), left)).otherwise(
            F.when(F.col(f"zd{j}") > 0, _log(F.col(f"zd{j}"), left)).otherwise(0.0) + lower_escape
        )
        total = F.col(f"t{j}") + F.col(f"d{j}")
        here = F.when(F.col(f"c{j}") > 0, _log(F.col(f"c{j}"), total)).otherwise(_log(F.col(f"d{j}"), total) + escaped)
        out = out.withColumn(f"after{j}", escaped).withColumn(f"value{j}", F.when(F.col(f"t{j}").isNull(), value).otherwise(here))
        after, value = F.col(f"after{j}"), F.col(f"value{j}")
    return out.select("key", value.alias("value"))


def _dealt(src: DataFrame) -> DataFrame:
    """``src`` (text, ...) with its part, written: rows of one id or text go to different parts."""
    size = src.agg(F.sum(F.octet_length("text").cast("bigint") + 64)).first()[0] or 0
    parts = max(1, math.ceil(size / PART_BYTES))
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    return written(src.withColumn("part", part), "ppm-parts")


def _lookup(keys: np.ndarray, known: np.ndarray, values: np.ndarray) -> np.ndarray:
    return values[np.searchsorted(known, keys)]


def score(docs: DataFrame, train: Column, passed: tuple[str, ...] = ()) -> DataFrame:
    """(passed columns, n_tokens, n_known, train_tokens, base_score, score) for every row of
    ``docs`` (text); ``train`` marks the rows to learn from.

    Null text counts as empty: one token, the end. Without training rows the word baseline has
    N = V = 0 and every byte has probability 1/256. Repeated rows stay repeated. Other
    columns are not read; a passed column named like a result is an error. Scores are log10
    probabilities.
    """
    src = docs.select(
        *passed, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    dealt = _dealt(src)

    keys = written(
        dealt.select("part", "text", "train").groupBy("part").applyInArrow(_distinct, "part int, kind int, key bigint, n bigint"),
        "ppm-keys",
    )
    totals = written(keys.groupBy("kind", "key").agg(F.sum("n").alias("c")), "ppm-totals")
    words = totals.filter(F.col("kind") == _WORD)
    n, v = words.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("int"))).first()
    n, v = int(n or 0), int(v or 0)
    values = words.select("kind", "key", F.col("c").cast("double").alias("value")).unionByName(
        _gram_values(totals.filter(F.col("kind") == _GRAM).select("key", "c")).select(F.lit(_GRAM).alias("kind"), "key", "value")
    )
    own = keys.select("part", "kind", "key").join(values, ["kind", "key"])
    floor = math.log10(n + 0.1 * (v + 1))
    names = [*passed, "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        kind = right.column("kind").to_numpy()
        code = right.column("key").to_numpy().astype(np.int64).view(np.uint64)
        value = right.column("value").to_numpy()
        known = {}
        for which in (_WORD, _GRAM):
            k, x = code[kind == which], value[kind == which]
            order = np.argsort(k)
            known[which] = k[order], x[order]
        count = len(left)
        tokens, seen = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
        base, total = np.zeros(count), np.zeros(count)
        end = float(_lookup(np.array([END_WORD], dtype=np.uint64), *known[_WORD])[0]) if count else 0.0
        for first, docs in chunks(utf8(left.column("text").combine_chunks())) if count else ():
            at = slice(first, first + len(docs))
            w = Words(docs)
            c = _lookup(w.hashes, *known[_WORD])
            logs = np.concatenate(([0.0], np.cumsum(np.log10(c + 0.1))))
            hits = np.concatenate(([0], np.cumsum(c > 0)))
            a, b = w.offsets[:-1], w.offsets[1:]
            tokens[at] = b - a + 1
            seen[at] = hits[b] - hits[a] + (end > 0)
            base[at] = logs[b] - logs[a] + math.log10(end + 0.1) - tokens[at] * floor
            g = _grams(docs)
            p = np.zeros(len(g.codes))
            p[g.inside] = _lookup(g.codes[g.inside], *known[_GRAM])
            total[at] = g.sums(p)
        columns = [left.column(c) for c in passed]
        columns += [pa.array(tokens), pa.array(seen), pa.array(np.full(count, n, dtype=np.int64)), pa.array(base), pa.array(total)]
        return pa.table(columns, names=names)

    given = dealt.drop("train")
    return given.groupBy("part").cogroup(own.groupBy("part")).applyInArrow(
        run, with_fields(given, passed, "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    )
