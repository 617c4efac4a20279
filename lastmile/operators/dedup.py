"""Keep one row per key.

``row_number() = 1`` over a key window is planned by Spark as a partial
``WindowGroupLimit`` before the shuffle and a final one after it: every map task keeps
only its best row per key, so a key holding a third of all rows ships one row per task,
not all of its copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order``; the caller makes ``order`` total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def keep_latest(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Keep the row with the greatest ``by`` per key (NULL ``by`` loses).

    Ties go to the smaller 64-bit hash of the remaining columns, then of which of them are NULL (a
    hash leaves NULLs out), so the result never depends on input order. The hashes are taken where
    the row is read: only they, ``by`` and the columns a query needs are shuffled, not every column
    as a sort key.
    """
    rest = [c for c in df.columns if c not in set(keys) and c != by]
    order = [F.col(by).desc_nulls_last()]
    if rest:
        order += [F.xxhash64(*rest).asc(), F.xxhash64(*[F.col(c).isNull() for c in rest]).asc()]
    return keep_first(df, keys, order)
