"""Joins against dimensions and keyed aggregates.

Building a join runs no job. It is a sort-merge join on the key that AQE turns into a broadcast
once the dimension's size has been measured (its shuffle output, below
``spark.sql.adaptive.autoBroadcastJoinThreshold``), and whose skewed partitions AQE splits
otherwise. A caller who would rather pay for a count than for a shuffle of the large side passes
``max_rows``: a count of at most one row more than the bound then decides on a broadcast at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

# What a broadcast side may take, as rows times the estimated width of a row.
BROADCAST_MAX_BYTES = 16 << 20
_TEXT_BYTES = 64


def row_bytes(df: DataFrame) -> int:
    """Estimated size of a row in memory: 8 bytes a value, 64 a text or nested value."""
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return 16 + sum(8 if isinstance(f.dataType, plain) else _TEXT_BYTES for f in df.schema.fields)


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (default: as many as fit the byte bound).

    Probed anew each time, as the data may have grown; the count stops after one row more
    than the bound and only a number reaches the driver.
    """
    rows = BROADCAST_MAX_BYTES // row_bytes(df) if max_rows is None else max_rows
    return df.select(F.lit(1).alias("_one")).limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    max_rows: int | None = None,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Join a (possibly large, possibly skewed) fact side to a keyed dimension.

    With ``max_rows`` the dimension is counted first, up to one row more, and broadcast if it has
    no more rows. ``bound`` is then a cheaper frame with at least as many rows as ``dim`` (e.g. the
    dimension before it was deduplicated by an aggregation); the count runs on it instead.
    """
    if max_rows is None:
        return facts.join(dim, on, how)
    small = fits_broadcast(bound if bound is not None else dim, max_rows)
    return facts.join(F.broadcast(dim) if small else dim, on, how)


def anti_join(child: DataFrame, parent: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``child`` whose key has no match in ``parent`` (NULL keys never match).

    The parent side is reduced to its distinct keys first (partial aggregation before the
    shuffle), so a hot parent key costs one row, not all of its copies. The key set grows
    with the data, so it is not probed for a broadcast: the planner sort-merge joins it
    and AQE broadcasts it only when the measured shuffle output is small.
    """
    cols = [on] if isinstance(on, str) else list(on)
    keys = parent.select(*cols).distinct()
    return child.join(keys, cols, "left_anti")


def semi_join(child: DataFrame, parent: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``child`` whose key has a match in ``parent``."""
    cols = [on] if isinstance(on, str) else list(on)
    keys = parent.select(*cols).distinct()
    return child.join(keys, cols, "left_semi")
