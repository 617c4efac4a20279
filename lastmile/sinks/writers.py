"""Writers. Every write is a distributed Spark write (one file per task), never a collect.

Paths name shared storage on a cluster. ``materialize`` writes a frame under the
session's ``spark.checkpoint.dir`` and reads it back, which cuts the lineage: a lost
executor then recomputes from the written table, not from the sources.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lastmile.session import ensure_checkpoint_dir

_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    balance_tasks: int | None = None,
    touched_only: bool = False,
    open_files: int | None = None,
) -> str:
    """Parquet write, optionally into ``partition_by`` directories.

    ``touched_only`` replaces only the partitions that ``df`` has rows in and leaves the files of all
    others as they are, so a day can be loaded again without rewriting the table.

    With ``balance_tasks=n`` the rows are first range-partitioned into n tasks on
    (partition columns, row hash). Range boundaries come from a sample, so each task
    holds about 1/n of the rows and only a few partition values: a value holding a third
    of the data is split over a third of the tasks, and the file count stays near
    n + number of values instead of tasks x values.

    ``open_files=n`` is for few partitions: a task keeps up to n files open and writes its rows as they
    come, instead of sorting all of them by partition first (with more partitions it sorts the rest).
    """
    if partition_by and balance_tasks:
        row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
        df = df.repartitionByRange(balance_tasks, *[F.col(c) for c in partition_by], row_hash)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if touched_only:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    elif touched_only:
        raise ValueError("only a partitioned table can be replaced in part")
    conf = df.sparkSession.conf
    before = conf.get(_OPEN_FILES, None)
    if open_files:
        conf.set(_OPEN_FILES, str(open_files))
    try:
        writer.parquet(path)
    finally:
        if open_files:
            conf.set(_OPEN_FILES, before) if before is not None else conf.unset(_OPEN_FILES)
    return path


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column], **options) -> dict[str, object]:
    """``write_parquet`` that also returns aggregates of the rows, taken while they are written:
    no second read, no further job."""
    observation = Observation(f"write-{uuid.uuid4().hex}")
    write_parquet(df.observe(observation, *[c.alias(n) for n, c in metrics.items()]), path, **options)
    return observation.get


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header line, written as a directory of part files."""
    df.write.mode(mode).option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
    ).csv(path)
    return path


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> str:
    """Save as a catalog table; ``bucket_by=(n, keys)`` co-locates later joins on keys."""
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, keys = bucket_by
        writer = writer.bucketBy(n, *keys).sortBy(*keys)
    writer.saveAsTable(name)
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return the table read back."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
