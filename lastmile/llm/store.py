"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``.

A written table cuts the lineage for good: it survives the loss of any executor, and
every executor can read it. Those that a step needs only until its own result stands are written in a
``scratch`` block and go at its end; others stay until the folder is cleared.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from lastmile.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# The tables of the scratch blocks that are open, the innermost last.
_OPEN: ContextVar[tuple[list[tuple[SparkSession, str]], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch() -> Iterator[None]:
    """The tables that ``written`` makes in this block are deleted at its end, also after an error.

    What leaves the block must not read them: values that reached the driver, or a table written
    with ``keep``.
    """
    tables: list[tuple[SparkSession, str]] = []
    before = _OPEN.set((*_OPEN.get(), tables))
    try:
        yield
    finally:
        _OPEN.reset(before)
        for spark, path in tables:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, drop_shuffles: bool = True, keep: bool = False) -> DataFrame:
    """``df`` written once as Parquet below the shared folder, read back.

    ``drop_shuffles`` lets Spark delete the shuffle files of this write as soon as it is done;
    ``df`` itself is then not to be run again. In a ``scratch`` block the table goes with the block, or
    with the one around it, if any, where ``keep`` is set.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    blocks = _OPEN.get()[:-1] if keep else _OPEN.get()
    if blocks:
        blocks[-1].append((spark, path))
    before = spark.conf.get(_CLEANUP, None)
    if drop_shuffles:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)
