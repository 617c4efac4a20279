"""Readers for raw feeds and the bronze load metadata.

Readers always take an explicit schema: inference costs a full extra pass over the input
and guesses types from whatever rows it sees. ``infer=True`` exists for ad hoc reads only.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.sources.schemas import CORRUPT_COLUMN, with_corrupt_column


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    permissive: bool = False,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header line. ``permissive`` keeps malformed lines in ``_corrupt_record``."""
    reader = spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    if schema is not None:
        reader = reader.schema(with_corrupt_column(schema) if permissive else schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    if permissive:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.csv(path)


def read_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    permissive: bool = False,
) -> DataFrame:
    """JSON lines; timestamps parse into the schema's timestamp_ntz columns."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(with_corrupt_column(schema) if permissive else schema)
    else:
        reader = reader.option("inferTimestamp", True)
    if permissive:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def drop_corrupt(df: DataFrame) -> DataFrame:
    """Rows that parsed, without the corrupt-record column."""
    if CORRUPT_COLUMN not in df.columns:
        return df
    return df.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def corrupt_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT_COLUMN).isNotNull())


def batch_timestamp() -> dt.datetime:
    """One timestamp for a whole load (the same for every row and every task)."""
    return dt.datetime.now().replace(microsecond=0)


def add_load_metadata(
    df: DataFrame,
    source_file: str,
    ingestion_ts: dt.datetime | Column | None = None,
) -> DataFrame:
    """Bronze metadata: ``ingestion_ts`` (one value per load unless the frame already
    carries one), ``source_file`` and ``load_date``, derived from the new ``ingestion_ts``.
    """
    if ingestion_ts is None and "ingestion_ts" in df.columns:
        ts = F.col("ingestion_ts")
    elif isinstance(ingestion_ts, Column):
        ts = ingestion_ts
    else:
        ts = F.lit(ingestion_ts or batch_timestamp()).cast("timestamp_ntz")
    return df.withColumns(
        {
            "ingestion_ts": ts,
            "source_file": F.lit(source_file),
            "load_date": F.to_date(ts),
        }
    )


def add_batch_metadata(df: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Documented bronze metadata: ``_source_file`` from the scan, ``_ingested_at`` and
    ``_batch_id`` as constants of the load."""
    return df.withColumns(
        {
            "_source_file": F.col("_metadata.file_path"),
            "_ingested_at": F.lit(batch_timestamp()).cast("timestamp_ntz"),
            "_batch_id": F.lit(batch_id or uuid.uuid4().hex),
        }
    )
