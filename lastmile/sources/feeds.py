"""The declared raw feeds: written as raw files, and loaded into bronze with a quarantine.

A load reads each feed of ``schemas.FEEDS`` once, permissively and with its declared schema, and
writes one Parquet table partitioned by ``quarantined`` and ``batch_id``: the lines that parse, with
load metadata, and the lines that do not, with their text and file. Nothing is dropped: loaded and
quarantined lines are counted while they are written and must add up to the lines read. Loading
a batch again replaces what that batch wrote before, in both parts, and nothing else.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.sinks.writers import write_observed
from lastmile.sources import files
from lastmile.sources.schemas import CORRUPT_COLUMN, FEEDS

QUARANTINED, BATCH = "quarantined", "batch_id"
SOURCE_PATH = "_source_path"
_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def declared(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the declared columns and types of a feed; a column it lacks is null."""
    schema = FEEDS[name][0]
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_raw(df: DataFrame, raw_dir: str, name: str, damaged: Column | None = None) -> str:
    """A feed as raw files: CSV with a header, or JSON lines. Lines of rows for which ``damaged``
    holds are broken: a mark before the first CSV value, half of a JSON line."""
    _, file_name, fmt = FEEDS[name]
    path = f"{raw_dir}/{file_name}"
    rows = declared(df, name)
    damaged = F.lit(False) if damaged is None else damaged
    if fmt == "json":
        line = F.to_json(F.struct(*rows.columns))
        rows.select(F.when(damaged, F.substring(line, F.lit(1), F.length(line) / 2)).otherwise(line).alias("value")).write.mode(
            "overwrite"
        ).text(path)
        return path
    first = rows.columns[0]
    marked = rows.withColumn(
        first, F.when(damaged, F.concat(F.lit("?"), F.coalesce(F.col(first).cast("string"), F.lit("")))).otherwise(F.col(first).cast("string"))
    )
    marked.write.mode("overwrite").option("header", True).option("timestampNTZFormat", _TIMESTAMP).csv(path)
    return path


def read_raw(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """All lines of a feed: parsed by its schema, or with their text in the corrupt-record column."""
    schema, file_name, fmt = FEEDS[name]
    read = files.read_json_lines if fmt == "json" else files.read_csv
    return read(spark, f"{raw_dir}/{file_name}", schema, permissive=True).withColumn(SOURCE_PATH, F.col("_metadata.file_path"))


def load_feed(
    spark: SparkSession, raw_dir: str, out_dir: str, name: str, batch_ts: dt.datetime | None = None
) -> dict[str, int]:
    """Load one feed's files as the batch of ``batch_ts`` (default: now); the counts of the load."""
    batch_ts = batch_ts or files.batch_timestamp()
    lines = files.add_load_metadata(read_raw(spark, raw_dir, name), FEEDS[name][1], batch_ts).withColumns(
        {QUARANTINED: F.col(CORRUPT_COLUMN).isNotNull(), BATCH: F.lit(f"{batch_ts:%Y%m%dT%H%M%S}")}
    )
    counts = write_observed(
        lines,
        bronze_path(out_dir, name),
        {"lines": F.count(F.lit(1)), "loaded": F.count_if(~F.col(QUARANTINED)), "quarantined": F.count_if(QUARANTINED)},
        partition_by=[QUARANTINED, BATCH],
        touched_only=True,
        open_files=2,  # one batch, loaded and quarantined
    )
    if counts["loaded"] + counts["quarantined"] != counts["lines"]:
        raise RuntimeError(f"{name}: lines were lost in the load: {counts}")
    return counts


def load_all(
    spark: SparkSession, raw_dir: str, out_dir: str, batch_ts: dt.datetime | None = None, names: Iterable[str] = FEEDS
) -> dict[str, dict[str, int]]:
    """Load the declared feeds as one batch; the counts of each."""
    batch_ts = batch_ts or files.batch_timestamp()
    return {name: load_feed(spark, raw_dir, out_dir, name, batch_ts) for name in names}


def bronze_path(out_dir: str, name: str) -> str:
    return f"{out_dir}/bronze/{name}.parquet"


def _bronze_schema(name: str) -> T.StructType:
    more = f"{CORRUPT_COLUMN} string, {SOURCE_PATH} string, ingestion_ts timestamp_ntz, source_file string, load_date date, "
    more += f"{QUARANTINED} boolean, {BATCH} string"
    return T.StructType([*FEEDS[name][0].fields, *T.StructType.fromDDL(more).fields])


def _bronze(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_bronze_schema(name)).parquet(bronze_path(out_dir, name))


def loaded(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """The loaded rows of all batches, with their load metadata (only their partitions are read)."""
    rows = _bronze(spark, out_dir, name).filter(~F.col(QUARANTINED))
    return rows.drop(CORRUPT_COLUMN, SOURCE_PATH, QUARANTINED, BATCH)


def quarantined(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """The lines that did not parse: (feed, line, source_file, source_path, ingestion_ts, batch_id)."""
    return (
        _bronze(spark, out_dir, name)
        .filter(QUARANTINED)
        .select(
            F.lit(name).alias("feed"), F.col(CORRUPT_COLUMN).alias("line"), "source_file",
            F.col(SOURCE_PATH).alias("source_path"), "ingestion_ts", BATCH,
        )
    )
