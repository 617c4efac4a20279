"""Data-quality assertions and profile measures as distributed aggregations.

Each check returns a small DataFrame (never a Python value), so checks compose with
``unionByName`` into one report and run as Spark jobs over whole tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.operators.joins import anti_join


def row_count(df: DataFrame, name: str) -> DataFrame:
    """(table_name, row_count) — one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count"
    )


def null_pct(df: DataFrame, columns: Sequence[str], suffix: str = "_null_pct") -> DataFrame:
    """Percentage of NULLs in each column, one row, columns ``<col><suffix>``."""
    n = F.count(F.lit(1))
    return df.agg(
        *[
            F.try_divide(F.count_if(F.col(c).isNull()).cast("double") * 100, n).alias(c + suffix)
            for c in columns
        ]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def count_duplicate_keys(df: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias(alias))


def count_duplicate_rows(df: DataFrame, alias: str) -> DataFrame:
    """Rows that repeat an earlier identical row (all but the first of each group);
    NULLs compare equal, as in a grouping."""
    return (
        df.groupBy(*df.columns)
        .count()
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias(alias))
    )


def group_size_distribution(df: DataFrame, key: str, size_name: str, count_name: str) -> DataFrame:
    """How many groups of ``key`` have each size."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias(size_name))
        .groupBy(size_name)
        .agg(F.count(F.lit(1)).alias(count_name))
    )


def count_orphans(child: DataFrame, parent: DataFrame, on: str, alias: str) -> DataFrame:
    """Child rows whose key is absent from the parent (NULL keys count as orphans, as in
    a left join followed by ``IS NULL``)."""
    return anti_join(child, parent, on).agg(F.count(F.lit(1)).alias(alias))


def not_null(df: DataFrame, column: str, test_name: str) -> DataFrame:
    """(test_name, failures, status): failures = rows where ``column`` is NULL."""
    failures = F.count_if(F.col(column).isNull()).cast("bigint")
    return df.agg(failures.alias("failures")).select(
        F.lit(test_name).alias("test_name"),
        "failures",
        F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )


def unique(df: DataFrame, keys: Sequence[str], test_name: str) -> DataFrame:
    """(test_name, failures, status): failures = key values occurring more than once
    (NULL keys are not tested, as in the SQL unique test)."""
    present = df
    for k in keys:
        present = present.filter(F.col(k).isNotNull())
    counted = duplicate_keys(present, keys).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
    return counted.select(
        F.lit(test_name).alias("test_name"),
        "failures",
        F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )


def key_tests(df: DataFrame, key: str, unique_name: str, not_null_name: str) -> DataFrame:
    """The unique and the not_null test of one key from a single aggregation: two rows
    (test_name, failures, status)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).cast("bigint").alias(unique_name),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias(not_null_name),
    )
    return counts.unpivot([], [unique_name, not_null_name], "test_name", "failures").withColumn(
        "status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail"))
    )


def sums_to(df: DataFrame, column: str, target: float, tolerance: float, test_name: str) -> DataFrame:
    """(test_name, total, passed): does ``sum(column)`` lie within ``target ± tolerance``."""
    return df.agg(F.sum(column).alias("total")).select(
        F.lit(test_name).alias("test_name"),
        "total",
        (F.abs(F.col("total") - target) <= tolerance).alias("passed"),
    )
