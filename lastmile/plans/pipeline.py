"""The whole medallion run as plain function composition: bronze -> silver -> marts ->
CSV export. Each layer is written to ``out_dir`` and the next layer reads the written
tables, so a layer's lineage starts at its own inputs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.plans import marts as M
from lastmile.plans import silver as S
from lastmile.plans.bronze import SOURCE_FILES, bronze
from lastmile.sinks.writers import save_table, write_csv, write_observed, write_parquet
from lastmile.sources import feeds
from lastmile.sources.files import batch_timestamp
from lastmile.sources.tables import Tables

# Mart -> export name.
MART_EXPORTS = {
    "01_SLA_breach_analysis": "sla_breach_analysis.csv",
    "02_restaurants_prep_delay": "restaurant_prep_delays.csv",
    "03_refund_drivers": "refund_drivers.csv",
    "04_riders_performance": "rider_performance.csv",
    "05_weekly_trends": "weekly_trends.csv",
}


def _in_parallel(jobs: dict[str, Callable[[], str]], workers: int = 4) -> dict[str, str]:
    """Run independent write jobs concurrently (Spark schedules jobs from several threads)."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def run_bronze(t: Tables, out_dir: str) -> dict[str, str]:
    batch_ts = batch_timestamp()
    return _in_parallel(
        {
            name: (lambda n=name: write_parquet(bronze(t, n, batch_ts), f"{out_dir}/bronze/{n}.parquet"))
            for name in SOURCE_FILES
        }
    )


def _bronze_frame(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    return spark.read.parquet(source) if isinstance(source, str) else source


def run_silver(
    spark: SparkSession,
    bronze: Mapping[str, str | DataFrame],
    out_dir: str,
    orders_partition_by: Sequence[str] = (),
) -> dict[str, str]:
    """Silver orders and timeline from bronze; facts from the written silver tables.

    ``orders_partition_by=("order_date",)`` gives the documented date-partitioned layout
    (worth it once a day is many MB; at small volumes it writes thousands of tiny files).
    """
    orders, events, restaurants, refunds = (
        _bronze_frame(spark, bronze[n]) for n in ("orders", "delivery_events", "restaurants", "refunds")
    )
    paths = _in_parallel(
        {
            "orders": lambda: write_parquet(
                S.silver_orders(orders, restaurants),
                f"{out_dir}/silver/orders.parquet",
                partition_by=list(orders_partition_by) or None,
                balance_tasks=int(spark.conf.get("spark.sql.shuffle.partitions")),
            ),
            "delivery_timeline": lambda: write_parquet(
                S.delivery_timeline(events), f"{out_dir}/silver/delivery_timeline.parquet"
            ),
        }
    )
    facts = S.facts_from_silver(
        spark.read.parquet(paths["orders"]),
        spark.read.parquet(paths["delivery_timeline"]),
        refunds,
    )
    paths["order_facts"] = write_parquet(facts, f"{out_dir}/silver/order_facts.parquet")
    return paths


def build_marts(facts: DataFrame) -> dict[str, DataFrame]:
    return {
        "01_SLA_breach_analysis": M.sla_breach(facts),
        "02_restaurants_prep_delay": M.restaurant_prep_delay(facts),
        "03_refund_drivers": M.refund_drivers(facts),
        "04_riders_performance": M.rider_performance(facts),
        "05_weekly_trends": M.weekly_trends(facts),
    }


def mart_path(out_dir: str, name: str) -> str:
    return f"{out_dir}/marts/{name}.parquet"


def run_marts(spark: SparkSession, silver: dict[str, str], out_dir: str) -> dict[str, str]:
    """Write the marts. Each one's not-null test is a count taken while it is written; NULLs raise
    once all marts are there to be looked at."""
    facts = spark.read.parquet(silver["order_facts"])
    found = _in_parallel(
        {
            name: (lambda n=name, df=mart: write_observed(df, mart_path(out_dir, n), {"nulls": _nulls(n)})["nulls"])
            for name, mart in build_marts(facts).items()
        }
    )
    _raise_nulls(found)
    return {name: mart_path(out_dir, name) for name in found}


# Column that must not be NULL in each written mart.
NOT_NULL = {
    "01_SLA_breach_analysis": "city",
    "02_restaurants_prep_delay": "restaurant_id",
    "03_refund_drivers": "refund_reason",
    "04_riders_performance": "rider_id",
    "05_weekly_trends": "week",
}


def _nulls(mart: str) -> Column:
    return F.count_if(F.col(NOT_NULL[mart]).isNull())


def _raise_nulls(found: dict[str, int]) -> None:
    failed = {f"{name}.{NOT_NULL[name]}": n for name, n in found.items() if n}
    if failed:
        raise ValueError(f"NULLs in written marts: {failed}")


def check_marts(spark: SparkSession, marts: dict[str, str]) -> dict[str, int]:
    """NULLs per tested column of marts written earlier; raises if there are any."""
    reports = [
        spark.read.parquet(path).agg(_nulls(name).alias("n")).select(
            F.lit(name).alias("mart"), "n"
        )
        for name, path in marts.items()
    ]
    found = {r["mart"]: r["n"] for r in reduce(DataFrame.unionByName, reports).collect()}
    _raise_nulls(found)
    return found


def export_marts(spark: SparkSession, marts: dict[str, str], out_dir: str) -> dict[str, str]:
    return _in_parallel(
        {
            name: (
                lambda n=name, p=path: write_csv(spark.read.parquet(p), f"{out_dir}/warehouse/{MART_EXPORTS[n]}")
            )
            for name, path in marts.items()
        }
    )


def run_pipeline(
    spark: SparkSession, sf_dir: str, out_dir: str, orders_partition_by: Sequence[str] = ()
) -> dict[str, dict[str, str]]:
    t = Tables(spark, sf_dir)
    bronze = run_bronze(t, out_dir)
    return {"bronze": bronze, **_run_layers(spark, bronze, out_dir, orders_partition_by)}


def run_pipeline_from_raw(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    batch_ts: dt.datetime | None = None,
    orders_partition_by: Sequence[str] = (),
) -> dict[str, dict]:
    """The whole run from raw feed files; ``loads`` holds the counts of each feed's load. Silver
    reads what all batches in ``out_dir`` have loaded, never the quarantine."""
    loads = feeds.load_all(spark, raw_dir, out_dir, batch_ts)
    bronze = {name: feeds.loaded(spark, out_dir, name) for name in loads}
    return {"loads": loads, **_run_layers(spark, bronze, out_dir, orders_partition_by)}


def _run_layers(
    spark: SparkSession, bronze: Mapping[str, str | DataFrame], out_dir: str, orders_partition_by: Sequence[str]
) -> dict[str, dict[str, str]]:
    silver = run_silver(spark, bronze, out_dir, orders_partition_by)
    marts = run_marts(spark, silver, out_dir)
    return {"silver": silver, "marts": marts, "warehouse": export_marts(spark, marts, out_dir)}


def reload_orders(spark: SparkSession, orders: DataFrame, restaurants: DataFrame, path: str) -> str:
    """Replace the days of ``orders`` (all loads of all orders of those days) in silver orders that
    are partitioned by ``order_date``; the files of other days stay as they are."""
    return write_parquet(
        S.silver_orders(orders, restaurants),
        path,
        partition_by=["order_date"],
        balance_tasks=int(spark.conf.get("spark.sql.shuffle.partitions")),
        touched_only=True,
    )


# -- catalog tables --------------------------------------------------------------------------
STAGING_VIEWS = {"stg_orders": "silver_orders", "stg_delivery_timeline": "delivery_timeline", "stg_order_facts": "order_facts"}


def silver_tables(
    spark: SparkSession, bronze: Mapping[str, str | DataFrame], database: str, buckets: int
) -> dict[str, str]:
    """Silver as catalog tables, bucketed and sorted by order: orders, timeline, refund totals."""
    orders, events, restaurants, refunds = (
        _bronze_frame(spark, bronze[n]) for n in ("orders", "delivery_events", "restaurants", "refunds")
    )
    frames = {
        "silver_orders": S.silver_orders(orders, restaurants),
        "delivery_timeline": S.delivery_timeline(events),
        "order_refunds": S.refund_agg(refunds),
    }
    # Dealt by bucket first, so a task writes one file of one bucket.
    by = (buckets, ["order_id"])
    return _in_parallel(
        {
            name: (lambda n=name, df=frame: save_table(df.repartition(buckets, "order_id"), f"{database}.{n}", bucket_by=by))
            for name, frame in frames.items()
        }
    )


def facts_of_tables(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """The facts over the bucketed silver tables: bucket joins bucket, nothing is exchanged."""
    return S.facts_from_totals(
        spark.table(tables["silver_orders"]), spark.table(tables["delivery_timeline"]), spark.table(tables["order_refunds"])
    )


def run_catalog(
    spark: SparkSession, bronze: Mapping[str, str | DataFrame], database: str, buckets: int | None = None
) -> dict[str, str]:
    """Silver, facts and marts as tables of a database, staging as its persistent views.

    Databases stand side by side: nothing outside ``database`` is made or replaced.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"create database if not exists {database}")
    tables = silver_tables(spark, bronze, database, buckets)
    tables["order_facts"] = save_table(
        facts_of_tables(spark, tables), f"{database}.order_facts", bucket_by=(buckets, ["order_id"])
    )
    for view, table in STAGING_VIEWS.items():
        spark.sql(f"create or replace view {database}.{view} as select * from {database}.{table}")
    marts = build_marts(spark.table(tables["order_facts"]))
    tables |= _in_parallel(
        {name: (lambda n=name, df=mart: save_table(df, f"{database}.`{n}`")) for name, mart in marts.items()}
    )
    return tables
