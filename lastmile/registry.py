"""Every query of the library, by name: ``(spark, sf_dir) -> DataFrame``.

Each query builds one lazy plan from the parquet tables under ``sf_dir``; nothing is
materialized between queries. ``Model`` only memoizes the *plans* of shared
intermediates within one query build.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.functions import sql as sql_macros
from lastmile.plans import bronze as B
from lastmile.plans import documented as D
from lastmile.plans import marts as M
from lastmile.plans import profiling as P
from lastmile.plans import silver as S
from lastmile.session import ensure_checkpoint_dir
from lastmile.sources import feeds
from lastmile.sources.schemas import FEEDS
from lastmile.sources.tables import Tables
from lastmile.streaming.timeline import stream_timeline_from_tables


# Batch time stamped on bronze loads by the registered queries (fixed, so results are
# reproducible; a real load stamps the current time).
LOAD_BATCH_TS = datetime.datetime(2002, 1, 1, 0, 0, 0)
ORDER_BATCHES = (LOAD_BATCH_TS, datetime.datetime(2002, 1, 2, 0, 0, 0))
# The broken lines of the quarantine queries: feed -> the id that is divisible by DAMAGED_MOD.
DAMAGED_FEEDS = {
    "orders": "order_id", "delivery_events": "order_id", "restaurants": "restaurant_id", "riders": "rider_id",
    "support_tickets": "ticket_id",
}
DAMAGED_MOD = 97


class Model:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)

    @cached_property
    def bronze_orders(self) -> DataFrame:
        return B.bronze(self.t, "orders")

    @cached_property
    def silver_orders(self) -> DataFrame:
        return S.silver_orders(self.bronze_orders, self.t.restaurants)

    @cached_property
    def timeline(self) -> DataFrame:
        return S.delivery_timeline(self.t.events)

    @cached_property
    def facts(self) -> DataFrame:
        return S.order_facts(self.bronze_orders, self.t.events, self.t.refunds, self.t.restaurants)

    @cached_property
    def sla(self) -> DataFrame:
        return M.sla_breach(self.facts)

    @cached_property
    def restaurants_mart(self) -> DataFrame:
        return M.restaurant_prep_delay(self.facts)

    @cached_property
    def refunds_mart(self) -> DataFrame:
        return M.refund_drivers(self.facts)

    @cached_property
    def riders_mart(self) -> DataFrame:
        return M.rider_performance(self.facts)

    @cached_property
    def weekly(self) -> DataFrame:
        return M.weekly_trends(self.facts)

    @cached_property
    def doc_orders(self) -> DataFrame:
        return D.doc_clean_orders(self.t.orders)

    @cached_property
    def doc_flags(self) -> DataFrame:
        return D.doc_dq_flags(self.doc_orders, self.timeline, self.t.restaurants)

    @cached_property
    def doc_drivers(self) -> DataFrame:
        return D.doc_refund_drivers(self.t.refunds, self.doc_orders)

    @cached_property
    def doc_weekly(self) -> DataFrame:
        return D.doc_weekly(self.facts)

    def raw_folder(self) -> str:
        """A fresh folder of raw files and their loads, in the shared folder."""
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/raw-{uuid.uuid4().hex}"

    def load(self, name: str) -> DataFrame:
        """A feed written as raw files and loaded again; orders in the two batches they came in."""
        out = self.raw_folder()
        feed = B.feed(self.t, name)
        batches = {LOAD_BATCH_TS: feed}
        if "ingestion_ts" in feed.columns:
            batches = {ts: feed.filter(F.col("ingestion_ts") == F.lit(ts).cast("timestamp_ntz")) for ts in ORDER_BATCHES}
        for i, (ts, rows) in enumerate(batches.items()):
            feeds.write_raw(rows, f"{out}/raw{i}", name)
            feeds.load_feed(self.spark, f"{out}/raw{i}", out, name, ts)
        return feeds.loaded(self.spark, out, name)

    @cached_property
    def damaged_load(self) -> tuple[str, dict[str, dict[str, int]]]:
        """Feeds of every format written with some broken lines and loaded: folder and counts."""
        out = self.raw_folder()
        for name, key in DAMAGED_FEEDS.items():
            feeds.write_raw(B.feed(self.t, name), f"{out}/raw", name, damaged=F.col(key) % DAMAGED_MOD == 0)
        return out, feeds.load_all(self.spark, f"{out}/raw", out, LOAD_BATCH_TS, DAMAGED_FEEDS)

    def load_report(self) -> DataFrame:
        rows = [(n, FEEDS[n][2], c["lines"], c["loaded"], c["quarantined"]) for n, c in self.damaged_load[1].items()]
        return self.spark.createDataFrame(rows, "feed string, format string, lines bigint, loaded bigint, quarantined bigint")

    def quarantine(self) -> DataFrame:
        """The broken lines, told by the first number in them."""
        out, _ = self.damaged_load
        lines = [feeds.quarantined(self.spark, out, n) for n in DAMAGED_FEEDS]
        return reduce(DataFrame.unionByName, lines).select(
            "feed", "source_file", F.regexp_extract("line", r"(\d+)", 1).cast("bigint").alias("line_id")
        )

    def sql_functions(self) -> DataFrame:
        """The documented macros called by name in SQL."""
        f = sql_macros.register(self.spark, "lastmile_")
        return self.facts.selectExpr(
            "order_id",
            f"{f[sql_macros.TIME_SLOT]}(order_hour) as time_slot",
            f"{f[sql_macros.DATEDIFF_MINUTES]}(order_ts, delivered_ts) as delivery_minutes",
        )


def _distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("total_orders"))


def _not_null_marts(m: Model) -> DataFrame:
    """The three not-null tests over their marts, each a plan of its own that reads only
    the fact columns its mart needs."""
    return (
        P.dq_not_null_sla_city(m.sla)
        .unionByName(P.dq_not_null_rider_id(m.riders_mart))
        .unionByName(P.dq_not_null_week(m.weekly))
    )


# name -> builder over the Model. Code-defined model first, then the documented one.
_QUERIES: dict[str, Callable[[Model], DataFrame]] = {
    # sources, bronze, dedupe
    "stg_orders": lambda m: m.silver_orders.select("*"),
    "stg_order_facts": lambda m: m.facts.select("*"),
    "stg_delivery_timeline": lambda m: m.timeline.select("*"),
    "preview_limit": lambda m: P.preview(m.bronze_orders, ["order_id", "ingestion_ts"], 5),
    "bronze_orders": lambda m: m.bronze_orders,
    "bronze_delivery_events": lambda m: B.bronze(m.t, "delivery_events", LOAD_BATCH_TS),
    "bronze_refunds": lambda m: B.bronze(m.t, "refunds", LOAD_BATCH_TS),
    "bronze_restaurants": lambda m: B.bronze(m.t, "restaurants", LOAD_BATCH_TS),
    "bronze_riders": lambda m: B.bronze(m.t, "riders", LOAD_BATCH_TS),
    "bronze_order_items": lambda m: B.bronze(m.t, "order_items", LOAD_BATCH_TS),
    "bronze_support_tickets": lambda m: B.bronze(m.t, "support_tickets", LOAD_BATCH_TS),
    "dedup_orders": lambda m: S.dedup_orders(m.t.orders),
    "dedup_events": lambda m: S.dedup_events(m.t.events),
    "latest_rider": lambda m: m.timeline.filter(F.col("rider_id").isNotNull()).select(
        "order_id", "rider_id"
    ),
    "refund_agg": lambda m: S.refund_agg(m.t.refunds),
    # silver
    "silver_orders": lambda m: m.silver_orders,
    "order_value_bucket": lambda m: _distribution(m.silver_orders, "order_value_bucket"),
    "delivery_timeline": lambda m: m.timeline,
    "delivery_timeline_all_types": lambda m: S.delivery_timeline(m.t.events, rider_from_all_types=True),
    "delivery_timeline_lifecycle": lambda m: S.delivery_timeline(m.t.events, rider_from_all_types=False),
    "order_facts": lambda m: m.facts,
    "stream_delivery_timeline": lambda m: stream_timeline_from_tables(m.spark, m.t.sf_dir),
    # intermediate + marts
    "int_sla_metrics": lambda m: M.int_sla_metrics(m.facts),
    "delay_bucket": lambda m: _distribution(M.int_sla_metrics(m.facts), "delay_bucket"),
    "int_restaurant_metrics": lambda m: M.int_restaurant_metrics(m.facts),
    "int_rider_metrics": lambda m: M.int_rider_metrics(m.facts),
    "sla_breach": lambda m: m.sla,
    "restaurant_prep_delay": lambda m: M.restaurants_ordered(m.restaurants_mart),
    "refund_drivers": lambda m: m.refunds_mart,
    "rider_performance": lambda m: M.riders_ordered(m.riders_mart),
    "weekly_trends": lambda m: M.weeks_ordered(m.weekly),
    # reports on the marts
    "breach_by_city": lambda m: M.breach_by_city(m.sla),
    "breach_by_slot": lambda m: M.breach_by_slot(m.sla),
    "refund_share": lambda m: M.refund_share(m.refunds_mart),
    "top_restaurants": lambda m: M.top_restaurants(m.restaurants_mart),
    "load_vs_late": lambda m: M.load_vs_late(m.riders_mart),
    # bronze profile and raw checks
    "row_counts": lambda m: P.row_counts(m.bronze_orders, m.t.events, m.t.refunds),
    "null_pct": lambda m: P.null_pct(m.bronze_orders),
    "duplicate_orders": lambda m: P.duplicate_orders(m.bronze_orders),
    "duplicate_rows": lambda m: P.duplicate_rows(m.t.events),
    "events_per_order": lambda m: P.events_per_order(m.t.events),
    "late_deliveries": lambda m: P.late_deliveries(m.bronze_orders, m.t.events),
    "orphan_refunds": lambda m: P.orphan_refunds(m.t.refunds, m.bronze_orders),
    "city_mismatch": lambda m: P.city_mismatch(m.bronze_orders, m.t.restaurants),
    "invalid_riders": lambda m: P.invalid_riders(m.t.events, m.t.riders),
    "bronze_profile": lambda m: P.bronze_profile(
        m.bronze_orders, m.t.events, m.t.refunds, m.t.restaurants
    ),
    # tests on the marts
    "dq_not_null_sla_city": lambda m: P.dq_not_null_sla_city(m.sla),
    "dq_not_null_rider_id": lambda m: P.dq_not_null_rider_id(m.riders_mart),
    "dq_not_null_week": lambda m: P.dq_not_null_week(m.weekly),
    "dq_not_null_marts": _not_null_marts,
    # documented model
    "doc_clean_orders": lambda m: m.doc_orders,
    "doc_dq_flags": lambda m: m.doc_flags,
    "doc_stg_orders": lambda m: D.doc_stg_orders(m.doc_orders, m.timeline, m.t.restaurants),
    "doc_dq_monitor": lambda m: D.doc_dq_monitor(m.doc_flags),
    "doc_dq_unique": lambda m: D.doc_dq_unique(m.doc_orders, m.t.restaurants),
    "doc_dq_pct_sum": lambda m: D.doc_dq_pct_sum(m.doc_drivers),
    "doc_sla_breach": lambda m: D.doc_sla_breach(m.facts),
    "doc_restaurant_risk": lambda m: D.doc_restaurant_risk(m.facts),
    "doc_refund_drivers": lambda m: m.doc_drivers,
    "doc_rider_daily": lambda m: D.doc_rider_daily(m.facts),
    "doc_rider_score": lambda m: D.doc_rider_score(m.facts, m.t.riders),
    "doc_weekly": lambda m: m.doc_weekly,
    "doc_weekly_wow": lambda m: D.doc_weekly_wow(m.doc_weekly),
    "doc_dim_restaurants": lambda m: D.doc_dim_restaurants(m.t.restaurants),
    "doc_dim_riders": lambda m: D.doc_dim_riders(m.t.riders, m.t.events),
    "doc_order_refunds": lambda m: D.doc_order_refunds(m.doc_orders, m.t.refunds),
    "doc_stg_events": lambda m: D.doc_stg_events(m.t.events, m.bronze_orders),
    "doc_event_flags": lambda m: D.doc_event_flags(m.t.events, m.bronze_orders),
    "doc_delivery_minutes": lambda m: D.doc_delivery_minutes(m.facts),
    "doc_dim_date": lambda m: D.doc_dim_date(m.bronze_orders),
    # raw files -> bronze and quarantine
    **{f"load_{name}": (lambda m, _n=name: m.load(_n)) for name in FEEDS},
    "load_report": lambda m: m.load_report(),
    "load_quarantine": lambda m: m.quarantine(),
    "sql_functions": lambda m: m.sql_functions(),
}

FLAGSHIP = "sla_breach"

def query_names() -> list[str]:
    return list(_QUERIES)


# Settings the plans rely on in whatever session they are built: no broadcast from size
# estimates (only behind a measured bound), hot join keys split even before an aggregation, and shuffle
# partitions merged to 16 MB, so that a task's sorts and aggregations hold a few hundred MB.
_SESSION_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}


def model_for(spark: SparkSession, sf_dir: str) -> Model:
    """A new model: it lists the files and reads the schemas as they are now.

    Sets ``_SESSION_CONF`` in the session, which stays; a setting that the application was started
    with is left as it is.
    """
    given = spark.sparkContext.getConf()
    for key, value in _SESSION_CONF.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return Model(spark, sf_dir)


def build(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _QUERIES[name](model_for(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, sf_dir, _n=name: build(_n, spark, sf_dir)) for name in _QUERIES
    }


__all__ = ["Model", "queries", "build", "query_names", "FLAGSHIP"]
