"""Intermediate models, the five marts, and the report tables built on the marts.

Every mart is one aggregation of the order facts on a low-cardinality key: partial
aggregation before the shuffle, so a hot city, rider or week costs one partial row per
task. Windows without a partition key only ever run on mart output (a handful of rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.functions import columns as C

TOP_RESTAURANTS = 10


def _sum_int(c: str):
    return F.sum(c).cast("bigint")


# -- intermediate ----------------------------------------------------------------------
def int_sla_metrics(facts: DataFrame) -> DataFrame:
    base = facts.select(
        "order_id",
        "city",
        "order_hour",
        "actual_delivery_minutes",
        "delay_minutes",
        "sla_breach_flag",
        "prep_delay_minutes",
    )
    return base.withColumns(
        {
            "time_slot": C.time_slot("order_hour"),
            "delay_bucket": C.delay_bucket("delay_minutes"),
        }
    )


def int_restaurant_metrics(facts: DataFrame) -> DataFrame:
    return facts.groupBy("restaurant_id", "city").agg(
        F.count("order_id").alias("total_orders"),
        F.avg("prep_delay_minutes").alias("avg_prep_delay"),
        F.avg("delay_minutes").alias("avg_delivery_delay"),
        C.ratio(F.sum("sla_breach_flag"), F.count("order_id")).alias("breach_rate"),
    )


def int_rider_metrics(facts: DataFrame) -> DataFrame:
    return (
        facts.filter(F.col("rider_id").isNotNull())
        .groupBy("rider_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            _sum_int("sla_breach_flag").alias("late_orders"),
            _sum_int("delivery_success_flag").alias("successful_orders"),
            F.avg("actual_delivery_minutes").alias("avg_delivery_time"),
            F.avg("delay_minutes").alias("avg_delay_minutes"),
        )
    )


# -- marts -----------------------------------------------------------------------------
def sla_breach(facts: DataFrame) -> DataFrame:
    """Breach count and rate per (city, time slot); a NULL city is a group of its own."""
    return (
        int_sla_metrics(facts)
        .groupBy("city", "time_slot")
        .agg(
            F.count("order_id").alias("total_orders"),
            _sum_int("sla_breach_flag").alias("breached_orders"),
            C.ratio(F.sum("sla_breach_flag"), F.count("order_id")).alias("breach_rate"),
        )
    )


def restaurant_prep_delay(facts: DataFrame) -> DataFrame:
    return int_restaurant_metrics(facts)


def restaurants_ordered(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("breach_rate").desc_nulls_last(), F.col("restaurant_id").asc_nulls_first())


def refund_drivers(facts: DataFrame) -> DataFrame:
    """Orders and refunded orders per refund class (DELAY / CANCELLATION / OTHER)."""
    return (
        facts.groupBy(
            C.refund_class("sla_breach_flag", "delivery_success_flag").alias("refund_reason")
        )
        .agg(
            F.count("order_id").alias("total_orders"),
            _sum_int("has_refund_flag").alias("refunded_orders"),
            C.ratio(F.sum("has_refund_flag"), F.count("order_id")).alias("refund_rate"),
        )
    )


def rider_performance(facts: DataFrame) -> DataFrame:
    return int_rider_metrics(facts).withColumn("late_rate", C.ratio("late_orders", "total_orders"))


def riders_ordered(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("total_orders").desc(), F.col("rider_id").asc())


def weekly_trends(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy(C.week_start("order_date").alias("week"))
        .agg(
            F.count("order_id").alias("total_orders"),
            _sum_int("delivery_success_flag").alias("completed_orders"),
            _sum_int("has_refund_flag").alias("refunded_orders"),
            _sum_int("sla_breach_flag").alias("breached_orders"),
            C.money_sum("refund_amount").alias("total_refund_amount"),
        )
    )


def weeks_ordered(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("week").asc_nulls_first())


# -- reports on the marts --------------------------------------------------------------
def breach_by_city(sla: DataFrame) -> DataFrame:
    """Unweighted mean of the slot breach rates per city, highest first."""
    return (
        sla.groupBy("city")
        .agg(C.ordered_mean("breach_rate").alias("avg_breach_rate"))
        .orderBy(F.col("avg_breach_rate").desc(), F.col("city").asc_nulls_first())
    )


def breach_by_slot(sla: DataFrame) -> DataFrame:
    return (
        sla.groupBy("time_slot")
        .agg(C.ordered_mean("breach_rate").alias("avg_breach_rate"))
        .orderBy("time_slot")
    )


def refund_share(refunds_mart: DataFrame) -> DataFrame:
    """Each class's refund rate as a percentage of the sum of rates (the pie chart), one
    decimal. The unpartitioned window runs on the mart's at most three rows."""
    total = F.sum("refund_rate").over(Window.partitionBy())
    return refunds_mart.select(
        "refund_reason",
        "refund_rate",
        F.round(F.try_divide(F.col("refund_rate") * 100, total), 1).alias("share_pct"),
    )


def top_restaurants(restaurants_mart: DataFrame, k: int = TOP_RESTAURANTS) -> DataFrame:
    """The k restaurants with the highest breach rate (ties: more orders, then lower id)."""
    return restaurants_mart.orderBy(
        F.col("breach_rate").desc_nulls_last(),
        F.col("total_orders").desc(),
        F.col("restaurant_id").asc_nulls_first(),
        F.col("city").asc_nulls_first(),
    ).limit(k)


def load_vs_late(riders_mart: DataFrame) -> DataFrame:
    return riders_mart.select("total_orders", "late_rate")
