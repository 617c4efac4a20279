"""Bronze profile and raw-feed checks, and the not-null tests on the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastmile.operators import quality as Q
from lastmile.operators.joins import anti_join, lookup_join

TOP_GROUP_SIZES = 5


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows under a total order (``LIMIT`` made repeatable)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(n)


def row_counts(orders: DataFrame, events: DataFrame, refunds: DataFrame) -> DataFrame:
    return (
        Q.row_count(orders, "orders")
        .unionByName(Q.row_count(events, "delivery_events"))
        .unionByName(Q.row_count(refunds, "refunds"))
    )


def null_pct(orders: DataFrame) -> DataFrame:
    """Percentage of orders without payment mode and without city, rounded to 2."""
    raw = Q.null_pct(orders, ["payment_mode", "city"])
    return raw.select(
        F.round("payment_mode_null_pct", 2).alias("payment_null_pct"),
        F.round("city_null_pct", 2).alias("city_null_pct"),
    )


def duplicate_orders(orders: DataFrame) -> DataFrame:
    return Q.count_duplicate_keys(orders, ["order_id"], "duplicate_order_ids")


def duplicate_rows(events: DataFrame) -> DataFrame:
    return Q.count_duplicate_rows(events, "duplicate_rows")


def events_per_order(events: DataFrame, k: int = TOP_GROUP_SIZES) -> DataFrame:
    """The ``k`` most frequent events-per-order counts (ties: smaller count first)."""
    dist = Q.group_size_distribution(events, "order_id", "events_per_order", "orders")
    return dist.orderBy(F.col("orders").desc(), F.col("events_per_order").asc()).limit(k)


def late_deliveries(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders whose latest DELIVERED event is after the promise.

    Events are reduced to one row per order before the join (instead of joining every
    event to its order and grouping afterwards). Duplicate order rows with the same
    promise count once.
    """
    delivered = (
        events.filter(F.col("event_type") == "DELIVERED")
        .groupBy("order_id")
        .agg(F.max("event_ts").alias("delivered_ts"))
    )
    promises = orders.select("order_id", "promised_delivery_ts").distinct()
    late = promises.join(delivered, "order_id", "inner").filter(
        F.col("delivered_ts") > F.col("promised_delivery_ts")
    )
    return late.agg(F.count(F.lit(1)).alias("late_deliveries"))


def orphan_refunds(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    return Q.count_orphans(refunds, orders, "order_id", "orphan_refunds")


def city_mismatch(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Orders carrying a city that differs from their restaurant's city."""
    dim = restaurants.select("restaurant_id", F.col("city").alias("restaurant_city"))
    with_city = orders.filter(F.col("city").isNotNull()).select("restaurant_id", "city")
    joined = lookup_join(with_city, dim, "restaurant_id", "inner")
    return joined.filter(F.col("city") != F.col("restaurant_city")).agg(
        F.count(F.lit(1)).alias("city_mismatch")
    )


def invalid_riders(events: DataFrame, riders: DataFrame) -> DataFrame:
    """Events whose rider is not in the rider table."""
    with_rider = events.filter(F.col("rider_id").isNotNull())
    return anti_join(with_rider, riders, "rider_id").agg(F.count(F.lit(1)).alias("invalid_riders"))


def _order_marks(orders: DataFrame, events: DataFrame, refunds: DataFrame, restaurants: DataFrame) -> DataFrame:
    """All three feeds reduced to counts per (order_id, promise): a row per order and promise, and
    one row per order for its events and refunds. Each feed is read once."""
    counts = ("orders", "no_payment", "no_city", "mismatch", "events", "refunds")

    def rows(df: DataFrame, promise: Column, delivered: Column, **ones: Column) -> DataFrame:
        return df.select(
            "order_id", promise.cast("timestamp_ntz").alias("promise"), delivered.cast("timestamp_ntz").alias("delivered"),
            *[ones.get(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        )

    none = F.lit(None)
    # A restaurant listed more than once counts a mismatch for each of its rows, and the order once.
    listed = restaurants.groupBy("restaurant_id", F.col("city").alias("stated")).agg(F.count(F.lit(1)).alias("rows"))
    dim = listed.groupBy("restaurant_id").agg(F.collect_list(F.struct("stated", "rows")).alias("cities"))
    placed = lookup_join(orders, dim, "restaurant_id")
    mismatch = F.aggregate(
        "cities", F.lit(0).cast("bigint"), lambda n, c: n + F.when(c["stated"] != F.col("city"), c["rows"]).otherwise(0)
    )
    parts = [
        rows(placed, F.col("promised_delivery_ts"), none, orders=F.lit(1), no_payment=F.col("payment_mode").isNull(),
             no_city=F.col("city").isNull(), mismatch=F.when(F.col("city").isNotNull() & F.col("cities").isNotNull(), mismatch).otherwise(0)),
        rows(events, none, F.when(F.col("event_type") == "DELIVERED", F.col("event_ts")), events=F.lit(1)),
        rows(refunds, none, none, refunds=F.lit(1)),
    ]
    both = parts[0].withColumn("is_order", F.lit(True))
    for p in parts[1:]:
        both = both.unionByName(p.withColumn("is_order", F.lit(False)))
    return both.groupBy("order_id", "is_order", "promise").agg(
        F.max("delivered").alias("delivered"), *[F.sum(c).alias(c) for c in counts]
    )


def bronze_profile(
    orders: DataFrame, events: DataFrame, refunds: DataFrame, restaurants: DataFrame
) -> DataFrame:
    """All bronze checks as one long (metric, value) table, each feed read once.

    The feeds meet per order: a window hands each promise its order's delivery time and row count.
    Its groups hold an order's few promises and one row of events and refunds, as those are
    aggregated before.
    """
    per_order = Window.partitionBy("order_id")
    known = F.col("order_id").isNotNull()
    rows = _order_marks(orders, events, refunds, restaurants).withColumns(
        {
            "order_delivered": F.max("delivered").over(per_order),
            "order_rows": F.sum("orders").over(per_order),
            "nth": F.row_number().over(per_order.orderBy(F.col("is_order").desc(), "promise")),
        }
    )
    loads = F.sum("orders")
    profile = rows.agg(
        F.coalesce(loads, F.lit(0)).alias("orders_rows"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("delivery_events_rows"),
        F.coalesce(F.sum("refunds"), F.lit(0)).alias("refunds_rows"),
        F.round(F.try_divide(F.sum("no_payment").cast("double") * 100, loads), 2).alias("payment_null_pct"),
        F.round(F.try_divide(F.sum("no_city").cast("double") * 100, loads), 2).alias("city_null_pct"),
        F.count_if((F.col("nth") == 1) & (F.col("order_rows") > 1)).alias("duplicate_order_ids"),
        F.count_if(known & F.col("is_order") & (F.col("order_delivered") > F.col("promise"))).alias("late_deliveries"),
        F.coalesce(F.sum(F.when(~known | (F.col("order_rows") == 0), F.col("refunds"))), F.lit(0)).alias("orphan_refunds"),
        F.coalesce(F.sum("mismatch"), F.lit(0)).alias("city_mismatch"),
    )
    return profile.select(*[F.col(c).cast("double").alias(c) for c in profile.columns]).unpivot(
        [], profile.columns, "metric", "value"
    )


# -- not-null tests on the marts ---------------------------------------------------------
def dq_not_null_sla_city(sla: DataFrame) -> DataFrame:
    return Q.not_null(sla, "city", "not_null_01_SLA_breach_analysis_city")


def dq_not_null_rider_id(riders_mart: DataFrame) -> DataFrame:
    return Q.not_null(riders_mart, "rider_id", "not_null_04_riders_performance_rider_id")


def dq_not_null_week(weekly: DataFrame) -> DataFrame:
    return Q.not_null(weekly, "week", "not_null_05_weekly_trends_week")
