"""The documented model: definitions that exist only in prose and SQL snippets of the
design documents, kept apart from the code-defined model under ``doc_`` names.

Where a documented input does not exist in the data, a stand-in is used and named:
* prep time "food_ready - accepted": no food-ready event exists; accepted -> picked-up is
  used (``rider_wait_minutes``).
* rider tenure: from the joining date to the rider's last delivery event (no other "today").
* orphan flag on orders: the order's restaurant does not exist in the restaurant table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.functions import columns as C
from lastmile.operators import quality as Q
from lastmile.operators.dedup import keep_first, keep_latest
from lastmile.operators.joins import lookup_join, semi_join

COMPLETED_STATUSES = ("COMPLETED", "DELIVERED")
CANCELLED_STATUS = "CANCELLED"
PCT_TOLERANCE = 0.1


def _count_if(cond):
    return F.count_if(cond).cast("bigint")


# -- silver orders, documented -----------------------------------------------------------
def doc_clean_orders(orders: DataFrame) -> DataFrame:
    """Dedupe (latest load) -> standardize text -> NULL handling -> derived columns."""
    latest = keep_latest(orders, ["order_id"], "ingestion_ts")
    std = latest.withColumns({c: C.clean_text(c) for c in ("city", "status", "payment_mode")})
    fixed = std.withColumns(
        {
            "payment_mode": C.payment_or_unknown("payment_mode"),
            "order_value": C.non_negative("order_value"),
        }
    )
    derived = fixed.withColumns(
        {
            "order_date": F.to_date("order_ts"),
            "order_hour": F.hour("order_ts"),
            "day_of_week": C.day_of_week("order_ts"),
        }
    )
    return derived.withColumns(
        {
            "time_slot": C.doc_time_slot("order_hour"),
            "is_weekend": C.is_weekend("day_of_week"),
        }
    )


DQ_FLAGS = (
    "_dq_has_null_customer",
    "_dq_invalid_order_value",
    "_dq_orphan_order",
    "_dq_invalid_sequence",
)


def with_dq_flags(clean_orders: DataFrame, timeline: DataFrame, restaurants: DataFrame) -> DataFrame:
    """The clean orders with the four documented row flags."""
    known = restaurants.select("restaurant_id").distinct().withColumn("_known", F.lit(True))
    with_dim = lookup_join(clean_orders, known, "restaurant_id")
    seq = timeline.select("order_id", "accepted_ts", "picked_ts", "delivered_ts")
    joined = with_dim.join(seq, "order_id", "left")
    bad_sequence = (F.col("picked_ts") < F.col("accepted_ts")) | (
        F.col("delivered_ts") < F.col("picked_ts")
    )
    return joined.select(
        *clean_orders.columns,
        F.col("customer_id").isNull().alias("_dq_has_null_customer"),
        F.coalesce(F.col("order_value") <= 0, F.lit(True)).alias("_dq_invalid_order_value"),
        F.col("_known").isNull().alias("_dq_orphan_order"),
        F.coalesce(bad_sequence, F.lit(False)).alias("_dq_invalid_sequence"),
    )


def doc_dq_flags(clean_orders: DataFrame, timeline: DataFrame, restaurants: DataFrame) -> DataFrame:
    """The four documented row flags per order."""
    return with_dq_flags(clean_orders, timeline, restaurants).select("order_id", *DQ_FLAGS)


def doc_stg_orders(clean_orders: DataFrame, timeline: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Staging: the documented clean orders without the rows any DQ flag marks (the flags
    are computed on the rows themselves, one pass)."""
    flagged = with_dq_flags(clean_orders, timeline, restaurants)
    any_flag = F.col(DQ_FLAGS[0])
    for name in DQ_FLAGS[1:]:
        any_flag = any_flag | F.col(name)
    return flagged.filter(~any_flag).select(*clean_orders.columns)


def doc_order_refunds(clean_orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """A row per order and refund, orders without a refund kept (category and amount NULL)."""
    each = refunds.select(
        "order_id", C.refund_category("refund_reason").alias("refund_category"), F.col("refund_amount")
    )
    return clean_orders.select("order_id", "city", "order_date", "order_value").join(each, "order_id", "left")


def doc_event_flags(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Each event with a flag that its order is unknown (a NULL order id is), for staging to drop."""
    known = orders.select("order_id").distinct().withColumn("_known", F.lit(True))
    return events.join(known, "order_id", "left").withColumn("_dq_orphan_event", F.col("_known").isNull()).drop("_known")


def doc_stg_events(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Staging: the events of known orders."""
    return doc_event_flags(events, orders).filter(~F.col("_dq_orphan_event")).drop("_dq_orphan_event")


def doc_delivery_minutes(facts: DataFrame) -> DataFrame:
    """Delivery and delay minutes with the fraction of a second."""
    return facts.select(
        "order_id",
        C.exact_minutes_between("order_ts", "delivered_ts").alias("delivery_minutes"),
        C.exact_minutes_between("promised_delivery_ts", "delivered_ts").alias("delay_minutes"),
    )


def doc_dq_monitor(flags: DataFrame) -> DataFrame:
    return flags.agg(
        F.count(F.lit(1)).alias("total_records"),
        _count_if(F.col("_dq_has_null_customer")).alias("null_customer_count"),
        _count_if(F.col("_dq_invalid_order_value")).alias("invalid_value_count"),
        _count_if(F.col("_dq_orphan_order")).alias("orphan_count"),
        _count_if(F.col("_dq_invalid_sequence")).alias("invalid_sequence_count"),
    )


def doc_dq_unique(clean_orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """unique + not_null on the staging primary keys (one pass per table)."""
    return Q.key_tests(
        clean_orders, "order_id", "unique_stg_orders_order_id", "not_null_stg_orders_order_id"
    ).unionByName(
        Q.key_tests(
            restaurants,
            "restaurant_id",
            "unique_stg_restaurants_restaurant_id",
            "not_null_stg_restaurants_restaurant_id",
        )
    )


# -- marts, documented -----------------------------------------------------------------
def doc_sla_breach(facts: DataFrame) -> DataFrame:
    """Breach % over delivered orders with a promise, per (city, five-way slot)."""
    delivered = facts.filter(
        F.col("delivered_ts").isNotNull() & F.col("promised_delivery_ts").isNotNull()
    ).withColumns(
        {
            "time_slot": C.doc_time_slot("order_hour"),
            "is_breached": C.breached_or_null("delivered_ts", "promised_delivery_ts"),
        }
    )
    agg = delivered.groupBy("city", "time_slot").agg(
        F.count(F.lit(1)).alias("delivered_orders"),
        _count_if(F.col("is_breached")).alias("breached_orders"),
    )
    return agg.withColumn(
        "breach_rate_pct", C.ratio("breached_orders", "delivered_orders") * 100
    )


def doc_restaurant_risk(facts: DataFrame) -> DataFrame:
    """Prep-time delay rate and risk class per restaurant with at least 10 timed orders."""
    timed = facts.filter(F.col("rider_wait_minutes").isNotNull())
    agg = timed.groupBy("restaurant_id", "city").agg(
        F.count(F.lit(1)).alias("orders"),
        F.avg("rider_wait_minutes").alias("avg_prep_time"),
        _count_if(F.col("rider_wait_minutes") > C.PREP_DELAY_THRESHOLD).alias("delayed_orders"),
    )
    return (
        agg.filter(F.col("orders") >= C.MIN_RESTAURANT_ORDERS)
        .withColumn("delay_rate_pct", C.ratio("delayed_orders", "orders") * 100)
        .withColumn("risk_category", C.risk_class("avg_prep_time", "delay_rate_pct"))
    )


def doc_refund_drivers(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    """Refund count and amount per driver category, with each as % of the total.

    Refunds whose order does not exist are dropped (filtered in staging). The
    unpartitioned windows run on the at most four category rows.
    """
    valid = semi_join(refunds, orders.select("order_id"), "order_id")
    exact = F.col("refund_amount").try_cast(C.MONEY_TYPE)
    agg = valid.groupBy(C.refund_category("refund_reason").alias("refund_category")).agg(
        F.count(F.lit(1)).alias("refund_count"),
        C.money_sum("refund_amount").alias("_amount"),
        F.try_sum(exact).alias("_exact"),
        F.count(exact).alias("_exact_count"),
        F.count("refund_amount").alias("_count"),
    )
    # Totals are summed exactly before any division, unless an amount does not fit.
    everything = Window.partitionBy()
    total = F.when(
        F.sum("_exact_count").over(everything) == F.sum("_count").over(everything),
        F.coalesce(F.try_sum("_exact").over(everything).cast("double"), F.sum("_amount").over(everything)),
    ).otherwise(F.sum("_amount").over(everything))
    return agg.select(
        "refund_category",
        "refund_count",
        F.col("_amount").alias("refund_amount"),
        F.try_divide(
            F.col("refund_count").cast("double") * 100, F.sum("refund_count").over(everything)
        ).alias("refund_count_pct"),
        F.try_divide(
            F.col("_amount") * 100,
            total,
        ).alias("refund_amount_pct"),
    )


def doc_dq_pct_sum(drivers: DataFrame) -> DataFrame:
    """Both percentage columns of the refund drivers must sum to 100 ± 0.1 (one pass)."""
    names = {
        "refund_count_pct": "assert_refund_count_pct_sums_to_100",
        "refund_amount_pct": "assert_refund_amount_pct_sums_to_100",
    }
    totals = drivers.agg(*[F.sum(c).alias(n) for c, n in names.items()])
    return totals.unpivot([], list(names.values()), "test_name", "total").withColumn(
        "passed", F.abs(F.col("total") - 100.0) <= PCT_TOLERANCE
    )


def doc_rider_daily(facts: DataFrame) -> DataFrame:
    """Per rider and day: orders, delivered orders, late deliveries, mean delivery time."""
    return (
        facts.filter(F.col("rider_id").isNotNull())
        .groupBy("rider_id", "order_date")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            _count_if(F.col("delivered_ts").isNotNull()).alias("orders_delivered"),
            _count_if(F.col("delivered_ts") > F.col("promised_delivery_ts")).alias("late_count"),
            F.avg("actual_delivery_minutes").alias("avg_delivery_time"),
        )
    )


def doc_rider_score(facts: DataFrame, riders: DataFrame) -> DataFrame:
    """On-time rate, orders per active day, efficiency against the city mean, and tier,
    for riders with at least 10 deliveries. City = the rider's home city (rider table).

    The city mean is an aggregation joined back, not a window over all riders of a city,
    so no task ever holds a whole city. Both uses of the per-rider rows need the same columns,
    so Spark computes them once and reads their exchange again.
    """
    delivered = facts.filter(F.col("rider_id").isNotNull() & F.col("delivered_ts").isNotNull())
    per_rider = delivered.groupBy("rider_id").agg(
        F.count(F.lit(1)).alias("deliveries"),
        _count_if(F.col("delivered_ts") > F.col("promised_delivery_ts")).alias("late_deliveries"),
        F.countDistinct("order_date").alias("active_days"),
    )
    # The second condition always holds; it keeps the late count in both uses of these rows, so
    # that their exchanges are one and the same.
    counted = (F.col("deliveries") >= C.MIN_RIDER_DELIVERIES) & (F.col("late_deliveries") <= F.col("deliveries"))
    ranked = per_rider.filter(counted).withColumns(
        {
            "orders_per_day": C.ratio("deliveries", "active_days"),
            "on_time_rate": 1 - C.ratio("late_deliveries", "deliveries"),
        }
    )
    home = riders.groupBy("rider_id").agg(F.min("city").alias("city"))
    ranked = lookup_join(ranked, home, "rider_id")
    city_avg = ranked.groupBy(F.col("city").alias("avg_city")).agg(
        C.stable_mean("orders_per_day").alias("city_avg_orders_per_day")
    )
    scored = ranked.join(city_avg, F.col("city").eqNullSafe(F.col("avg_city")), "left").drop(
        "avg_city"
    )
    return scored.withColumns(
        {
            "efficiency_score": F.try_divide(
                F.col("orders_per_day"), F.col("city_avg_orders_per_day")
            )
            * F.col("on_time_rate"),
            "performance_tier": C.rider_tier(
                "on_time_rate", F.col("orders_per_day") >= F.col("city_avg_orders_per_day")
            ),
        }
    )


def doc_weekly(facts: DataFrame) -> DataFrame:
    """Per ISO week: completed, cancelled, GMV (to the cent), refunds and the two rates."""
    status = C.clean_text("status")
    completed = status.isin(*COMPLETED_STATUSES)
    agg = facts.groupBy(C.week_start("order_date").alias("week")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        _count_if(completed).alias("completed_orders"),
        _count_if(status == CANCELLED_STATUS).alias("cancelled_orders"),
        # Summed exactly, then rounded to the cent once.
        F.round(C.money_sum(F.when(completed, F.col("order_value"))), 2).alias("total_gmv"),
        C.money_sum("refund_amount").alias("refund_amount"),
    )
    return agg.withColumns(
        {
            "cancellation_rate": C.ratio("cancelled_orders", "total_orders") * 100,
            "refund_rate": F.try_divide(F.col("refund_amount"), F.col("total_gmv")) * 100,
        }
    )


def doc_weekly_wow(weekly: DataFrame) -> DataFrame:
    """Week-over-week change in % against the previous week present. The window is
    unpartitioned but runs on the weekly mart, one row per calendar week."""
    by_week = Window.orderBy("week")

    def wow(c: str):
        prev = F.lag(c).over(by_week)
        return F.try_divide((F.col(c) - prev).cast("double"), prev) * 100

    return weekly.select(
        "week",
        "total_orders",
        "total_gmv",
        "refund_amount",
        wow("total_orders").alias("total_orders_wow_pct"),
        wow("total_gmv").alias("total_gmv_wow_pct"),
        wow("refund_amount").alias("refund_amount_wow_pct"),
    )


# -- dimensions ------------------------------------------------------------------------
def doc_dim_restaurants(restaurants: DataFrame) -> DataFrame:
    attributes = ["city", "cuisine_type", "rating_band", "onboarding_date"]
    order = [F.col(c).asc_nulls_last() for c in attributes]
    return keep_first(restaurants.select("restaurant_id", *attributes), ["restaurant_id"], order)


def doc_dim_riders(riders: DataFrame, events: DataFrame) -> DataFrame:
    """Riders with city, shift, joining date and tenure (days from joining to the last delivery event)."""
    activity = (
        events.filter(F.col("rider_id").isNotNull())
        .groupBy("rider_id")
        .agg(
            F.to_date(F.min("event_ts")).alias("first_event_date"),
            F.to_date(F.max("event_ts")).alias("last_event_date"),
        )
    )
    attributes = ["city", "shift_type", "joining_date"]
    order = [F.col(c).asc_nulls_last() for c in attributes]
    home = keep_first(riders.select("rider_id", *attributes), ["rider_id"], order)
    return home.join(activity, "rider_id", "left").withColumn(
        "tenure_days", F.datediff("last_event_date", "joining_date")
    )


def doc_dim_date(orders: DataFrame) -> DataFrame:
    """One row per calendar day from the first to the last order date.

    The span is bounded by the calendar, not by the data volume: one row of bounds is
    exploded into the days.
    """
    bounds = orders.agg(
        F.min(F.to_date("order_ts")).alias("lo"), F.max(F.to_date("order_ts")).alias("hi")
    )
    days = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_day")
    )
    return days.withColumns(
        {
            "year": F.year("date_day"),
            "month": F.month("date_day"),
            "day_of_month": F.dayofmonth("date_day"),
            "day_of_week": C.day_of_week("date_day"),
            "week_start": C.week_start("date_day"),
            "is_weekend": C.is_weekend(C.day_of_week("date_day")),
        }
    )
