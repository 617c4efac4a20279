"""Silver models: cleaned orders, the per-order delivery timeline, and the order facts.

Plan shape of ``order_facts`` (see README, "Plans"):

* orders are deduplicated by ``order_id``            -> one exchange on order_id
* events are reduced to one timeline row per order  -> one exchange on order_id
* refunds are summed per order                      -> one exchange on order_id
* the three are joined on order_id without further exchanges (co-partitioned), and the
  restaurant city is attached last: a broadcast when the restaurant dimension is provably
  small, otherwise one exchange of the facts on restaurant_id (AQE splits a hot restaurant).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from lastmile.functions import columns as C
from lastmile.operators.dedup import keep_first, keep_latest
from lastmile.operators.joins import lookup_join

# Lifecycle event type -> timeline column, in lifecycle order.
LIFECYCLE = (
    ("ASSIGNED", "accepted_ts"),
    ("PICKED_UP", "picked_ts"),
    ("DELIVERED", "delivered_ts"),
)


# -- orders ------------------------------------------------------------------------------
def dedup_orders(orders: DataFrame) -> DataFrame:
    """Latest load of each order (greatest ``ingestion_ts``; ties broken on all columns)."""
    return keep_latest(orders, ["order_id"], "ingestion_ts")


def restaurant_cities(restaurants: DataFrame) -> DataFrame:
    """restaurant_id -> city, one row per restaurant (a duplicated restaurant row must not
    fan out orders; among duplicates the smallest city wins)."""
    return restaurants.groupBy("restaurant_id").agg(F.min("city").alias("restaurant_city"))


def attach_restaurant_city(df: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Overwrite ``city`` with the restaurant's city — always, so an order whose restaurant
    is missing ends with a NULL city even if the order carried one."""
    joined = lookup_join(df, restaurant_cities(restaurants), "restaurant_id")
    return joined.withColumn("city", F.col("restaurant_city")).drop("restaurant_city")


def clean_order_columns(orders: DataFrame) -> DataFrame:
    """Payment fallback, the missing-payment flag (computed after the fallback, so a literal
    'UNKNOWN' counts as missing) and the derived date, hour, value bucket and load date."""
    with_payment = orders.withColumn("payment_mode", C.payment_or_unknown("payment_mode"))
    return with_payment.withColumns(
        {
            "payment_mode_missing_flag": C.flag(F.col("payment_mode") == C.UNKNOWN_PAYMENT),
            "order_date": F.to_date("order_ts"),
            "order_hour": F.hour("order_ts"),
            "order_value_bucket": C.value_bucket("order_value"),
            "load_date": F.to_date("ingestion_ts"),
        }
    )


def silver_orders(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    return attach_restaurant_city(clean_order_columns(dedup_orders(orders)), restaurants)


# -- delivery events -------------------------------------------------------------------
def dedup_events(events: DataFrame) -> DataFrame:
    """First event of each (order, type): earliest ``event_ts`` with NULL first, then the
    smallest rider with NULL last."""
    order = [F.col("event_ts").asc_nulls_first(), F.col("rider_id").asc_nulls_last()]
    return keep_first(events, ["order_id", "event_type"], order)


def _first_of_type(event_type: str) -> Column:
    """The first event of one type as a struct, by min over (ts, rider missing, rider).

    Struct ordering puts a NULL field first, so a NULL ``event_ts`` wins (as in
    ``dedup_events``) and a present rider beats a missing one at the same time.
    """
    key = F.struct(
        F.col("event_ts").alias("ts"),
        F.col("rider_id").isNull().alias("no_rider"),
        F.col("rider_id").alias("rider"),
    )
    return F.min(F.when(F.col("event_type") == event_type, key))


def _latest_rider(firsts: list[tuple[str, str]]) -> Column:
    """Rider of the latest first-event that has a rider: ``event_ts`` descending with NULL
    last, then event type descending, then rider descending."""
    candidates = [
        F.when(
            F.col(f"{name}.rider").isNotNull(),
            F.struct(
                F.col(f"{name}.ts").alias("ts"),
                F.lit(event_type).alias("event_type"),
                F.col(f"{name}.rider").alias("rider"),
            ),
        )
        for event_type, name in firsts
    ]
    return F.array_max(F.array(*candidates)).getField("rider")


FIRST_COLUMNS = tuple((t, f"_first_{t.lower()}") for t, _ in LIFECYCLE)


def first_events(events: DataFrame | GroupedData) -> DataFrame:
    """Per order (or per group of ``events`` grouped already) and lifecycle type: the first event as a struct (ts, no_rider, rider),
    and its time as ``min(ts)`` plus a has-NULL-time flag.

    The time of the first event is NULL if any event of the type has no time (NULL sorts
    first), else the minimum — two fixed-width aggregates. Queries that never use the
    rider therefore lose the struct aggregate to column pruning and run as a hash
    aggregation; the struct (a sort-based aggregate) is only computed when the rider is
    needed. Every column is a min or max, so partial results (e.g. one per streaming
    micro-batch) merge with ``merge_first_events`` into the same answer.
    """
    aggs = []
    for t, name in FIRST_COLUMNS:
        of_type = F.col("event_type") == t
        aggs += [
            _first_of_type(t).alias(name),
            F.min(F.when(of_type, F.col("event_ts"))).alias(f"{name}_min_ts"),
            F.max(F.when(of_type, F.col("event_ts").isNull())).alias(f"{name}_null_ts"),
        ]
    grouped = events.groupBy("order_id") if isinstance(events, DataFrame) else events
    return grouped.agg(*aggs)


def merge_first_events(partials: DataFrame) -> DataFrame:
    aggs = []
    for _, name in FIRST_COLUMNS:
        aggs += [
            F.min(name).alias(name),
            F.min(f"{name}_min_ts").alias(f"{name}_min_ts"),
            F.max(f"{name}_null_ts").alias(f"{name}_null_ts"),
        ]
    return partials.groupBy("order_id").agg(*aggs)


def _first_time(name: str) -> Column:
    return F.when(F.col(f"{name}_null_ts"), F.lit(None)).otherwise(F.col(f"{name}_min_ts"))


def timeline_from_first_events(firsts: DataFrame) -> DataFrame:
    """Timeline columns from the per-type first events."""
    timeline = firsts.select(
        "order_id",
        *[_first_time(tmp).alias(name) for (_, name), (_, tmp) in zip(LIFECYCLE, FIRST_COLUMNS)],
        _latest_rider(list(FIRST_COLUMNS)).alias("rider_id"),
    )
    return timeline.withColumns(
        {
            "rider_wait_minutes": C.minutes_between("accepted_ts", "picked_ts"),
            "pickup_to_delivery_minutes": C.minutes_between("picked_ts", "delivered_ts"),
            "delivery_status": F.when(F.col("delivered_ts").isNull(), F.lit("INCOMPLETE"))
            .otherwise(F.lit("COMPLETED")),
        }
    )


def delivery_timeline(events: DataFrame, rider_from_all_types: bool = True) -> DataFrame:
    """One row per order: the lifecycle timestamps of the first event of each type, the
    rider of the latest of those events, waits in minutes and the delivery status.

    The first event of every type competes for the rider. With ``rider_from_all_types``
    false only the three lifecycle types do; dedupe, pivot and rider choice are then one
    aggregation on ``order_id`` (partial before the shuffle, final after it).
    """
    if rider_from_all_types:
        return _timeline_all_types(events)
    return timeline_from_first_events(first_events(events))


def _timeline_all_types(events: DataFrame) -> DataFrame:
    """First event per (order, type) for every type, then one row per order."""
    key = F.struct(
        F.col("event_ts").alias("ts"),
        F.col("rider_id").isNull().alias("no_rider"),
        F.col("rider_id").alias("rider"),
    )
    firsts = events.groupBy("order_id", "event_type").agg(F.min(key).alias("w"))
    latest = F.max(
        F.when(
            F.col("w.rider").isNotNull(),
            F.struct(F.col("w.ts").alias("ts"), F.col("event_type"), F.col("w.rider").alias("rider")),
        )
    )
    per_order = firsts.groupBy("order_id").agg(
        *[
            F.max(F.when(F.col("event_type") == t, F.struct(F.col("w.ts").alias("ts")))).alias(name)
            for t, name in LIFECYCLE
        ],
        latest.getField("rider").alias("rider_id"),
    )
    timeline = per_order.select(
        "order_id", *[F.col(f"{name}.ts").alias(name) for _, name in LIFECYCLE], "rider_id"
    )
    return timeline.withColumns(
        {
            "rider_wait_minutes": C.minutes_between("accepted_ts", "picked_ts"),
            "pickup_to_delivery_minutes": C.minutes_between("picked_ts", "delivered_ts"),
            "delivery_status": F.when(F.col("delivered_ts").isNull(), F.lit("INCOMPLETE"))
            .otherwise(F.lit("COMPLETED")),
        }
    )


# -- refunds ---------------------------------------------------------------------------
def refund_agg(refunds: DataFrame) -> DataFrame:
    """Refund total per order (exact) and a constant has-refund flag."""
    return refunds.groupBy("order_id").agg(
        C.money_sum("refund_amount").alias("refund_amount"),
        F.lit(1).alias("has_refund_flag"),
    )


# -- facts -----------------------------------------------------------------------------
def order_facts(
    orders: DataFrame, events: DataFrame, refunds: DataFrame, restaurants: DataFrame
) -> DataFrame:
    """One row per order: cleaned order, timeline, delivery measures, refunds, flags."""
    facts = facts_from_silver(
        clean_order_columns(dedup_orders(orders)), delivery_timeline(events), refunds
    )
    return attach_restaurant_city(facts, restaurants)


def facts_from_silver(orders: DataFrame, timeline: DataFrame, refunds: DataFrame) -> DataFrame:
    """Facts from cleaned orders (one row per order) and the timeline: measures, refund
    totals and flags. The city is whatever ``orders`` carries."""
    return facts_from_totals(orders, timeline, refund_agg(refunds))


def facts_from_totals(orders: DataFrame, timeline: DataFrame, totals: DataFrame) -> DataFrame:
    """The facts where the refunds are already totals per order (``refund_agg``)."""
    facts = orders.join(timeline, "order_id", "left")
    facts = facts.withColumns(
        {
            "actual_delivery_minutes": C.minutes_between("order_ts", "delivered_ts"),
            "delay_minutes": C.minutes_between("promised_delivery_ts", "delivered_ts"),
            "prep_delay_minutes": C.minutes_between("order_ts", "accepted_ts"),
        }
    ).withColumn("sla_breach_flag", C.breach_flag("delay_minutes"))
    facts = facts.join(totals, "order_id", "left").fillna(
        {"refund_amount": 0.0, "has_refund_flag": 0}
    )
    return facts.withColumns(
        {
            "delivery_success_flag": C.present_flag("delivered_ts"),
            "rider_assigned_flag": C.present_flag("rider_id"),
        }
    )
