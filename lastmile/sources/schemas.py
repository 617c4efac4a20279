"""Explicit schemas of the raw fulfilment feeds (no inference at scale)."""

from pyspark.sql import types as T

ORDERS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("restaurant_id", T.LongType()),
        T.StructField("city", T.StringType()),
        T.StructField("order_ts", T.TimestampNTZType()),
        T.StructField("promised_delivery_ts", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("order_value", T.DoubleType()),
        T.StructField("payment_mode", T.StringType()),
    ]
)

DELIVERY_EVENTS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("rider_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

ORDER_ITEMS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("item_price", T.DoubleType()),
        T.StructField("cuisine_type", T.StringType()),
    ]
)

RESTAURANTS = T.StructType(
    [
        T.StructField("restaurant_id", T.LongType()),
        T.StructField("city", T.StringType()),
        T.StructField("cuisine_type", T.StringType()),
        T.StructField("rating_band", T.StringType()),
        T.StructField("onboarding_date", T.DateType()),
    ]
)

RIDERS = T.StructType(
    [
        T.StructField("rider_id", T.LongType()),
        T.StructField("city", T.StringType()),
        T.StructField("shift_type", T.StringType()),
        T.StructField("joining_date", T.DateType()),
    ]
)

REFUNDS = T.StructType(
    [
        T.StructField("refund_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("refund_ts", T.TimestampNTZType()),
        T.StructField("refund_reason", T.StringType()),
        T.StructField("refund_amount", T.DoubleType()),
    ]
)

SUPPORT_TICKETS = T.StructType(
    [
        T.StructField("ticket_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("ticket_type", T.StringType()),
        T.StructField("created_ts", T.TimestampNTZType()),
        T.StructField("resolution_status", T.StringType()),
    ]
)

# Name -> (schema, raw file name, format) of the seven feeds.
FEEDS = {
    "orders": (ORDERS, "orders.csv", "csv"),
    "delivery_events": (DELIVERY_EVENTS, "delivery_events.json", "json"),
    "order_items": (ORDER_ITEMS, "order_items.csv", "csv"),
    "restaurants": (RESTAURANTS, "restaurants.csv", "csv"),
    "riders": (RIDERS, "riders.csv", "csv"),
    "refunds": (REFUNDS, "refunds.csv", "csv"),
    "support_tickets": (SUPPORT_TICKETS, "support_tickets.csv", "csv"),
}

CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """The schema plus a string column that receives unparsable lines."""
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
