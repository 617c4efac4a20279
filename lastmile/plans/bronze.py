"""Bronze: each fulfilment feed with its load metadata (ingestion time, source file,
load date). The seven feeds share one function; orders keep the per-load ingestion time
they carry, the others are stamped with the load's batch time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from lastmile.sources.files import add_load_metadata
from lastmile.sources.tables import Tables

# Feed -> raw file name it is loaded from.
SOURCE_FILES = {
    "orders": "orders.csv",
    "delivery_events": "delivery_events.json",
    "order_items": "order_items.csv",
    "restaurants": "restaurants.csv",
    "riders": "riders.csv",
    "refunds": "refunds.csv",
    "support_tickets": "support_tickets.csv",
}


def feed(t: Tables, name: str) -> DataFrame:
    return {
        "orders": lambda: t.orders,
        "delivery_events": lambda: t.events,
        "order_items": lambda: t.order_items,
        "restaurants": lambda: t.restaurants,
        "riders": lambda: t.riders,
        "refunds": lambda: t.refunds,
        "support_tickets": lambda: t.tickets,
    }[name]()


def bronze(t: Tables, name: str, batch_ts: dt.datetime | None = None) -> DataFrame:
    """The feed with load metadata; ``batch_ts`` defaults to now (orders keep their own)."""
    df = feed(t, name)
    ts = None if "ingestion_ts" in df.columns else batch_ts
    return add_load_metadata(df, SOURCE_FILES[name], ts)
