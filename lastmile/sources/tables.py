"""The fulfilment entities, derived from the provided TPC-H-style tables.

The provided tables carry no fulfilment data, so each entity is a deterministic projection
of them (orders -> orders, lineitem -> lifecycle events and refunds, customer ->
restaurants, supplier -> riders). The arithmetic seeds the defects the analytics must
handle: duplicated order loads, missing payment modes and values, events without a rider,
refunds whose order does not exist. No row of a table is left out.

Everything here is lazy: a ``Tables`` object only records how to read and derive each frame.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.operators.joins import lookup_join

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the mapping (they define the test inputs; both engines use the same).
ORDER_MINUTE_BASE = 480          # first order minute of the day (08:00)
ORDER_MINUTE_SPAN = 901          # order minutes 480 .. 1380
PROMISE_BASE = 505               # promise = order minute + 25 + (key * 7) % 21
PROMISE_SPREAD = 21
ORDER_CITY_MOD = 9               # orders with key % 9 = 0 carry a (wrong) city
ORDER_CITY_VALUE = "NATION_0"
NULL_VALUE_MOD = 211             # orders with key % 211 = 0 have no order value
ORDER_VALUE_DIVISOR = 300.0
NULL_PAYMENT_PRIORITY = "5-LOW"  # this priority maps to a missing payment mode
RELOAD_MOD = 100                 # orders with key % 100 = 0 are loaded twice
FIRST_LOAD_TS = "2002-01-01 00:00:00"
SECOND_LOAD_TS = "2002-01-02 00:00:00"
NULL_RIDER_MOD = 7               # lineitems with suppkey % 7 = 0 have no rider
ORPHAN_REFUND_MOD = 101          # lineitems with partkey % 101 = 0 refund a missing order
ORPHAN_REFUND_OFFSET = 1_000_000_000
RATING_LOW_BELOW = 0.0           # account balance of a low-rated restaurant
RATING_MEDIUM_BELOW = 5000.0
ONBOARDING_FROM, ONBOARDING_SPREAD = "1990-01-01", 700   # onboarding date = from + key % spread
SHIFT_TYPES = ("DAY", "NIGHT", "FLEX")                   # by key % 3
JOINING_FROM, JOINING_SPREAD = "1990-06-01", 500


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now: files are listed and the schema read on every call."""
    return spark.read.parquet(path)


def _minutes_after(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)


class Tables:
    """Lazy access to the provided parquet tables and the fulfilment views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A provided table; its schema is read once for all entities of this object."""
        if name not in self._read:
            self._read[name] = read_table(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    # -- dimensions --------------------------------------------------------------------
    @cached_property
    def restaurants(self) -> DataFrame:
        c = self.raw("customer")
        nation = self.raw("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city")
        )
        return lookup_join(c, nation, "c_nationkey").select(
            F.col("c_custkey").alias("restaurant_id"),
            "city",
            F.col("c_mktsegment").alias("cuisine_type"),
            F.when(F.col("c_acctbal") < RATING_LOW_BELOW, F.lit("LOW"))
            .when(F.col("c_acctbal") < RATING_MEDIUM_BELOW, F.lit("MEDIUM"))
            .otherwise(F.lit("HIGH"))
            .alias("rating_band"),
            F.date_add(F.lit(ONBOARDING_FROM).cast("date"), (F.col("c_custkey") % ONBOARDING_SPREAD).cast("int")).alias("onboarding_date"),
        )

    @cached_property
    def riders(self) -> DataFrame:
        s = self.raw("supplier")
        nation = self.raw("nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("city")
        )
        return lookup_join(s, nation, "s_nationkey").select(
            F.col("s_suppkey").alias("rider_id"),
            "city",
            F.element_at(F.array(*map(F.lit, SHIFT_TYPES)), (F.col("s_suppkey") % 3 + 1).cast("int")).alias("shift_type"),
            F.date_add(F.lit(JOINING_FROM).cast("date"), (F.col("s_suppkey") % JOINING_SPREAD).cast("int")).alias("joining_date"),
        )

    # -- facts -------------------------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        """Order loads: every order once, every 100th order a second time, a day later
        (with a changed value and the raw priority as payment mode).

        One scan: each order row expands to its one or two loads.
        """
        o = self.raw("orders")
        key = F.col("o_orderkey")
        minute = F.lit(ORDER_MINUTE_BASE) + key % ORDER_MINUTE_SPAN
        promise = F.lit(PROMISE_BASE) + key % ORDER_MINUTE_SPAN + (key * 7) % PROMISE_SPREAD
        loads = F.when(key % RELOAD_MOD == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        expanded = o.withColumn("_load", F.explode(loads))
        first = F.col("_load") == 1
        value = F.col("o_totalprice") / ORDER_VALUE_DIVISOR
        return expanded.select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_custkey").alias("restaurant_id"),
            F.when(key % ORDER_CITY_MOD == 0, F.lit(ORDER_CITY_VALUE)).alias("city"),
            _minutes_after(F.col("o_orderdate"), minute).alias("order_ts"),
            _minutes_after(F.col("o_orderdate"), promise).alias("promised_delivery_ts"),
            F.when(F.col("o_orderstatus") == "P", F.lit("CANCELLED"))
            .otherwise(F.lit("COMPLETED"))
            .alias("status"),
            F.when(first, F.when(key % NULL_VALUE_MOD != 0, value))
            .otherwise(value + 1.0)
            .alias("order_value"),
            F.when(
                first,
                F.when(F.col("o_orderpriority") != NULL_PAYMENT_PRIORITY, F.col("o_orderpriority")),
            )
            .otherwise(F.col("o_orderpriority"))
            .alias("payment_mode"),
            F.when(first, F.to_timestamp_ntz(F.lit(FIRST_LOAD_TS)))
            .otherwise(F.to_timestamp_ntz(F.lit(SECOND_LOAD_TS)))
            .alias("ingestion_ts"),
        )

    @cached_property
    def events(self) -> DataFrame:
        """Lifecycle events: one per lineitem; line 1-2 ASSIGNED, 3-4 PICKED_UP, 5+ DELIVERED."""
        return self.events_from(self.raw("lineitem"))

    def events_from(self, lineitem: DataFrame) -> DataFrame:
        """Events of any lineitem frame, batch or streaming (a stream-static join)."""
        li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        o = self.raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
        )
        line = F.col("l_linenumber")
        jitter = F.col("l_partkey") % 5
        offset = (
            F.when(line <= 2, 5 + jitter)
            .when(line <= 4, 15 + jitter)
            .otherwise(30 + jitter * 7)
        )
        minute = F.lit(ORDER_MINUTE_BASE) + F.col("l_orderkey") % ORDER_MINUTE_SPAN + offset
        return li.join(o, "l_orderkey", "left").select(
            F.col("l_orderkey").alias("order_id"),
            F.when(F.col("l_suppkey") % NULL_RIDER_MOD != 0, F.col("l_suppkey")).alias("rider_id"),
            F.when(line <= 2, F.lit("ASSIGNED"))
            .when(line <= 4, F.lit("PICKED_UP"))
            .otherwise(F.lit("DELIVERED"))
            .alias("event_type"),
            _minutes_after(F.col("o_orderdate"), minute).alias("event_ts"),
        )

    @cached_property
    def refunds(self) -> DataFrame:
        """A refund per returned line."""
        li = self.raw("lineitem").filter(F.col("l_returnflag") != "N")
        cents = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) / 3.0)
        return li.select(
            F.when(
                F.col("l_partkey") % ORPHAN_REFUND_MOD == 0,
                F.col("l_orderkey") + ORPHAN_REFUND_OFFSET,
            )
            .otherwise(F.col("l_orderkey"))
            .alias("order_id"),
            F.when(F.col("l_returnflag") == "R", F.lit("DELAY"))
            .otherwise(F.lit("MISSING_ITEM"))
            .alias("refund_reason"),
            (cents.cast("bigint").cast("double") / 100).alias("refund_amount"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        li = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
        )
        part = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        return li.join(part, "l_partkey", "left").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("item_price"),
            F.col("p_type").alias("cuisine_type"),
        )

    @cached_property
    def tickets(self) -> DataFrame:
        """Support tickets are the ``error`` events; other events are not tickets."""
        e = self.raw("events").filter(F.col("event_type") == "error")
        return e.select(
            F.col("event_id").alias("ticket_id"),
            F.col("event_id").alias("order_id"),
            F.col("ts").alias("created_ts"),
            F.when(F.col("value") > 50, F.lit("OPEN"))
            .otherwise(F.lit("RESOLVED"))
            .alias("resolution_status"),
        )
