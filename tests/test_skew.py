"""A key holding a third of all rows: AQE splits the skewed join partition, and the
aggregation on the same key still gives the exact answer."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import same_rows
from lastmile.plans import silver as S

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def _skewed_events(spark, n=60000):
    base = dt.datetime(2024, 1, 1)
    li = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 11).alias("rider"),
        F.col("id"),
    )
    orders = spark.range(n).select(F.col("id").alias("k"), F.lit(base).cast("timestamp_ntz").alias("day"))
    joined = li.join(orders, "k")
    return joined.select(
        F.col("k").alias("order_id"),
        F.col("rider").alias("rider_id"),
        F.element_at(F.array(F.lit("ASSIGNED"), F.lit("PICKED_UP"), F.lit("DELIVERED")), (F.floor(F.col("id") / 3) % 3 + 1).cast("int")).alias("event_type"),
        F.timestamp_add("MINUTE", F.col("id") % 97, F.col("day")).alias("event_ts"),
    )


def test_hot_key_join_is_split_and_exact(spark):
    saved = {k: spark.conf.get(k) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        timeline = S.delivery_timeline(_skewed_events(spark))
        timeline.collect()  # run this Dataset so its adaptive plan is final
        plan = timeline._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in plan or "skew=true" in plan.lower(), plan[:3000]
        hot = timeline.filter("order_id = 7").first()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    plain = S.delivery_timeline(_skewed_events(spark))
    assert same_rows(timeline, plain)
    assert hot.accepted_ts is not None and hot.delivered_ts is not None
