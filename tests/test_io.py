"""Sources and sinks: typed CSV / JSON-lines reads, corrupt rows, load metadata,
partitioned and CSV writes, the medallion pipeline, lineage cuts, broadcast probe."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, same_rows
from lastmile.operators.joins import fits_broadcast, lookup_join
from lastmile.plans import marts as M
from lastmile.plans.pipeline import MART_EXPORTS, run_pipeline
from lastmile.registry import model_for
from lastmile.sinks.writers import materialize, write_csv, write_parquet
from lastmile.sources import files
from lastmile.sources.schemas import CORRUPT_COLUMN, DELIVERY_EVENTS, ORDERS


def test_csv_round_trip_with_schema(spark, tmp_dir):
    orders = model_for(spark, SF_SMALL).t.orders.drop("ingestion_ts")
    path = write_csv(orders, f"{tmp_dir}/orders_csv")
    back = files.read_csv(spark, path, ORDERS)
    assert back.schema == ORDERS
    assert same_rows(back, orders)


def test_csv_permissive_keeps_corrupt_lines(spark, tmp_dir):
    path = f"{tmp_dir}/bad.csv"
    with open(path, "w") as f:
        f.write("order_id,customer_id,restaurant_id,city,order_ts,promised_delivery_ts,status,order_value,payment_mode\n")
        f.write("1,2,3,,2024-01-01 10:00:00,2024-01-01 10:30:00,COMPLETED,12.5,UPI\n")
        f.write("x,2,3,,2024-01-01 10:00:00,2024-01-01 10:30:00,COMPLETED,12.5,UPI\n")
    df = files.read_csv(spark, path, ORDERS, permissive=True).cache()
    assert files.corrupt_rows(df).count() == 1
    good = files.drop_corrupt(df).collect()
    assert len(good) == 1 and good[0].order_ts == dt.datetime(2024, 1, 1, 10, 0)
    assert CORRUPT_COLUMN not in files.drop_corrupt(df).columns


def test_json_lines_with_schema_and_corrupt(spark, tmp_dir):
    path = f"{tmp_dir}/events.json"
    with open(path, "w") as f:
        f.write('{"order_id": 1, "rider_id": 5, "event_type": "ASSIGNED", "event_ts": "2024-01-01T10:05:00", "latitude": 1.0, "longitude": 2.0}\n')
        f.write("{not json\n")
    df = files.read_json_lines(spark, path, DELIVERY_EVENTS, permissive=True).cache()
    assert df.filter(F.col(CORRUPT_COLUMN).isNotNull()).count() == 1
    row = files.drop_corrupt(df).first()
    assert row.event_ts == dt.datetime(2024, 1, 1, 10, 5) and row.rider_id == 5


def test_load_metadata_derives_load_date_from_new_ts(spark):
    df = spark.range(3).withColumnRenamed("id", "x")
    ts = dt.datetime(2024, 5, 6, 23, 59, 59)
    out = files.add_load_metadata(df, "x.csv", ts).collect()
    assert {(r.ingestion_ts, r.source_file, r.load_date) for r in out} == {(ts, "x.csv", ts.date())}


def test_batch_metadata_names_source_file(spark, tmp_dir):
    path = write_parquet(spark.range(2), f"{tmp_dir}/p")
    out = files.add_batch_metadata(spark.read.parquet(path), "b1").collect()
    assert all(r._batch_id == "b1" and r._source_file.startswith("file:") for r in out)


def test_partitioned_write(spark, tmp_dir):
    silver = model_for(spark, SF_SMALL).silver_orders
    path = write_parquet(silver, f"{tmp_dir}/silver_orders", partition_by=["order_date"])
    assert any(d.startswith("order_date=") for d in os.listdir(path))
    back = spark.read.parquet(path)
    assert back.count() == silver.count()
    one_day = silver.select("order_date").first()[0]
    scan = back.filter(F.col("order_date") == one_day)
    assert "PartitionFilters: [isnotnull(order_date" in scan._jdf.queryExecution().executedPlan().toString()


def test_pipeline_end_to_end(spark, tmp_dir):
    out = run_pipeline(spark, SF_SMALL, tmp_dir, orders_partition_by=("order_date",))
    assert set(out["warehouse"]) == set(MART_EXPORTS)
    sla_csv = spark.read.option("header", True).option("inferSchema", True).csv(out["warehouse"]["01_SLA_breach_analysis"])
    expected = M.sla_breach(model_for(spark, SF_SMALL).facts)
    assert sla_csv.count() == expected.count()
    assert sla_csv.agg(F.sum("total_orders")).first()[0] == expected.agg(F.sum("total_orders")).first()[0]
    orders_dir = out["silver"]["orders"]
    assert any(d.startswith("order_date=") for d in os.listdir(orders_dir))
    facts = spark.read.parquet(out["silver"]["order_facts"])
    assert facts.count() == model_for(spark, SF_SMALL).facts.count()


def test_materialize_cuts_lineage(spark):
    df = model_for(spark, SF_SMALL).sla
    stored = materialize(df, "sla")
    assert same_rows(stored, df)
    ckpt = spark.sparkContext.getCheckpointDir().split(":", 1)[-1].lstrip("/")
    assert ckpt in stored.inputFiles()[0] and "/tables/sla-" in stored.inputFiles()[0]


def test_broadcast_probe(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    assert fits_broadcast(small, max_rows=100)
    assert not fits_broadcast(big, max_rows=100)
    plan = lookup_join(big, small, "k", max_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    plan = lookup_join(small, big, "k", max_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_balanced_partitioned_write_splits_hot_value(spark, tmp_dir):
    # one order_date holds most rows: range partitioning spreads it over several tasks
    df = spark.range(20000).select(
        F.when(F.col("id") < 15000, F.lit("2024-01-01")).otherwise(
            F.concat(F.lit("2024-02-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0"))
        ).alias("order_date"),
        F.col("id"),
    )
    path = write_parquet(df, f"{tmp_dir}/bal", partition_by=["order_date"], balance_tasks=8)
    hot = [f for f in os.listdir(f"{path}/order_date=2024-01-01") if f.endswith(".parquet")]
    assert len(hot) >= 4
    assert spark.read.parquet(path).count() == 20000


def test_bucketed_tables_join_without_exchange(spark):
    from lastmile.sinks.writers import save_table

    m = model_for(spark, SF_SMALL)
    save_table(m.silver_orders, "t_silver_orders", bucket_by=(8, ["order_id"]))
    save_table(m.timeline, "t_timeline", bucket_by=(8, ["order_id"]))
    joined = spark.table("t_silver_orders").join(spark.table("t_timeline"), "order_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == m.silver_orders.join(m.timeline, "order_id").count()
