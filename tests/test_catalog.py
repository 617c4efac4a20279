"""Catalog tables, plans that need no exchange or second scan, and queries that run no job when built."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, same_rows
from lastmile.functions import columns as C
from lastmile.functions import sql as sql_macros
from lastmile.plans import documented as D
from lastmile.plans import pipeline as P
from lastmile.plans import profiling
from lastmile.registry import build, model_for


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    return P.run_bronze(model_for(spark, SF_SMALL).t, str(tmp_path_factory.mktemp("bronze")))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _jobs(spark, group, action) -> int:
    sc = spark.sparkContext
    sc.setJobGroup(group, "")
    try:
        action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_catalog_run_joins_buckets_and_keeps_marts(spark, bronze):
    tables = P.run_catalog(spark, bronze, "shop_a", buckets=4)
    plan = _plan(P.facts_of_tables(spark, tables))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    m = model_for(spark, SF_SMALL)
    assert same_rows(spark.table("shop_a.order_facts").select(*m.facts.columns), m.facts)
    assert same_rows(spark.table("shop_a.`01_SLA_breach_analysis`"), m.sla)
    assert same_rows(spark.table("shop_a.stg_orders"), m.silver_orders.select(*spark.table("shop_a.stg_orders").columns))
    assert spark.catalog.tableExists("shop_a.stg_order_facts") and not spark.catalog.tableExists("stg_order_facts")


def test_two_databases_side_by_side(spark, bronze):
    few = {**bronze, "orders": spark.read.parquet(bronze["orders"]).filter("order_id % 2 = 0")}
    P.run_catalog(spark, bronze, "shop_b", buckets=2)
    P.run_catalog(spark, few, "shop_c", buckets=2)
    whole, half = spark.table("shop_b.stg_orders").count(), spark.table("shop_c.stg_orders").count()
    assert 0 < half < whole == build("stg_orders", spark, SF_SMALL).count()


def test_build_leaves_no_view_behind(spark):
    spark.sql("drop view if exists stg_orders")
    build("stg_orders", spark, SF_SMALL)
    assert not spark.catalog.tableExists("stg_orders")


@pytest.mark.parametrize("name", ["sla_breach", "order_facts", "city_mismatch", "doc_rider_score", "doc_dq_flags", "bronze_profile"])
def test_building_runs_no_job(spark, name):
    """Only the schema of the files is read."""
    tables = _jobs(spark, f"tables-{name}", lambda: [model_for(spark, SF_SMALL).t.raw(t) for t in ("orders", "lineitem", "customer", "supplier", "nation")])
    built = _jobs(spark, f"build-{name}", lambda: build(name, spark, SF_SMALL))
    assert built <= 2 * tables  # a table that serves two entities has its schema read for each


def test_mart_tests_cost_no_job(spark, bronze, tmp_path):
    silver = P.run_silver(spark, bronze, str(tmp_path))
    seen = []
    facts = spark.read.parquet(silver["order_facts"]).withColumn("city", F.lit(None).cast("string"))
    bad = {"order_facts": P.write_parquet(facts, f"{tmp_path}/bad")}
    with pytest.raises(ValueError, match="01_SLA_breach_analysis.city"):
        P.run_marts(spark, bad, f"{tmp_path}/bad_marts")
    marts = P.run_marts(spark, silver, str(tmp_path))
    assert P.check_marts(spark, marts) == dict.fromkeys(P.NOT_NULL, 0)
    mart = P.build_marts(spark.read.parquet(silver["order_facts"]))["05_weekly_trends"]
    plain = _jobs(spark, "plain", lambda: P.write_parquet(mart, f"{tmp_path}/plain"))
    observed = _jobs(spark, "observed", lambda: seen.append(P.write_observed(mart, f"{tmp_path}/observed", {"nulls": P._nulls("05_weekly_trends")})))
    assert seen == [{"nulls": 0}] and observed == plain


def test_profile_reads_every_feed_once(spark, bronze):
    frames = [spark.read.parquet(bronze[n]) for n in ("orders", "delivery_events", "refunds", "restaurants")]
    out = profiling.bronze_profile(*frames)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 4
    assert same_rows(out, build("bronze_profile", spark, SF_SMALL))


def test_profile_counts_odd_rows(spark):
    orders = spark.createDataFrame(
        [(1, 1, "X", "a", None), (1, 1, "X", "a", None), (2, 1, None, None, None), (None, 2, "Y", "a", None), (None, 9, "Y", None, None)],
        "order_id bigint, restaurant_id bigint, city string, payment_mode string, promised_delivery_ts timestamp_ntz",
    )
    events = spark.createDataFrame([(1, "DELIVERED", None), (None, "X", None)], "order_id bigint, event_type string, event_ts timestamp_ntz")
    refunds = spark.createDataFrame([(1,), (5,), (5,), (None,)], "order_id bigint")
    restaurants = spark.createDataFrame([(1, "X"), (1, "Z"), (1, "Z"), (2, None)], "restaurant_id bigint, city string")
    got = {r.metric: r.value for r in profiling.bronze_profile(orders, events, refunds, restaurants).collect()}
    assert got["orders_rows"] == 5 and got["delivery_events_rows"] == 2 and got["refunds_rows"] == 4
    assert got["duplicate_order_ids"] == 2 and got["orphan_refunds"] == 3 and got["late_deliveries"] == 0
    assert got["city_mismatch"] == 4 and got["city_null_pct"] == 20.0 and got["payment_null_pct"] == 40.0
    assert got["city_mismatch"] == profiling.city_mismatch(orders, restaurants).first()[0]


def test_reload_of_one_day_leaves_the_other_files(spark, bronze, tmp_path):
    import os

    silver = P.run_silver(spark, bronze, str(tmp_path), orders_partition_by=("order_date",))["orders"]
    orders, restaurants = spark.read.parquet(bronze["orders"]), spark.read.parquet(bronze["restaurants"])
    day = spark.read.parquet(silver).select("order_date").first()[0]
    files = lambda: {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(silver) for f in fs if f.endswith(".parquet")}
    before, rows = files(), spark.read.parquet(silver).count()
    of_day = orders.filter(F.to_date("order_ts") == F.lit(day)).withColumn("payment_mode", F.lit("AGAIN"))
    P.reload_orders(spark, of_day, restaurants, silver)
    after = files()
    kept = {f for f in before if f"order_date={day}" not in f}
    assert kept and all(after.get(f) == before[f] for f in kept)
    back = spark.read.parquet(silver)
    assert back.count() == rows
    assert back.filter(F.col("order_date") == day).select("payment_mode").distinct().collect()[0][0] == "AGAIN"


def test_sql_functions_are_inlined(spark):
    facts = model_for(spark, SF_SMALL).facts
    f = sql_macros.register(spark, "t_")
    got = facts.selectExpr("order_id", f"{f['time_slot']}(order_hour) as s", f"{f['datediff_minutes']}(order_ts, delivered_ts) as m")
    same = facts.select("order_id", C.doc_time_slot("order_hour").alias("s"), C.exact_minutes_between("order_ts", "delivered_ts").alias("m"))
    assert same_rows(got, same)
    assert "t_time_slot" not in _plan(got) and "t_datediff" not in _plan(got)


def test_rider_score_reuses_one_exchange(spark):
    df = build("doc_rider_score", spark, SF_SMALL)
    df.collect()
    assert "ReusedExchange" in _plan(df)


def test_orphan_event_is_flagged_and_dropped(spark):
    events = spark.createDataFrame([(1, "ASSIGNED"), (2, "ASSIGNED"), (None, "ASSIGNED")], "order_id bigint, event_type string")
    orders = spark.createDataFrame([(1,), (1,), (None,)], "order_id bigint")
    flags = {r.order_id: r._dq_orphan_event for r in D.doc_event_flags(events, orders).collect()}
    assert flags == {1: False, 2: True, None: True}
    assert [r.order_id for r in D.doc_stg_events(events, orders).collect()] == [1]


def test_refund_beyond_exact_money_does_not_stop_the_report(spark):
    refunds = spark.createDataFrame([(1, "DELAY", 1e30), (1, "DELAY", 2.5), (2, "OTHER", 1e30), (2, "OTHER", None)], "order_id bigint, refund_reason string, refund_amount double")
    orders = spark.createDataFrame([(1,), (2,)], "order_id bigint")
    out = {r.refund_category: r for r in D.doc_refund_drivers(refunds, orders).collect()}
    assert out["Delay"].refund_amount == 1e30 and out["Delay"].refund_amount_pct == 50.0 and out["Other"].refund_count == 2


@pytest.mark.parametrize(
    ("name", "keys"),
    [
        ("restaurant_prep_delay", [("breach_rate", True), ("restaurant_id", False)]),
        ("rider_performance", [("total_orders", True), ("rider_id", False)]),
        ("weekly_trends", [("week", False)]),
        ("breach_by_city", [("avg_breach_rate", True), ("city", False)]),
        ("breach_by_slot", [("time_slot", False)]),
        ("top_restaurants", [("breach_rate", True), ("total_orders", True), ("restaurant_id", False)]),
        ("preview_limit", [("order_id", False), ("ingestion_ts", False)]),
        ("events_per_order", [("orders", True), ("events_per_order", False)]),
    ],
)
def test_reports_come_in_order(spark, name, keys):
    """Rows as they are returned, against the declared keys (True: descending, nulls last)."""
    rows = [r.asDict() for r in build(name, spark, SF_SMALL).collect()]
    assert len(rows) > 1
    expected = rows
    for column, descending in reversed(keys):
        present = sorted((r for r in expected if r[column] is not None), key=lambda r: r[column], reverse=descending)
        absent = [r for r in expected if r[column] is None]
        expected = present + absent if descending else absent + present
    assert rows == expected


@pytest.mark.parametrize("name", ["01_SLA_breach_analysis", "05_weekly_trends", "02_restaurants_prep_delay"])
def test_exported_mart_reads_back_row_for_row(spark, bronze, tmp_path, name):
    """The CSV export, read with the mart's schema, is the mart."""
    from lastmile.sources.files import read_csv

    silver = P.run_silver(spark, bronze, str(tmp_path))
    marts = P.run_marts(spark, silver, str(tmp_path))
    out = P.export_marts(spark, marts, str(tmp_path))
    mart = spark.read.parquet(marts[name])
    assert same_rows(read_csv(spark, out[name], mart.schema), mart)
