"""Raw feeds to bronze: all seven loaded, broken lines in quarantine, reloads by batch."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, same_rows
from lastmile.__main__ import main
from lastmile.plans import bronze as B
from lastmile.plans.pipeline import run_pipeline_from_raw
from lastmile.registry import model_for
from lastmile.sources import feeds
from lastmile.sources.schemas import FEEDS, ORDERS

TS = dt.datetime(2024, 5, 6, 7, 0)


def _raw(spark, raw_dir, damaged=None):
    t = model_for(spark, SF_SMALL).t
    for name in FEEDS:
        feeds.write_raw(B.feed(t, name), raw_dir, name, damaged)
    return t


def test_command_loads_all_feeds(spark, tmp_dir, capsys):
    t = _raw(spark, f"{tmp_dir}/raw")
    main(["load", f"{tmp_dir}/raw", f"{tmp_dir}/out", "--batch-ts", TS.isoformat()])
    report = json.loads(capsys.readouterr().out)
    assert set(report) == set(FEEDS)
    for name in FEEDS:
        expected = B.bronze(t, name, TS) if name != "orders" else B.add_load_metadata(t.orders.drop("ingestion_ts"), "orders.csv", TS)
        got = feeds.loaded(spark, f"{tmp_dir}/out", name)
        both = [c for c in got.columns if c in expected.columns]
        assert {f.name for f in FEEDS[name][0].fields} <= set(got.columns)
        typed = expected.select(*[F.col(c).cast(got.schema[c].dataType).alias(c) for c in both])
        assert same_rows(got.select(*both), typed), name
        assert report[name] == {"lines": typed.count(), "loaded": typed.count(), "quarantined": 0}


def test_quarantine_loses_nothing(spark, tmp_dir):
    good = "2,2,3,,2024-01-01 10:00:00,2024-01-01 10:30:00.25,COMPLETED,12.5,\"a, b\"\n"
    bad = ["x,2,3,,2024-01-01 10:00:00,2024-01-01 10:30:00,COMPLETED,12.5,UPI\n", "7,8\n", "3,2,3,,yesterday,2024-01-01 10:30:00,COMPLETED,12.5,UPI\n"]
    os.makedirs(f"{tmp_dir}/raw")
    with open(f"{tmp_dir}/raw/orders.csv", "w") as f:
        f.write(",".join(ORDERS.names) + "\n" + good + "".join(bad))
    with open(f"{tmp_dir}/raw/delivery_events.json", "w") as f:
        f.write('{"order_id": 1, "event_type": "ASSIGNED", "event_ts": "2024-01-01T10:05:00"}\n{not json\n{"order_id": "one"}\n')
    counts = feeds.load_all(spark, f"{tmp_dir}/raw", tmp_dir, TS, ["orders", "delivery_events"])
    assert counts["orders"] == {"lines": 4, "loaded": 1, "quarantined": 3}
    assert counts["delivery_events"] == {"lines": 3, "loaded": 1, "quarantined": 2}
    row = feeds.loaded(spark, tmp_dir, "orders").first()
    assert (row.order_id, row.payment_mode, row.ingestion_ts, row.load_date) == (2, "a, b", TS, TS.date())
    assert row.promised_delivery_ts == dt.datetime(2024, 1, 1, 10, 30, 0, 250000)
    lines = feeds.quarantined(spark, tmp_dir, "orders").collect()
    assert sorted(r.line for r in lines) == sorted(b.strip() for b in bad)
    assert all(r.source_path.endswith("/raw/orders.csv") and r.feed == "orders" for r in lines)
    assert {r.line for r in feeds.quarantined(spark, tmp_dir, "delivery_events").collect()} == {"{not json", '{"order_id": "one"}'}


def test_batches_add_up_and_a_repeated_batch_replaces_itself(spark, tmp_dir):
    t = model_for(spark, SF_SMALL).t
    n = t.riders.count()
    feeds.write_raw(t.riders, f"{tmp_dir}/raw", "riders", damaged=F.col("rider_id") == 3)
    for ts in (TS, TS, TS + dt.timedelta(hours=1)):
        feeds.load_feed(spark, f"{tmp_dir}/raw", tmp_dir, "riders", ts)
    assert feeds.loaded(spark, tmp_dir, "riders").count() == 2 * (n - 1)
    assert feeds.quarantined(spark, tmp_dir, "riders").groupBy("batch_id").count().collect()[0]["count"] == 1
    # loaded again without its broken line: only the part it has rows in is replaced
    feeds.write_raw(t.riders.limit(0), f"{tmp_dir}/none", "riders")
    assert feeds.load_feed(spark, f"{tmp_dir}/none", f"{tmp_dir}/empty", "riders", TS)["lines"] == 0
    assert feeds.loaded(spark, f"{tmp_dir}/empty", "riders").count() == 0


def test_silver_reads_no_quarantine(spark, tmp_dir):
    _raw(spark, f"{tmp_dir}/raw", damaged=F.lit(False))
    t = model_for(spark, SF_SMALL).t
    feeds.write_raw(B.feed(t, "orders"), f"{tmp_dir}/raw", "orders", damaged=F.col("order_id") % 10 == 0)
    out = run_pipeline_from_raw(spark, f"{tmp_dir}/raw", tmp_dir, TS)
    good = t.orders.filter("order_id % 10 <> 0").select("order_id").distinct()
    assert out["loads"]["orders"]["quarantined"] == t.orders.filter("order_id % 10 = 0").count() > 0
    assert same_rows(spark.read.parquet(out["silver"]["order_facts"]).select("order_id"), good)


def test_write_and_read_stay_one_job_each(spark, tmp_dir):
    """The counts of a load cost no second pass."""
    feeds.write_raw(model_for(spark, SF_SMALL).t.riders, f"{tmp_dir}/raw", "riders")
    sc = spark.sparkContext
    sc.setJobGroup("one-load", "")
    feeds.load_feed(spark, f"{tmp_dir}/raw", tmp_dir, "riders", TS)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("one-load")) == 1


def test_unknown_feed_is_an_error(spark, tmp_dir):
    with pytest.raises(KeyError):
        feeds.load_all(spark, tmp_dir, tmp_dir, TS, ["nothing"])


@pytest.mark.parametrize("name", ["order_items", "refunds"])
def test_a_load_does_not_sort_its_rows(spark, tmp_dir, name):
    t = model_for(spark, SF_SMALL).t
    rows = B.feed(t, name)
    feeds.write_raw(rows, f"{tmp_dir}/raw", name, damaged=F.col("order_id") % 10 == 0)
    counts = feeds.load_feed(spark, f"{tmp_dir}/raw", tmp_dir, name, TS)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    plan = spark._jsparkSession.sharedState().statusStore().executionsList().last().physicalPlanDescription()
    assert "WriteFiles" in plan and "Scan csv" in plan and "Sort" not in plan
    assert counts["quarantined"] == rows.filter("order_id % 10 = 0").count() > 0
    assert feeds.quarantined(spark, tmp_dir, name).count() == counts["quarantined"]
    assert same_rows(
        feeds.loaded(spark, tmp_dir, name).select("order_id"), rows.filter("order_id % 10 != 0").select("order_id")
    )
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
