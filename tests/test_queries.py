"""Every registered query against its oracle SQL in DuckDB, on the smallest tables,
plus invariants that hold on any input."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL, same_rows

sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, register_tables  # noqa: E402
from lastmile.registry import model_for, query_names  # noqa: E402

NAMES = sorted(query_names())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register_tables(c, SF_SMALL)
    return c


def test_every_query_has_oracle_sql():
    assert set(query_names()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    result = compare(df, con, E.oracle_sql()[name])
    assert result["status"] == "ok", result["issues"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"city", "time_slot", "total_orders", "breached_orders", "breach_rate"}
    assert df.count() > 0


def test_fact_invariants(spark):
    m = model_for(spark, SF_SMALL)
    facts = m.facts
    n_orders = m.t.orders.select("order_id").distinct().count()
    assert facts.count() == n_orders == facts.select("order_id").distinct().count()
    total = m.sla.agg(F.sum("total_orders")).first()[0]
    assert total == n_orders
    # refund money: facts + refunds of unknown orders = all refunds
    known = facts.agg(F.sum(F.col("refund_amount").cast("decimal(18,2)"))).first()[0]
    orphans = m.t.refunds.join(m.t.orders.select("order_id"), "order_id", "left_anti")
    orphan_sum = orphans.agg(F.sum(F.col("refund_amount").cast("decimal(18,2)"))).first()[0] or 0
    all_sum = m.t.refunds.agg(F.sum(F.col("refund_amount").cast("decimal(18,2)"))).first()[0]
    assert known + orphan_sum == all_sum


def test_repartitioned_input_same_marts(spark):
    from lastmile.plans import marts as M
    from lastmile.plans import silver as S

    m = model_for(spark, SF_SMALL)
    t = m.t
    shuffled = S.order_facts(
        t.orders.repartition(5), t.events.repartition(7), t.refunds.repartition(3), t.restaurants
    )
    assert same_rows(M.sla_breach(shuffled), m.sla)
    assert same_rows(M.weekly_trends(shuffled), m.weekly)
