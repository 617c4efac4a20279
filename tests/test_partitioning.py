"""Results do not depend on the number of shuffle partitions (fresh plans per setting)."""

from conftest import SF_SMALL, same_rows
from lastmile.plans import documented as D
from lastmile.plans import marts as M
from lastmile.plans import profiling as P
from lastmile.plans import silver as S
from lastmile.sources.tables import Tables

CONF = {"spark.sql.shuffle.partitions": "37", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _results(spark):
    t = Tables(spark, SF_SMALL)
    facts = S.order_facts(t.orders, t.events, t.refunds, t.restaurants)
    return {
        "sla": M.sla_breach(facts),
        "riders": M.rider_performance(facts),
        "weekly": M.weekly_trends(facts),
        "dedup": S.dedup_orders(t.orders),
        "drivers": D.doc_refund_drivers(t.refunds, D.doc_clean_orders(t.orders)),
        "profile": P.bronze_profile(t.orders, t.events, t.refunds, t.restaurants),
    }


def test_results_independent_of_shuffle_partitions(spark):
    base = {k: v.collect() for k, v in _results(spark).items()}
    saved = {k: spark.conf.get(k) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        other = _results(spark)
        for name, df in other.items():
            assert same_rows(df, spark.createDataFrame(base[name], df.schema)), name
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
