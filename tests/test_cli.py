"""The command line: list, query to parquet."""

import os

from conftest import SF_SMALL, same_rows
from lastmile.__main__ import main
from lastmile.registry import build, query_names


def test_list(capsys):
    main(["list"])
    assert capsys.readouterr().out.split() == query_names()


def test_query_to_parquet(spark, tmp_dir):
    out = f"{tmp_dir}/refund_drivers"
    main(["query", "refund_drivers", SF_SMALL, "--out", out])
    assert same_rows(spark.read.parquet(out), build("refund_drivers", spark, SF_SMALL))


def test_new_files_and_columns_are_seen(spark, tmp_dir):
    """Nothing is remembered between two builds in one session."""
    import shutil

    from pyspark.sql import functions as F

    for t in ("orders", "lineitem", "customer", "supplier", "nation"):
        os.makedirs(f"{tmp_dir}/{t}.parquet")
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{tmp_dir}/{t}.parquet/part-0.parquet")
    n = spark.read.parquet(f"{tmp_dir}/orders.parquet").count()
    rows = lambda: {r["table_name"]: r["row_count"] for r in build("row_counts", spark, tmp_dir).collect()}
    before = rows()["orders"]
    assert build("stg_orders", spark, tmp_dir).count() == n
    more = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("o_orderkey", F.col("o_orderkey") + 10**9 + 7)
    more.filter("o_orderkey % 100 <> 0").write.mode("append").parquet(f"{tmp_dir}/orders.parquet")
    added = more.filter("o_orderkey % 100 <> 0").count()
    assert rows()["orders"] == before + added
    assert build("stg_orders", spark, tmp_dir).count() == n + added


def test_shared_folder_is_needed_off_local(spark):
    from lastmile.session import is_local

    assert is_local("local") and is_local("local[8]")
    assert not is_local("local-cluster[2,1,1024]") and not is_local("yarn") and not is_local("spark://h:7077")
