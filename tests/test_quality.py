"""Generic quality operators on hand-made rows."""

from lastmile.operators import quality as Q


def _df(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (None, "b"), (None, "c"), (3, "d")]
    return spark.createDataFrame(rows, "k long, v string")


def test_counts_and_percentages(spark):
    df = _df(spark)
    assert Q.row_count(df, "t").first().asDict() == {"table_name": "t", "row_count": 6}
    pct = Q.null_pct(df, ["k", "v"]).first()
    assert (pct.k_null_pct, pct.v_null_pct) == (2 * 100 / 6, 1 * 100 / 6)


def test_duplicates(spark):
    df = _df(spark)
    # key 1 and the NULL key occur twice
    assert Q.count_duplicate_keys(df, ["k"], "d").first().d == 2
    # one exact repeat: (1, 'a')
    assert Q.count_duplicate_rows(df, "r").first().r == 1
    sizes = {r.size: r.groups for r in Q.group_size_distribution(df, "k", "size", "groups").collect()}
    assert sizes == {2: 2, 1: 2}


def test_orphans_null_key_counts(spark):
    child = spark.createDataFrame([(1,), (5,), (None,)], "k long")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert Q.count_orphans(child, parent, "k", "o").first().o == 2


def test_not_null_unique_and_key_tests(spark):
    df = _df(spark)
    nn = Q.not_null(df, "k", "nn").first()
    assert (nn.test_name, nn.failures, nn.status) == ("nn", 2, "fail")
    un = Q.unique(df, ["k"], "un").first()
    assert (un.failures, un.status) == (1, "fail")  # NULL keys are not tested
    both = {r.test_name: (r.failures, r.status) for r in Q.key_tests(df, "k", "u", "n").collect()}
    assert both == {"u": (1, "fail"), "n": (2, "fail")}
    clean = spark.createDataFrame([(1,), (2,)], "k long")
    assert {r.status for r in Q.key_tests(clean, "k", "u", "n").collect()} == {"pass"}


def test_sums_to(spark):
    df = spark.createDataFrame([(33.3,), (66.65,)], "p double")
    r = Q.sums_to(df, "p", 100.0, 0.1, "s").first()
    assert r.passed and abs(r.total - 99.95) < 1e-9


def test_rows_that_hardly_repeat_are_grouped_in_small_partitions(spark):
    # About 60 MB of shuffle: one task's share if partitions were merged up to Spark's default of 64 MB.
    rows = spark.range(0, 2_500_000, 1, 4).selectExpr("xxhash64(id) as a", "xxhash64(id, 1) as b")
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        grouped = Q.duplicate_keys(rows, ["a", "b"])
        assert 3 <= grouped.rdd.getNumPartitions() <= 16
        assert Q.count_duplicate_rows(rows.unionAll(rows.limit(5)), "r").first().r == 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
