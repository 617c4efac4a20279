"""Edge rows for every column function: boundaries and NULLs."""

import datetime as dt

from pyspark.sql import functions as F

from lastmile.functions import columns as C


def _eval(spark, values, expr, schema):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_value_bucket_edges_and_null(spark):
    got = _eval(spark, [199.99, 200.0, 499.99, 500.0, None], C.value_bucket("x"), "x double")
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


def test_time_slot_hour_edges(spark):
    hours = [10, 11, 14, 15, 17, 18, 22, 23, None]
    got = _eval(spark, hours, C.time_slot("x"), "x int")
    assert got == ["OFF_PEAK", "LUNCH", "LUNCH", "OFF_PEAK", "OFF_PEAK", "DINNER", "DINNER", "OFF_PEAK", "OFF_PEAK"]


def test_delay_bucket_edges_and_null(spark):
    got = _eval(spark, [-5.0, 0.0, 0.5, 10.0, 10.5, None], C.delay_bucket("x"), "x double")
    assert got == ["ON_TIME", "ON_TIME", "MINOR_DELAY", "MINOR_DELAY", "MAJOR_DELAY", "MAJOR_DELAY"]


def test_breach_flag_null_delay_is_not_breached(spark):
    got = _eval(spark, [-1.0, 0.0, 0.1, None], C.breach_flag("x"), "x double")
    assert got == [0, 0, 1, 0]


def test_minutes_between_floors_to_whole_seconds(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10, 0, 0, 900000), dt.datetime(2024, 1, 1, 10, 1, 2, 100000))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    # floor(b) - floor(a) = 62 seconds
    assert df.select(C.minutes_between("a", "b")).first()[0] == 62 / 60


def test_week_start_is_monday(spark):
    days = [dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2024, 12, 31), dt.date(2025, 1, 5)]
    got = _eval(spark, days, C.week_start("x"), "x date")
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 12, 30), dt.date(2024, 12, 30)]


def test_refund_class_order(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1)], "b int, s int")
    got = [r[0] for r in df.select(C.refund_class("b", "s")).collect()]
    assert got == ["DELAY", "DELAY", "CANCELLATION", "OTHER"]


def test_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "n long, d long")
    assert [r[0] for r in df.select(C.ratio("n", "d")).collect()] == [None, 0.25]


def test_money_sum_cuts_nothing(spark):
    def total(values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(C.money_sum("x")).first()[0]

    assert total([0.1, 0.2, 0.3]) == 0.6
    assert total([0.004] * 3) == 0.012
    assert total([1e17, 0.25]) == 1e17
    assert total([1e30, 1.0]) == 1e30
    assert total([None, 0.5]) == 0.5 and total([None]) is None


def test_exact_minutes_keep_the_fraction(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10, 0, 0, 900000), dt.datetime(2024, 1, 1, 10, 1, 2, 100000)), (None, None)],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in df.select(C.exact_minutes_between("a", "b")).collect()] == [61.2 / 60, None]


def test_doc_time_slot(spark):
    hours = [7, 8, 11, 12, 15, 16, 19, 20, 23, 0]
    got = _eval(spark, hours, C.doc_time_slot("x"), "x int")
    assert got == ["late_night", "morning", "morning", "lunch", "lunch", "evening", "evening", "dinner", "dinner", "late_night"]


def test_refund_category_map(spark):
    reasons = ["Delay", "Missing_Items", "Wrong_Order", "Cancellation", "Quality_Issue", None, "DELAY", " missing_item "]
    got = _eval(spark, reasons, C.refund_category("x"), "x string")
    assert got == ["Delay", "Missing Items", "Missing Items", "Cancellation", "Other", "Other", "Delay", "Missing Items"]


def test_risk_and_tier(spark):
    df = spark.createDataFrame(
        [(26.0, 31.0), (26.0, 30.0), (21.0, 21.0), (20.0, 50.0)], "a double, r double"
    )
    got = [x[0] for x in df.select(C.risk_class("a", "r")).collect()]
    assert got == ["High Risk", "Medium Risk", "Medium Risk", "Low Risk"]
    df = spark.createDataFrame(
        [(0.95, True), (0.95, False), (0.90, True), (0.80, False), (0.79, True)], "r double, a boolean"
    )
    got = [x[0] for x in df.select(C.rider_tier("r", "a")).collect()]
    assert got == ["Star Performer", "Meets Expectations", "Meets Expectations", "Needs Improvement", "At Risk"]


def test_three_valued_breach(spark):
    df = spark.createDataFrame(
        [(None, dt.datetime(2024, 1, 1)), (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)),
         (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
        "d timestamp_ntz, p timestamp_ntz",
    )
    assert [r[0] for r in df.select(C.breached_or_null("d", "p")).collect()] == [None, True, False]


def test_day_of_week_sunday_is_one(spark):
    got = _eval(spark, [dt.date(2024, 1, 7), dt.date(2024, 1, 13)], F.col("x"), "x date")
    df = spark.createDataFrame([(d,) for d in got], "x date")
    dows = [r[0] for r in df.select(C.day_of_week("x")).collect()]
    assert dows == [1, 7]
    assert [r[0] for r in df.select(C.is_weekend(C.day_of_week("x"))).collect()] == [True, True]
