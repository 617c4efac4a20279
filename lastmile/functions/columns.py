"""Column expressions for the fulfilment measures.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
NULL behaviour is part of each definition and is spelled out per function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- fixed values of the definitions ---------------------------------------------------
VALUE_LOW_BELOW = 200            # order value < 200 -> LOW
VALUE_MEDIUM_BELOW = 500         # order value < 500 -> MEDIUM, else HIGH
LUNCH_HOURS = (11, 14)           # inclusive
DINNER_HOURS = (18, 22)          # inclusive
MINOR_DELAY_MAX = 10             # minutes
UNKNOWN_PAYMENT = "UNKNOWN"
# Five-way slot of the documented model: (first hour, last hour, name), inclusive.
DOC_SLOTS = ((8, 11, "morning"), (12, 15, "lunch"), (16, 19, "evening"), (20, 23, "dinner"))
DOC_SLOT_OTHER = "late_night"
# Documented refund reason -> driver category (upper-cased raw reason on the left).
# The documented spellings and the generator's spellings (MISSING_ITEM, CUSTOMER_CANCEL)
# are both listed; anything else, and NULL, is "Other".
REFUND_CATEGORY = {
    "DELAY": "Delay",
    "MISSING_ITEMS": "Missing Items",
    "MISSING_ITEM": "Missing Items",
    "WRONG_ORDER": "Missing Items",
    "CANCELLATION": "Cancellation",
    "CUSTOMER_CANCEL": "Cancellation",
    "QUALITY_ISSUE": "Other",
}
REFUND_CATEGORY_OTHER = "Other"
PREP_DELAY_THRESHOLD = 20        # minutes
# Risk classes: (name, avg prep above, delay rate % above)
RISK_CLASSES = (("High Risk", 25, 30), ("Medium Risk", 20, 20))
RISK_OTHER = "Low Risk"
# Rider tiers: (name, on-time rate at least, must be at or above the city average)
RIDER_TIERS = (
    ("Star Performer", 0.95, True),
    ("Meets Expectations", 0.90, False),
    ("Needs Improvement", 0.80, False),
)
RIDER_TIER_OTHER = "At Risk"
MIN_RESTAURANT_ORDERS = 10
MIN_RIDER_DELIVERIES = 10


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """(end - start) in minutes as double, on whole seconds; NULL if either is NULL."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / 60


def exact_minutes_between(start: str | Column, end: str | Column) -> Column:
    """(end - start) in minutes as double, microseconds counted; NULL if either is NULL."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / 60_000_000


def flag(cond: Column) -> Column:
    """int 1 when ``cond`` is true, else 0 (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def present_flag(c: str | Column) -> Column:
    """int 1 when the value is present, 0 when NULL."""
    return F.when(_c(c).isNull(), F.lit(0)).otherwise(F.lit(1))


def breach_flag(delay_minutes: str | Column) -> Column:
    """1 when the delay is positive; a NULL delay (never delivered) is 0."""
    return flag(_c(delay_minutes) > 0)


def payment_or_unknown(c: str | Column) -> Column:
    return F.coalesce(_c(c), F.lit(UNKNOWN_PAYMENT))


def value_bucket(value: str | Column) -> Column:
    """LOW below 200, MEDIUM below 500, otherwise HIGH — NULL falls through to HIGH."""
    v = _c(value)
    return (
        F.when(v < VALUE_LOW_BELOW, F.lit("LOW"))
        .when(v < VALUE_MEDIUM_BELOW, F.lit("MEDIUM"))
        .otherwise(F.lit("HIGH"))
    )


def time_slot(hour: str | Column) -> Column:
    """LUNCH for hours 11-14, DINNER for 18-22 (inclusive), otherwise OFF_PEAK."""
    h = _c(hour)
    return (
        F.when(h.between(*LUNCH_HOURS), F.lit("LUNCH"))
        .when(h.between(*DINNER_HOURS), F.lit("DINNER"))
        .otherwise(F.lit("OFF_PEAK"))
    )


def delay_bucket(delay_minutes: str | Column) -> Column:
    """ON_TIME at or below 0, MINOR_DELAY up to 10, else MAJOR_DELAY — NULL is MAJOR."""
    d = _c(delay_minutes)
    return (
        F.when(d <= 0, F.lit("ON_TIME"))
        .when(d <= MINOR_DELAY_MAX, F.lit("MINOR_DELAY"))
        .otherwise(F.lit("MAJOR_DELAY"))
    )


def refund_class(breach: str | Column, success: str | Column) -> Column:
    """DELAY for breached orders, else CANCELLATION when not delivered, else OTHER."""
    return (
        F.when(_c(breach) == 1, F.lit("DELAY"))
        .when(_c(success) == 0, F.lit("CANCELLATION"))
        .otherwise(F.lit("OTHER"))
    )


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator as double; NULL instead of an error on a zero denominator."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator))


def week_start(d: str | Column) -> Column:
    """Monday of the ISO week of a date or timestamp, as a date."""
    return F.trunc(F.to_date(_c(d)), "week")


MEAN_DECIMALS = 12


def stable_mean(c: str | Column) -> Column:
    """Mean of doubles rounded to 12 decimals, so it does not depend on summation order."""
    return F.round(F.avg(_c(c)), MEAN_DECIMALS)


def ordered_mean(c: str | Column) -> Column:
    """Mean of doubles added up from the smallest, so it does not depend on the order of rows and
    is not rounded. Holds a group's values: for groups of mart rows."""
    values = F.array_sort(F.collect_list(_c(c)))
    return F.try_divide(F.aggregate(values, F.lit(0.0), lambda total, x: total + x), F.size(values))


MONEY_TYPE = "decimal(38,10)"


def money_sum(c: str | Column) -> Column:
    """Sum of money held as double, independent of row order: added up exactly at ten decimals and
    turned into a double once. If an amount or the sum is beyond 28 digits (or not a number),
    the plain sum of doubles."""
    amount = _c(c)
    exact = amount.try_cast(MONEY_TYPE)
    return F.when(F.count(exact) == F.count(amount), F.coalesce(F.try_sum(exact).cast("double"), F.sum(amount))).otherwise(
        F.sum(amount)
    )


# -- documented variants ---------------------------------------------------------------
def clean_text(c: str | Column) -> Column:
    return F.upper(F.trim(_c(c)))


def non_negative(c: str | Column) -> Column:
    """Negative values become NULL."""
    return F.when(_c(c) >= 0, _c(c))


def day_of_week(c: str | Column) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(_c(c))


def is_weekend(dow: str | Column) -> Column:
    return _c(dow).isin(1, 7)


def doc_time_slot(hour: str | Column) -> Column:
    h = _c(hour)
    expr = None
    for lo, hi, name in DOC_SLOTS:
        expr = (F.when if expr is None else expr.when)(h.between(lo, hi), F.lit(name))
    return expr.otherwise(F.lit(DOC_SLOT_OTHER))


def refund_category(reason: str | Column) -> Column:
    r = F.upper(F.trim(_c(reason)))
    expr = None
    for raw, category in REFUND_CATEGORY.items():
        expr = (F.when if expr is None else expr.when)(r == raw, F.lit(category))
    return expr.otherwise(F.lit(REFUND_CATEGORY_OTHER))


def breached_or_null(delivered: str | Column, promised: str | Column) -> Column:
    """Three-valued breach: NULL when not delivered, else delivered after promised."""
    d, p = _c(delivered), _c(promised)
    return F.when(d.isNull(), F.lit(None).cast("boolean")).otherwise(d > p)


def risk_class(avg_prep: str | Column, delay_rate_pct: str | Column) -> Column:
    a, r = _c(avg_prep), _c(delay_rate_pct)
    expr = None
    for name, avg_above, rate_above in RISK_CLASSES:
        expr = (F.when if expr is None else expr.when)((a > avg_above) & (r > rate_above), F.lit(name))
    return expr.otherwise(F.lit(RISK_OTHER))


def rider_tier(on_time_rate: str | Column, at_or_above_city_avg: str | Column) -> Column:
    r, above = _c(on_time_rate), _c(at_or_above_city_avg)
    expr = None
    for name, min_rate, needs_avg in RIDER_TIERS:
        cond = (r >= min_rate) & above if needs_avg else r >= min_rate
        expr = (F.when if expr is None else expr.when)(cond, F.lit(name))
    return expr.otherwise(F.lit(RIDER_TIER_OTHER))
