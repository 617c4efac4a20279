"""The documented macros as SQL functions of a session, for use in SQL text and views.

They are SQL expressions, so the optimizer puts their bodies in the place of the calls: the plan is
that of the Column forms in ``functions.columns``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lastmile.functions.columns import DOC_SLOT_OTHER, DOC_SLOTS

DATEDIFF_MINUTES, TIME_SLOT = "datediff_minutes", "time_slot"


def register(spark: SparkSession, prefix: str = "") -> dict[str, str]:
    """Create the temporary functions; their names by macro. A function of that name is replaced."""
    names = {m: f"{prefix}{m}" for m in (DATEDIFF_MINUTES, TIME_SLOT)}
    spark.sql(
        f"create or replace temporary function {names[DATEDIFF_MINUTES]}(started timestamp_ntz, ended timestamp_ntz) returns double "
        "return timestampdiff(MICROSECOND, started, ended) / 60000000D"
    )
    slots = " ".join(f"when hour_of_day between {lo} and {hi} then '{name}'" for lo, hi, name in DOC_SLOTS)
    spark.sql(
        f"create or replace temporary function {names[TIME_SLOT]}(hour_of_day int) returns string "
        f"return case {slots} else '{DOC_SLOT_OTHER}' end"
    )
    return names
