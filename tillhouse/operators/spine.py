"""Date spine (D1): one row per day from the first to the last day seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine(df: DataFrame, day_col: str, out: str = "date_day") -> DataFrame:
    """Every calendar day between min and max of ``day_col`` (inclusive).

    One global min/max (partial aggregation, one row crosses the shuffle), then
    a generator; the output is bounded by the calendar, not by the data.  An
    empty input gives no rows.
    """
    bounds = df.agg(F.min(day_col).alias("_lo"), F.max(day_col).alias("_hi"))
    return (bounds.where(F.col("_lo").isNotNull())
            .select(F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias(out)))
