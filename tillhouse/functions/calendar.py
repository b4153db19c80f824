"""Calendar parts for the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.functions._util import as_col

# English month abbreviations and day names (1-based lookups,
# independent of the JVM locale).
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
              "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
             "Saturday", "Sunday"]


def iso_dow(d) -> Column:
    """ISO day of week, 1 = Monday .. 7 = Sunday (``dayofweek`` is Sunday = 1)."""
    return (F.weekday(as_col(d)) + 1).cast("int")


def year_month(d) -> Column:
    return F.date_format(as_col(d), "yyyy-MM")


def month_label(d) -> Column:
    """``Jan 2026``."""
    d = as_col(d)
    return F.concat(F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBR]), F.month(d)),
                    F.lit(" "), F.year(d).cast("string"))


def day_name(d) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in DAY_NAMES]), iso_dow(d))


def is_weekend(d) -> Column:
    return F.when(iso_dow(d) >= 6, F.lit(1)).otherwise(F.lit(0))
