from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value) -> Column:
    """A ``timestamp_ntz`` literal from a naive ``datetime``, built from its text
    so no time zone (driver or session) can shift it."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
