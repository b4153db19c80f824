"""Latest version per key (D2) - the replacing-table ``FINAL`` read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], version: str = "updated_at",
                  tie_break: Sequence[str] = ("_batch_id",), within: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the greatest ``version`` per key; ties go to the
    greatest ``tie_break`` (the last batch written wins).

    ``row_number() = 1`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so a hot key with millions of versions sends at most one
    row per map partition through the exchange.

    Rows are sorted by the last key first: of ``tenant_id`` and an id, the id
    tells rows apart without a look at the rest.  ``within`` names columns that
    follow from the key and come before it.
    """
    order = [F.col(version).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_break]
    w = Window.partitionBy(*within, *reversed(keys)).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))
