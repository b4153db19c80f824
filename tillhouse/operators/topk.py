"""Top-k per group (W1, W2), global top-k (O2), last n distinct values (O3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _orders(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def top_k_per(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int,
              rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..k per group by ``order`` (give a full tie-break).

    ``row_number <= k`` is rewritten by Catalyst into a partial
    ``WindowGroupLimit`` ahead of the exchange, so each group ships at most
    k rows per map partition even when one group holds most of the data.
    """
    rn = rank_col or "_rn"
    w = Window.partitionBy(*group).orderBy(*_orders(order))
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= k)
    return out if rank_col else out.drop(rn)


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """Global top-k: ``TakeOrderedAndProject`` (per-partition top-k, then merge)."""
    return df.orderBy(*_orders(order)).limit(k)


def last_n_distinct(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n greatest distinct values of ``col`` actually observed (at most n rows)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(F.col(col).desc()).limit(n)
