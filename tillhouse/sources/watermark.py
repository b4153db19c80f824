"""High-water-mark state for incremental loads (S9, S10) and file slicing (S2).

The state is an append-only table ``(tenant_id, table_name, watermark,
run_id)``; the current value of a (tenant, table) is the one of its latest
run.  Its size is tenants x tables - configuration, not data - so it is the
only thing joined by broadcast here.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions._util import ntz
from tillhouse.schemas import WATERMARK_STATE

EPOCH = _dt.datetime(1970, 1, 1)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], WATERMARK_STATE)


def current(state: DataFrame) -> DataFrame:
    """Current watermark per (tenant, table): the value of the latest run."""
    return (state.groupBy("tenant_id", "table_name")
                 .agg(F.max_by("watermark", "run_id").alias("watermark")))


def slice_since(df: DataFrame, state: DataFrame, table: str, version_col: str = "updated_at",
                tenant_col: str = "tenant_id") -> DataFrame:
    """Rows of ``df`` newer than their tenant's watermark for ``table`` (strict
    ``>``); a tenant without state starts at the epoch."""
    wm = (current(state).where(F.col("table_name") == table)
          .select(F.col("tenant_id").alias(tenant_col), F.col("watermark").alias("_wm")))
    return (df.join(wm, tenant_col, "left")
              .where(F.col(version_col) > F.coalesce(F.col("_wm"), ntz(EPOCH)))
              .drop("_wm"))


def batch_watermarks(batch: DataFrame, table: str, run_id: int, version_col: str = "updated_at",
                     tenant_col: str = "tenant_id") -> DataFrame:
    """Max version of the new rows per tenant, truncated to whole seconds.

    Truncation re-pulls the rows of the last fractional second next run (the
    filter is strict), which dedup makes harmless and which also catches late
    rows of that second.
    """
    return (batch.groupBy(F.col(tenant_col).alias("tenant_id"))
                 .agg(F.date_trunc("second", F.max(version_col)).cast("timestamp_ntz").alias("watermark"))
                 .select("tenant_id", F.lit(table).alias("table_name"), "watermark",
                         F.lit(run_id).cast("long").alias("run_id")))


def advance(state: DataFrame, new_marks: DataFrame, run_id: int) -> DataFrame:
    """State rows for ``run_id``: the new mark where a tenant/table had rows,
    the old one otherwise (a table with no new rows keeps its watermark)."""
    old = current(state).alias("o")
    new = new_marks.alias("n")
    on = (F.col("o.tenant_id") == F.col("n.tenant_id")) & (F.col("o.table_name") == F.col("n.table_name"))
    return (old.join(new, on, "full_outer")
               .select(F.coalesce("n.tenant_id", "o.tenant_id").alias("tenant_id"),
                       F.coalesce("n.table_name", "o.table_name").alias("table_name"),
                       F.coalesce("n.watermark", "o.watermark").alias("watermark"),
                       F.lit(run_id).cast("long").alias("run_id")))
