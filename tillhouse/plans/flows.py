"""Whole load flows over the driver's tables, written, read back and registered
as queries: what the jobs store equals what the models define (S5-S7, S11, S12, D3)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.plans import incremental, jobs
from tillhouse.plans.warehouse import pinned_loaded_at
from tillhouse.schemas import RAW_MT
from tillhouse.session import scratch_path
from tillhouse.sources import landing
from tillhouse.sources.manifest import PublishedTable
from tillhouse.sources.tpch import DriverTables, raw_multi, raw_single

FACT_TABLES = ("transactions", "transaction_items", "transaction_promotions")


def _root(t: DriverTables, name: str) -> str:
    return scratch_path(t.spark, f"flow-{name}-{uuid.uuid4().hex}")


def full_load(t: DriverTables, table: str) -> DataFrame:
    """A raw table after two full loads, the first of which was empty."""
    root, source = _root(t, "full"), {table: raw_single(t)[table]}
    jobs.load_full(t.spark, {table: source[table].limit(0)}, root)
    jobs.load_full(t.spark, source, root)
    return jobs.read_tables(t.spark, root, [table])[table]


def compaction_days(t: DriverTables) -> DataFrame:
    """Events landed as four batches by day of the month and compacted: batch 2
    first lands in part and with other values, is compacted and retried; the
    compaction after batch 3 is skipped; batch 4 is empty; batch 5 is the rest."""
    root, keys = _root(t, "days"), ["event_type", "user_id"]
    table = PublishedTable(t.spark, f"{root}/compact")
    part = F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 8)).cast("int")

    def land(batch, df):
        landing.append_versions(df, f"{root}/landing", batch, "event_type")

    def compact(up_to):
        landed = t.spark.read.schema(schema).parquet(f"{root}/landing").select(*columns, "_batch_id")
        return landing.compact(landed, table, keys, "ts", ("_batch_id", "event_id"), buckets=16, up_to=up_to)

    columns = t.events.columns
    schema = t.events.withColumn("_batch_id", F.lit(0).cast("long")).schema
    by_day = [t.events.where(part == i) for i in range(4)]
    land(1, by_day[0])
    compact(1)
    land(2, by_day[1].where("event_id % 2 = 0").withColumn("value", F.col("value") + 1))
    compact(2)
    land(2, by_day[1])
    land(3, by_day[2])
    land(4, t.events.limit(0))
    compact(4)
    land(5, by_day[3])
    compact(5)
    return compact(5).select(*columns)


def incremental_fact(t: DriverTables, fact: str) -> DataFrame:
    """A fact after three runs: the older versions of all tenants, then the
    current ones of two tenants, then those of the third."""
    root, raw = _root(t, "facts"), raw_multi(t)
    out = None
    runs = {1: F.col("_batch_id") == 0,
            2: (F.col("_batch_id") == 1) & F.col("tenant_id").isin("t0", "t1"),
            3: (F.col("_batch_id") == 1) & (F.col("tenant_id") == "t2")}
    names = [n for n in FACT_TABLES if n in ("transactions", incremental.FACTS[fact][0])]
    for run, rows in runs.items():
        for name in names:
            landing.append_versions(raw[name].where(rows), f"{root}/landing/{name}", run)
        compacted = jobs.compact_tables(t.spark, f"{root}/landing", f"{root}/compact", names, run, buckets=16)
        out = incremental.build_facts(t.spark, compacted, f"{root}/landing", f"{root}/marts", run, RAW_MT,
                                      pinned_loaded_at(), [fact])
    return out[fact]


def daily_build(t: DriverTables, mart: str) -> DataFrame:
    """A mart as the scheduled job stores it: single- or multi-tenant by its name."""
    root = _root(t, "build")
    if mart in ("fact_sales", "dim_customer", "dim_product", "dim_date"):
        raw = jobs.land_raw_single(t.spark, raw_single(t), f"{root}/raw")
        return jobs.build_single(t.spark, raw, f"{root}/marts", pinned_loaded_at())[mart]
    raw = jobs.land_raw_multi(t.spark, raw_multi(t), f"{root}/landing", 0)
    return jobs.build_multi(t.spark, raw, f"{root}/marts", pinned_loaded_at())[mart]
