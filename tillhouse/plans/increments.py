"""Load-layer results over the driver's tables (registered as queries).

``events`` serves as a versioned source: tenant = ``event_type``, key =
``(event_type, user_id)``, version = ``ts`` (microseconds), tie-break =
``event_id``.  A first load is simulated as the rows before a fixed instant;
the second load is then the incremental slice against the state the first
one left, and the advanced state follows from it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions._util import ntz
from tillhouse.functions import initcap_alnum, surrogate_key
from tillhouse.operators import latest_by_key
from tillhouse.schemas import RAW_MT, conform
from tillhouse.sources import landing, watermark
from tillhouse.sources.jdbc import fan_in
from tillhouse.sources.tpch import N_TENANTS, DriverTables, _named, _order_cols, local_txn_id, raw_multi

FIRST_LOAD_BEFORE = _dt.datetime(2024, 1, 15)   # the first simulated load saw events before this
EVENTS_TABLE = "events"


def event_versions(t: DriverTables) -> DataFrame:
    return t.events.select(F.col("event_type").alias("tenant_id"), "user_id", "event_id",
                           F.col("ts").alias("updated_at"), "value")


def latest_events(t: DriverTables) -> DataFrame:
    return latest_by_key(t.events, ["event_type", "user_id"], "ts", ["event_id"])


def compaction_merge(t: DriverTables) -> DataFrame:
    """The events compacted up to the first load, merged with every later
    event: must equal deduplicating all events at once."""
    keys = ["event_type", "user_id"]
    cut = ntz(FIRST_LOAD_BEFORE)
    base = latest_by_key(t.events.where(F.col("ts") < cut), keys, "ts", ["event_id"])
    delta = t.events.where(F.col("ts") >= cut)
    return landing.merge_versions(base, delta, keys, "ts", ("event_id",))


def _first_state(t: DriverTables) -> DataFrame:
    v = event_versions(t)
    first = v.where(F.col("updated_at") < ntz(FIRST_LOAD_BEFORE))
    return watermark.advance(watermark.empty_state(t.spark),
                             watermark.batch_watermarks(first, EVENTS_TABLE, 1), 1)


def incremental_slice(t: DriverTables) -> DataFrame:
    return watermark.slice_since(event_versions(t), _first_state(t), EVENTS_TABLE)


def watermark_after_second_load(t: DriverTables) -> DataFrame:
    state1 = _first_state(t)
    new = watermark.batch_watermarks(incremental_slice(t), EVENTS_TABLE, 2)
    return watermark.advance(state1, new, 2)


def tenant_union(t: DriverTables) -> DataFrame:
    """Current transaction versions assembled from one source per tenant."""
    k = F.col("o_orderkey")
    per_tenant = {
        f"t{i}": t.orders.where(F.pmod(k, F.lit(N_TENANTS)) == i)
                         .select(*_named(_order_cols(t, local_txn_id(k))))
        for i in range(N_TENANTS)
    }
    u = fan_in(per_tenant).withColumn("updated_at", F.lit(None).cast("timestamp_ntz")) \
                          .withColumn("_batch_id", F.lit(0).cast("long"))
    return conform(u, RAW_MT["transactions"]).drop("updated_at", "_batch_id")


def raw_load_audit(t: DriverTables) -> DataFrame:
    return landing.load_audit(raw_multi(t))


def key_examples(t: DriverTables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        surrogate_key("c_custkey").alias("key_id"),
        surrogate_key("c_name", "c_mktsegment").alias("key_pair"),
        surrogate_key("c_mktsegment", F.lit(None).cast("string")).alias("key_with_null"))


def title_examples(t: DriverTables) -> DataFrame:
    return t.part.select("p_partkey", initcap_alnum("p_name").alias("name_title"),
                         initcap_alnum("p_type").alias("type_title"),
                         initcap_alnum("p_brand").alias("brand_title"))
