"""Adapter: the driver's TPC-H-style tables -> the retail raw tables.

The driver tables carry no tenants, promotions, versions or dirty values, so
all of these are derived by fixed rules (the oracle SQL spells out the same
rules).  Everything here is narrow (projections, filters, generators) except
the promotion dimension, a distinct over the discounted line items, and two
joins with nation / region, which are fixed-size tables (25 and 5 rows at any
scale factor) and therefore broadcast.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions._util import ntz
from tillhouse.schemas import RAW_MT, RAW_ST, conform

# ---- fixed values of the derivation rules ---------------------------------
N_TENANTS = 3                       # tenant = 't' || (orderkey mod 3)
PAYMENT_BY_PRIORITY = ["cash", "debit", "credit", "e-wallet", "e-wallet"]
STATUS_BY_ORDERSTATUS = {"F": "completed", "O": "pending", "P": "cancelled"}
STORE_TYPES = ["minimarket", "supermarket", "express"]
PROMO_TYPES = ["discount", "bundle", "cashback"]
PROMO_DISCOUNT_PCT = [5, 10, 15, 20, 25]
PROMO_MIN_PURCHASE = [0, 25000, 50000, 100000]
N_PROMOS = 24                       # promo_id = partkey mod 24
N_PROMO_NAMES = 12                  # promo_name = 'Promo ' || promo_id mod 12
PROMO_MIN_DISCOUNT = 0.08           # a line with this discount or more used a promo
DIM_EPOCH = _dt.datetime(1994, 1, 1)
DIM_VERSION_TS = _dt.datetime(2020, 1, 1)
STORE_EPOCH = _dt.date(2015, 1, 1)
PROMO_EPOCH = _dt.date(1995, 1, 1)

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


class DriverTables:
    """Lazy access to ``{sf_dir}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


# ---- small rule helpers ----------------------------------------------------
def _pick(values, idx: Column) -> Column:
    """1-based lookup into a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int"))


def _plus_days(base, n: Column) -> Column:
    if isinstance(base, _dt.datetime):
        return F.timestamp_add("DAY", n, ntz(base))
    return F.date_add(F.lit(base), n.cast("int"))


def tenant_of(orderkey: Column) -> Column:
    return F.concat(F.lit("t"), F.pmod(orderkey, F.lit(N_TENANTS)).cast("string"))


def local_txn_id(orderkey: Column) -> Column:
    """Per-tenant transaction id; ids collide across tenants on purpose."""
    return F.floor(orderkey / F.lit(N_TENANTS)).cast("long")


def _all_tenants() -> Column:
    return F.explode(F.array(*[F.lit(f"t{i}") for i in range(N_TENANTS)]))


def _nations(t: DriverTables) -> DataFrame:
    # nation x region: 25 rows at every scale factor (TPC-H fixes both tables).
    return (t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", "r_name"))


def n_stores(t: DriverTables) -> Column:
    """Store count as a scalar subquery (no join, no driver round trip)."""
    return t.supplier.select(F.count(F.lit(1))).scalar()


# ---- single-tenant raw tables ---------------------------------------------
def raw_customers(t: DriverTables) -> DataFrame:
    k = F.col("c_custkey")
    df = t.customer.join(F.broadcast(_nations(t)), F.col("c_nationkey") == F.col("n_nationkey"))
    return conform(df.select(
        k.alias("customer_id"),
        F.when(k % 5 == 0, F.concat(F.lit(" "), "c_name", F.lit(" "))).otherwise(F.col("c_name")).alias("name"),
        F.concat(F.lit("08"), F.lpad(k.cast("string"), 10, "0")).alias("phone"),
        F.concat(F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@MAIL.TEST")).alias("email"),
        _pick(["Male", "Female", " MALE ", "female"], F.pmod(k, F.lit(4)) + 1).alias("gender"),
        F.when(k % 2 == 0, F.lower("n_name")).otherwise(F.concat(F.lit(" "), "n_name")).alias("city"),
        _plus_days(DIM_EPOCH, F.pmod(k, F.lit(365))).alias("created_at"),
    ), RAW_ST["customers"])


def raw_products(t: DriverTables) -> DataFrame:
    k = F.col("p_partkey")
    return conform(t.part.select(
        k.alias("product_id"),
        F.when(k % 7 == 0, F.concat("p_name", F.lit(" "))).otherwise(F.col("p_name")).alias("product_name"),
        F.when(k % 50 == 0, F.lit(None)).when(k % 3 == 0, F.lower("p_type"))
         .otherwise(F.col("p_type")).alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
        F.when(k % 10 == 0, F.lit(None)).when(k % 10 == 1, F.lit(0)).otherwise(F.lit(1)).alias("is_active"),
        _plus_days(DIM_EPOCH, F.pmod(k, F.lit(365))).alias("created_at"),
    ), RAW_ST["products"])


def _status(orderkey: Column) -> Column:
    base = (F.when(F.col("o_orderstatus") == "F", F.lit(STATUS_BY_ORDERSTATUS["F"]))
            .when(F.col("o_orderstatus") == "O", F.lit(STATUS_BY_ORDERSTATUS["O"]))
            .when(F.col("o_orderstatus") == "P", F.lit(STATUS_BY_ORDERSTATUS["P"])))
    return F.when(orderkey % 7 == 0, F.concat(F.lit(" "), F.upper(base), F.lit(" "))).otherwise(base)


def _payment(orderkey: Column) -> Column:
    base = _pick(PAYMENT_BY_PRIORITY, F.substring("o_orderpriority", 1, 1).cast("int"))
    return F.when(orderkey % 5 == 0, F.concat(F.lit(" "), F.upper(base))).otherwise(base)


def _order_cols(t: DriverTables, txn_id: Column) -> dict[str, Column]:
    k = F.col("o_orderkey")
    return {
        "transaction_id": txn_id,
        "customer_id": F.col("o_custkey"),
        "store_id": F.pmod(k, n_stores(t)),
        "transaction_date": F.col("o_orderdate"),
        "total_amount": F.col("o_totalprice").cast("decimal(14,2)"),
        "payment_method": _payment(k),
        "status": _status(k),
    }


def _named(cols: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in cols.items()]


def raw_transactions(t: DriverTables) -> DataFrame:
    return conform(t.orders.select(*_named(_order_cols(t, F.col("o_orderkey")))),
                   RAW_ST["transactions"])


def _item_id() -> Column:
    # (orderkey, linenumber) is not unique in the driver data; with part,
    # supplier and ship day it is.
    return F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                       F.to_date("l_shipdate").cast("string"))


def _subtotal() -> Column:
    return F.col("l_extendedprice").cast("decimal(14,2)")


def _unit_price() -> Column:
    # extended price / quantity, truncated to the cent, in exact integer cents
    cents = (_subtotal() * 100).cast("long")
    per_unit = F.floor(cents / F.col("l_quantity").cast("long")).cast("long")
    return (per_unit.cast("decimal(14,2)") / 100).cast("decimal(12,2)")


def _item_cols(txn_id: Column) -> list[Column]:
    return [
        _item_id().alias("item_id"),
        txn_id.alias("transaction_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _unit_price().alias("unit_price"),
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount"),
        _subtotal().alias("subtotal"),
    ]


def raw_transaction_items(t: DriverTables) -> DataFrame:
    return conform(t.lineitem.select(*_item_cols(F.col("l_orderkey"))), RAW_ST["transaction_items"])


def raw_single(t: DriverTables):
    from tillhouse.plans.lazy import LazyDict
    return LazyDict({"customers": lambda: raw_customers(t), "products": lambda: raw_products(t),
                     "transactions": lambda: raw_transactions(t),
                     "transaction_items": lambda: raw_transaction_items(t)})


# ---- multi-tenant raw tables (row versions) -------------------------------
def _versioned(df: DataFrame, table: str) -> DataFrame:
    return conform(df, RAW_MT[table])


def _dims_for_all_tenants(df: DataFrame, version_ts: Column, table: str) -> DataFrame:
    return _versioned(df.select(_all_tenants().alias("tenant_id"), "*",
                                version_ts.alias("updated_at"), F.lit(0).alias("_batch_id")), table)


def raw_mt_customers(t: DriverTables) -> DataFrame:
    c = raw_customers(t)
    return _dims_for_all_tenants(c, F.col("created_at"), "customers")


def raw_mt_products(t: DriverTables) -> DataFrame:
    p = raw_products(t)
    return _dims_for_all_tenants(p, F.col("created_at"), "products")


def raw_mt_stores(t: DriverTables) -> DataFrame:
    k = F.col("s_suppkey")
    s = t.supplier.join(F.broadcast(_nations(t)), F.col("s_nationkey") == F.col("n_nationkey"))
    stype = _pick(STORE_TYPES, F.pmod(k, F.lit(3)) + 1)
    s = s.select(
        k.alias("store_id"),
        F.when(k % 4 == 0, F.concat(F.lit(" "), "s_name")).otherwise(F.col("s_name")).alias("store_name"),
        F.when(k % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("city"),
        F.col("r_name").alias("province"),
        F.when(k % 2 == 1, F.upper(stype)).otherwise(stype).alias("store_type"),
        _plus_days(STORE_EPOCH, F.pmod(k, F.lit(1000))).alias("opened_at"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.lit(1)).alias("is_active"),
    )
    return _dims_for_all_tenants(s, ntz(DIM_VERSION_TS), "stores")


def raw_mt_suppliers(t: DriverTables) -> DataFrame:
    k = F.col("s_suppkey")
    s = t.supplier.join(F.broadcast(_nations(t)), F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.select(
        k.alias("supplier_id"), F.col("s_name").alias("supplier_name"),
        F.concat(F.lit("contact "), k.cast("string")).alias("contact_name"),
        F.col("n_name").alias("city"), F.col("r_name").alias("country"),
        ntz(DIM_VERSION_TS).alias("created_at"),
    )
    return _dims_for_all_tenants(s, F.col("created_at"), "suppliers")


def raw_mt_transactions(t: DriverTables) -> DataFrame:
    """Orders as row versions.

    Every order has a current version (batch 1, stamped a day after the order).
    Cancelled orders also have an older ``completed`` version (batch 0), and
    every fifth pending order a ``completed`` version with the *same* stamp in
    batch 0, so only the batch id decides.  Deduplicating after the status
    filter would resurrect both kinds.
    """
    k = F.col("o_orderkey")
    cols = _order_cols(t, local_txn_id(k))
    cancelled = F.col("o_orderstatus") == "P"
    base = t.orders.select(tenant_of(k).alias("tenant_id"), *_named(cols), cancelled.alias("_cancelled"),
                           (cancelled | ((F.col("o_orderstatus") == "O") & (k % 5 == 0))).alias("_old"),
                           F.timestamp_add("DAY", F.lit(1), F.col("o_orderdate")).alias("_cur_ts"))
    older = F.col("_batch_id") == 0
    out = _versions_of(base).withColumns({
        "status": F.when(older, F.lit(STATUS_BY_ORDERSTATUS["F"])).otherwise(F.col("status")),
        "updated_at": F.when(older & F.col("_cancelled"), F.col("transaction_date")).otherwise(F.col("_cur_ts"))})
    return _versioned(out, "transactions")


def _versions_of(base: DataFrame) -> DataFrame:
    """A row of batch 1 for every row and another of batch 0 where ``_old``.
    Only the batch number is generated: columns that nobody reads are not derived."""
    one, both = F.array(F.lit(1).cast("long")), F.array(F.lit(1).cast("long"), F.lit(0).cast("long"))
    return base.select("*", F.explode(F.when(F.col("_old"), both).otherwise(one)).alias("_batch_id"))


def raw_mt_transaction_items(t: DriverTables) -> DataFrame:
    """Line items as row versions; some first lines also have an older,
    doubled version in batch 0 that deduplication must discard.  Both come
    from one scan through a generator (no second pass, no union)."""
    k = F.col("l_orderkey")
    base = t.lineitem.select(tenant_of(k).alias("tenant_id"), *_item_cols(local_txn_id(k)),
                             F.col("l_shipdate").alias("_ts"),
                             ((F.col("l_linenumber") == 1) & (k % 11 == 0)).alias("_old"))
    older = F.col("_batch_id") == 0
    out = _versions_of(base).withColumns({
        "quantity": F.when(older, F.col("quantity") + 1).otherwise(F.col("quantity")),
        "subtotal": F.when(older, (F.col("subtotal") * 2).cast("decimal(14,2)")).otherwise(F.col("subtotal")),
        "updated_at": F.when(older, F.timestamp_add("DAY", F.lit(-1), F.col("_ts"))).otherwise(F.col("_ts"))})
    return _versioned(out, "transaction_items")


def _promo_lines(t: DriverTables) -> DataFrame:
    return t.lineitem.where(F.col("l_discount") >= F.lit(PROMO_MIN_DISCOUNT))


def promo_id_of(partkey: Column) -> Column:
    return F.pmod(partkey, F.lit(N_PROMOS)).cast("long")


def raw_mt_promotions(t: DriverTables) -> DataFrame:
    ids = (_promo_lines(t)
           .select(tenant_of(F.col("l_orderkey")).alias("tenant_id"),
                   promo_id_of(F.col("l_partkey")).alias("promo_id"))
           .distinct())
    p = F.col("promo_id")
    name = F.concat(F.lit("Promo "), F.pmod(p, F.lit(N_PROMO_NAMES)).cast("string"))
    ptype = _pick(PROMO_TYPES, F.pmod(p, F.lit(3)) + 1)
    start = _plus_days(PROMO_EPOCH, p * 30)
    out = ids.select(
        "tenant_id", "promo_id",
        F.when(p % 5 == 0, F.concat(F.lit(" "), name)).otherwise(name).alias("promo_name"),
        F.when(p % 2 == 1, F.upper(ptype)).otherwise(ptype).alias("promo_type"),
        _pick(PROMO_DISCOUNT_PCT, F.pmod(p, F.lit(5)) + 1).cast("decimal(5,2)").alias("discount_pct"),
        start.alias("start_date"),
        F.date_add(start, 90).alias("end_date"),
        _pick(PROMO_MIN_PURCHASE, F.pmod(p, F.lit(4)) + 1).cast("decimal(12,2)").alias("min_purchase"),
        ntz(DIM_VERSION_TS).alias("updated_at"),
        F.lit(0).cast("long").alias("_batch_id"))
    return _versioned(out, "promotions")


def raw_mt_transaction_promotions(t: DriverTables) -> DataFrame:
    k = F.col("l_orderkey")
    out = _promo_lines(t).select(
        tenant_of(k).alias("tenant_id"),
        _item_id().alias("id"),
        local_txn_id(k).alias("transaction_id"),
        promo_id_of(F.col("l_partkey")).alias("promo_id"),
        (_subtotal() * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(12,2)").alias("discount_applied"),
        F.col("l_shipdate").alias("updated_at"),
        F.lit(0).cast("long").alias("_batch_id"))
    return _versioned(out, "transaction_promotions")


def raw_multi(t: DriverTables):
    from tillhouse.plans.lazy import LazyDict
    return LazyDict({
        "customers": lambda: raw_mt_customers(t), "products": lambda: raw_mt_products(t),
        "transactions": lambda: raw_mt_transactions(t),
        "transaction_items": lambda: raw_mt_transaction_items(t),
        "stores": lambda: raw_mt_stores(t), "suppliers": lambda: raw_mt_suppliers(t),
        "promotions": lambda: raw_mt_promotions(t),
        "transaction_promotions": lambda: raw_mt_transaction_promotions(t),
    })
