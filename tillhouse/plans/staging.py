"""Staging models: cleaned views over the raw tables (lazy DataFrames).

Single tenant (ST) models read a full snapshot; multi-tenant (MT) models read
row versions and keep the latest per ``(tenant_id, pk)`` *before* any filter,
so a transaction that moved from completed to cancelled stays out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import clean_title, norm, strip
from tillhouse.operators import latest_by_key
from tillhouse.plans.lazy import LazyDict
from tillhouse.schemas import MT_KEYS

COMPLETED = "completed"


def _latest(raw: DataFrame, table: str, deduplicated: bool = False) -> DataFrame:
    """Latest version per (tenant_id, pk); a compacted input (one row per key
    already, see ``landing.merge_versions``) is taken as it is."""
    return raw if deduplicated else latest_by_key(raw, ["tenant_id", MT_KEYS[table]])


# ---- single tenant ----------------------------------------------------------
def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select("customer_id", strip("name").alias("customer_name"), "phone",
                      norm("email").alias("email"), norm("gender").alias("gender"),
                      clean_title("city").alias("city"), "created_at")


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select("product_id", strip("product_name").alias("product_name"),
                      clean_title("category").alias("category"), strip("brand").alias("brand"),
                      "unit_price", F.coalesce("is_active", F.lit(1)).alias("is_active"))


def _transactions(df: DataFrame, lead: list[str]) -> DataFrame:
    return (df.where(norm("status") == COMPLETED)
              .select(*lead, "transaction_id", "customer_id", "store_id", "transaction_date",
                      F.to_date("transaction_date").alias("transaction_day"), "total_amount",
                      norm("payment_method").alias("payment_method"),
                      norm("status").alias("status")))


def stg_transactions(raw: DataFrame) -> DataFrame:
    return _transactions(raw, [])


def stg_transaction_items(raw: DataFrame) -> DataFrame:
    return raw.select("item_id", "transaction_id", "product_id", "quantity", "unit_price",
                      "discount", "subtotal")


# ---- multi tenant -----------------------------------------------------------
def stg_customers_mt(raw: DataFrame, deduplicated: bool = False) -> DataFrame:
    return _latest(raw, "customers", deduplicated).select(
        "tenant_id", "customer_id", strip("name").alias("customer_name"), "phone",
        norm("email").alias("email"), norm("gender").alias("gender"),
        clean_title("city").alias("city"), "created_at", "updated_at")


def stg_products_mt(raw: DataFrame, deduplicated: bool = False) -> DataFrame:
    return _latest(raw, "products", deduplicated).select(
        "tenant_id", "product_id", strip("product_name").alias("product_name"),
        clean_title("category").alias("category"), strip("brand").alias("brand"),
        "unit_price", F.coalesce("is_active", F.lit(1)).alias("is_active"))


def stg_transactions_mt(raw: DataFrame, deduplicated: bool = False) -> DataFrame:
    return _transactions(_latest(raw, "transactions", deduplicated), ["tenant_id"])


def stg_transaction_items_mt(raw: DataFrame, deduplicated: bool = False) -> DataFrame:
    return _latest(raw, "transaction_items", deduplicated).select(
        "tenant_id", "item_id", "transaction_id", "product_id", "quantity", "unit_price",
        "discount", "subtotal")


def stg_stores(raw: DataFrame, deduplicated: bool = False) -> DataFrame:
    return _latest(raw, "stores", deduplicated).select(
        "tenant_id", "store_id", strip("store_name").alias("store_name"),
        clean_title("city").alias("city"), "province", norm("store_type").alias("store_type"),
        "opened_at", F.coalesce("is_active", F.lit(1)).alias("is_active"))


def stg_promotions(raw: DataFrame, deduplicated: bool = False) -> DataFrame:
    return _latest(raw, "promotions", deduplicated).select(
        "tenant_id", "promo_id", strip("promo_name").alias("promo_name"),
        norm("promo_type").alias("promo_type"), "discount_pct", "start_date", "end_date",
        "min_purchase")


def stg_transaction_promotions(raw: DataFrame, deduplicated: bool = False) -> DataFrame:
    return _latest(raw, "transaction_promotions", deduplicated).select(
        "tenant_id", "id", "transaction_id", "promo_id", "discount_applied")


def stg_suppliers(raw: DataFrame, deduplicated: bool = False) -> DataFrame:
    return _latest(raw, "suppliers", deduplicated).select(
        "tenant_id", "supplier_id", strip("supplier_name").alias("supplier_name"),
        "contact_name", clean_title("city").alias("city"), "country")


SINGLE = {"stg_customers": (stg_customers, "customers"), "stg_products": (stg_products, "products"),
          "stg_transactions": (stg_transactions, "transactions"),
          "stg_transaction_items": (stg_transaction_items, "transaction_items")}
MULTI = {"stg_customers_mt": (stg_customers_mt, "customers"),
         "stg_products_mt": (stg_products_mt, "products"),
         "stg_transactions_mt": (stg_transactions_mt, "transactions"),
         "stg_transaction_items_mt": (stg_transaction_items_mt, "transaction_items"),
         "stg_stores": (stg_stores, "stores"), "stg_promotions": (stg_promotions, "promotions"),
         "stg_transaction_promotions": (stg_transaction_promotions, "transaction_promotions"),
         "stg_suppliers": (stg_suppliers, "suppliers")}


def _layer(models, raw, **kw) -> LazyDict:
    return LazyDict({name: (lambda fn=fn, t=t: fn(raw[t], **kw)) for name, (fn, t) in models.items()})


def staging_single(raw: Mapping[str, DataFrame]) -> LazyDict:
    """The four single-tenant staging models (each built on first use)."""
    return _layer(SINGLE, raw)


def staging_multi(raw: Mapping[str, DataFrame], deduplicated: bool = False) -> LazyDict:
    """The eight multi-tenant staging models (each built on first use);
    ``deduplicated`` when ``raw`` holds compacted tables (one row per key)."""
    return _layer(MULTI, raw, deduplicated=deduplicated)
