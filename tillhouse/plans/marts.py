"""Marts: star schema built from the staging models.

Dimensions and facts get md5 surrogate keys; ``loaded_at`` is a parameter
(default: the statement's local timestamp) so tests and the oracle can pin it.
The two facts are the only fact-fact joins (items x transactions, junction x
transactions): sort-merge joins on ``(tenant_id, transaction_id)``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import (day_name, is_weekend, iso_dow, month_label, surrogate_key,
                                 year_month)
from tillhouse.operators import date_spine
from tillhouse.plans.lazy import LazyDict


def load_time(loaded_at: Column | None) -> Column:
    return loaded_at if loaded_at is not None else F.localtimestamp()


def _loaded(loaded_at: Column | None) -> Column:
    return load_time(loaded_at).alias("loaded_at")


# ---- single tenant ----------------------------------------------------------
def dim_customer(stg_customers: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return stg_customers.select(surrogate_key("customer_id").alias("customer_key"), "customer_id",
                                "customer_name", "gender", "city", "created_at", _loaded(loaded_at))


def dim_product(stg_products: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return stg_products.select(surrogate_key("product_id").alias("product_key"), "product_id",
                               "product_name", "category", "brand", "unit_price", "is_active",
                               _loaded(loaded_at))


def dim_date(stg_transactions: DataFrame, with_day_of_month: bool = True) -> DataFrame:
    """Calendar rows for every day between the first and last completed sale."""
    d = F.col("date_day")
    cols = [surrogate_key("date_day").alias("date_key"), d,
            F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
            year_month(d).alias("year_month"), month_label(d).alias("month_label")]
    if with_day_of_month:
        cols.append(F.dayofmonth(d).alias("day_of_month"))
    cols += [iso_dow(d).alias("day_of_week"), day_name(d).alias("day_name"),
             is_weekend(d).alias("is_weekend")]
    return date_spine(stg_transactions, "transaction_day").select(*cols)


def fact_sales(stg_items: DataFrame, stg_transactions: DataFrame,
               loaded_at: Column | None = None) -> DataFrame:
    """Line-item grain; the inner join drops items of non-completed sales."""
    i, t = stg_items.alias("i"), stg_transactions.alias("t")
    return i.join(t, F.col("i.transaction_id") == F.col("t.transaction_id"), "inner").select(
        surrogate_key("i.item_id").alias("sale_key"),
        F.col("i.item_id").alias("item_id"),
        F.col("i.transaction_id").alias("transaction_id"),
        F.col("t.customer_id").alias("customer_id"),
        F.col("i.product_id").alias("product_id"),
        surrogate_key("t.customer_id").alias("customer_key"),
        surrogate_key("i.product_id").alias("product_key"),
        surrogate_key("t.transaction_day").alias("date_key"),
        F.col("t.transaction_day").alias("transaction_day"),
        F.col("t.store_id").alias("store_id"),
        F.col("t.payment_method").alias("payment_method"),
        F.col("i.quantity").alias("quantity"),
        F.col("i.unit_price").alias("unit_price"),
        F.col("i.discount").alias("discount"),
        F.col("i.subtotal").alias("subtotal"),
        _loaded(loaded_at))


# ---- multi tenant -----------------------------------------------------------
def dim_customer_mt(stg: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return stg.select(surrogate_key("tenant_id", "customer_id").alias("customer_key"), "tenant_id",
                      "customer_id", "customer_name", "gender", "city", _loaded(loaded_at))


def dim_product_mt(stg: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return stg.select(surrogate_key("tenant_id", "product_id").alias("product_key"), "tenant_id",
                      "product_id", "product_name", "category", "brand", "unit_price",
                      "is_active", _loaded(loaded_at))


def dim_date_mt(stg_transactions_mt: DataFrame) -> DataFrame:
    return dim_date(stg_transactions_mt, with_day_of_month=False)


def dim_store(stg: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return stg.select(surrogate_key("tenant_id", "store_id").alias("store_key"), "tenant_id",
                      "store_id", "store_name", "city", "province", "store_type", "opened_at",
                      "is_active", _loaded(loaded_at))


def dim_promotion(stg: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return stg.select(surrogate_key("tenant_id", "promo_id").alias("promo_key"), "tenant_id",
                      "promo_id", "promo_name", "promo_type", "discount_pct", "start_date",
                      "end_date", "min_purchase", _loaded(loaded_at))


def fct_sales(stg_items_mt: DataFrame, stg_transactions_mt: DataFrame,
              loaded_at: Column | None = None) -> DataFrame:
    i, t = stg_items_mt.alias("i"), stg_transactions_mt.alias("t")
    on = ((F.col("i.tenant_id") == F.col("t.tenant_id"))
          & (F.col("i.transaction_id") == F.col("t.transaction_id")))
    return i.join(t, on, "inner").select(
        surrogate_key("i.tenant_id", "i.item_id").alias("sale_key"),
        F.col("i.tenant_id").alias("tenant_id"),
        F.col("i.item_id").alias("item_id"),
        F.col("i.transaction_id").alias("transaction_id"),
        F.col("t.customer_id").alias("customer_id"),
        F.col("i.product_id").alias("product_id"),
        F.col("t.store_id").alias("store_id"),
        F.col("t.transaction_day").alias("transaction_day"),
        F.col("t.payment_method").alias("payment_method"),
        F.col("i.quantity").alias("quantity"),
        F.col("i.unit_price").alias("unit_price"),
        F.col("i.discount").alias("discount"),
        F.col("i.subtotal").alias("subtotal"),
        _loaded(loaded_at))


def fct_promotion_usage(stg_junction: DataFrame, stg_transactions_mt: DataFrame,
                        loaded_at: Column | None = None) -> DataFrame:
    tp, t = stg_junction.alias("tp"), stg_transactions_mt.alias("t")
    on = ((F.col("tp.tenant_id") == F.col("t.tenant_id"))
          & (F.col("tp.transaction_id") == F.col("t.transaction_id")))
    return tp.join(t, on, "inner").select(
        surrogate_key("tp.tenant_id", "tp.id").alias("promo_usage_key"),
        F.col("tp.tenant_id").alias("tenant_id"),
        F.col("tp.id").alias("junction_id"),
        F.col("tp.transaction_id").alias("transaction_id"),
        F.col("tp.promo_id").alias("promo_id"),
        F.col("t.store_id").alias("store_id"),
        F.col("t.customer_id").alias("customer_id"),
        F.col("t.transaction_day").alias("transaction_day"),
        F.col("tp.discount_applied").alias("discount_applied"),
        F.col("t.total_amount").alias("transaction_total"),
        _loaded(loaded_at))


def marts_single(stg: Mapping[str, DataFrame], loaded_at: Column | None = None) -> LazyDict:
    """The four single-tenant marts (each built on first use)."""
    return LazyDict({
        "dim_customer": lambda: dim_customer(stg["stg_customers"], loaded_at),
        "dim_product": lambda: dim_product(stg["stg_products"], loaded_at),
        "dim_date": lambda: dim_date(stg["stg_transactions"]),
        "fact_sales": lambda: fact_sales(stg["stg_transaction_items"], stg["stg_transactions"], loaded_at),
    })


def marts_multi(stg: Mapping[str, DataFrame], loaded_at: Column | None = None) -> LazyDict:
    """The seven multi-tenant marts (each built on first use)."""
    return LazyDict({
        "dim_customer_mt": lambda: dim_customer_mt(stg["stg_customers_mt"], loaded_at),
        "dim_product_mt": lambda: dim_product_mt(stg["stg_products_mt"], loaded_at),
        "dim_date_mt": lambda: dim_date_mt(stg["stg_transactions_mt"]),
        "dim_store": lambda: dim_store(stg["stg_stores"], loaded_at),
        "dim_promotion": lambda: dim_promotion(stg["stg_promotions"], loaded_at),
        "fct_sales": lambda: fct_sales(stg["stg_transaction_items_mt"], stg["stg_transactions_mt"], loaded_at),
        "fct_promotion_usage": lambda: fct_promotion_usage(stg["stg_transaction_promotions"],
                                                           stg["stg_transactions_mt"], loaded_at),
    })
