"""The analytical questions (public API) over the marts.

Every question aggregates the fact by its own keys first and joins dimension
attributes afterwards (one row per key instead of one per line item enters the
join), then aggregates again by the attribute.  Only the date dimension, whose
size is bounded by the calendar, is broadcast explicitly; other dimensions are
left to AQE, which broadcasts them only when their runtime size is under the
threshold.  Money leaves as ``double`` (the consumer projection).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.operators import (exact_quantiles, last_n_distinct, member_flag, pivot_wide, series,
                                 share_of_total, top_k, top_k_per)
from tillhouse.sources.landing import stored

SEGMENTS = ["High", "Medium", "Low"]
SEGMENT_QUANTILES = (0.33, 0.66)


def _calendar(dim_date: DataFrame, *cols: str) -> DataFrame:
    # no broadcast hint: one stray date makes the calendar long, so AQE decides by its size
    return dim_date.select("date_day", *cols)


def _money(c: str, out: str | None = None):
    return F.col(c).cast("double").alias(out or c)


# ---- single tenant (notebook questions) --------------------------------------
def top_products_per_category(fact_sales: DataFrame, dim_product: DataFrame, k: int = 5) -> DataFrame:
    per_product = fact_sales.groupBy("product_id").agg(F.sum("quantity").alias("_q"))
    named = per_product.join(dim_product.select("product_id", "category", "product_name"), "product_id")
    totals = (named.where(F.col("category").isNotNull())
                   .groupBy("category", "product_name").agg(F.sum("_q").alias("total_qty")))
    top = top_k_per(totals, ["category"], [F.desc("total_qty"), F.asc("product_name")], k)
    return (top.select("category", "product_name", F.col("total_qty").cast("long").alias("total_qty"))
               .orderBy("category", F.desc("total_qty"), "product_name"))


def monthly_revenue(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = fact_sales.groupBy("transaction_day").agg(F.sum("subtotal").alias("_r"))
    j = per_day.join(_calendar(dim_date, "year_month"), F.col("transaction_day") == F.col("date_day"))
    return (j.groupBy("year_month").agg(F.sum("_r").alias("revenue"))
             .select("year_month", _money("revenue")).orderBy("year_month"))


def payment_mix(fact_sales: DataFrame) -> DataFrame:
    # count(DISTINCT transaction_id) per method as distinct pairs, then counts
    pairs = (fact_sales.where(F.col("transaction_id").isNotNull())
                       .select("payment_method", "transaction_id").distinct())
    counts = pairs.groupBy("payment_method").agg(F.count(F.lit(1)).alias("txn_count"))
    return (share_of_total(counts, "txn_count", "pct", 1)
            .select("payment_method", F.col("txn_count").cast("long").alias("txn_count"), "pct")
            .orderBy(F.desc("txn_count"), "payment_method"))


# ---- multi tenant (service questions) ----------------------------------------
def revenue_by_store(fct_sales: DataFrame, dim_store: DataFrame, dim_date_mt: DataFrame,
                     as_decimal: bool = False) -> DataFrame:
    """Revenue per (store name, month) over all months (sparse)."""
    per = fct_sales.groupBy("tenant_id", "store_id", "transaction_day").agg(F.sum("subtotal").alias("_r"))
    j = (per.join(dim_store.select("tenant_id", "store_id", "store_name"), ["tenant_id", "store_id"])
            .join(_calendar(dim_date_mt, "year_month"), F.col("transaction_day") == F.col("date_day")))
    out = j.groupBy(F.col("store_name").alias("store"), F.col("year_month").alias("month")) \
           .agg(F.sum("_r").alias("revenue"))
    return out if as_decimal else out.select("store", "month", _money("revenue")).orderBy("month", "store")


def _store_series(fct_sales, dim_store, dim_date_mt, n_months) -> DataFrame:
    sparse = revenue_by_store(fct_sales, dim_store, dim_date_mt, as_decimal=True)
    # months and series both read this small aggregate: the fact is scanned once
    sparse = stored(sparse.select("store", "month", _money("revenue")), "store-months")
    months = last_n_distinct(sparse, "month", n_months)
    return series(sparse, "store", "month", "revenue", months, fill=0.0, axis_out="months", measure_out="data")


def revenue_by_store_series(fct_sales: DataFrame, dim_store: DataFrame, dim_date_mt: DataFrame,
                            n_months: int = 6) -> DataFrame:
    """One row per store with sales ever: the last ``n_months`` observed months
    and the store's revenue in each (0 where none), as arrays in month order."""
    return _store_series(fct_sales, dim_store, dim_date_mt, n_months).orderBy("store")


def revenue_by_store_dense(fct_sales: DataFrame, dim_store: DataFrame, dim_date_mt: DataFrame,
                           n_months: int = 6) -> DataFrame:
    """Every store with sales ever x the last ``n_months`` observed months, missing = 0."""
    s = _store_series(fct_sales, dim_store, dim_date_mt, n_months)
    return (s.select("store", F.inline(F.arrays_zip(F.col("months").alias("month"),
                                                     F.col("data").alias("revenue"))))
             .orderBy("store", "month"))


def top_promotions(fct_promotion_usage: DataFrame, dim_promotion: DataFrame, k: int = 10) -> DataFrame:
    per = fct_promotion_usage.groupBy("tenant_id", "promo_id").agg(F.sum("discount_applied").alias("_d"))
    named = per.join(dim_promotion.select("tenant_id", "promo_id", "promo_name"), ["tenant_id", "promo_id"])
    totals = named.groupBy(F.col("promo_name").alias("promo")).agg(F.sum("_d").alias("total_discount"))
    return top_k(totals, [F.desc("total_discount"), F.asc("promo")], k) \
        .select("promo", _money("total_discount"))


def promo_vs_no_promo(fct_sales: DataFrame, fct_promotion_usage: DataFrame) -> DataFrame:
    """Average transaction value (sum of its item subtotals) with / without a promo."""
    keys = ["tenant_id", "transaction_id"]
    per_txn = fct_sales.groupBy(*keys).agg(F.sum("subtotal").alias("_val"))
    flagged = member_flag(per_txn, fct_promotion_usage, keys, "_promo")
    grp = F.when(F.col("_promo"), F.lit("with_promo")).otherwise(F.lit("no_promo")).alias("grp")
    return (flagged.groupBy(grp)
                   .agg(F.bround(F.avg(F.col("_val").cast("double")), 0).alias("avg_txn_value"),
                        F.count(F.lit(1)).cast("long").alias("n_transactions"))
                   .orderBy("grp"))


def _city_product_revenue(fct_sales, dim_store, dim_product_mt) -> DataFrame:
    per = fct_sales.groupBy("tenant_id", "store_id", "product_id").agg(F.sum("subtotal").alias("_r"))
    j = (per.join(dim_store.select("tenant_id", "store_id", "city"), ["tenant_id", "store_id"])
            .join(dim_product_mt.select("tenant_id", "product_id", "product_name"),
                  ["tenant_id", "product_id"]))
    return j.groupBy("city", "product_name").agg(F.sum("_r").alias("revenue"))


def _top_products_by_city(fct_sales, dim_store, dim_product_mt, k) -> DataFrame:
    totals = _city_product_revenue(fct_sales, dim_store, dim_product_mt)
    top = top_k_per(totals, ["city"], [F.desc("revenue"), F.asc("product_name")], k, rank_col="rank")
    return top.select("city", "product_name", _money("revenue"), "rank")


def top_products_by_city(fct_sales: DataFrame, dim_store: DataFrame, dim_product_mt: DataFrame,
                         k: int = 3) -> DataFrame:
    """Top k products per city of the *store*, by revenue (name breaks ties)."""
    return (_top_products_by_city(fct_sales, dim_store, dim_product_mt, k).drop("rank")
            .orderBy("city", F.desc("revenue"), "product_name"))


def top_products_by_city_wide(fct_sales: DataFrame, dim_store: DataFrame, dim_product_mt: DataFrame,
                              k: int = 3) -> DataFrame:
    """One row per city: product_1, revenue_1 .. product_k, revenue_k (missing revenue 0)."""
    ranked = _top_products_by_city(fct_sales, dim_store, dim_product_mt, k)
    return pivot_wide(ranked, ["city"], "rank", list(range(1, k + 1)),
                      {"product_name": "product_{v}", "revenue": "revenue_{v}"}).orderBy("city")


def customer_spend(fct_sales: DataFrame) -> DataFrame:
    return fct_sales.groupBy("tenant_id", "customer_id").agg(F.sum("subtotal").alias("total_spend"))


def _customer_segments(fct_sales: DataFrame, dim_customer_mt: DataFrame,
                      quantiles=SEGMENT_QUANTILES, exact: bool = True,
                      accuracy: int = 10000) -> DataFrame:
    """Customers per (city of the *customer*, High / Medium / Low spend segment).

    Thresholds are quantiles over every spender, including a NULL-customer
    group, before the join to the customer dimension: exact and interpolated
    by default (bounded memory, see ``exact_quantiles``); ``exact=False``
    takes the sketch's values directly (one pass, an element of the data
    within n/accuracy ranks, not interpolated).
    """
    # the quantiles and the result read one stored aggregate: the fact is shuffled once
    cust = stored(customer_spend(fct_sales), "customer-spend")
    th = F.col("_th")
    spend = F.col("total_spend")
    seg = F.when(spend >= th[1], F.lit(SEGMENTS[0])).when(spend >= th[0], F.lit(SEGMENTS[1])) \
           .otherwise(F.lit(SEGMENTS[2]))
    # the thresholds enter the plan once, as a column
    if exact:
        th_value = exact_quantiles(cust, "total_spend", list(quantiles), accuracy=accuracy)
    else:
        th_value = cust.agg(F.percentile_approx(F.col("total_spend").cast("double"), list(quantiles),
                                                accuracy)).scalar()
    cust = cust.select("*", th_value.alias("_th"))
    j = cust.join(dim_customer_mt.select("tenant_id", "customer_id", "city"), ["tenant_id", "customer_id"])
    return (j.groupBy("city", seg.alias("segment"))
             .agg(F.count(F.lit(1)).cast("long").alias("n_customers")))


def customer_segments(fct_sales: DataFrame, dim_customer_mt: DataFrame, **kw) -> DataFrame:
    return _customer_segments(fct_sales, dim_customer_mt, **kw).orderBy("city", "segment")


def customer_segments_wide(fct_sales: DataFrame, dim_customer_mt: DataFrame, **kw) -> DataFrame:
    seg = _customer_segments(fct_sales, dim_customer_mt, **kw)
    return pivot_wide(seg, ["city"], "segment", SEGMENTS, {"n_customers": "{v}"}).orderBy("city")


def transactions_by_weekday(fct_sales: DataFrame, dim_date_mt: DataFrame) -> DataFrame:
    """Distinct transactions and revenue per ISO weekday.

    A transaction has exactly one day, so grouping by (tenant, transaction,
    day) first makes ``count(*)`` per weekday equal to the distinct count
    without a separate distinct aggregation.
    """
    per_txn = (fct_sales.where(F.col("transaction_id").isNotNull())
               .groupBy("tenant_id", "transaction_id", "transaction_day").agg(F.sum("subtotal").alias("_v")))
    j = per_txn.join(_calendar(dim_date_mt, "day_of_week", "day_name"),
                     F.col("transaction_day") == F.col("date_day"))
    return (j.groupBy(F.col("day_of_week").alias("dow"), "day_name")
             .agg(F.count(F.lit(1)).cast("long").alias("n_transactions"), F.sum("_v").alias("revenue"))
             .select(F.col("dow").cast("int").alias("dow"), "day_name", "n_transactions", _money("revenue"))
             .orderBy("dow"))
