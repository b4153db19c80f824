"""The declared data-quality suite (77 checks: 40 single-tenant, 37 multi-tenant)
plus composite-key checks the declared suite lacks (multi-tenant ids collide,
so only ``(tenant_id, id)`` identifies a row)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tillhouse.operators.quality import ModelChecks as M
from tillhouse.operators.quality import run_suite, shared_models
from tillhouse.plans.lazy import LazyDict, merged
from tillhouse.session import run_concurrently
from tillhouse.sources.landing import stored

# Accepted domains.
PAYMENT_METHODS = ["cash", "debit", "credit", "e-wallet"]
STORE_TYPES = ["minimarket", "supermarket", "express"]
PROMO_TYPES = ["discount", "bundle", "cashback"]

# Models that one pass over their raw table gives, without a shuffle, and the
# stored transactions: every check reads them as they are.
ONE_PASS = {"stg_customers", "stg_products", "stg_transactions", "stg_transaction_items", "dim_customer", "dim_product",
            "stg_transactions_mt", "raw_products", "raw_transactions", "raw_items", "raw_junction"}

SUITE_SINGLE = {
    "stg_customers": M(not_null=["customer_id", "customer_name"], unique=["customer_id"]),
    "stg_products": M(not_null=["product_id", "product_name", "unit_price"], unique=["product_id"]),
    "stg_transactions": M(not_null=["transaction_id", "transaction_date"], unique=["transaction_id"],
                          accepted_values={"payment_method": PAYMENT_METHODS}),
    "stg_transaction_items": M(not_null=["item_id", "transaction_id", "quantity"], unique=["item_id"],
                               relationships=[("product_id", "stg_products", "product_id")]),
    "dim_customer": M(not_null=["customer_key", "customer_id"], unique=["customer_key", "customer_id"]),
    "dim_product": M(not_null=["product_key", "product_id", "unit_price"],
                     unique=["product_key", "product_id"]),
    "dim_date": M(not_null=["date_key", "date_day", "year_month"], unique=["date_key", "date_day"]),
    "fact_sales": M(not_null=["sale_key", "transaction_id", "product_id", "quantity", "subtotal"],
                    unique=["sale_key"],
                    relationships=[("product_id", "dim_product", "product_id"),
                                   ("customer_id", "dim_customer", "customer_id"),
                                   ("transaction_day", "dim_date", "date_day")],
                    accepted_values={"payment_method": PAYMENT_METHODS}),
}

SUITE_MULTI = {
    "stg_transactions_mt": M(not_null=["transaction_id", "tenant_id"],
                             accepted_values={"payment_method": PAYMENT_METHODS}),
    "stg_stores": M(not_null=["store_id"], accepted_values={"store_type": STORE_TYPES}),
    "stg_promotions": M(not_null=["promo_id"], accepted_values={"promo_type": PROMO_TYPES}),
    "dim_store": M(not_null=["store_key", "store_id"], unique=["store_key"],
                   accepted_values={"store_type": STORE_TYPES}),
    "dim_promotion": M(not_null=["promo_key", "promo_id"], unique=["promo_key"]),
    "dim_customer_mt": M(not_null=["customer_key", "customer_id"], unique=["customer_key"]),
    "dim_product_mt": M(not_null=["product_key", "product_id"], unique=["product_key"]),
    "dim_date_mt": M(not_null=["date_key", "date_day"], unique=["date_key", "date_day"]),
    "fct_sales": M(not_null=["sale_key", "tenant_id", "store_id", "product_id", "subtotal", "quantity"],
                   unique=["sale_key"]),
    "fct_promotion_usage": M(not_null=["promo_usage_key", "promo_id", "discount_applied",
                                       "transaction_total"],
                             unique=["promo_usage_key"],
                             relationships=[("promo_id", "dim_promotion", "promo_id")]),
}

# Added: natural keys of the MT dimensions, and every fact key against its
# dimension on the composite key.
SUITE_MULTI_COMPOSITE = {
    "dim_store": M(unique=[["tenant_id", "store_id"]]),
    "dim_promotion": M(unique=[["tenant_id", "promo_id"]]),
    "dim_customer_mt": M(unique=[["tenant_id", "customer_id"]]),
    "dim_product_mt": M(unique=[["tenant_id", "product_id"]]),
    "fct_sales": M(relationships=[(["tenant_id", "store_id"], "dim_store", ["tenant_id", "store_id"]),
                                  (["tenant_id", "product_id"], "dim_product_mt", ["tenant_id", "product_id"]),
                                  (["tenant_id", "customer_id"], "dim_customer_mt", ["tenant_id", "customer_id"]),
                                  ("transaction_day", "dim_date_mt", "date_day")]),
    "fct_promotion_usage": M(relationships=[(["tenant_id", "promo_id"], "dim_promotion",
                                             ["tenant_id", "promo_id"])]),
}


def only(spec: dict[str, M], kind: str) -> dict[str, M]:
    """The part of ``spec`` with checks of one kind."""
    out = {}
    for name, m in spec.items():
        v = getattr(m, kind)
        if v:
            out[name] = M(**{kind: v})
    return out


def suite_specs(layer: str, composite: bool = True) -> list[dict[str, M]]:
    if layer == "single":
        return [SUITE_SINGLE]
    return [SUITE_MULTI] + ([SUITE_MULTI_COMPOSITE] if composite else [])


def derived_once(models: Mapping[str, DataFrame], specs: Sequence[Mapping[str, M]]) -> LazyDict:
    """``models`` in which those that several checks read, and that take a shuffle
    to derive, are derived once: their checked columns are written to the shared
    folder, all at the same time, and read back."""
    shared = {m: models[m].select(*cols) for m, cols in shared_models(specs).items() if m not in ONE_PASS}
    return merged(models, run_concurrently({m: (lambda m=m, df=df: stored(df, f"checked-{m}")) for m, df in shared.items()}))


def warehouse_checks(wh, layers=("single", "multi"), kind: str | None = None) -> DataFrame:
    """``run_checks`` over the models of a warehouse that stores none of them.
    The deduplicated transactions, from which both facts and the calendar start,
    are derived once too where more than one model is checked."""
    specs = [only(spec, kind) if kind else spec for layer in layers for spec in suite_specs(layer)]
    used = {m for spec in specs for m in spec} | {p for spec in specs for chk in spec.values() for _, p, _ in chk.relationships}
    parts = []
    if "single" in layers:
        parts += [wh.stg_st, wh.marts_st]
    if "multi" in layers:
        parts += [wh.stg_mt, wh.marts_mt]
        if len(used & {"stg_transactions_mt", "fct_sales", "fct_promotion_usage", "dim_date_mt"}) > 1:
            wh.stg_mt["stg_transactions_mt"] = stored(wh.stg_mt["stg_transactions_mt"], "stg_transactions_mt")
    return run_checks(derived_once(merged(*parts), specs), layers, kind)


def run_checks(models: dict[str, DataFrame], layers=("single", "multi"), kind: str | None = None,
               composite: bool = True) -> DataFrame:
    """Run the suite(s) of ``layers`` (optionally one kind of check only)."""
    parts = []
    for layer in layers:
        for spec in suite_specs(layer, composite):
            spec = only(spec, kind) if kind else spec
            if spec:
                parts.append(run_suite(models, spec))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_checks(spec: dict[str, M]) -> int:
    return sum(len(m.not_null) + len(m.unique) + len(m.relationships) + len(m.accepted_values)
               for m in spec.values())


# Checks that the raw versions must fail: duplicate versions, values before cleaning,
# lines and promotions of sales that are not completed.
SUITE_RAW = {
    "raw_products": M(not_null=["product_id", "category", "is_active"], unique=["product_id", "brand"]),
    "raw_transactions": M(not_null=["transaction_id", "status"], unique=[["tenant_id", "transaction_id"], "transaction_id"],
                          accepted_values={"payment_method": PAYMENT_METHODS, "status": ["completed", "pending", "cancelled"]}),
    "raw_items": M(unique=[["tenant_id", "item_id"]],
                   relationships=[(["tenant_id", "transaction_id"], "stg_transactions_mt", ["tenant_id", "transaction_id"]),
                                  ("product_id", "clean_products", "product_id")]),
    "raw_junction": M(relationships=[(["tenant_id", "transaction_id"], "stg_transactions_mt", ["tenant_id", "transaction_id"]),
                                     ("promo_id", "clean_promotions", "promo_id")]),
}


def raw_suite(wh) -> DataFrame:
    """``SUITE_RAW`` over the raw multi-tenant versions; its clean products have
    a category, its clean promotions a name without stray spaces."""
    raw = wh.raw_mt
    return run_suite({"raw_products": raw["products"], "raw_transactions": raw["transactions"],
                      "raw_items": raw["transaction_items"], "raw_junction": raw["transaction_promotions"],
                      "stg_transactions_mt": stored(wh.stg_mt["stg_transactions_mt"].select("tenant_id", "transaction_id"), "sale-keys"),
                      "clean_products": raw["products"].where("category is not null"),
                      "clean_promotions": raw["promotions"].where("promo_name = trim(promo_name)")}, SUITE_RAW)
