"""Declared schemas of the raw landing tables (single and multi-tenant).

``conform`` selects by name and casts, so a missing column fails at analysis
time and an extra column is dropped; there is no schema evolution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, S = T.LongType(), T.IntegerType(), T.StringType()
TS, D = T.TimestampNTZType(), T.DateType()


def _dec(p, s):
    return T.DecimalType(p, s)


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


# Item ids of the driver tables are composite strings (see sources.tpch), so
# item_id and the junction id are strings rather than serial longs.
RAW_ST = {
    "customers": T.StructType([
        _f("customer_id", L, False), _f("name", S, False), _f("phone", S),
        _f("email", S), _f("gender", S), _f("city", S), _f("created_at", TS)]),
    "products": T.StructType([
        _f("product_id", L, False), _f("product_name", S, False), _f("category", S),
        _f("brand", S), _f("unit_price", _dec(12, 2), False), _f("is_active", I),
        _f("created_at", TS)]),
    "transactions": T.StructType([
        _f("transaction_id", L, False), _f("customer_id", L), _f("store_id", L),
        _f("transaction_date", TS, False), _f("total_amount", _dec(14, 2), False),
        _f("payment_method", S), _f("status", S)]),
    "transaction_items": T.StructType([
        _f("item_id", S, False), _f("transaction_id", L), _f("product_id", L),
        _f("quantity", I, False), _f("unit_price", _dec(12, 2), False),
        _f("discount", _dec(5, 2), False), _f("subtotal", _dec(14, 2), False)]),
}

_MT_ONLY = {
    "stores": T.StructType([
        _f("store_id", L, False), _f("store_name", S, False), _f("city", S),
        _f("province", S), _f("store_type", S), _f("opened_at", D), _f("is_active", I)]),
    "suppliers": T.StructType([
        _f("supplier_id", L, False), _f("supplier_name", S), _f("contact_name", S),
        _f("city", S), _f("country", S), _f("created_at", TS)]),
    "promotions": T.StructType([
        _f("promo_id", L, False), _f("promo_name", S), _f("promo_type", S),
        _f("discount_pct", _dec(5, 2)), _f("start_date", D), _f("end_date", D),
        _f("min_purchase", _dec(12, 2))]),
    "transaction_promotions": T.StructType([
        _f("id", S, False), _f("transaction_id", L), _f("promo_id", L),
        _f("discount_applied", _dec(12, 2))]),
}

# Primary key of every multi-tenant table (the full key is (tenant_id, pk)).
MT_KEYS = {
    "customers": "customer_id", "products": "product_id",
    "transactions": "transaction_id", "transaction_items": "item_id",
    "stores": "store_id", "suppliers": "supplier_id",
    "promotions": "promo_id", "transaction_promotions": "id",
}


def mt_schema(table: str) -> T.StructType:
    base = RAW_ST.get(table) or _MT_ONLY[table]
    return T.StructType([_f("tenant_id", S, False), *base.fields,
                         _f("updated_at", TS, False), _f("_batch_id", L, False)])


RAW_MT = {t: mt_schema(t) for t in MT_KEYS}

WATERMARK_STATE = T.StructType([
    _f("tenant_id", S, False), _f("table_name", S, False),
    _f("watermark", TS, False), _f("run_id", L, False)])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema`` by name with casts (S4, S5).

    Booleans become 0/1 integers through the cast; NULL stays NULL.
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.IntegerType):
            c = c.cast("int")
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
