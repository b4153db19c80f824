import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from tillhouse.plans import marts, questions as Q, staging
from tillhouse.schemas import RAW_MT, RAW_ST

T = dt.datetime


def _raw_mt(spark, table, rows):
    return spark.createDataFrame(rows, RAW_MT[table])


def test_stg_transactions_keeps_completed_only(spark):
    rows = [(1, 10, 1, T(2024, 1, 1, 9), D("10.00"), " E-Wallet", " Completed "),
            (2, 10, 1, T(2024, 1, 1, 9), D("10.00"), "cash", "CANCELLED"),
            (3, None, 1, T(2024, 1, 1, 9), D("10.00"), None, None)]
    df = staging.stg_transactions(spark.createDataFrame(rows, RAW_ST["transactions"]))
    got = df.collect()
    assert [(r.transaction_id, r.payment_method, r.status, r.transaction_day) for r in got] == \
        [(1, "e-wallet", "completed", dt.date(2024, 1, 1))]


def test_mt_dedup_before_status_filter(spark):
    txn = [("t1", 7, 1, 1, T(2024, 1, 1), D("5.00"), "cash", "completed", T(2024, 1, 1), 0),
           ("t1", 7, 1, 1, T(2024, 1, 1), D("5.00"), "cash", "cancelled", T(2024, 1, 2), 1),
           ("t2", 7, 1, 1, T(2024, 1, 1), D("9.00"), "cash", "completed", T(2024, 1, 1), 0)]
    stg = staging.stg_transactions_mt(_raw_mt(spark, "transactions", txn))
    assert sorted((r.tenant_id, r.transaction_id) for r in stg.collect()) == [("t2", 7)]


def test_fct_sales_joins_on_composite_key(spark):
    txn = [("t1", 7, 1, 1, T(2024, 1, 1), D("5.00"), "cash", "completed", T(2024, 1, 1), 0),
           ("t2", 7, 2, 2, T(2024, 1, 3), D("9.00"), "debit", "completed", T(2024, 1, 3), 0)]
    items = [("t1", "a", 7, 100, 1, D("5.00"), D("0"), D("5.00"), T(2024, 1, 1), 0),
             ("t2", "a", 7, 100, 2, D("4.50"), D("0"), D("9.00"), T(2024, 1, 3), 0),
             ("t2", "b", 8, 100, 2, D("4.50"), D("0"), D("9.00"), T(2024, 1, 3), 0)]   # no transaction
    st = staging.stg_transactions_mt(_raw_mt(spark, "transactions", txn))
    it = staging.stg_transaction_items_mt(_raw_mt(spark, "transaction_items", items))
    f = marts.fct_sales(it, st).collect()
    assert sorted((r.tenant_id, r.customer_id, r.payment_method) for r in f) == [("t1", 1, "cash"), ("t2", 2, "debit")]
    assert len({r.sale_key for r in f}) == 2


def _facts(spark, rows):
    return spark.createDataFrame(
        rows, "tenant_id string, transaction_id long, customer_id long, store_id long, product_id long, "
              "transaction_day date, subtotal decimal(14,2)")


def test_customer_segments_null_customer_moves_thresholds(spark):
    d = dt.date(2024, 1, 1)
    rows = [("t1", i, i, 1, 1, d, D(str(10 * i))) for i in range(1, 7)] + [("t1", 99, None, 1, 1, d, D("100000"))]
    fact = _facts(spark, rows)
    cust = spark.createDataFrame([("t1", i, "C") for i in range(1, 7)], "tenant_id string, customer_id long, city string")
    got = {r.segment: r.n_customers for r in Q.customer_segments(fact, cust).collect()}
    # thresholds over 7 spenders (incl. NULL): q33 = 29.8, q66 = 49.6 -> 10,20 Low; 30,40 Medium; 50,60 High
    assert got == {"Low": 2, "Medium": 2, "High": 2}
    wide = Q.customer_segments_wide(fact, cust).first()
    assert (wide.High, wide.Medium, wide.Low) == (2, 2, 2)


def test_promo_vs_no_promo_half_even_and_item_sums(spark):
    d = dt.date(2024, 1, 1)
    fact = _facts(spark, [("t1", 1, 1, 1, 1, d, D("1.00")), ("t1", 1, 1, 1, 2, d, D("1.50")),
                          ("t1", 2, 1, 1, 1, d, D("0.50")), ("t2", 1, 1, 1, 1, d, D("3.50"))])
    usage = spark.createDataFrame([("t2", 1), ("t2", 1)], "tenant_id string, transaction_id long")
    got = {r.grp: (r.avg_txn_value, r.n_transactions) for r in Q.promo_vs_no_promo(fact, usage).collect()}
    # no_promo: (2.5 + 0.5) / 2 = 1.5 -> 2 (half-even); with_promo: 3.5 -> 4
    assert got == {"no_promo": (2.0, 2), "with_promo": (4.0, 1)}


def test_transactions_by_weekday_counts_distinct_tenant_transactions(spark):
    mon, tue = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    fact = _facts(spark, [("t1", 1, 1, 1, 1, mon, D("1.00")), ("t1", 1, 1, 1, 2, mon, D("2.00")),
                          ("t2", 1, 1, 1, 1, mon, D("3.00")), ("t1", 2, 1, 1, 1, tue, D("4.00"))])
    raw = spark.createDataFrame([(mon,), (tue,)], "transaction_day date")
    dim = marts.dim_date_mt(raw)
    got = {r.dow: (r.day_name, r.n_transactions, r.revenue) for r in Q.transactions_by_weekday(fact, dim).collect()}
    assert got == {1: ("Monday", 2, 6.0), 2: ("Tuesday", 1, 4.0)}


def test_payment_mix_pct(spark):
    fact = spark.createDataFrame([("cash", 1), ("cash", 1), ("cash", 2), ("debit", 3), ("credit", 4)],
                                 "payment_method string, transaction_id long")
    got = {r.payment_method: (r.txn_count, r.pct) for r in Q.payment_mix(fact).collect()}
    assert got == {"cash": (2, 50.0), "debit": (1, 25.0), "credit": (1, 25.0)}


def test_top_products_by_city_wide_missing_ranks(spark):
    d = dt.date(2024, 1, 1)
    fact = _facts(spark, [("t1", 1, 1, 1, 1, d, D("5")), ("t1", 1, 1, 1, 2, d, D("7")), ("t1", 2, 1, 2, 1, d, D("1"))])
    stores = spark.createDataFrame([("t1", 1, "A"), ("t1", 2, "B")], "tenant_id string, store_id long, city string")
    prods = spark.createDataFrame([("t1", 1, "p1"), ("t1", 2, "p2")], "tenant_id string, product_id long, product_name string")
    rows = {r.city: r for r in Q.top_products_by_city_wide(fact, stores, prods).collect()}
    assert (rows["A"].product_1, rows["A"].revenue_1, rows["A"].product_2) == ("p2", 7.0, "p1")
    assert (rows["B"].product_1, rows["B"].product_2, rows["B"].revenue_2, rows["B"].revenue_3) == ("p1", None, 0.0, 0.0)
