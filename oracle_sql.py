"""DuckDB formulation of every registered query (the correctness oracle).

Written independently of the Spark code as plain SQL over the driver's
tables: the adapter rules, staging, marts and questions are spelled out as
CTEs.  Every statement is ``WITH <all CTEs> <final select>``; unused CTEs
cost nothing.
"""

from __future__ import annotations

LOAD_TS = "TIMESTAMP '2024-01-01 00:00:00'"


def initcap(x: str) -> str:
    """Title case, a word starting after any non-alphanumeric character."""
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform("
            f"range(1, length({x}) + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches("
            f"substr({x}, i - 1, 1), '[\\p{{L}}\\p{{N}}]') THEN upper(substr({x}, i, 1)) "
            f"ELSE lower(substr({x}, i, 1)) END), '') END")


def sk(*cols: str) -> str:
    parts = [f"coalesce(regexp_replace(CAST({c} AS VARCHAR), '([\\\\|_])', '\\\\\\1', 'g'), '_null_')"
             for c in cols]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def _status(k="o_orderkey"):
    base = ("CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' "
            "WHEN 'P' THEN 'cancelled' END")
    return f"CASE WHEN {k} % 7 = 0 THEN ' ' || upper({base}) || ' ' ELSE {base} END"


def _payment(k="o_orderkey"):
    base = ("(['cash','debit','credit','e-wallet','e-wallet'])"
            "[CAST(substr(o_orderpriority, 1, 1) AS INTEGER)]")
    return f"CASE WHEN {k} % 5 = 0 THEN ' ' || upper({base}) ELSE {base} END"


ITEM_ID = ("concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, "
           "CAST(CAST(l_shipdate AS DATE) AS VARCHAR))")
SUBTOTAL = "CAST(l_extendedprice AS DECIMAL(14,2))"
UNIT_PRICE = (f"CAST(CAST((CAST({SUBTOTAL} * 100 AS BIGINT) // CAST(l_quantity AS BIGINT)) "
              f"AS DECIMAL(14,2)) / 100 AS DECIMAL(12,2))")
N_STORES = "(SELECT count(*) FROM supplier)"
TENANT = "'t' || CAST(l_orderkey % 3 AS VARCHAR)"

ADAPTER = f"""
tenants AS (SELECT * FROM (VALUES ('t0'), ('t1'), ('t2')) v(tenant_id)),
geo AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
raw_customers AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN c_custkey % 5 = 0 THEN ' ' || c_name || ' ' ELSE c_name END AS name,
    '08' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone,
    ' ' || replace(c_name, '#', '.') || '@MAIL.TEST' AS email,
    (['Male', 'Female', ' MALE ', 'female'])[c_custkey % 4 + 1] AS gender,
    CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) ELSE ' ' || n_name END AS city,
    TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at
  FROM customer JOIN geo ON c_nationkey = n_nationkey),
raw_products AS (
  SELECT p_partkey AS product_id,
    CASE WHEN p_partkey % 7 = 0 THEN p_name || ' ' ELSE p_name END AS product_name,
    CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN lower(p_type) ELSE p_type END AS category,
    p_brand AS brand, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
    CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN 0 ELSE 1 END AS is_active,
    TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(p_partkey % 365 AS INTEGER)) AS created_at
  FROM part),
raw_transactions AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, o_orderkey % {N_STORES} AS store_id,
    o_orderdate AS transaction_date, CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount,
    {_payment()} AS payment_method, {_status()} AS status
  FROM orders),
raw_transaction_items AS (
  SELECT {ITEM_ID} AS item_id, l_orderkey AS transaction_id, l_partkey AS product_id,
    CAST(l_quantity AS INTEGER) AS quantity, {UNIT_PRICE} AS unit_price,
    CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount, {SUBTOTAL} AS subtotal
  FROM lineitem),
mt_orders AS (
  SELECT 't' || CAST(o_orderkey % 3 AS VARCHAR) AS tenant_id, o_orderkey // 3 AS transaction_id,
    o_custkey AS customer_id, o_orderkey % {N_STORES} AS store_id, o_orderdate AS transaction_date,
    CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount, {_payment()} AS payment_method,
    {_status()} AS status, o_orderstatus, o_orderkey
  FROM orders),
raw_mt_transactions AS (
  SELECT tenant_id, transaction_id, customer_id, store_id, transaction_date, total_amount,
    payment_method, status, transaction_date + INTERVAL 1 DAY AS updated_at, 1 AS _batch_id
  FROM mt_orders
  UNION ALL
  SELECT tenant_id, transaction_id, customer_id, store_id, transaction_date, total_amount,
    payment_method, 'completed', transaction_date, 0
  FROM mt_orders WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT tenant_id, transaction_id, customer_id, store_id, transaction_date, total_amount,
    payment_method, 'completed', transaction_date + INTERVAL 1 DAY, 0
  FROM mt_orders WHERE o_orderstatus = 'O' AND o_orderkey % 5 = 0),
mt_lines AS (
  SELECT {TENANT} AS tenant_id, {ITEM_ID} AS item_id, l_orderkey // 3 AS transaction_id,
    l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity, {UNIT_PRICE} AS unit_price,
    CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount, {SUBTOTAL} AS subtotal,
    l_shipdate AS updated_at, (l_linenumber = 1 AND l_orderkey % 11 = 0) AS is_old
  FROM lineitem),
raw_mt_transaction_items AS (
  SELECT tenant_id, item_id, transaction_id, product_id, quantity, unit_price, discount, subtotal,
    updated_at, 1 AS _batch_id FROM mt_lines
  UNION ALL
  SELECT tenant_id, item_id, transaction_id, product_id, quantity + 1, unit_price, discount,
    CAST(subtotal * 2 AS DECIMAL(14,2)), updated_at - INTERVAL 1 DAY, 0 FROM mt_lines WHERE is_old),
raw_mt_customers AS (SELECT tenants.tenant_id, raw_customers.*, created_at AS updated_at, 0 AS _batch_id
  FROM raw_customers CROSS JOIN tenants),
raw_mt_products AS (SELECT tenants.tenant_id, raw_products.*, created_at AS updated_at, 0 AS _batch_id
  FROM raw_products CROSS JOIN tenants),
raw_mt_stores AS (
  SELECT tenants.tenant_id, s_suppkey AS store_id,
    CASE WHEN s_suppkey % 4 = 0 THEN ' ' || s_name ELSE s_name END AS store_name,
    CASE WHEN s_suppkey % 2 = 0 THEN lower(n_name) ELSE n_name END AS city,
    r_name AS province,
    CASE WHEN s_suppkey % 2 = 1 THEN upper((['minimarket', 'supermarket', 'express'])[s_suppkey % 3 + 1])
         ELSE (['minimarket', 'supermarket', 'express'])[s_suppkey % 3 + 1] END AS store_type,
    DATE '2015-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS opened_at,
    CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 1 END AS is_active,
    TIMESTAMP '2020-01-01 00:00:00' AS updated_at, 0 AS _batch_id
  FROM supplier JOIN geo ON s_nationkey = n_nationkey CROSS JOIN tenants),
raw_mt_suppliers AS (
  SELECT tenants.tenant_id, s_suppkey AS supplier_id, s_name AS supplier_name,
    'contact ' || CAST(s_suppkey AS VARCHAR) AS contact_name, n_name AS city, r_name AS country,
    TIMESTAMP '2020-01-01 00:00:00' AS created_at, TIMESTAMP '2020-01-01 00:00:00' AS updated_at,
    0 AS _batch_id
  FROM supplier JOIN geo ON s_nationkey = n_nationkey CROSS JOIN tenants),
promo_ids AS (SELECT DISTINCT {TENANT} AS tenant_id, l_partkey % 24 AS promo_id
  FROM lineitem WHERE l_discount >= 0.08),
raw_mt_promotions AS (
  SELECT tenant_id, promo_id,
    CASE WHEN promo_id % 5 = 0 THEN ' Promo ' ELSE 'Promo ' END || CAST(promo_id % 12 AS VARCHAR) AS promo_name,
    CASE WHEN promo_id % 2 = 1 THEN upper((['discount', 'bundle', 'cashback'])[promo_id % 3 + 1])
         ELSE (['discount', 'bundle', 'cashback'])[promo_id % 3 + 1] END AS promo_type,
    CAST(([5, 10, 15, 20, 25])[promo_id % 5 + 1] AS DECIMAL(5,2)) AS discount_pct,
    DATE '1995-01-01' + CAST(promo_id * 30 AS INTEGER) AS start_date,
    DATE '1995-01-01' + CAST(promo_id * 30 + 90 AS INTEGER) AS end_date,
    CAST(([0, 25000, 50000, 100000])[promo_id % 4 + 1] AS DECIMAL(12,2)) AS min_purchase,
    TIMESTAMP '2020-01-01 00:00:00' AS updated_at, 0 AS _batch_id
  FROM promo_ids),
raw_mt_transaction_promotions AS (
  SELECT {TENANT} AS tenant_id, {ITEM_ID} AS id, l_orderkey // 3 AS transaction_id,
    l_partkey % 24 AS promo_id,
    CAST({SUBTOTAL} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS discount_applied,
    l_shipdate AS updated_at, 0 AS _batch_id
  FROM lineitem WHERE l_discount >= 0.08)"""


def _latest(raw: str, pk: str) -> str:
    return (f"(SELECT * FROM {raw} QUALIFY row_number() OVER (PARTITION BY tenant_id, {pk} "
            f"ORDER BY updated_at DESC, _batch_id DESC) = 1)")


def _date_dim(src: str, with_dom: bool) -> str:
    dom = "CAST(dayofmonth(date_day) AS INTEGER) AS day_of_month," if with_dom else ""
    return f"""(
  SELECT {sk('date_day')} AS date_key, date_day,
    CAST(year(date_day) AS INTEGER) AS year, CAST(quarter(date_day) AS INTEGER) AS quarter,
    CAST(month(date_day) AS INTEGER) AS month, strftime(date_day, '%Y-%m') AS year_month,
    (['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'])[month(date_day)]
      || ' ' || CAST(year(date_day) AS VARCHAR) AS month_label,
    {dom}
    CAST(isodow(date_day) AS INTEGER) AS day_of_week,
    (['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'])[isodow(date_day)] AS day_name,
    CASE WHEN isodow(date_day) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(min(transaction_day), max(transaction_day), INTERVAL 1 DAY)) AS DATE)
          AS date_day FROM {src}))"""


MODELS = f"""
stg_customers AS (SELECT customer_id, trim(name) AS customer_name, phone, lower(trim(email)) AS email,
    lower(trim(gender)) AS gender, {initcap('trim(city)')} AS city, created_at FROM raw_customers),
stg_products AS (SELECT product_id, trim(product_name) AS product_name,
    {initcap('trim(category)')} AS category, trim(brand) AS brand, unit_price,
    coalesce(is_active, 1) AS is_active FROM raw_products),
stg_transactions AS (SELECT transaction_id, customer_id, store_id, transaction_date,
    CAST(transaction_date AS DATE) AS transaction_day, total_amount,
    lower(trim(payment_method)) AS payment_method, lower(trim(status)) AS status
  FROM raw_transactions WHERE lower(trim(status)) = 'completed'),
stg_transaction_items AS (SELECT item_id, transaction_id, product_id, quantity, unit_price, discount,
    subtotal FROM raw_transaction_items),
dim_customer AS (SELECT {sk('customer_id')} AS customer_key, customer_id, customer_name, gender, city,
    created_at, {LOAD_TS} AS loaded_at FROM stg_customers),
dim_product AS (SELECT {sk('product_id')} AS product_key, product_id, product_name, category, brand,
    unit_price, is_active, {LOAD_TS} AS loaded_at FROM stg_products),
dim_date AS {_date_dim('stg_transactions', True)},
fact_sales AS (SELECT {sk('i.item_id')} AS sale_key, i.item_id, i.transaction_id, t.customer_id,
    i.product_id, {sk('t.customer_id')} AS customer_key, {sk('i.product_id')} AS product_key,
    {sk('t.transaction_day')} AS date_key, t.transaction_day, t.store_id, t.payment_method,
    i.quantity, i.unit_price, i.discount, i.subtotal, {LOAD_TS} AS loaded_at
  FROM stg_transaction_items i JOIN stg_transactions t ON i.transaction_id = t.transaction_id),
stg_customers_mt AS (SELECT tenant_id, customer_id, trim(name) AS customer_name, phone,
    lower(trim(email)) AS email, lower(trim(gender)) AS gender, {initcap('trim(city)')} AS city,
    created_at, updated_at FROM {_latest('raw_mt_customers', 'customer_id')}),
stg_products_mt AS (SELECT tenant_id, product_id, trim(product_name) AS product_name,
    {initcap('trim(category)')} AS category, trim(brand) AS brand, unit_price,
    coalesce(is_active, 1) AS is_active FROM {_latest('raw_mt_products', 'product_id')}),
stg_transactions_mt AS (SELECT tenant_id, transaction_id, customer_id, store_id, transaction_date,
    CAST(transaction_date AS DATE) AS transaction_day, total_amount,
    lower(trim(payment_method)) AS payment_method, lower(trim(status)) AS status
  FROM {_latest('raw_mt_transactions', 'transaction_id')} WHERE lower(trim(status)) = 'completed'),
stg_transaction_items_mt AS (SELECT tenant_id, item_id, transaction_id, product_id, quantity,
    unit_price, discount, subtotal FROM {_latest('raw_mt_transaction_items', 'item_id')}),
stg_stores AS (SELECT tenant_id, store_id, trim(store_name) AS store_name,
    {initcap('trim(city)')} AS city, province, lower(trim(store_type)) AS store_type, opened_at,
    coalesce(is_active, 1) AS is_active FROM {_latest('raw_mt_stores', 'store_id')}),
stg_promotions AS (SELECT tenant_id, promo_id, trim(promo_name) AS promo_name,
    lower(trim(promo_type)) AS promo_type, discount_pct, start_date, end_date, min_purchase
  FROM {_latest('raw_mt_promotions', 'promo_id')}),
stg_transaction_promotions AS (SELECT tenant_id, id, transaction_id, promo_id, discount_applied
  FROM {_latest('raw_mt_transaction_promotions', 'id')}),
stg_suppliers AS (SELECT tenant_id, supplier_id, trim(supplier_name) AS supplier_name, contact_name,
    {initcap('trim(city)')} AS city, country FROM {_latest('raw_mt_suppliers', 'supplier_id')}),
dim_customer_mt AS (SELECT {sk('tenant_id', 'customer_id')} AS customer_key, tenant_id, customer_id,
    customer_name, gender, city, {LOAD_TS} AS loaded_at FROM stg_customers_mt),
dim_product_mt AS (SELECT {sk('tenant_id', 'product_id')} AS product_key, tenant_id, product_id,
    product_name, category, brand, unit_price, is_active, {LOAD_TS} AS loaded_at FROM stg_products_mt),
dim_date_mt AS {_date_dim('stg_transactions_mt', False)},
dim_store AS (SELECT {sk('tenant_id', 'store_id')} AS store_key, tenant_id, store_id, store_name, city,
    province, store_type, opened_at, is_active, {LOAD_TS} AS loaded_at FROM stg_stores),
dim_promotion AS (SELECT {sk('tenant_id', 'promo_id')} AS promo_key, tenant_id, promo_id, promo_name,
    promo_type, discount_pct, start_date, end_date, min_purchase, {LOAD_TS} AS loaded_at
  FROM stg_promotions),
fct_sales AS (SELECT {sk('i.tenant_id', 'i.item_id')} AS sale_key, i.tenant_id, i.item_id,
    i.transaction_id, t.customer_id, i.product_id, t.store_id, t.transaction_day, t.payment_method,
    i.quantity, i.unit_price, i.discount, i.subtotal, {LOAD_TS} AS loaded_at
  FROM stg_transaction_items_mt i JOIN stg_transactions_mt t
    ON i.tenant_id = t.tenant_id AND i.transaction_id = t.transaction_id),
fct_promotion_usage AS (SELECT {sk('tp.tenant_id', 'tp.id')} AS promo_usage_key, tp.tenant_id,
    tp.id AS junction_id, tp.transaction_id, tp.promo_id, t.store_id, t.customer_id,
    t.transaction_day, tp.discount_applied, t.total_amount AS transaction_total,
    {LOAD_TS} AS loaded_at
  FROM stg_transaction_promotions tp JOIN stg_transactions_mt t
    ON tp.tenant_id = t.tenant_id AND tp.transaction_id = t.transaction_id)"""


def with_models(final: str, extra: str = "") -> str:
    extra = f",\n{extra}" if extra else ""
    return f"WITH {ADAPTER},{MODELS}{extra}\n{final}"


MODEL_NAMES = [
    "stg_customers", "stg_products", "stg_transactions", "stg_transaction_items",
    "dim_customer", "dim_product", "dim_date", "fact_sales",
    "stg_customers_mt", "stg_products_mt", "stg_transactions_mt", "stg_transaction_items_mt",
    "stg_stores", "stg_promotions", "stg_transaction_promotions", "stg_suppliers",
    "dim_customer_mt", "dim_product_mt", "dim_date_mt", "dim_store", "dim_promotion",
    "fct_sales", "fct_promotion_usage",
]

QUESTIONS = {
    "top_products_per_category": """
SELECT category, product_name, CAST(total_qty AS BIGINT) AS total_qty FROM (
  SELECT category, product_name, total_qty,
         row_number() OVER (PARTITION BY category ORDER BY total_qty DESC, product_name) AS rn
  FROM (SELECT p.category, p.product_name, sum(f.quantity) AS total_qty
        FROM fact_sales f JOIN dim_product p ON f.product_id = p.product_id
        WHERE p.category IS NOT NULL GROUP BY 1, 2))
WHERE rn <= 5""",
    "monthly_revenue": """
SELECT d.year_month, CAST(sum(f.subtotal) AS DOUBLE) AS revenue
FROM fact_sales f JOIN dim_date d ON f.transaction_day = d.date_day GROUP BY 1""",
    "payment_mix": """
SELECT payment_method, CAST(txn_count AS BIGINT) AS txn_count,
       round_even(txn_count / sum(txn_count) OVER () * 100, 1) AS pct
FROM (SELECT payment_method, count(DISTINCT transaction_id) AS txn_count FROM fact_sales GROUP BY 1)""",
    "revenue_by_store": """
SELECT store, month, CAST(sales AS DOUBLE) AS revenue FROM store_months""",
    "revenue_by_store_dense": """
SELECT store, month, CAST(coalesce(sales, 0) AS DOUBLE) AS revenue
FROM (SELECT * FROM (SELECT DISTINCT store FROM store_months), (SELECT DISTINCT month FROM store_months ORDER BY month DESC LIMIT 6))
  LEFT JOIN store_months USING (store, month)""",
    "revenue_by_store_series": """
SELECT names.store, list(cal.month ORDER BY cal.month) AS months,
       list(CAST(coalesce((SELECT x.sales FROM store_months x WHERE x.store = names.store AND x.month = cal.month), 0) AS DOUBLE)
            ORDER BY cal.month) AS data
FROM (SELECT DISTINCT store FROM store_months) names,
     (SELECT month FROM store_months GROUP BY month ORDER BY month DESC LIMIT 6) cal
GROUP BY names.store""",
    "top_promotions": """
SELECT * FROM (
WITH granted AS (SELECT tenant_id, promo_id, sum(discount_applied) AS given FROM fct_promotion_usage GROUP BY ALL),
named AS (SELECT promo_name, sum(given) AS given FROM granted JOIN dim_promotion USING (tenant_id, promo_id) GROUP BY promo_name)
SELECT promo_name AS promo, CAST(given AS DOUBLE) AS total_discount FROM named
QUALIFY row_number() OVER (ORDER BY given DESC, promo_name) <= 10)""",
    "promo_vs_no_promo": """
SELECT * FROM (
WITH baskets AS (SELECT tenant_id, transaction_id, CAST(sum(subtotal) AS DOUBLE) AS worth FROM fct_sales GROUP BY ALL),
used AS (SELECT * FROM baskets SEMI JOIN fct_promotion_usage USING (tenant_id, transaction_id)),
sides AS (SELECT 'with_promo' AS grp, worth FROM used
          UNION ALL SELECT 'no_promo', worth FROM baskets ANTI JOIN fct_promotion_usage USING (tenant_id, transaction_id))
SELECT grp, round_even(avg(worth), 0) AS avg_txn_value, CAST(count(*) AS BIGINT) AS n_transactions FROM sides GROUP BY grp)""",
    "top_products_by_city": """
SELECT city, product_name, CAST(sales AS DOUBLE) AS revenue FROM city_products WHERE place <= 3""",
    "top_products_by_city_wide": """
SELECT city, arg_max(product_name, sales) FILTER (WHERE place = 1) AS product_1, CAST(coalesce(sum(sales) FILTER (WHERE place = 1), 0) AS DOUBLE) AS revenue_1,
       arg_max(product_name, sales) FILTER (WHERE place = 2) AS product_2, CAST(coalesce(sum(sales) FILTER (WHERE place = 2), 0) AS DOUBLE) AS revenue_2,
       arg_max(product_name, sales) FILTER (WHERE place = 3) AS product_3, CAST(coalesce(sum(sales) FILTER (WHERE place = 3), 0) AS DOUBLE) AS revenue_3
FROM city_products GROUP BY city""",
    "customer_segments": """
SELECT city, segment, CAST(count(*) AS BIGINT) AS n_customers FROM buyers JOIN dim_customer_mt USING (tenant_id, customer_id)
GROUP BY city, segment""",
    "customer_segments_wide": """
SELECT city, CAST(sum(CAST(segment = 'High' AS INTEGER)) AS BIGINT) AS High, CAST(sum(CAST(segment = 'Medium' AS INTEGER)) AS BIGINT) AS Medium,
       CAST(sum(CAST(segment = 'Low' AS INTEGER)) AS BIGINT) AS Low
FROM buyers JOIN dim_customer_mt USING (tenant_id, customer_id) GROUP BY city""",
    "transactions_by_weekday": """
SELECT * FROM (
WITH daily AS (SELECT transaction_day, count(DISTINCT (tenant_id, transaction_id)) AS sold, sum(subtotal) AS taken
               FROM fct_sales WHERE tenant_id IS NOT NULL AND transaction_id IS NOT NULL GROUP BY transaction_day)
SELECT CAST(isodow(transaction_day) AS INTEGER) AS dow, dayname(transaction_day) AS day_name,
       CAST(sum(sold) AS BIGINT) AS n_transactions, CAST(sum(taken) AS DOUBLE) AS revenue
FROM daily GROUP BY ALL)""",
}

QUESTION_CTES = """
store_days AS (SELECT tenant_id, store_id, transaction_day, sum(subtotal) AS sales FROM fct_sales GROUP BY ALL),
store_months AS (SELECT store_name AS store, strftime(transaction_day, '%Y-%m') AS month, sum(sales) AS sales
  FROM store_days JOIN dim_store USING (tenant_id, store_id) GROUP BY ALL),
shelf AS (SELECT tenant_id, store_id, product_id, sum(subtotal) AS sales FROM fct_sales GROUP BY ALL),
city_products AS (SELECT city, product_name, sum(sales) AS sales,
    row_number() OVER (PARTITION BY city ORDER BY sum(sales) DESC, product_name) AS place
  FROM shelf JOIN dim_store USING (tenant_id, store_id) JOIN dim_product_mt USING (tenant_id, product_id)
  GROUP BY city, product_name),
spenders AS (SELECT tenant_id, customer_id, CAST(sum(subtotal) AS DOUBLE) AS spent FROM fct_sales GROUP BY ALL),
buyers AS (SELECT tenant_id, customer_id, (['Low', 'Medium', 'High'])[1 + len(list_filter(
    (SELECT quantile_cont(spent, [0.33, 0.66]) FROM spenders), lambda mark: spent >= mark))] AS segment FROM spenders)"""


def oracle_queries() -> dict[str, str]:
    out = {name: with_models(f"SELECT * FROM {name}") for name in MODEL_NAMES}
    for name, final in QUESTIONS.items():
        out[name] = with_models(final, QUESTION_CTES)
    out.update(dq_queries())
    out.update(load_queries())
    return out


# ---- data-quality checks, generated from the declared suite ---------------
def _cols(c):
    return [c] if isinstance(c, str) else list(c)


def _check_sql(model: str, kind: str, arg) -> str:
    head = lambda col, check: f"SELECT '{model}' AS model, '{col}' AS \"column\", '{check}' AS \"check\", "
    if kind == "not_null":
        return head(arg, "not_null") + f"CAST(count(*) FILTER (WHERE {arg} IS NULL) AS BIGINT) AS failures FROM {model}"
    if kind == "unique":
        cs = _cols(arg)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cs)
        return (head(",".join(cs), "unique") + "CAST(count(*) AS BIGINT) AS failures FROM "
                f"(SELECT {', '.join(cs)} FROM {model} WHERE {nn} GROUP BY ALL HAVING count(*) > 1)")
    if kind == "relationships":
        cc, parent, pc = arg
        cc, pc = _cols(cc), _cols(pc)
        nn = " AND ".join(f"c.{c} IS NOT NULL" for c in cc)
        on = " AND ".join(f"p.{p_} = c.{c}" for c, p_ in zip(cc, pc))
        return (head(",".join(cc), "relationships") + "CAST(count(*) AS BIGINT) AS failures "
                f"FROM {model} c WHERE {nn} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {on})")
    col, values = arg
    vals = ", ".join(f"'{v}'" for v in values)
    return (head(col, "accepted_values") + "CAST(count(*) AS BIGINT) AS failures FROM "
            f"(SELECT DISTINCT {col} FROM {model} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))")


def dq_sql(specs, kind=None) -> str:
    selects = []
    for spec in specs:
        for model, m in spec.items():
            for k in ("not_null", "unique", "relationships", "accepted_values"):
                if kind and k != kind:
                    continue
                items = getattr(m, k)
                if k == "accepted_values":
                    items = list(items.items())
                selects += [_check_sql(model, k, a) for a in items]
    return with_models("\nUNION ALL\n".join(selects))


def dq_queries() -> dict[str, str]:
    from tillhouse.plans.checks import suite_specs
    st, mt = suite_specs("single"), suite_specs("multi")
    out = {"dq_suite_single": dq_sql(st), "dq_suite_multi": dq_sql(mt)}
    out["dq_raw_versions"] = with_models(f"SELECT model, \"column\", \"check\", CAST(failures AS BIGINT) AS failures FROM ({DQ_RAW})")
    for kind in ("not_null", "unique", "relationships", "accepted_values"):
        out[f"dq_{kind}"] = dq_sql(st + mt, kind)
    return out


# Spelled out, not taken from the declared suite: each of these fails on the raw versions.
DQ_RAW = """
SELECT 'raw_products' AS model, 'product_id' AS "column", 'not_null' AS "check", count(*) FILTER (WHERE product_id IS NULL) AS failures FROM raw_mt_products
UNION ALL SELECT 'raw_products', 'category', 'not_null', 3 * (SELECT count(*) FROM part WHERE p_partkey % 50 = 0 OR p_type IS NULL)
UNION ALL SELECT 'raw_products', 'is_active', 'not_null', 3 * (SELECT count(*) FROM part WHERE p_partkey % 10 = 0)
UNION ALL SELECT 'raw_products', 'product_id', 'unique', (SELECT count(DISTINCT p_partkey) FROM part)
UNION ALL SELECT 'raw_products', 'brand', 'unique', (SELECT count(DISTINCT p_brand) FROM part)
UNION ALL SELECT 'raw_transactions', 'transaction_id', 'not_null', 0
UNION ALL SELECT 'raw_transactions', 'status', 'not_null', 0
UNION ALL SELECT 'raw_transactions', 'tenant_id,transaction_id', 'unique',
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' OR (o_orderstatus = 'O' AND o_orderkey % 5 = 0))
UNION ALL SELECT 'raw_transactions', 'transaction_id', 'unique',
  (SELECT count(*) FROM (SELECT transaction_id FROM raw_mt_transactions GROUP BY 1 HAVING count(*) >= 2))
UNION ALL SELECT 'raw_transactions', 'payment_method', 'accepted_values',
  (SELECT count(DISTINCT payment_method) FROM mt_orders WHERE payment_method LIKE ' %')
UNION ALL SELECT 'raw_transactions', 'status', 'accepted_values',
  (SELECT count(DISTINCT status) FROM mt_orders WHERE status LIKE ' %')
UNION ALL SELECT 'raw_items', 'tenant_id,item_id', 'unique', (SELECT count(*) FROM mt_lines WHERE is_old)
UNION ALL SELECT 'raw_items', 'tenant_id,transaction_id', 'relationships',
  (SELECT count(*) FROM raw_mt_transaction_items i ANTI JOIN stg_transactions_mt t USING (tenant_id, transaction_id))
UNION ALL SELECT 'raw_items', 'product_id', 'relationships',
  (SELECT count(*) FROM raw_mt_transaction_items WHERE product_id NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 50 <> 0))
UNION ALL SELECT 'raw_junction', 'tenant_id,transaction_id', 'relationships',
  (SELECT count(*) FROM raw_mt_transaction_promotions i ANTI JOIN stg_transactions_mt t USING (tenant_id, transaction_id))
UNION ALL SELECT 'raw_junction', 'promo_id', 'relationships',
  (SELECT count(*) FROM raw_mt_transaction_promotions WHERE promo_id % 5 = 0)"""


# ---- load layer over events / orders ---------------------------------------
_FIRST = """
ev AS (SELECT event_type AS tenant_id, user_id, event_id, ts AS updated_at, value FROM events),
wm1 AS (SELECT tenant_id, CAST(date_trunc('second', max(updated_at)) AS TIMESTAMP) AS watermark
        FROM ev WHERE updated_at < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1),
slice AS (SELECT ev.* FROM ev LEFT JOIN wm1 ON ev.tenant_id = wm1.tenant_id
          WHERE ev.updated_at > coalesce(wm1.watermark, TIMESTAMP '1970-01-01 00:00:00')),
wm2 AS (SELECT tenant_id, CAST(date_trunc('second', max(updated_at)) AS TIMESTAMP) AS watermark
        FROM slice GROUP BY 1)"""

_AUDIT_TABLES = ["customers", "products", "transactions", "transaction_items", "stores", "suppliers",
                 "promotions", "transaction_promotions"]


def load_queries() -> dict[str, str]:
    audit_parts = "\nUNION ALL\n".join(
        f"SELECT tenant_id, '{t}' AS table_name, count(*) AS rows_loaded FROM raw_mt_{t} GROUP BY 1"
        for t in _AUDIT_TABLES)
    return {
        "latest_by_key": "SELECT * FROM events QUALIFY row_number() OVER "
                         "(PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1",
        "compaction_merge": "SELECT * FROM events QUALIFY row_number() OVER "
                            "(PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1",
        "compaction_days": "SELECT * FROM events QUALIFY row_number() OVER "
                           "(PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1",
        "full_load_products": with_models("SELECT * FROM raw_products"),
        "full_load_transactions": with_models("SELECT * FROM raw_transactions"),
        "fct_sales_incremental": with_models("SELECT * FROM fct_sales"),
        "fct_promotion_usage_incremental": with_models("SELECT * FROM fct_promotion_usage"),
        "stored_fact_sales": with_models("SELECT * FROM fact_sales"),
        "stored_dim_store": with_models("SELECT * FROM dim_store"),
        "incremental_slice": f"WITH {_FIRST} SELECT * FROM slice",
        "watermark_advance": f"""WITH {_FIRST}
SELECT coalesce(n.tenant_id, o.tenant_id) AS tenant_id, 'events' AS table_name,
       coalesce(n.watermark, o.watermark) AS watermark, CAST(2 AS BIGINT) AS run_id
FROM wm1 o FULL OUTER JOIN wm2 n ON o.tenant_id = n.tenant_id""",
        "tenant_union": with_models(
            "SELECT tenant_id, transaction_id, customer_id, store_id, transaction_date, total_amount, "
            "payment_method, status FROM mt_orders"),
        "load_audit": with_models(
            f"SELECT tenant_id, table_name, CAST(rows_loaded AS BIGINT) AS rows_loaded FROM per "
            f"UNION ALL SELECT NULL, NULL, CAST(sum(rows_loaded) AS BIGINT) FROM per",
            f"per AS ({audit_parts})"),
        "surrogate_key": f"""SELECT c_custkey, {sk('c_custkey')} AS key_id,
  {sk('c_name', 'c_mktsegment')} AS key_pair, {sk('c_mktsegment', 'CAST(NULL AS VARCHAR)')} AS key_with_null
FROM customer""",
        "initcap_alnum": f"""SELECT p_partkey, {initcap('p_name')} AS name_title,
  {initcap('p_type')} AS type_title, {initcap('p_brand')} AS brand_title FROM part""",
    }
