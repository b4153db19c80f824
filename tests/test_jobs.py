import datetime as dt

from pyspark.sql import functions as F

from tillhouse.plans import jobs
from tillhouse.schemas import RAW_ST, conform
from tillhouse.sources.manifest import published
from tillhouse.sources.tpch import DriverTables, raw_multi, raw_single

SMOKE = "/root/testdata/sf0.001"


def test_conform_booleans_to_int_and_drops_extra(spark):
    df = spark.createDataFrame([(1, "p", True, "x"), (2, "q", None, "y")],
                               "product_id long, product_name string, is_active boolean, extra string")
    df = df.withColumn("unit_price", F.lit(1).cast("decimal(12,2)"))
    for c in ("category", "brand"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    out = conform(df, RAW_ST["products"])
    assert out.columns == [f.name for f in RAW_ST["products"].fields]
    assert [r.is_active for r in out.collect()] == [1, None]


def test_full_load_replaces_and_keeps_empty_tables(spark, tmp_root):
    t = DriverTables(spark, SMOKE)
    src = raw_single(t)
    audit = {r.table_name: r.rows_loaded for r in jobs.load_full(spark, src, f"{tmp_root}/raw").collect()}
    assert audit["transactions"] == spark.read.parquet(f"{SMOKE}/orders.parquet").count()
    empty = {k: v.limit(0) for k, v in src.items()}
    jobs.load_full(spark, empty, f"{tmp_root}/raw")
    assert published(spark, f"{tmp_root}/raw/transactions").count() == 0


def test_daily_jobs_end_to_end(spark, tmp_root):
    t = DriverTables(spark, SMOKE)
    failing_st = jobs.daily_single(spark, raw_single(t), f"{tmp_root}/st").collect()
    assert failing_st == []
    # the source database holds one (current) version per row
    current = {"transactions": 1, "transaction_items": 1}
    src = {k: v.where(F.col("_batch_id") == current.get(k, 0)).drop("_batch_id")
           for k, v in raw_multi(t).items()}
    # two runs over the same source: the second lands only the re-pulled last second
    f1 = jobs.daily_multi(spark, src, f"{tmp_root}/mt", 1).collect()
    marts1 = published(spark, f"{tmp_root}/mt/marts/fct_sales").agg(F.count("*"), F.sum("subtotal")).first()
    f2 = jobs.daily_multi(spark, src, f"{tmp_root}/mt", 2).collect()
    marts2 = published(spark, f"{tmp_root}/mt/marts/fct_sales").agg(F.count("*"), F.sum("subtotal")).first()
    assert tuple(marts1) == tuple(marts2)
    assert f1 == [] and f2 == []


def test_compacted_daily_flow_equals_dedup_on_read(spark, tmp_root):
    t = DriverTables(spark, SMOKE)
    current = {"transactions": 1, "transaction_items": 1}
    src = {k: v.where(F.col("_batch_id") == current.get(k, 0)).drop("_batch_id")
           for k, v in raw_multi(t).items()}
    # day 2: every 10th transaction is cancelled with a later version
    changed = (src["transactions"].where(F.pmod("transaction_id", F.lit(10)) == 0)
               .withColumn("status", F.lit("cancelled"))
               .withColumn("updated_at", F.timestamp_add("DAY", F.lit(400), F.col("updated_at"))))
    src2 = dict(src, transactions=src["transactions"].unionByName(changed))

    def totals(root):
        return tuple(published(spark, f"{root}/marts/fct_sales").agg(F.count("*"), F.sum("subtotal")).first())

    plain, comp = f"{tmp_root}/plain", f"{tmp_root}/comp"
    assert jobs.daily_multi(spark, src, plain, 1).collect() == []
    assert jobs.daily_multi(spark, src, comp, 1, compacted=True).collect() == []
    assert totals(plain) == totals(comp)
    assert jobs.daily_multi(spark, src2, plain, 2).collect() == []
    assert jobs.daily_multi(spark, src2, comp, 2, compacted=True).collect() == []
    assert totals(plain) == totals(comp)
    import os
    # only the table that changed on day 2 got a new compacted copy
    assert os.path.isdir(f"{comp}/compact/transactions/v2")
    assert not os.path.exists(f"{comp}/compact/transaction_items/v2")
