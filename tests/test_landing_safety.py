"""Loads and compaction lose nothing: skipped days, quiet days, retries, drift, odd tenant ids."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillhouse.plans import jobs
from tillhouse.sources.manifest import published

T0 = dt.datetime(2024, 1, 1)


def customers(spark, rows):
    """rows: (tenant, id, name, day)."""
    data = [(t, i, n, None, None, None, None, None, T0 + dt.timedelta(days=d)) for t, i, n, d in rows]
    return spark.createDataFrame(data, "tenant_id string, customer_id long, name string, phone string, email string, "
                                       "gender string, city string, created_at timestamp_ntz, updated_at timestamp_ntz")


def load(spark, root, rows, run):
    return jobs.load_incremental(spark, {"customers": customers(spark, rows)}, f"{root}/landing", f"{root}/state", run)


def compacted(spark, root, run):
    df = jobs.compact_tables(spark, f"{root}/landing", f"{root}/compact", ["customers"], run)["customers"]
    return sorted((r["tenant_id"], r["customer_id"], r["name"]) for r in df.collect())


def test_compaction_takes_every_batch_since_the_last(spark, tmp_root):
    days = [[("a", 1, "one", 1), ("a", 2, "two", 1)], [("a", 1, "one-2", 2), ("a", 9, "new-2", 2)], [("a", 2, "two-3", 3)]]
    load(spark, tmp_root, days[0], 1)
    assert compacted(spark, tmp_root, 1) == [("a", 1, "one"), ("a", 2, "two")]
    load(spark, tmp_root, days[1], 2)                      # its compaction is skipped
    load(spark, tmp_root, days[2], 3)
    want = [("a", 1, "one-2"), ("a", 2, "two-3"), ("a", 9, "new-2")]
    assert compacted(spark, tmp_root, 3) == want
    for quiet in (4, 5):                                   # nothing new: the copy stays
        load(spark, tmp_root, days[2], quiet)
        assert compacted(spark, tmp_root, quiet) == want
    load(spark, tmp_root, [("b", 1, "other", 6)], 6)
    assert compacted(spark, tmp_root, 6) == want + [("b", 1, "other")]


def test_retry_gives_the_same_rows_and_audit(spark, tmp_root):
    rows = [("01", 1, "x", 1), ("1", 1, "y", 1)]
    first = sorted(map(str, load(spark, tmp_root, rows, 1).collect()))
    assert sorted(map(str, load(spark, tmp_root, rows, 1).collect())) == first
    assert compacted(spark, tmp_root, 1) == [("01", 1, "x"), ("1", 1, "y")]       # ids stay text
    assert jobs.read_state(spark, f"{tmp_root}/state").count() == 2
    load(spark, tmp_root, [("1", 2, "z", 2)], 2)
    assert ("1", 2, "z") in compacted(spark, tmp_root, 2)


def test_empty_first_batch_drift_and_booleans(spark, tmp_root):
    assert {r["rows_loaded"] for r in load(spark, tmp_root, [], 1).collect()} == {0}
    more = customers(spark, [("a", 1, "n", 1)]).withColumn("extra", F.lit(1))
    jobs.load_incremental(spark, {"customers": more}, f"{tmp_root}/landing", f"{tmp_root}/state", 2)
    assert "extra" not in jobs.landing.read_landed(spark, f"{tmp_root}/landing/customers").columns
    with pytest.raises(Exception, match="name"):
        jobs.load_incremental(spark, {"customers": more.drop("name")}, f"{tmp_root}/landing", f"{tmp_root}/state", 3)
    products = spark.createDataFrame([("a", 1, "p", "c", "b", 1.0, True, None, T0)],
                                     "tenant_id string, product_id long, product_name string, category string, brand string, "
                                     "unit_price double, is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz")
    jobs.load_incremental(spark, {"products": products}, f"{tmp_root}/landing", f"{tmp_root}/state", 4)
    jobs.land_raw_single(spark, {"products": products.drop("tenant_id", "updated_at")}, f"{tmp_root}/raw")
    for row in (spark.read.parquet(f"{tmp_root}/landing/products").first(), published(spark, f"{tmp_root}/raw/products").first()):
        assert row["is_active"] == 1 and row["is_active"] is not True


def test_a_batch_reads_only_its_files(spark, tmp_root):
    load(spark, tmp_root, [("a", 1, "x", 1)], 1)
    load(spark, tmp_root, [("a", 1, "y", 2)], 2)
    df = jobs.landing.read_landed(spark, f"{tmp_root}/landing/customers", 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_batch_id" in plan and df.count() == 1
