import datetime as dt
import os

from pyspark.sql import functions as F

from tillhouse.plans import jobs, staging
from tillhouse.sources.manifest import PublishedTable
from tillhouse.sources import jdbc, landing, watermark
from tillhouse.streaming import land_new_files

T = dt.datetime
SRC = "tenant_id string, id long, v string, updated_at timestamp_ntz"


def test_watermark_truncation_strictness_and_defaults(spark):
    state = spark.createDataFrame([("t1", "tx", T(2024, 1, 1, 10, 0, 5), 1), ("t2", "tx", T(2024, 1, 1), 1)],
                                  "tenant_id string, table_name string, watermark timestamp_ntz, run_id long")
    src = spark.createDataFrame([
        ("t1", 1, "re-pulled", T(2024, 1, 1, 10, 0, 5, 300000)),   # same second, later micro: pulled again
        ("t1", 2, "equal", T(2024, 1, 1, 10, 0, 5)),                # equal to watermark: skipped
        ("t1", 3, "older", T(2024, 1, 1, 9)),                       # below: skipped
        ("t3", 4, "new tenant", T(1999, 1, 1)),                     # no state: epoch
    ], SRC)
    got = sorted(r.v for r in watermark.slice_since(src, state, "tx").collect())
    assert got == ["new tenant", "re-pulled"]
    marks = watermark.batch_watermarks(watermark.slice_since(src, state, "tx"), "tx", 2)
    new = {(r.tenant_id, r.table_name): r.watermark for r in watermark.advance(state, marks, 2).collect()}
    assert new == {("t1", "tx"): T(2024, 1, 1, 10, 0, 5), ("t2", "tx"): T(2024, 1, 1),
                   ("t3", "tx"): T(1999, 1, 1)}
    # unknown table starts at the epoch
    assert watermark.slice_since(src, state, "other").count() == 4


def test_incremental_load_twice_is_idempotent(spark, tmp_root):
    src = spark.createDataFrame([("t1", 1, "a", T(2024, 1, 1, 0, 0, 0, 500)), ("t2", 1, "b", T(2024, 1, 1))], SRC)
    landing_root, state = f"{tmp_root}/landing", f"{tmp_root}/state"
    a1 = {(r.tenant_id, r.table_name): r.rows_loaded
          for r in jobs.load_incremental(spark, {"tx": src}, landing_root, state, 1).collect()}
    assert a1 == {("t1", "tx"): 1, ("t2", "tx"): 1, (None, None): 2}
    # run 2: one row changed, plus the sub-second row is re-pulled
    src2 = src.unionByName(spark.createDataFrame([("t2", 1, "b2", T(2024, 1, 2))], SRC))
    a2 = {(r.tenant_id, r.table_name): r.rows_loaded
          for r in jobs.load_incremental(spark, {"tx": src2}, landing_root, state, 2).collect()}
    assert a2 == {("t1", "tx"): 1, ("t2", "tx"): 1, (None, None): 2}
    landed = landing.read_landed(spark, f"{landing_root}/tx")
    from tillhouse.operators import latest_by_key
    latest = {(r.tenant_id, r.id): r.v for r in latest_by_key(landed, ["tenant_id", "id"]).collect()}
    assert latest == {("t1", 1): "a", ("t2", 1): "b2"}
    cur = {r.tenant_id: r.watermark for r in watermark.current(jobs.read_state(spark, state)).collect()}
    assert cur == {"t1": T(2024, 1, 1), "t2": T(2024, 1, 2)}
    # compaction keeps one version per key
    comp = landing.compact(landed, PublishedTable(spark, f"{tmp_root}/compact"), ["tenant_id", "id"], buckets=4)
    assert comp.count() == 2


def test_fan_in_and_full_load_audit(spark, tmp_root):
    a = spark.createDataFrame([(1, "x")], "id long, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z")], "id long, v string")
    u = jdbc.fan_in({"t1": a, "t2": b})
    assert u.columns[0] == "tenant_id" and u.count() == 3
    audit = {(r.tenant_id, r.table_name): r.rows_loaded for r in landing.load_audit({"v": u}).collect()}
    assert audit == {("t1", "v"): 1, ("t2", "v"): 2, (None, None): 3}


def test_jdbc_incremental_read_pushes_filter(spark):
    url = "jdbc:derby:memory:tillhouse_t;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.createDataFrame([(i, f"n{i}", T(2024, 1, 1 + i)) for i in range(10)],
                                 "ID long, NAME string, UPDATED_AT timestamp")
    rows.write.format("jdbc").option("url", url).option("dbtable", "CUSTOMERS") \
        .option("driver", props["driver"]).mode("overwrite").save()
    df = jdbc.read_since(spark, url, "CUSTOMERS", T(2024, 1, 5), props, version_col="UPDATED_AT",
                         partition_column="ID", lower_bound=0, upper_bound=10, num_partitions=3)
    assert sorted(r.ID for r in df.collect()) == [5, 6, 7, 8, 9]
    assert df.rdd.getNumPartitions() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "UPDATED_AT" in plan.split("PushedFilters")[1][:200]
    full = jdbc.read_full(spark, url, "CUSTOMERS", props)
    assert full.count() == 10


def test_stream_lands_only_new_files(spark, tmp_root):
    schema = "tenant_id string, id long, updated_at timestamp_ntz"
    src, out, ck = f"{tmp_root}/src", f"{tmp_root}/out", f"{tmp_root}/ck"
    spark.createDataFrame([("t1", 1, T(2024, 1, 1))], schema).write.parquet(f"{src}/f1")
    from pyspark.sql.types import StructType
    st = StructType.fromDDL(schema)
    land_new_files(spark, f"{src}/*", st, out, ck)
    spark.createDataFrame([("t2", 2, T(2024, 1, 2))], schema).write.parquet(f"{src}/f2")
    land_new_files(spark, f"{src}/*", st, out, ck)
    got = sorted((r.tenant_id, r.id, r._batch_id) for r in spark.read.parquet(out).collect())
    assert got == [("t1", 1, 0), ("t2", 2, 1)]
    # a replayed epoch replaces its first attempt instead of adding a copy
    from tillhouse.streaming.file_landing import epoch_writer
    replay = spark.createDataFrame([("t2", 2, T(2024, 1, 2))], schema)
    epoch_writer(out)(replay, 1)
    got = sorted((r.tenant_id, r.id, r._batch_id) for r in spark.read.parquet(out).collect())
    assert got == [("t1", 1, 0), ("t2", 2, 1)]


def test_jdbc_multi_tenant_incremental_load(spark, tmp_root):
    url = "jdbc:derby:memory:tillhouse_mt;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}

    def put(schema, rows):
        df = spark.createDataFrame(rows, "customer_id long, name string, updated_at timestamp")
        df.write.format("jdbc").option("url", url).option("dbtable", f"{schema}.customers") \
            .option("driver", props["driver"]).mode("overwrite").save()

    put("A", [(1, "a1", T(2024, 1, 1, 10, 0, 0)), (2, "a2", T(2024, 1, 1, 11, 0, 0))])
    put("B", [(1, "b1", T(2024, 1, 2, 10, 0, 0))])            # id 1 collides across tenants
    src = {"customers": jdbc.incremental_source(spark, url, {"ta": "A", "tb": "B"}, "customers", props)}
    land, state = f"{tmp_root}/landing", f"{tmp_root}/state"
    a1 = jobs.load_incremental(spark, src, land, state, 1, schemas={})
    assert {(r.tenant_id, r.rows_loaded) for r in a1.collect()} == {("ta", 2), ("tb", 1), (None, 3)}
    put("A", [(1, "a1", T(2024, 1, 1, 10, 0, 0)), (2, "a2-new", T(2024, 1, 3, 9, 0, 0))])
    a2 = jobs.load_incremental(spark, src, land, state, 2, schemas={})
    assert {(r.tenant_id, r.rows_loaded) for r in a2.collect()} == {("ta", 1), ("tb", 0), (None, 1)}
    from tillhouse.operators import latest_by_key
    latest = {(r.tenant_id, r.customer_id): r.name for r in
              latest_by_key(landing.read_landed(spark, f"{land}/customers"), ["tenant_id", "customer_id"]).collect()}
    assert latest == {("ta", 1): "a1", ("ta", 2): "a2-new", ("tb", 1): "b1"}


def test_merge_versions_equals_dedup_of_union(spark):
    base_rows = [("t1", 1, "a", T(2024, 1, 1), 0), ("t1", 2, "b", T(2024, 1, 1), 0), ("t2", 1, "c", T(2024, 1, 5), 0)]
    delta_rows = [("t1", 1, "a2", T(2024, 1, 2), 1),        # newer: replaces
                  ("t2", 1, "c-old", T(2024, 1, 3), 1),     # older than base: base stays
                  ("t1", 3, "new", T(2024, 1, 2), 1),       # new key
                  ("t1", 3, "new2", T(2024, 1, 2), 1)]      # same-second duplicate in the batch
    schema = "tenant_id string, id long, v string, updated_at timestamp_ntz, _batch_id long"
    base = spark.createDataFrame(base_rows, schema)
    delta = spark.createDataFrame(delta_rows, schema)
    from tillhouse.operators import latest_by_key
    got = {(r.tenant_id, r.id): r.v for r in landing.merge_versions(base, delta, ["tenant_id", "id"]).collect()}
    want = {(r.tenant_id, r.id): r.v for r in latest_by_key(base.unionByName(delta), ["tenant_id", "id"]).collect()}
    assert set(got) == set(want) and got[("t1", 1)] == "a2" and got[("t2", 1)] == "c" and got[("t1", 2)] == "b"
    assert got[("t1", 3)] in ("new", "new2")


def _derby(spark, name, table, rows, ddl):
    url, props = f"jdbc:derby:memory:{name};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.createDataFrame(rows, ddl).write.format("jdbc").option("url", url).option("dbtable", table) \
        .option("driver", props["driver"]).mode("overwrite").save()
    return url, props


def test_key_ranges_even_out_skewed_keys_and_keep_null_ones(spark):
    from collections import Counter
    keys = [*range(1, 901), *range(1_000_000, 1_000_100), -50, None, None]    # crowded at one end, gaps, negative, null
    rows = [(k, f"n{i}", T(2024, 1, 1 + i % 20)) for i, k in enumerate(keys)]
    url, props = _derby(spark, "tillhouse_r", "SALES", rows, "ID long, NAME string, UPDATED_AT timestamp")
    df = jdbc.read_ranges(spark, url, "SALES", "ID", 8, T(2024, 1, 5), "UPDATED_AT", props)
    want = Counter((r[0], r[1]) for r in rows if r[2] > T(2024, 1, 5))
    assert Counter((r.ID, r.NAME) for r in df.collect()) == want
    assert df.rdd.getNumPartitions() >= 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "UPDATED_AT" in plan.split("PushedFilters")[1][:200]
    # a uniform key: many tasks with like shares
    url, props = _derby(spark, "tillhouse_u", "SALES", [(k, "n", T(2024, 1, 9)) for k in range(800)], "ID long, NAME string, UPDATED_AT timestamp")
    even = jdbc.read_ranges(spark, url, "SALES", "ID", 8, None, "UPDATED_AT", props)
    sizes = [n for n in even.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n]
    assert sum(sizes) == 800 and 8 <= len(sizes) <= 10 and max(sizes) <= 2 * 800 / 8
    whole = jdbc.read_ranges(spark, url, "SALES", "ID", 4, version_col=None, properties=props)
    assert whole.count() == 800
    nothing = jdbc.read_ranges(spark, url, "SALES", "ID", 4, T(2030, 1, 1), "UPDATED_AT", props)
    assert nothing.count() == 0


def test_configured_load_reads_all_tenants_in_ranges(spark, tmp_root):
    for schema, n in (("A", 40), ("B", 10)):
        url, props = _derby(spark, "tillhouse_c", f"{schema}.customers", [(i, f"{schema}{i}", T(2024, 1, 1 + i % 9)) for i in range(n)],
                            "customer_id long, name string, updated_at timestamp")
        _derby(spark, "tillhouse_c", f"{schema}.stores", [(1, "s", T(2024, 1, 1))], "store_id long, name string, updated_at timestamp")
    config = {"url": url, "properties": props, "tenants": {"ta": "A", "tb": "B"},
              "tables": {"customers": {"split_on": "customer_id", "num_ranges": 4}, "stores": {}}}
    src = jdbc.configured_sources(spark, config)
    audit = jobs.load_incremental(spark, src, f"{tmp_root}/l", f"{tmp_root}/s", 1, schemas={})
    assert {(r.tenant_id, r.table_name, r.rows_loaded) for r in audit.collect()} == {
        ("ta", "customers", 40), ("tb", "customers", 10), ("ta", "stores", 1), ("tb", "stores", 1), (None, None, 52)}
    assert src["customers"](watermark.empty_state(spark)).rdd.getNumPartitions() > 6
    again = jobs.load_incremental(spark, src, f"{tmp_root}/l", f"{tmp_root}/s", 2, schemas={})
    assert {(r.tenant_id, r.table_name, r.rows_loaded) for r in again.collect()} == {
        ("ta", "customers", 0), ("tb", "customers", 0), ("ta", "stores", 0), ("tb", "stores", 0), (None, None, 0)}


def test_state_is_read_from_the_last_complete_run_alone(spark, tmp_root):
    state = f"{tmp_root}/s"
    mark = lambda day: spark.createDataFrame([("t", "x", T(2024, 1, day))], "tenant_id string, table_name string, watermark timestamp_ntz")
    for run, day in ((1, 1), (2, 5), (10, 7)):
        mark(day).write.parquet(f"{state}/run_id={run}")
    os.makedirs(f"{state}/run_id=11/_temporary")                             # broke off while it wrote
    os.makedirs(f"{state}/run_id=12")
    got = jobs.last_state(spark, state, 13)
    assert [tuple(r) for r in got.collect()] == [("t", "x", T(2024, 1, 7), 10)]
    assert {f.split("run_id=")[1].split("/")[0] for f in got.inputFiles()} == {"10"}
    assert jobs.last_state(spark, state, 10).first().watermark == T(2024, 1, 5)
    assert jobs.last_state(spark, state, 1).count() == 0 and jobs.last_state(spark, f"{tmp_root}/none", 5).count() == 0


def test_audit_reads_no_column_of_the_landed_batch(spark, tmp_root):
    """Tenants are folders and rows are counted in the file footers."""
    df = spark.createDataFrame([("t1", 1, T(2024, 1, 1)), ("t1", 2, T(2024, 1, 1)), ("t2", 3, T(2024, 1, 1))],
                               "tenant_id string, id long, updated_at timestamp_ntz")
    landing.append_versions(df, f"{tmp_root}/x", 4)
    audit = landing.load_audit({"x": landing.read_landed(spark, f"{tmp_root}/x", 4)})
    plan = spark._jvm.PythonSQLUtils.explainString(audit._jdf.queryExecution(), "formatted")
    assert "ReadSchema: struct<>" in plan and "updated_at" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert {(r.tenant_id, r.rows_loaded) for r in audit.collect()} == {("t1", 2), ("t2", 1), (None, 3)}
