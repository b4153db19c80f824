"""Published tables, bucketed compaction and the incremental fact build: equal to
the full results, untouched files stay, readers and failed writes do no harm."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import latest_by_key
from tillhouse.plans import incremental, jobs
from tillhouse.schemas import RAW_MT, conform
from tillhouse.sources import landing
from tillhouse.sources.manifest import PublishedTable, publish, published
from tillhouse.streaming.file_landing import epoch_writer

T0 = dt.datetime(2024, 1, 1)
VERSION = "tenant_id string, id long, name string, updated_at timestamp_ntz"
KEYS = ["tenant_id", "id"]


def files(table):
    """File names of the newest version by partition."""
    return {p: sorted(f for f in os.listdir(f"{table.path}/{d}") if f.endswith(".parquet"))
            for p, d in table.manifest()["parts"].items()}


def rows(df):
    return sorted(map(str, df.collect()))


# ---- published tables ---------------------------------------------------------
def test_a_reader_keeps_its_version_and_a_failed_write_changes_nothing(spark, tmp_root):
    path = f"{tmp_root}/t"
    publish(spark.createDataFrame([(1, "a")], "id long, v string"), path)
    reader = published(spark, path)
    publish(spark.createDataFrame([(2, "b"), (3, "c")], "id long, v string"), path)
    assert rows(reader) == ["Row(id=1, v='a')"] and published(spark, path).count() == 2
    bad = spark.range(3).select("id", F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.lit("x")).alias("v"))
    with pytest.raises(Exception, match="no"):
        publish(bad, path)
    assert published(spark, path).count() == 2
    publish(spark.createDataFrame([], "id long, v string"), path)             # takes the version of the failed write
    assert published(spark, path).count() == 0 and published(spark, path).columns == ["id", "v"]


def test_partitions_are_replaced_alone(spark, tmp_root):
    table = PublishedTable(spark, f"{tmp_root}/t")
    df = spark.createDataFrame([("x/y", 1), ("b", 2), ("c=%", 3)], "p string, v long")
    table.replace(df, F.col("p"))
    before = files(table)
    assert table.parts() == ["b", "c=%", "x/y"]
    out = table.replace(df.where("p = 'b'").withColumn("v", F.lit(9).cast("long")), F.col("p"), ["b", "c=%"])
    assert sorted(map(tuple, out.collect())) == [("b", 9), ("x/y", 1)]        # c had no rows any more
    assert files(table)["x/y"] == before["x/y"] and files(table)["b"] != before["b"]
    assert table.read(["x/y"]).count() == 1 and table.read([]).count() == 0
    with pytest.raises(ValueError, match="not replaced"):
        table.replace(df.where("p = 'x/y'"), F.col("p"), ["b"])
    assert table.read().count() == 2
    assert table.retain(1) == ["v3"] or table.retain(1) == []                 # the refused write left v3
    assert table.read().count() == 2


def test_a_second_writer_of_a_version_is_refused(spark, tmp_root):
    table = PublishedTable(spark, f"{tmp_root}/t")
    table.replace(spark.range(1))
    stale = table.manifest()
    table.replace(spark.range(2))
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit({**stale, "version": 2})
    assert table.read().count() == 2


# ---- compaction ---------------------------------------------------------------
def land(spark, path, batch, data):
    df = spark.createDataFrame([(t, i, n, T0 + dt.timedelta(days=d)) for t, i, n, d in data], VERSION)
    landing.append_versions(df, path, batch)


def landed(spark, path):
    return spark.read.schema(f"{VERSION}, _batch_id long").parquet(path)


def test_compaction_equals_dedup_over_skips_retries_and_quiet_days(spark, tmp_root):
    path, table = f"{tmp_root}/x", PublishedTable(spark, f"{tmp_root}/c")

    def check(up_to=None):
        got = landing.compact(landed(spark, path), table, KEYS, buckets=16, up_to=up_to)
        seen = landed(spark, path) if up_to is None else landed(spark, path).where(F.col("_batch_id") <= up_to)
        assert rows(got.select(*VERSION_COLUMNS)) == rows(latest_by_key(seen, KEYS).select(*VERSION_COLUMNS))

    VERSION_COLUMNS = ["tenant_id", "id", "name", "updated_at", "_batch_id"]
    land(spark, path, 1, [(t, i, "one", 1) for t in ("01", "1", "b") for i in range(40)])
    check()
    before = files(table)
    land(spark, path, 2, [("01", 1, "two", 2), ("1", 99, "new", 2)])
    check()
    changed = [p for p, f in files(table).items() if before.get(p) != f]
    assert 1 <= len(changed) <= 2                                             # the buckets of two keys
    # the batch is retried: one row more, one less, one older than before
    land(spark, path, 2, [("01", 1, "two", 0), ("1", 7, "late", 2)])
    check()
    land(spark, path, 3, [("b", 3, "three", 3)])                              # compaction skipped
    land(spark, path, 4, [("b", 3, "four", 3), ("b", 4, "four", 4)])          # a tie: the later batch wins
    check()
    quiet = files(table)
    land(spark, path, 5, [])
    check()
    check()
    assert files(table) == quiet
    land(spark, path, 2, [])                                                  # retried as an empty batch
    check()
    land(spark, path, 6, [("01", 1, "six", 6)])
    check(up_to=5)                                                            # batch 6 is not taken yet
    check()


def test_only_touched_buckets_are_read(spark, tmp_root):
    path, table = f"{tmp_root}/x", PublishedTable(spark, f"{tmp_root}/c")
    land(spark, path, 1, [("a", i, "one", 1) for i in range(200)])
    landing.compact(landed(spark, path), table, KEYS, buckets=32)
    land(spark, path, 2, [("a", 5, "two", 2)])
    landing.compact(landed(spark, path), table, KEYS, buckets=32)
    m = table.manifest()
    assert sum(d.startswith("v2/") for d in m["parts"].values()) == 1
    assert m["buckets"] if "buckets" in m else m["meta"]["buckets"] == 32


def test_batches_and_streams_share_a_layout(spark, tmp_root):
    path = f"{tmp_root}/x"
    land(spark, path, 1, [("a", 1, "batch", 1), ("b", 1, "batch", 1)])
    streamed = spark.createDataFrame([("a", 1, "stream", T0 + dt.timedelta(days=2))], VERSION)
    for _ in range(2):                                                        # an epoch that is replayed
        epoch_writer(path, batch_offset=10)(streamed, 0)
    assert sorted((r["_batch_id"], r["tenant_id"]) for r in landed(spark, path).collect()) == [(1, "a"), (1, "b"), (10, "a")]
    one = landing.read_landed(spark, path, 10)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "_batch_id" in plan.split("PartitionFilters: [")[1].split("]")[0] and one.count() == 1


# ---- incremental facts --------------------------------------------------------
def batch(spark, root, run, txns=(), items=(), promos=()):
    """txns: (tenant, id, day, status); items: (tenant, item, txn, subtotal); promos: (tenant, id, txn)."""
    at = T0 + dt.timedelta(days=run)
    t = spark.createDataFrame([(t, i, 1, 1, dt.datetime(2024, *d), 5.0, "cash", s, at) for t, i, d, s in txns],
                              "tenant_id string, transaction_id long, customer_id long, store_id long, transaction_date timestamp_ntz, "
                              "total_amount double, payment_method string, status string, updated_at timestamp_ntz")
    i = spark.createDataFrame([(t, i, x, 1, 1, 1.0, 0.0, v, at) for t, i, x, v in items],
                              "tenant_id string, item_id string, transaction_id long, product_id long, quantity int, unit_price double, "
                              "discount double, subtotal double, updated_at timestamp_ntz")
    p = spark.createDataFrame([(t, i, x, 1, 1.0, at) for t, i, x in promos],
                              "tenant_id string, id string, transaction_id long, promo_id long, discount_applied double, updated_at timestamp_ntz")
    tables = {"transactions": t, "transaction_items": i, "transaction_promotions": p}
    for name, df in tables.items():
        out = conform(df.withColumn("_batch_id", F.lit(run).cast("long")), RAW_MT[name])
        landing.append_versions(out, f"{root}/landing/{name}", run)
    return list(tables)


def facts(spark, root, run, names):
    raw = jobs.compact_tables(spark, f"{root}/landing", f"{root}/compact", names, run, buckets=8)
    got = incremental.build_facts(spark, raw, f"{root}/landing", f"{root}/marts", run, RAW_MT)
    full = incremental.build_facts(spark, raw, f"{root}/landing", f"{root}/full-{run}-{len(os.listdir(root))}", run, RAW_MT)
    for name in incremental.FACTS:
        assert rows(got[name].drop("loaded_at")) == rows(full[name].drop("loaded_at")), name
    return got


def test_facts_follow_moves_cancellations_and_late_lines(spark, tmp_root):
    r = tmp_root
    names = batch(spark, r, 1, [("a", 1, (1, 5), "completed"), ("a", 2, (2, 5), "completed"), ("b", 1, (1, 9), "completed"), ("b", 2, (3, 1), "pending")],
                  [("a", "i1", 1, 1.0), ("a", "i2", 2, 2.0), ("b", "i1", 1, 3.0), ("b", "i2", 2, 4.0), ("b", "i3", None, 4.0)], [("a", "p1", 1), ("b", "p1", 2)])
    assert facts(spark, r, 1, names)["fct_sales"].count() == 3
    table = PublishedTable(spark, f"{r}/marts/fct_sales")
    assert table.parts() == ["a|2024-01", "a|2024-02", "b|2024-01"]
    before = files(table)
    batch(spark, r, 2, [("a", 1, (4, 5), "completed")])                       # moves to another month
    facts(spark, r, 2, names)
    assert table.parts() == ["a|2024-02", "a|2024-04", "b|2024-01"]
    batch(spark, r, 3, [("b", 2, (3, 1), "completed"), ("a", 2, (2, 5), " CANCELLED ")])
    facts(spark, r, 3, names)
    assert table.parts() == ["a|2024-04", "b|2024-01", "b|2024-03"]
    batch(spark, r, 4, [], [("a", "i9", 1, 9.0), ("b", "i2", 1, 4.5)])        # a late line, and one that changes its transaction
    facts(spark, r, 4, names)
    assert table.parts() == ["a|2024-04", "b|2024-01"]
    batch(spark, r, 5, [("a", 7, (6, 1), "completed")], [("a", "i7", 7, 7.0)])
    facts(spark, r, 5, names)
    assert "a|2024-06" in table.parts()
    untouched = files(table)
    batch(spark, r, 6)                                                        # nothing changed
    facts(spark, r, 6, names)
    assert files(table) == untouched and untouched["b|2024-01"] != before["b|2024-01"]
    batch(spark, r, 7, [("a", 7, (6, 2), "completed")])
    facts(spark, r, 7, names)
    now = files(table)
    assert [p for p in now if now[p] != untouched[p]] == ["a|2024-06"]        # other partitions keep their files
    batch(spark, r, 5, [("a", 8, (7, 1), "completed")], [("a", "i8", 8, 8.0)])  # batch 5 replaced after it was taken
    facts(spark, r, 7, names)
    assert "a|2024-07" in table.parts()


def test_a_failing_check_ends_the_day(spark):
    results = spark.createDataFrame([("m", "c", "unique", 2), ("m", "d", "not_null", 0)], jobs.CHECK_RESULT_SCHEMA)
    with pytest.raises(jobs.ChecksFailed, match="m.c unique: 2") as e:
        jobs.gate(results)
    assert len(e.value.failures) == 1
    assert jobs.gate(results, "return").count() == 1
    assert jobs.gate(results.where("failures = 0")).count() == 0


def test_a_batch_of_one_tenant_leaves_the_buckets_of_others(spark, tmp_root):
    path, table = f"{tmp_root}/landing", PublishedTable(spark, f"{tmp_root}/compact")
    land(spark, path, 1, [("a", i, "v1", 1) for i in range(20)] + [("b", i, "v1", 1) for i in range(20)])
    landing.compact(landed(spark, path), table, KEYS, buckets=2, group="tenant_id")
    before = table.manifest()["parts"]
    assert sorted(before) == ["a|0", "a|1", "b|0", "b|1"]
    land(spark, path, 2, [("b", i, "v2", 2) for i in range(20)])
    got = landing.compact(landed(spark, path), table, KEYS, buckets=2)             # the table keeps its layout
    after = table.manifest()["parts"]
    assert {p for p in after if after[p] != before[p]} == {"b|0", "b|1"}
    assert {(r["tenant_id"], r["name"]) for r in got.collect()} == {("a", "v1"), ("b", "v2")} and got.count() == 40


def test_compaction_sends_versions_once_unless_many_are_of_the_same_keys(spark, monkeypatch):
    one = spark.range(1000).selectExpr("'a' as tenant_id", "id", "1 as updated_at", "1 as _batch_id")
    many = spark.range(1000).selectExpr("'a' as tenant_id", "id % 10 as id", "id as updated_at", "1 as _batch_id")

    def run(df):
        out, parts = landing._latest_in_parts(df, None, KEYS, "updated_at", ("_batch_id",), landing.part_of(KEYS, 4), 4)
        exchanges = [l for l in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in l]
        assert set(parts) <= {"0", "1", "2", "3"}
        return len(exchanges), out

    assert run(one)[0] == 1 and run(one)[1].count() == 1000
    assert run(many)[0] == 2 and sorted(r["updated_at"] for r in run(many)[1].collect()) == list(range(990, 1000))
    monkeypatch.setattr(landing, "ROWS_PER_TASK", 50)                               # parts split by key
    n, out = run(one)
    assert n == 1 and out.count() == 1000 and out.groupBy("_part").count().count() == 4


def test_rows_of_a_renewed_fact_are_computed_once(spark, tmp_root):
    table = PublishedTable(spark, f"{tmp_root}/t")
    part = F.col("p")
    table.replace(spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), ("z", 4)], "p string, v int"), part)
    old, seen = table.manifest()["parts"], spark.sparkContext.accumulator(0)

    def note(v):
        seen.add(1)
        return v
    fresh = spark.createDataFrame([("x", 2), ("w", 5)], "p string, v int").withColumn("v", F.udf(note, "int")("v"))
    got = table.renew(fresh, part, ["z"], lambda rows: rows.where("v not in (2, 4)"))
    assert sorted(map(tuple, got.collect())) == [("w", 5), ("x", 1), ("x", 2), ("y", 3)]
    assert seen.value == 2 and table.parts() == ["w", "x", "y"] and table.manifest()["parts"]["y"] == old["y"]
    version = table.versions()[-1]
    assert table.renew(fresh.limit(0), part, [], lambda rows: rows, {"n": 1}).count() == 4
    assert table.versions()[-1] == version + 1 and table.meta() == {"n": 1}


def test_lines_are_deduplicated_where_their_sale_is(spark):
    schema = "tenant_id string, id long, txn long, updated_at long, _batch_id long"
    data = [("a", i, i // 3, 1, 1) for i in range(30)] + [("a", i, i // 3, 0, 0) for i in range(0, 30, 4)]
    still = spark.createDataFrame(data, schema)
    at = ["tenant_id", "txn"]
    got = landing.latest_in_place(still, KEYS, at)
    assert rows(got) == rows(latest_by_key(still, KEYS))
    plan = got.groupBy(*at).count()._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange" in line for line in plan.splitlines()) == 1              # a grouping by sale moves nothing
    moving = spark.createDataFrame(
        data + [("a", 0, 9, 5, 2), ("a", 1, None, 5, 2), ("b", 1, 7, 1, 1), (None, 2, 3, 1, 1), (None, 2, 3, 2, 1),
                ("a", 99, None, 1, 1)] + [("a", 50, 4, i, 1) for i in range(120)], schema)
    got = landing.latest_in_place(moving, KEYS, at)
    assert got.columns == moving.columns and rows(got) == rows(latest_by_key(moving, KEYS))
