import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillhouse.operators import (date_spine, densify, exact_quantiles, last_n_distinct, latest_by_key,
                                 member_flag, pivot_wide, series, share_of_total, top_k, top_k_per)

T = dt.datetime


def test_latest_by_key_ties_go_to_last_batch(spark):
    rows = [("t1", 1, "completed", T(2024, 1, 1, 10, 0, 0), 0),
            ("t1", 1, "cancelled", T(2024, 1, 1, 10, 0, 0), 1),   # same second, later batch
            ("t2", 1, "completed", T(2024, 1, 1, 9, 0, 0), 0),    # colliding id, other tenant
            ("t1", 2, "pending", T(2024, 1, 2), 0),
            ("t1", 2, "completed", T(2024, 1, 1), 3)]             # later batch but older version
    df = spark.createDataFrame(rows, "tenant_id string, id long, status string, updated_at timestamp_ntz, _batch_id long")
    got = {(r.tenant_id, r.id): r.status for r in latest_by_key(df, ["tenant_id", "id"]).collect()}
    assert got == {("t1", 1): "cancelled", ("t2", 1): "completed", ("t1", 2): "pending"}


def test_latest_by_key_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("updated_at"),
                                 F.lit(0).alias("_batch_id"))
    plan = latest_by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_date_spine_leap_year_end_and_empty(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 30),), (dt.date(2024, 3, 1),)], "d date")
    days = [r[0] for r in date_spine(df, "d").collect()]
    assert days[0] == dt.date(2023, 12, 30) and days[-1] == dt.date(2024, 3, 1)
    assert dt.date(2024, 2, 29) in days and len(days) == 63
    assert date_spine(df.where("false"), "d").count() == 0


def test_top_k_per_ties_and_small_groups(spark):
    rows = [("A", "p1", 10.0), ("A", "p2", 10.0), ("A", "p3", 10.0), ("A", "p0", 10.0),
            ("B", "q1", 5.0), (None, "z", 99.0)]
    df = spark.createDataFrame(rows, "city string, product string, revenue double")
    got = top_k_per(df, ["city"], [F.desc("revenue"), F.asc("product")], 3, rank_col="rn").collect()
    a = sorted((r.product, r.rn) for r in got if r.city == "A")
    assert a == [("p0", 1), ("p1", 2), ("p2", 3)]
    assert [r.product for r in got if r.city == "B"] == ["q1"]
    assert [r.product for r in top_k(df, [F.desc("revenue"), F.asc("product")], 2).collect()] == ["z", "p0"]


def test_last_n_distinct_densify_series(spark):
    facts = spark.createDataFrame(
        [("S1", "2024-01", 5.0), ("S1", "2024-03", 7.0), ("S2", "2023-01", 1.0), ("S3", "2024-02", 2.0)],
        "store string, month string, revenue double")
    months = last_n_distinct(facts, "month", 2)
    assert sorted(r[0] for r in months.collect()) == ["2024-02", "2024-03"]
    dense = densify(facts, "store", "month", "revenue", months)
    got = {(r.store, r.month): r.revenue for r in dense.collect()}
    assert got == {("S1", "2024-02"): 0.0, ("S1", "2024-03"): 7.0, ("S2", "2024-02"): 0.0,
                   ("S2", "2024-03"): 0.0, ("S3", "2024-02"): 2.0, ("S3", "2024-03"): 0.0}
    s = {r.store: (r.months, r.data) for r in series(facts, "store", "month", "revenue", months).collect()}
    assert s["S1"] == (["2024-02", "2024-03"], [0.0, 7.0])
    assert s["S2"] == (["2024-02", "2024-03"], [0.0, 0.0])


def test_pivot_wide_fills_missing(spark):
    df = spark.createDataFrame([("X", "High", 2), ("X", "Low", 1), ("Y", "Medium", 4)],
                               "city string, segment string, n long")
    got = {r.city: (r.High, r.Medium, r.Low)
           for r in pivot_wide(df, ["city"], "segment", ["High", "Medium", "Low"], {"n": "{v}"}).collect()}
    assert got == {"X": (2, 0, 1), "Y": (0, 4, 0)}


@pytest.mark.parametrize("accuracy", [10000, 50])
def test_exact_quantiles_match_linear_interpolation(spark, accuracy):
    rnd = random.Random(7)
    vals = [round(rnd.lognormvariate(3, 1.5), 2) for _ in range(20000)] + [7.0] * 3000
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    probs = [0.0, 0.33, 0.5, 0.66, 1.0]
    got = spark.range(1).select(exact_quantiles(df, "x", probs, accuracy=accuracy).alias("q")).first()[0]
    want = np.quantile(np.array(vals), probs, method="linear")
    for g, w in zip(got, want):
        assert g == pytest.approx(w, rel=1e-12, abs=1e-9)


def test_exact_quantiles_small_inputs(spark):
    for vals in ([5.0], [1.0, 2.0], [3.0, 1.0, 2.0, 2.0]):
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        got = spark.range(1).select(exact_quantiles(df, "x", [0.33, 0.66])).first()[0]
        want = np.quantile(np.array(vals), [0.33, 0.66], method="linear")
        assert list(got) == pytest.approx(list(want))


def test_share_of_total_and_member_flag(spark):
    df = spark.createDataFrame([("cash", 1), ("debit", 2)], "m string, n long")
    got = {r.m: r.pct for r in share_of_total(df, "n").collect()}
    assert got == {"cash": 33.3, "debit": 66.7}
    left = spark.createDataFrame([("t1", 1), ("t1", 2), ("t2", 1)], "tenant_id string, transaction_id long")
    members = spark.createDataFrame([("t1", 1), ("t1", 1), ("t2", None)], "tenant_id string, transaction_id long")
    got = {(r.tenant_id, r.transaction_id): r.f for r in member_flag(left, members, ["tenant_id", "transaction_id"], "f").collect()}
    assert got == {("t1", 1): True, ("t1", 2): False, ("t2", 1): False}
