from tillhouse.operators import quality as dq


def test_checks_count_failures_and_ignore_nulls(spark):
    child = spark.createDataFrame([(1, "a", "cash"), (1, "b", "bitcoin"), (None, None, None), (3, "c", "bitcoin"),
                                   (4, None, "cash")], "id long, name string, pm string")
    parent = spark.createDataFrame([(1,), (3,)], "id long")
    res = {(r.column, r.check): r.failures for r in dq.run_suite(
        {"c": child, "p": parent},
        {"c": dq.ModelChecks(not_null=["id", "name"], unique=["id"], relationships=[("id", "p", "id")],
                             accepted_values={"pm": ["cash", "debit"]})}).collect()}
    assert res == {("id", "not_null"): 1, ("name", "not_null"): 2, ("id", "unique"): 1,
                   ("id", "relationships"): 1, ("pm", "accepted_values"): 1}


def test_composite_keys(spark):
    child = spark.createDataFrame([("t1", 1), ("t2", 1), ("t1", 1), (None, 2)], "tenant_id string, id long")
    parent = spark.createDataFrame([("t1", 1)], "tenant_id string, id long")
    u = dq.unique(child, "c", ["tenant_id", "id"]).first().failures
    r = dq.relationships(child, "c", ["tenant_id", "id"], parent, ["tenant_id", "id"]).first().failures
    assert (u, r) == (1, 1)


def test_one_scan_finds_nulls_and_values_and_one_all_parents(spark):
    df = spark.createDataFrame([(None, "x", "q", 1, "t1"), (1, "y", None, 2, "t1"), (2, "ok", "z", 9, "t1"), (3, "x", "ok", 9, None)],
                               "id long, a string, b string, pid long, tenant string")
    out = {(r["column"], r["check"]): r["failures"] for r in dq.nulls_and_values(df, "m", ["id", "b"], {"a": ["ok"], "b": ["ok"]}).collect()}
    assert out == {("id", "not_null"): 1, ("b", "not_null"): 1, ("a", "accepted_values"): 2, ("b", "accepted_values"): 2}
    parent = spark.createDataFrame([(1, "t1"), (2, "t2"), (2, None)], "pid long, tenant string")
    lost = {r["column"]: r["failures"] for r in dq.orphans(df, "m", [("pid", parent, "pid"), (["tenant", "pid"], parent, ["tenant", "pid"])]).collect()}
    assert lost == {"pid": 2, "tenant,pid": 2}
    for check in (dq.nulls_and_values(df, "m", ["id"], {"a": ["ok"]}), dq.orphans(df, "m", [("pid", parent, "pid"), ("tenant", parent, "tenant")])):
        plan = check._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("id#") and plan.count("LogicalRDD [id") == 1
    empty = df.where("false")
    assert {r["failures"] for r in dq.nulls_and_values(empty, "m", ["id"], {"a": ["ok"]}).collect()} == {0}
    assert {r["failures"] for r in dq.orphans(empty, "m", [("pid", parent, "pid")]).collect()} == {0}


def test_failing_rows_are_those_counted(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "id long, v string")
    ids = lambda d: sorted((str(r["id"]), str(r["v"])) for r in d.collect())
    assert ids(dq.failing_rows(df, "not_null", "v")) == [("2", "None")]
    assert ids(dq.failing_rows(df, "unique", "id")) == [("1", "a"), ("1", "b")]
    assert ids(dq.failing_rows(df, "accepted_values", "v", ["a"])) == [("1", "b"), ("None", "c")]
    assert ids(dq.failing_rows(df, "relationships", "id", parent=df.where("id = 2"))) == [("1", "a"), ("1", "b")]


def test_models_that_several_checks_read_are_derived_once(spark):
    import __spark_entry__ as e

    def scans(name, table):
        plan = e.queries()[name](spark, e.SMOKE_DIR)._jdf.queryExecution().optimizedPlan()
        leaves = plan.collectLeaves()
        return sum(f"{table}key#" in leaves.apply(i).toString() for i in range(leaves.size()))

    # of the raw tables only what a single scan of the suite needs is left: promotions are found in the lines
    assert scans("dq_suite_multi", "o_order") == 0
    assert scans("dq_suite_multi", "l_order") == 1


def test_shared_models_names_the_checked_columns():
    from tillhouse.operators.quality import shared_models
    spec = {"a": dq.ModelChecks(not_null=["x"], unique=["x", ["x", "y"]]), "b": dq.ModelChecks(not_null=["z"]),
            "c": dq.ModelChecks(relationships=[("k", "b", "z"), (["p", "q"], "d", ["p", "q"])])}
    assert shared_models([spec]) == {"a": ["x", "y"], "b": ["z"]}
