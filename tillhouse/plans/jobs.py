"""Jobs: the scheduled units of work (S11, S12), run as distributed Spark jobs.

* ``load_full``        - single-tenant snapshot: every raw table replaced
* ``load_incremental`` - multi-tenant: slice each table by its watermark,
                         append the versions, then advance the state
* ``build_single`` / ``build_multi`` - staging (lazy) -> marts (written)
* ``run_checks``       - the data-quality suite over written marts

Marts are written as Parquet and read back for questions and checks, so every
downstream action starts from stored tables instead of re-deriving the star
schema (lineage is cut at the table boundary, and a lost executor recomputes
at most one stage of one job).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators.quality import run_suite
from tillhouse.plans import checks, incremental, staging
from tillhouse.plans.lazy import merged
from tillhouse.plans.warehouse import Warehouse
from tillhouse.schemas import MT_KEYS, RAW_MT, RAW_ST, WATERMARK_STATE, conform
from tillhouse.session import WRITE_OPTIONS, path_exists, run_concurrently, scratch_path
from tillhouse.sources import landing, watermark
from tillhouse.sources.manifest import PublishedTable, entries, publish, published


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_tables(tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Publish each table as a new version (``sources.manifest``): readers of the
    old ones go on, and a build that fails changes nothing."""
    paths = {name: _path(root, name) for name in tables}
    run_concurrently({name: (lambda df=df, p=paths[name]: publish(df, p)) for name, df in tables.items()})
    return paths


def read_tables(spark: SparkSession, root: str, names) -> dict[str, DataFrame]:
    return {n: published(spark, _path(root, n)) for n in names}


# ---- loads ----------------------------------------------------------------
def load_full(spark: SparkSession, sources: Mapping[str, DataFrame], raw_root: str) -> DataFrame:
    """Replace every single-tenant raw table with its source snapshot; return
    the audit (rows per table + total) computed from the written tables."""
    run_concurrently({t: (lambda t=t, df=df: landing.land_full(conform(df, RAW_ST[t]), _path(raw_root, t)))
                      for t, df in sources.items()})
    return landing.load_audit(read_tables(spark, raw_root, sources), tenant_col=None)


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The stored watermarks; none before the first run.  An unreadable state
    is an error, never a silent full reload."""
    if not path_exists(spark, state_path):
        return watermark.empty_state(spark)
    return spark.read.schema(WATERMARK_STATE).parquet(state_path).select(*WATERMARK_STATE.fieldNames())


def last_state(spark: SparkSession, state_path: str, before: int) -> DataFrame:
    """The state that the last complete run before ``before`` left: only that
    run's files are read.  A run that broke off while it wrote its state has no
    file or still its temporary folder, and does not count."""
    runs = [int(n.removeprefix("run_id=")) for n in entries(spark, state_path) if n.startswith("run_id=")]
    for run in sorted((r for r in runs if r < before), reverse=True):
        files = entries(spark, f"{state_path.rstrip('/')}/run_id={run}")
        if any(f.endswith(".parquet") for f in files) and "_temporary" not in files:
            df = spark.read.schema(T.StructType(WATERMARK_STATE.fields[:-1])).parquet(f"{state_path.rstrip('/')}/run_id={run}")
            return df.withColumn("run_id", F.lit(run).cast("long"))
    return watermark.empty_state(spark)


def _conformed(df: DataFrame, table: str, batch_id: int, schemas: Mapping = RAW_MT) -> DataFrame:
    """A batch in its table's declared schema: booleans as 0/1, a missing
    column fails here, extra ones go."""
    out = df if "_batch_id" in df.columns else df.withColumn("_batch_id", F.lit(batch_id).cast("long"))
    return conform(out, schemas[table]) if table in schemas else out


def _raw_schema(table: str):
    return RAW_MT.get(table)


def load_incremental(spark: SparkSession, sources: Mapping[str, Callable[[DataFrame], DataFrame] | DataFrame],
                     landing_root: str, state_path: str, run_id: int, schemas: Mapping = RAW_MT) -> DataFrame:
    """One incremental multi-tenant run.

    Each batch lands in its table's declared schema (``schemas``); a table
    that has none lands as its source gives it.

    ``sources[table]`` is either a DataFrame with ``tenant_id`` and
    ``updated_at`` (sliced here against the state), or a callable that
    receives the current state and returns the already-sliced rows (e.g.
    per-tenant ``jdbc.read_since`` with the filter pushed to the database).

    Order matters: all batches land first, the state of this run only after
    every table landed.  A retry of the run reads the state of earlier runs and
    replaces its own batch and state, so rows, state and audit come out the same.
    """
    state = last_state(spark, state_path, run_id)

    def land(table, src):
        batch = src(state) if callable(src) else watermark.slice_since(src, state, table)
        path = _path(landing_root, table)
        landing.append_versions(_conformed(batch.drop("_batch_id"), table, run_id, schemas), path, run_id)
        return landing.read_landed(spark, path, run_id, schemas.get(table))

    # all tables of all tenants at once; an error in any of them ends the run before the state moves
    batches = run_concurrently({t: (lambda t=t, src=src: land(t, src)) for t, src in sources.items()})
    marks = [watermark.batch_watermarks(df, t, run_id) for t, df in batches.items()]
    new_state = watermark.advance(state, reduce(DataFrame.unionByName, marks), run_id)
    new_state.drop("run_id").write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/run_id={run_id}")
    # every known (tenant, table) pair gets a row, 0 where nothing was loaded
    known = last_state(spark, state_path, run_id + 1).select("tenant_id", "table_name")
    counted = landing.load_audit(batches).where(F.col("table_name").isNotNull())
    per = (known.join(counted, ["tenant_id", "table_name"], "left")
                .select("tenant_id", "table_name",
                        F.coalesce("rows_loaded", F.lit(0)).cast("long").alias("rows_loaded")))
    total = per.agg(F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("long").alias("rows_loaded")).select(
        F.lit(None).cast("string").alias("tenant_id"), F.lit(None).cast("string").alias("table_name"),
        "rows_loaded")
    return per.unionByName(total)


# ---- builds -----------------------------------------------------------------
def _shared(df: DataFrame, name: str, marts_root: str) -> DataFrame:
    """A staging model read by several marts, computed once: written as
    Parquet under the cluster's shared checkpoint folder and read back
    (survives executor loss, cuts the lineage, keeps column pruning and
    filter pushdown for the readers).  The folder is keyed by the marts
    location, so each build of the same marts overwrites its copy instead of
    leaving a new one behind."""
    key = hashlib.md5(marts_root.encode()).hexdigest()[:16]
    path = scratch_path(df.sparkSession, f"staging-{key}/{name}")
    df.write.mode("overwrite").options(**WRITE_OPTIONS).parquet(path)
    return df.sparkSession.read.parquet(path)


def build_single(spark: SparkSession, raw: Mapping[str, DataFrame], marts_root: str,
                 loaded_at: Column | None = None, staging_out: dict | None = None) -> dict[str, DataFrame]:
    """Staging (lazy) -> marts (written, read back).  ``staging_out``, when
    given, receives the staging models the build used (shared ones already
    written), so checks after the build need not recompute them."""
    wh = Warehouse.from_raw(raw_st=raw, loaded_at=loaded_at)
    wh.stg_st["stg_transactions"] = _shared(wh.stg_st["stg_transactions"], "stg_transactions", marts_root)  # fact + date dim
    write_tables(wh.marts_st, marts_root)
    if staging_out is not None:
        staging_out.update(wh.stg_st)
    return read_tables(spark, marts_root, wh.marts_st)


def build_multi(spark: SparkSession, raw: Mapping[str, DataFrame], marts_root: str,
                loaded_at: Column | None = None, staging_out: dict | None = None,
                mt_deduplicated: bool = False, landing_root: str | None = None, run_id: int | None = None) -> dict[str, DataFrame]:
    """As ``build_single`` for the multi-tenant models; ``mt_deduplicated``
    when ``raw`` holds compacted tables (one row per key).

    With ``landing_root`` and ``run_id`` (and compacted ``raw``) the facts are
    not built anew: only the tenant and month partitions that batches since
    their last build affect are replaced (``plans.incremental``)."""
    wh = Warehouse.from_raw(raw_mt=raw, loaded_at=loaded_at, mt_deduplicated=mt_deduplicated)
    # deduplicated transactions feed both facts, the date dimension and checks
    wh.stg_mt["stg_transactions_mt"] = _shared(wh.stg_mt["stg_transactions_mt"], "stg_transactions_mt", marts_root)
    if not mt_deduplicated:       # lines are deduplicated where the join with their sales finds them
        for table, model in (("transaction_items", staging.stg_transaction_items_mt), ("transaction_promotions", staging.stg_transaction_promotions)):
            if table in raw:
                wh.stg_mt[model.__name__] = model(landing.latest_in_place(raw[table], ["tenant_id", MT_KEYS[table]], incremental.TXN), True)
    models = dict.fromkeys(wh.marts_mt)
    if landing_root is not None:
        incremental.build_facts(spark, raw, landing_root, marts_root, run_id, RAW_MT, loaded_at)
        models = {m: None for m in models if m not in incremental.FACTS}
    write_tables({m: wh.marts_mt[m] for m in models}, marts_root)
    if staging_out is not None:
        staging_out.update(wh.stg_mt)
    return read_tables(spark, marts_root, wh.marts_mt)


def land_raw_single(spark: SparkSession, raw: Mapping[str, DataFrame], raw_root: str) -> dict[str, DataFrame]:
    """Full load of the single-tenant raw tables; returns the landed tables."""
    run_concurrently({t: (lambda df=df, t=t: landing.land_full(conform(df, RAW_ST[t]) if t in RAW_ST else df, _path(raw_root, t)))
                      for t, df in raw.items()})
    return read_tables(spark, raw_root, raw)


def land_raw_multi(spark: SparkSession, raw: Mapping[str, DataFrame], landing_root: str,
                   batch_id: int) -> dict[str, DataFrame]:
    """Append the multi-tenant row versions as one batch (keeping their own
    ``_batch_id`` when present); returns all landed versions."""
    def append(t, df):
        out = _conformed(df, t, batch_id)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**WRITE_OPTIONS)
            .partitionBy("_batch_id", "tenant_id").parquet(_path(landing_root, t)))

    run_concurrently({t: (lambda t=t, df=df: append(t, df)) for t, df in raw.items()})
    return {t: landing.read_landed(spark, _path(landing_root, t), schema=_raw_schema(t)) for t in raw}


def seed_state(spark: SparkSession, landed: Mapping[str, DataFrame], state_path: str, run_id: int) -> None:
    """State for tables landed outside ``load_incremental`` (e.g. an initial
    bulk landing): the watermark of everything landed so far."""
    marks = [watermark.batch_watermarks(df, t, run_id) for t, df in landed.items()]
    reduce(DataFrame.unionByName, marks).drop("run_id").write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/run_id={run_id}")


def compact_tables(spark: SparkSession, landing_root: str, compact_root: str, tables, run_id: int,
                   buckets: int = 64, keep: int = 7) -> dict[str, DataFrame]:
    """Compacted copy of each landed table as of ``run_id`` (D3), see
    ``landing.compact``: only the buckets that new or replaced batches touch are
    read and written.  Versions that none of the last ``keep`` runs that changed
    a table names are deleted."""
    def one(t):
        table = PublishedTable(spark, _path(compact_root, t))
        landed = landing.read_landed(spark, _path(landing_root, t), schema=_raw_schema(t))
        landing.compact(landed, table, ["tenant_id", MT_KEYS[t]], buckets=buckets, up_to=run_id,
                        group="tenant_id")
        table.retain(keep)
        return table.read()

    return run_concurrently({t: (lambda t=t: one(t)) for t in tables})


class ChecksFailed(RuntimeError):
    """A day's data-quality gate: carries the failing checks."""

    def __init__(self, failures: list):
        self.failures = failures
        super().__init__("; ".join(f"{r['model']}.{r['column']} {r['check']}: {r['failures']}" for r in failures))


def gate(results: DataFrame, on_failure: str = "raise") -> DataFrame:
    """The failing checks; with ``on_failure="raise"`` any of them ends the run."""
    if on_failure not in ("raise", "return"):
        raise ValueError(on_failure)
    bad = failing(results)
    if on_failure == "raise" and (rows := bad.collect()):            # at most one row per check
        raise ChecksFailed(rows)
    return bad


def daily_single(spark: SparkSession, sources: Mapping[str, DataFrame], root: str, on_failure: str = "raise") -> DataFrame:
    """The single-tenant day: full load -> staging -> marts -> checks.
    A failing check ends the run; with ``on_failure="return"`` the failing
    checks are returned instead."""
    raw = land_raw_single(spark, sources, _path(root, "raw"))
    stg: dict = {}
    st = build_single(spark, raw, _path(root, "marts"), staging_out=stg)
    return gate(run_checks(merged(stg, st), layers=("single",)), on_failure)


def daily_multi(spark: SparkSession, sources: Mapping[str, DataFrame], root: str, run_id: int,
                compacted: bool = False, on_failure: str = "raise") -> DataFrame:
    """The multi-tenant day: incremental load -> staging -> marts -> checks.

    ``compacted``: merge the batches since the last compaction into its copy,
    and bring the facts up to date from it (no dedup of the whole history, no
    full rebuild); otherwise staging deduplicates every landed version on read.
    A failing check ends the run; with ``on_failure="return"`` the failing
    checks are returned instead.
    """
    landing_root = _path(root, "landing")
    load_incremental(spark, sources, landing_root, _path(root, "state"), run_id)
    stg: dict = {}
    if compacted:
        raw = compact_tables(spark, landing_root, _path(root, "compact"), list(sources), run_id)
        mt = build_multi(spark, raw, _path(root, "marts"), staging_out=stg, mt_deduplicated=True,
                         landing_root=landing_root, run_id=run_id)
    else:
        raw = {t: landing.read_landed(spark, _path(landing_root, t), schema=_raw_schema(t)) for t in sources}
        mt = build_multi(spark, raw, _path(root, "marts"), staging_out=stg)
    return gate(run_checks(merged(stg, mt), layers=("multi",)), on_failure)


CHECK_RESULT_SCHEMA = "model string, column string, check string, failures bigint"


def run_checks(models: Mapping[str, DataFrame], layers=("single", "multi"),
               concurrent: bool = True) -> DataFrame:
    """Run the declared suite(s).  With ``concurrent`` every model's checks are
    submitted at the same time (one small aggregation job each); the result
    is one row per check - bounded by the suite, not by the data - so it is
    gathered into a small DataFrame.  Without, one lazy union is returned."""
    if not concurrent:
        return checks.run_checks(models, layers)
    actions = {}
    for layer in layers:
        for si, spec in enumerate(checks.suite_specs(layer)):
            for name, m in spec.items():
                actions[f"{layer}:{si}:{name}"] = (lambda name=name, m=m: run_suite(models, {name: m}).collect())
    rows = [r for v in run_concurrently(actions).values() for r in v]
    spark = next(iter(models.values())).sparkSession
    return spark.createDataFrame(rows, CHECK_RESULT_SCHEMA)


def failing(results: DataFrame) -> DataFrame:
    return results.where(F.col("failures") > 0)
