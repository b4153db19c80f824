"""Incremental build of the multi-tenant facts (S11).

A fact is a published table (``sources.manifest``) with one partition for each
tenant and month of the sale.  Its manifest holds the load ids of the batches it
was built from.  For the batches that are new since then:

1. *Affected transactions*: those with a changed version, those that a changed
   line belongs to, and those that the line belonged to in the fact before.
2. *Affected partitions*: where rows of these transactions stand now, and where
   they stood (a sale that moved to another month, or was cancelled).
3. The rows of the affected transactions are derived anew and written once, at
   their place; beside them all other rows of the affected partitions are
   copied, and all other partitions keep their files.

The result is that of a full build but for ``loaded_at``, which stays that of the
build that derived the row.  A batch that was replaced after the fact took it may
have lost rows nobody can name any more: then, and on the first run, the fact is
built in full.  Only partition names and load ids reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions import surrogate_key
from tillhouse.plans import marts
from tillhouse.plans.warehouse import Warehouse
from tillhouse.sources import landing
from tillhouse.sources.landing import semi, stored
from tillhouse.sources.manifest import PublishedTable

TXN = ["tenant_id", "transaction_id"]

#: fact: (line table, its staging model, its key, the key's name in the fact, builder)
FACTS = {
    "fct_sales": ("transaction_items", "stg_transaction_items_mt", "item_id", "item_id", marts.fct_sales),
    "fct_promotion_usage": ("transaction_promotions", "stg_transaction_promotions", "id", "junction_id", marts.fct_promotion_usage),
}


def month_part() -> Column:
    """Partition of a fact row: tenant and month; text, so both keep their form."""
    return F.concat_ws("|", F.coalesce("tenant_id", F.lit("_null_")), F.coalesce(F.date_format("transaction_day", "yyyy-MM"), F.lit("_null_")))


def _names(df: DataFrame) -> list[str]:
    """Distinct partitions of ``df``: at most tenants x months."""
    return [r["p"] for r in df.select(month_part().alias("p")).distinct().collect()]


def _placed(df: DataFrame) -> DataFrame:
    """Rows of a partition together, big partitions over several tasks."""
    return df.withColumn("_month", month_part()).hint("rebalance", F.col("_month")).drop("_month")


def _keyed_in_place(rows: DataFrame, fact_key: str, loaded_at: Column | None) -> DataFrame:
    """``_placed`` with the surrogate key and the load time set where the rows
    are written: neither is shuffled."""
    name = rows.columns[0]
    return (_placed(rows.drop(name, "loaded_at")).withColumn(name, surrogate_key("tenant_id", fact_key))
            .withColumn("loaded_at", marts.load_time(loaded_at)).select(*rows.columns))


def fact_is_current(table: PublishedTable, loads: Mapping[str, Mapping[str, str]]) -> bool:
    return table.exists() and table.meta().get("loads") == loads


def update_fact(table: PublishedTable, build: Callable[..., DataFrame], lines: DataFrame, transactions: DataFrame,
                changed_lines: DataFrame, changed_transactions: DataFrame, line_key: str, fact_key: str,
                loaded_at: Column | None = None, meta: dict | None = None) -> DataFrame:
    """Bring ``table`` up to date with ``lines`` and ``transactions`` (staged,
    all of them), of which ``changed_lines`` (tenant_id, line key,
    transaction_id) and ``changed_transactions`` (tenant_id, transaction_id)
    name what changed since it was built."""
    old = table.read()
    # lines meet by the hash of their key: one that is taken for another costs no more than deriving a sale's rows once more
    before = (old.select(*TXN, F.xxhash64("tenant_id", fact_key).alias("_line"))
              .join(changed_lines.select(F.xxhash64("tenant_id", line_key).alias("_line")), "_line", "left_semi"))
    keys = stored(changed_transactions.select(*TXN).unionByName(changed_lines.select(*TXN))
                   .unionByName(before.select(*TXN)).dropna().distinct(), "fact-keys")
    # the keys hold no nulls: joined as equals, transactions stay where their lines are looked up
    of = F.col("tenant_id").isin([r["tenant_id"] for r in keys.select("tenant_id").distinct().collect()])
    fresh = build(lines.where(of), transactions.where(of).join(keys, TXN, "left_semi"), loaded_at)
    return table.renew(_keyed_in_place(fresh, fact_key, loaded_at), month_part(), _names(old.where(of).join(keys, TXN, "left_semi")),
                       lambda rows: _placed(semi(rows, keys, TXN, "left_anti")), meta)


def build_facts(spark: SparkSession, raw: Mapping[str, DataFrame], landing_root: str, marts_root: str, run_id: int,
                schemas: Mapping, loaded_at: Column | None = None, only: Sequence[str] = tuple(FACTS)) -> dict[str, DataFrame]:
    """The facts (``only`` some of them), up to the batches of ``run_id``.  ``raw`` holds the compacted
    tables as of that run, ``landing_root`` the landed versions."""
    staged = Warehouse.from_raw(raw_mt=raw, mt_deduplicated=True).stg_mt
    out = {}
    for fact in only:
        lines, model, line_key, fact_key, build = FACTS[fact]
        table = PublishedTable(spark, f"{marts_root.rstrip('/')}/{fact}")
        landed = {t: landing.read_landed(spark, f"{landing_root.rstrip('/')}/{t}", schema=schemas.get(t)) for t in ("transactions", lines)}
        loads = {t: {str(b): i for b, i in landing.load_ids(df).items() if b <= run_id} for t, df in landed.items()}
        if fact_is_current(table, loads):
            out[fact] = table.read()
            continue
        known = table.meta().get("loads") if table.exists() else None
        if known is None or any(loads[t].get(b) != i for t in loads for b, i in known.get(t, {}).items()):
            rows = build(staged[model], staged["stg_transactions_mt"], loaded_at)
            out[fact] = table.replace(_keyed_in_place(rows, fact_key, loaded_at), month_part(), meta={"loads": loads})
            continue
        new = {t: landed[t].where(F.col("_batch_id").isin([int(b) for b in loads[t] if b not in known.get(t, {})])) for t in loads}
        out[fact] = update_fact(table, build, staged[model], staged["stg_transactions_mt"], new[lines].select("tenant_id", line_key, "transaction_id"),
                                new["transactions"], line_key, fact_key, loaded_at, {"loads": loads})
    return out
