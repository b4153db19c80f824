"""Benchmark of the whole daily flow at one scale factor.

Steps (each timed, with its shuffle bytes read from Spark's event log):
  land_raw_single      full load of the single-tenant raw tables
  land_raw_multi       initial landing of the multi-tenant row versions (+ state)
  compact_full         latest version per key of everything landed (written)
  load_incremental_1pct  incremental run where 1 % of transactions changed
  compact_1pct         that day's batch merged into the compacted copy
  build_single / build_multi   staging -> marts (written, read back)
  <question>           each analytical question on the written marts
  dq_suite             all 86 data-quality checks

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import time
import uuid
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tillhouse.plans import jobs  # noqa: E402
from tillhouse.plans import questions as Q  # noqa: E402
from tillhouse.plans.lazy import merged  # noqa: E402
from tillhouse.plans.warehouse import Warehouse  # noqa: E402
from tillhouse.session import get_session, scratch_path  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffle_bytes(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, from the event log."""
    stage_group, out = {}, defaultdict(int)
    paths = [p for p in glob.glob(f"{log_dir}/**", recursive=True) if os.path.isfile(p)]
    for path in sorted(paths):
        with open(path, errors="replace") as fh:
            for line in fh:
                if '"SparkListenerJobStart"' in line:
                    ev = json.loads(line)
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif '"SparkListenerTaskEnd"' in line:
                    ev = json.loads(line)
                    g = stage_group.get(ev.get("Stage ID"))
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if g:
                        out[g] += int(m.get("Shuffle Bytes Written", 0))
    return dict(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    run_tag = uuid.uuid4().hex[:8]
    probe = get_session(f"local[{cpus}]", "tillhouse-bench")
    root = scratch_path(probe, f"bench-{run_tag}")
    probe.stop()
    log_dir = f"{root}/eventlog"
    os.makedirs(log_dir, exist_ok=True)
    spark = get_session(f"local[{cpus}]", "tillhouse-bench", shuffle_partitions=max(8, cpus * 2),
                        extra={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                               "spark.eventLog.dir": f"file://{log_dir}",
                               "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    sc = spark.sparkContext
    times: dict[str, float] = {}

    def timed(name, fn):
        sc.setJobGroup(name, name)
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    wh = Warehouse.from_driver_tables(spark, sf_dir)
    raw_st = timed("land_raw_single", lambda: jobs.land_raw_single(spark, wh.raw_st, f"{root}/raw_st"))

    landing_root, state = f"{root}/landing", f"{root}/state"

    def land_multi():
        landed = jobs.land_raw_multi(spark, wh.raw_mt, landing_root, 0)
        jobs.seed_state(spark, landed, state, 1)
        return landed
    timed("land_raw_multi", land_multi)
    compact_root = f"{root}/compact"
    timed("compact_full", lambda: jobs.compact_tables(spark, landing_root, compact_root, list(wh.raw_mt), 1))

    # the source after a day in which 1 % of the transactions changed status
    src = wh.raw_mt["transactions"].where(F.col("_batch_id") == 1).drop("_batch_id")
    changed = (src.where(F.pmod("transaction_id", F.lit(100)) == 0)
                  .withColumn("status", F.lit("cancelled"))
                  .withColumn("updated_at", F.timestamp_add("DAY", F.lit(3650), F.col("updated_at"))))
    source_today = src.unionByName(changed)
    timed("load_incremental_1pct",
          lambda: jobs.load_incremental(spark, {"transactions": source_today}, landing_root, state, 2).collect())
    # merge only today's batch into yesterday's compacted copy
    raw_mt = timed("compact_1pct", lambda: jobs.compact_tables(spark, landing_root, compact_root,
                                                               list(wh.raw_mt), 2))

    stg: dict = {}
    st = timed("build_single", lambda: jobs.build_single(spark, raw_st, f"{root}/st", wh.loaded_at, stg))
    mt = timed("build_multi", lambda: jobs.build_multi(spark, raw_mt, f"{root}/mt", wh.loaded_at, stg,
                                                       mt_deduplicated=True))

    qs = {
        "top_products_per_category": lambda: Q.top_products_per_category(st["fact_sales"], st["dim_product"]),
        "monthly_revenue": lambda: Q.monthly_revenue(st["fact_sales"], st["dim_date"]),
        "payment_mix": lambda: Q.payment_mix(st["fact_sales"]),
        "revenue_by_store": lambda: Q.revenue_by_store(mt["fct_sales"], mt["dim_store"], mt["dim_date_mt"]),
        "revenue_by_store_series": lambda: Q.revenue_by_store_series(mt["fct_sales"], mt["dim_store"], mt["dim_date_mt"]),
        "top_promotions": lambda: Q.top_promotions(mt["fct_promotion_usage"], mt["dim_promotion"]),
        "promo_vs_no_promo": lambda: Q.promo_vs_no_promo(mt["fct_sales"], mt["fct_promotion_usage"]),
        "top_products_by_city": lambda: Q.top_products_by_city_wide(mt["fct_sales"], mt["dim_store"], mt["dim_product_mt"]),
        "customer_segments": lambda: Q.customer_segments_wide(mt["fct_sales"], mt["dim_customer_mt"]),
        "transactions_by_weekday": lambda: Q.transactions_by_weekday(mt["fct_sales"], mt["dim_date_mt"]),
    }
    for name, fn in qs.items():
        timed(name, lambda fn=fn: run(fn()))

    models = merged(stg, st, mt)
    timed("dq_suite", lambda: jobs.run_checks(models).collect())

    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "shuffle_bytes": shuffle_bytes(log_dir)}))


if __name__ == "__main__":
    main()
