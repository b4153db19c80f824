"""Lazy wiring of raw -> staging -> marts for one source of raw tables.

``Warehouse.from_driver_tables`` derives the raw tables from the driver's
parquet files; ``Warehouse.from_raw`` takes already-landed raw tables (see
``sources.landing``).  Nothing is computed until an action runs on a result.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions._util import ntz
from tillhouse.plans import marts, staging
from tillhouse.sources.tpch import DriverTables, raw_multi, raw_single

# Fixed load stamp used when results must be reproducible (tests, oracle).
PINNED_LOAD_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)


def pinned_loaded_at() -> Column:
    return ntz(PINNED_LOAD_TS)


MT_ONLY_MODELS = {"stg_stores", "stg_promotions", "stg_transaction_promotions", "stg_suppliers",
                  "dim_store", "dim_promotion", "fct_sales", "fct_promotion_usage"}


class Warehouse:
    def __init__(self, raw_st, raw_mt, loaded_at: Column | None = None, mt_deduplicated: bool = False):
        # raw_st / raw_mt: mappings of DataFrames, or zero-argument callables
        # that build them (so a single-tenant question never analyses MT
        # tables); mt_deduplicated: raw_mt is compacted (one row per key)
        self._raw_st, self._raw_mt, self.loaded_at = raw_st, raw_mt, loaded_at
        self.mt_deduplicated = mt_deduplicated

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, pin_load_ts: bool = True) -> "Warehouse":
        t = DriverTables(spark, sf_dir)
        return cls(lambda: raw_single(t), lambda: raw_multi(t),
                   pinned_loaded_at() if pin_load_ts else None)

    @classmethod
    def from_raw(cls, raw_st=None, raw_mt=None, loaded_at=None, mt_deduplicated: bool = False) -> "Warehouse":
        return cls(raw_st, raw_mt, loaded_at, mt_deduplicated)

    @cached_property
    def raw_st(self) -> dict[str, DataFrame]:
        return self._raw_st() if callable(self._raw_st) else self._raw_st

    @cached_property
    def raw_mt(self) -> dict[str, DataFrame]:
        return self._raw_mt() if callable(self._raw_mt) else self._raw_mt

    @cached_property
    def stg_st(self) -> dict[str, DataFrame]:
        return staging.staging_single(self.raw_st)

    @cached_property
    def stg_mt(self) -> dict[str, DataFrame]:
        return staging.staging_multi(self.raw_mt, self.mt_deduplicated)

    @cached_property
    def marts_st(self) -> dict[str, DataFrame]:
        return marts.marts_single(self.stg_st, self.loaded_at)

    @cached_property
    def marts_mt(self) -> dict[str, DataFrame]:
        return marts.marts_multi(self.stg_mt, self.loaded_at)

    def model(self, name: str) -> DataFrame:
        if name.endswith("_mt") or name in MT_ONLY_MODELS:
            layers = ("stg_mt", "marts_mt")
        else:
            layers = ("stg_st", "marts_st")
        for layer in layers:
            d = getattr(self, layer)
            if name in d:
                return d[name]
        raise KeyError(name)
