"""JDBC sources: full snapshot (S1), incremental slice (S2), tenant fan-in (S3)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions._util import ntz


EPOCH = _dt.datetime(1970, 1, 1)


def read_full(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Whole table; with a numeric ``partition_column`` the scan is split into
    ``num_partitions`` parallel range queries (one per task)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("preferTimestampNTZ", "true")
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
              .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
    return r.load()


def read_since(spark: SparkSession, url: str, table: str, since: _dt.datetime | None,
               properties: Mapping[str, str] | None = None, version_col: str = "updated_at",
               **partitioning) -> DataFrame:
    """Rows changed strictly after ``since`` (epoch when unknown).

    The comparison is a DataFrame filter, which the JDBC source pushes into the
    remote WHERE clause (visible as ``PushedFilters`` in the plan).
    """
    df = read_full(spark, url, table, properties, **partitioning)
    return df.where(F.col(version_col) > ntz(since or EPOCH))


def fan_in(sources: Mapping[str, DataFrame], tenant_col: str = "tenant_id") -> DataFrame:
    """One DataFrame over all tenants, ``tenant_id`` first.  Spark plans the
    per-tenant scans as parallel branches of one union."""
    tagged = [df.select(F.lit(t).alias(tenant_col), *df.columns) for t, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


FINE = 16      # histogram cells for each range asked for


def _reader(spark: SparkSession, url: str, properties: Mapping[str, str] | None):
    r = spark.read.format("jdbc").option("url", url).option("preferTimestampNTZ", "true")
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r


def _quoted(spark: SparkSession, url: str, column: str) -> str:
    """A column's name as Spark itself writes it for this database."""
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)


def _after(version_col: str, since: _dt.datetime | None) -> str:
    return f"{version_col} > {{ts '{(since or EPOCH).strftime('%Y-%m-%d %H:%M:%S.%f')}'}}"


def key_ranges(spark: SparkSession, url: str, table: str, column: str, num_ranges: int, where: str = "1 = 1",
               properties: Mapping[str, str] | None = None) -> list[str]:
    """Predicates that cut the rows of ``table`` that meet ``where`` into about
    ``num_ranges`` ranges of the whole-number ``column`` with like numbers of rows.

    The source itself gives the least and greatest key and a histogram of
    ``FINE * num_ranges`` cells between them (two aggregates, a bounded number
    of rows comes back); cells are joined into ranges until each holds its share,
    so keys that crowd in one place do not end up in one range.  Open ends and a
    predicate for null keys keep every row, also one that is written meanwhile."""
    def ask(sql):
        return _reader(spark, url, properties).option("dbtable", f"({sql}) q").load().collect()

    column = _quoted(spark, url, column)
    low, high, rows = ask(f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT(*) AS n FROM {table} WHERE {where}")[0]
    null = f"{column} IS NULL AND {where}"
    if low is None:
        return [f"{column} IS NOT NULL AND {where}", null]
    low, high = int(low), int(high)
    width = max(1, -(-(high - low + 1) // (FINE * num_ranges)))
    cells = ask(f"SELECT cell, COUNT(*) AS n FROM (SELECT ({column} - {low}) / {width} AS cell FROM {table} "
                f"WHERE {column} IS NOT NULL AND {where}) c GROUP BY cell")
    share, held, cuts = rows / num_ranges, 0, []
    for cell, n in sorted((int(c), int(n)) for c, n in cells):
        if held and held + n > share:
            cuts.append(low + cell * width)
            held = 0
        held += n
    edges = [None, *cuts, None]
    ranges = [" AND ".join([f"{column} >= {a}"] * (a is not None) + [f"{column} < {b}"] * (b is not None)
                           or [f"{column} IS NOT NULL"]) for a, b in zip(edges, edges[1:])]
    return [f"{r} AND {where}" for r in ranges] + [null]


def read_ranges(spark: SparkSession, url: str, table: str, column: str, num_ranges: int, since: _dt.datetime | None = None,
                version_col: str | None = "updated_at", properties: Mapping[str, str] | None = None) -> DataFrame:
    """A table in parallel: one query and one task for each of ``key_ranges``.
    With ``version_col`` only rows changed after ``since``, in every query."""
    where = _after(_quoted(spark, url, version_col), since) if version_col else "1 = 1"
    predicates = key_ranges(spark, url, table, column, num_ranges, where, properties)
    props = {"preferTimestampNTZ": "true", **(properties or {})}
    df = spark.read.jdbc(url, table, predicates=predicates, properties=props)
    return df.where(F.col(version_col) > ntz(since or EPOCH)) if version_col else df


def incremental_source(spark: SparkSession, url: str, tenant_schemas: Mapping[str, str], table: str,
                       properties: Mapping[str, str] | None = None, version_col: str = "updated_at",
                       tenant_col: str = "tenant_id", split_on: str | None = None, num_ranges: int = 8):
    """A source for ``jobs.load_incremental``: given the watermark state, read
    ``<schema>.<table>`` of every tenant with its own watermark pushed into
    the remote WHERE clause, and fan the tenants in.  With ``split_on`` (a
    whole-number key) each tenant's table is read in ``num_ranges`` tasks.

    Only the current state rows of this table (one per tenant) reach the
    driver, to build the per-tenant predicates; the rows themselves are read
    by executor tasks.
    """
    from tillhouse.sources import watermark  # local import: avoids a cycle

    def read(state: DataFrame) -> DataFrame:
        marks = {r["tenant_id"]: r["watermark"]
                 for r in watermark.current(state).where(F.col("table_name") == table).collect()}
        per_tenant = {t: read_ranges(spark, url, f"{schema}.{table}", split_on, num_ranges, marks.get(t), version_col, properties)
                      if split_on else read_since(spark, url, f"{schema}.{table}", marks.get(t), properties, version_col)
                      for t, schema in tenant_schemas.items()}
        return fan_in(per_tenant, tenant_col)

    return read


def configured_sources(spark: SparkSession, config: Mapping) -> dict:
    """Sources for ``jobs.load_incremental`` of every table of a configuration::

        {"url": ..., "properties": {...}, "tenants": {"t1": "schema_1", ...},
         "tables": {"customers": {"split_on": "customer_id", "num_ranges": 8}, "stores": {}}}

    Without ``tables``: all tables of ``schemas.MT_KEYS``, split by their key
    where it is a whole number."""
    from pyspark.sql.types import LongType

    from tillhouse.schemas import MT_KEYS, RAW_MT
    tables = config.get("tables") or {t: {"split_on": k} if isinstance(RAW_MT[t][k].dataType, LongType) else {} for t, k in MT_KEYS.items()}
    return {t: incremental_source(spark, config["url"], config["tenants"], t, config.get("properties"), **options)
            for t, options in tables.items()}
