"""Landing sinks (S6, S7), load audit (S8) and compaction of versions (D3).

These are the only functions besides ``plans.jobs`` that run actions.  Each
write is one distributed job; downstream work reads the *written* data back
(``where _batch_id = n``) so a source is never read twice within a run and
lineage is cut at the table boundary.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators.dedup import latest_by_key
from tillhouse.session import WRITE_OPTIONS, scratch_path
from tillhouse.sources.manifest import PART, PublishedTable, publish

#: Versions that one task of a compaction sorts, about 150 MB of them in memory.
ROWS_PER_TASK = 500_000


def land_full(df: DataFrame, path: str) -> None:
    """The table is replaced by a new published version; an empty input still
    leaves an (empty) table with the declared schema, and a reader of the old
    one or a failed write changes nothing."""
    publish(df, path)


def append_versions(df: DataFrame, path: str, batch_id: int, tenant_col: str = "tenant_id") -> None:
    """Land a batch of row versions as its own partition ``_batch_id=<id>``, by
    tenant inside.  A retry of the batch replaces it, so a run is idempotent."""
    (df.drop("_batch_id").write.mode("overwrite").options(**WRITE_OPTIONS)
       .partitionBy(tenant_col).parquet(f"{path.rstrip('/')}/_batch_id={batch_id}"))


def read_landed(spark: SparkSession, path: str, batch_id: int | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """Landed versions; ``batch_id`` prunes to that batch's files.  With the
    declared ``schema`` an empty table reads as empty and ids that look like
    numbers stay text."""
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if schema is not None:
        df = df.select(*schema.fieldNames())
    return df.where(F.col("_batch_id") == batch_id) if batch_id is not None else df


def load_ids(landed: DataFrame) -> dict[int, str]:
    """What identifies each batch's load: its file names, which Spark makes anew
    for every write.  A batch that was replaced has another id."""
    names: dict[int, list[str]] = {}
    for f in landed.inputFiles():
        found = re.search(r"/_batch_id=(-?\d+)/(.*)$", f)
        if found:
            names.setdefault(int(found[1]), []).append(found[2])
    return {b: hashlib.md5("\n".join(sorted(fs)).encode()).hexdigest() for b, fs in names.items()}


def load_audit(batches: Mapping[str, DataFrame], tenant_col: str | None = "tenant_id") -> DataFrame:
    """Rows loaded per (tenant, table) plus one total row (tenant and table
    NULL).  Each count is a partial aggregate; one small union results."""
    parts = []
    for table, df in batches.items():
        key = F.col(tenant_col) if tenant_col and tenant_col in df.columns else F.lit(None).cast("string")
        parts.append(df.groupBy(key.alias("tenant_id"))
                       .agg(F.count(F.lit(1)).alias("rows_loaded"))
                       .select("tenant_id", F.lit(table).alias("table_name"), "rows_loaded"))
    per = reduce(DataFrame.unionByName, parts)
    total = per.agg(F.sum("rows_loaded").alias("rows_loaded")).select(
        F.lit(None).cast("string").alias("tenant_id"), F.lit(None).cast("string").alias("table_name"),
        "rows_loaded")
    return per.unionByName(total).withColumn("rows_loaded", F.col("rows_loaded").cast("long"))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def part_of(keys: Sequence[str], buckets: int, group: str | None = None) -> Column:
    """Partition of a compacted row: its bucket, within its ``group`` if there is one."""
    bucket = bucket_of(keys, buckets).cast("string")
    # never null, so that the write needs no other order than the one the rows have
    return F.concat_ws("|", F.coalesce(F.col(group), F.lit("_null_")), bucket) if group else F.concat_ws("|", bucket)


def _latest_in_parts(delta: DataFrame, base: DataFrame | None, keys: Sequence[str], version: str, tie_break: Sequence[str],
                     part: Column, buckets: int) -> tuple[DataFrame, list[str]]:
    """Latest version per key of ``delta`` and ``base``, in column ``_part`` the
    partition, whose rows are together; and the partitions of ``delta``.

    Versions go to their partition in one shuffle.  Only where so many are older
    ones of the same keys that a frequent key could more than double a bucket are
    the latest of ``delta`` found first, of which a map task sends one per key.  A
    partition of many rows is split by key over several tasks, so that no sort
    outgrows its memory."""
    counted = delta.groupBy(part.alias(PART)).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*keys), 0.02).alias("keys"))
    found = counted.collect()                                                                 # a row per partition
    rows, different = sum(r["n"] for r in found), sum(r["keys"] for r in found)
    if rows - different > rows / buckets:
        delta, rows = latest_by_key(delta, keys, version, tie_break), min(rows, different)
    both = delta
    if base is not None:
        both, rows = base.unionByName(delta.select(*base.columns)), rows + base.count()
    tasks = -(-rows // ROWS_PER_TASK)
    splits = -(-tasks // max(1, len(found)))
    placed = both.withColumn(PART, part).withColumn("_split", F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(splits)))
    by = [PART, "_split"] if splits > 1 else [PART]
    placed = placed.repartition(tasks, *by) if tasks > _shuffle_partitions(delta.sparkSession) else placed.repartition(*by)
    return latest_by_key(placed, keys, version, tie_break, within=by).drop("_split"), [r[PART] for r in found]


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def compact(landed: DataFrame, table: PublishedTable, keys: Sequence[str], version: str = "updated_at",
            tie_break: Sequence[str] = ("_batch_id",), buckets: int = 64, up_to: int | None = None,
            group: str | None = None) -> DataFrame:
    """Latest version per key of ``landed`` (its batches up to ``up_to``),
    published in hash buckets of the key (D3).  With ``group``, one of the keys,
    each of its values has buckets of its own: a batch of one tenant leaves the
    files of the others as they are.

    The manifest holds the load id of every batch that was merged.  Batches it
    does not hold are merged into the buckets their keys fall in; those buckets
    are read once and written once, the others keep their files.  A batch whose
    load id changed was replaced after it was merged: for every key of its new
    load, and every key whose kept version came from its old load, the latest
    version is found anew among all landed versions.  The result is always that
    of deduplicating ``landed`` as a whole.

    A landed table without new or replaced batches changes nothing."""
    spark, known = landed.sparkSession, table.meta()
    ids = {str(b): i for b, i in load_ids(landed).items() if up_to is None or b <= up_to}
    if up_to is not None:
        landed = landed.where(F.col("_batch_id") <= up_to)
    if not table.exists():
        latest, _ = _latest_in_parts(landed, None, keys, version, tie_break, part_of(keys, buckets, group), buckets)
        return table.replace(latest, F.col(PART), meta={"loads": ids, "buckets": buckets, "keys": list(keys), "group": group})
    if known["keys"] != list(keys):
        raise ValueError(f"{table.path} is compacted by {known['keys']}")
    buckets, loads = known["buckets"], known["loads"]
    new = [int(b) for b in ids if b not in loads]
    again = [int(b) for b, i in loads.items() if ids.get(b) != i]
    if not new and not again:
        return table.read()
    delta = landed.where(F.col("_batch_id").isin(new)) if new else landed.limit(0)
    part = part_of(keys, buckets, known.get("group"))
    if again:
        base = table.read()
        touched_keys = (landed.where(F.col("_batch_id").isin(again)).select(*keys)
                        .unionByName(base.where(F.col("_batch_id").isin(again)).select(*keys))
                        .unionByName(delta.select(*keys)).distinct())
        # a null-safe semi join: a null tenant or key is a key like others
        touched = stored(touched_keys.withColumn(PART, part), "compact-keys")
        delta = semi(landed, touched, keys)
    else:
        touched = delta.select(part.alias(PART))
    which = [r[PART] for r in touched.select(PART).distinct().collect()]                      # groups x buckets names
    if not which:
        table.note({**known, "loads": ids})
        return table.read()
    base = table.read(which)
    if again:
        base = semi(base, touched, keys, "left_anti")
    merged, _ = _latest_in_parts(delta, base, keys, version, tie_break, part, buckets)
    return table.replace(merged, F.col(PART), which, {**known, "loads": ids})


def semi(df: DataFrame, of: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose keys are (not) among those of ``of``; null equals null."""
    k = of.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    return df.join(k, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)]), how)


def stored(df: DataFrame, name: str) -> DataFrame:
    """A small result that is used twice, written once to the shared folder."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.options(**WRITE_OPTIONS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def latest_in_place(landed: DataFrame, keys: Sequence[str], at: Sequence[str], version: str = "updated_at",
                    tie_break: Sequence[str] = ("_batch_id",), many: int = 100) -> DataFrame:
    """``latest_by_key`` whose rows are left by ``at``, where a join on it needs no
    shuffle of its own.

    Hashes of the keys are counted first.  Those whose versions all have the same
    ``at``, as lines that stay with their sale, meet there.  Those that moved, have
    no place or more than ``many`` versions are deduplicated by themselves."""
    key, place = F.xxhash64(*keys).alias("_key"), F.xxhash64(*at)
    nowhere = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in at])
    apart = stored(landed.groupBy(key).agg(F.min(place).alias("_lo"), F.max(place).alias("_hi"), F.count_if(nowhere).alias("_none"),
                                           F.count(F.lit(1)).alias("_n"))
                   .where((F.col("_lo") != F.col("_hi")) | (F.col("_none") > 0) | (F.col("_n") > many)).select("_key"), "keys-apart")
    if apart.isEmpty():
        return latest_by_key(landed.repartition(*at), keys, version, tie_break, within=at)
    hashed = landed.withColumn("_key", key)
    there = hashed.join(apart, "_key", "left_anti").drop("_key").repartition(*at)
    moved = hashed.join(apart, "_key", "left_semi").drop("_key")
    return (latest_by_key(there, keys, version, tie_break, within=at).select(*landed.columns)
            .unionByName(latest_by_key(moved, keys, version, tie_break).select(*landed.columns)))


def merge_versions(base: DataFrame, delta: DataFrame, keys: list[str], version: str = "updated_at",
                   tie_break: tuple[str, ...] = ("_batch_id",)) -> DataFrame:
    """Latest version per key of ``base`` (one row per key already) plus a
    new batch ``delta`` - the same rows as deduplicating base + delta together,
    without shuffling the base.

    Keys the delta does not touch pass straight through (anti join on the
    delta's keys); only base rows of touched keys meet the delta rows in a
    dedup.  When the delta is small AQE broadcasts its keys, so the base is
    never shuffled; it is still scanned and written again as the new copy.
    """
    cols = base.columns
    d = latest_by_key(delta.select(*cols), keys, version, tie_break)
    touched = d.select(*keys)
    untouched = base.join(touched, keys, "left_anti")
    contested = base.join(touched, keys, "left_semi").unionByName(d)
    return untouched.unionByName(latest_by_key(contested, keys, version, tie_break)).select(*cols)
