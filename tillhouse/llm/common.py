"""Helpers shared by the operators: stored intermediates, words, hashing, components."""

from __future__ import annotations

import os
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.session import scratch_path

#: Characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"

_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver runs it from a
    checkout; an installed package or a PYTHONPATH of the cluster stays first."""
    env = spark.sparkContext.environment
    if _PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH", ""), _PACKAGE_ROOT) if x)
    return spark


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, and a lost executor does not lose it."""
    path = scratch_path(df.sparkSession, f"llm-{uuid.uuid4().hex}/{name}")
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *keep: str) -> DataFrame:
    """``df`` with its columns, but for ``keep``, named in_0, in_1, ...: what an
    operator adds can't clash with them.  ``at`` gives a column's new name."""
    return df.toDF(*[c if c in keep else f"in_{i}" for i, c in enumerate(df.columns)])


def at(df: DataFrame, column: str) -> str:
    """Name of ``column`` of ``df`` in ``numbered(df)``."""
    return f"in_{df.columns.index(column)}"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- words and shingles -----------------------------------------------------
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective): spreads every input bit over the word."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of ``text``, A-Z lower-cased.  ``bytes``
    methods see ASCII only, so lower() and split() mean exactly A-Z and the
    six separators."""
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles_of(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of all word n-grams in order; with fewer words, the whole
    sequence as one; without words, none.  Words are well mixed hashes already,
    so a polynomial of them, mixed once, tells their sequences apart."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(size, n)
    out = words[:n - k + 1] + U(k)
    for i in range(1, k):
        out *= _BASE
        out += words[i:n - k + 1 + i]
    return mix(out)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values: a sort and a comparison of neighbours cost less than ``np.unique``."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return distinct(shingles_of(word_hashes(text), size))


# ---- running totals of array columns ----------------------------------------
def let(x, body):
    """``body`` of the value of ``x``, which is evaluated once (inside lambdas
    Spark would evaluate a repeated expression each time)."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def running(values, op, zero):
    """Running totals (each including its own element) of an array column under
    an associative ``op``: blocks of 32 elements and an array of block totals,
    so long arrays cost little more than their length."""
    g = 32
    total = lambda xs: F.aggregate(xs, zero, op)
    cut = lambda vs: F.transform(F.sequence(F.lit(0), F.floor((F.size(vs) - 1) / g).cast("int")),
                                 lambda b: F.slice(vs, b * g + 1, F.lit(g)))
    starts = lambda blocks: F.aggregate(F.transform(blocks, total), F.array(zero),
                                        lambda acc, t: F.concat(acc, F.array(op(F.element_at(acc, -1), t))))
    return let(let(values, cut), lambda blocks: let(starts(blocks), lambda before: F.flatten(F.transform(
        blocks, lambda xs, b: F.transform(xs, lambda x, i: op(F.get(before, b), total(F.slice(xs, F.lit(1), i + 1))))))))


# ---- connected components ---------------------------------------------------
def connected_components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` as (node, component), where
    component is the smallest node reachable.  Alternates large-star and
    small-star steps; each step's edges are stored in the shared folder, so a
    hub of any size costs one partially aggregated minimum.  Only a count and a
    hash sum reach the driver."""
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cur, seen = store(both, "edges0"), None
    for i in range(1, 200):
        sym = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sym.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = sym.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        back = large.join(low, "a")
        small = (back.select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(low.select("a", F.col("m").alias("b")))).where("a <> b").distinct()
        cur = store(small, f"edges{i}")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    else:
        raise RuntimeError("components have not settled after 199 rounds")
    stars = cur.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    heads = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(heads)


# ---- Arrow columns added to a DataFrame -------------------------------------
def with_arrow_columns(df: DataFrame, fields, text: str, make) -> DataFrame:
    """``df`` plus ``fields``, which ``make(texts)`` returns as one sequence for
    each field.  Input columns of the same names are replaced."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    own = {f.name for f in fields}
    if text in own:
        raise ValueError(f"{text!r} is an output column")
    df = df.drop(*[c for c in df.columns if c in own])
    schema = T.StructType([*df.schema.fields, *fields])
    at, kinds, names = df.columns.index(text), [to_arrow_type(f.dataType) for f in fields], [f.name for f in schema]

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                new = make(batch.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *[pa.array(x, k) for x, k in zip(new, kinds)]], names=names)

    return df.mapInArrow(work, schema)
