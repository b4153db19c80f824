"""Session construction and shared configuration."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every job relies on: UTC so NTZ <-> date conversions never shift,
# AQE so join strategy / partition count / skew splits are decided on runtime
# sizes instead of guesses.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# How tables and intermediate copies are written: their keys are hex and ids,
# which zstd packs to about half of what the default codec leaves.
WRITE_OPTIONS = {"compression": "zstd"}


def get_session(master: str | None = None, app: str = "tillhouse",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - no SparkContext on this client
        pass
    return spark


def shuffle_partitions_for(input_bytes: int, target_partition_bytes: int = 256 << 20,
                           minimum: int = 8) -> int:
    """Initial shuffle partition count for an input of ``input_bytes``.

    AQE only *coalesces* small partitions (and splits skewed ones), so the
    initial count must be large enough for the biggest shuffle: about one
    partition per 256 MB of input keeps every partition well inside executor
    memory; AQE merges the rest back to its advisory size.
    """
    return max(minimum, -(-input_bytes // target_partition_bytes))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session may name none (tests): it gets a folder of its own.
    On a cluster a machine-local folder would scatter the rows, so a missing
    setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on this client
        pass
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tillhouse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return os.path.join(base, "tables", name) if "://" not in base else f"{base}/tables/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, in whatever store Spark reads it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def run_concurrently(actions: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """Submit independent Spark actions (e.g. writes of different tables) at
    the same time, so stages of one table that cannot use every core leave
    the rest to the others.  Each action is still one distributed job; an
    error in any of them is re-raised here."""
    if len(actions) <= 1:
        return {k: f() for k, f in actions.items()}
    with ThreadPoolExecutor(max_workers=min(len(actions), 8)) as pool:
        # worker threads inherit the caller's local properties (job group,
        # scheduler pool), so cancellation and accounting still apply
        futures = {k: pool.submit(inheritable_thread_target(f)) for k, f in actions.items()}
        return {k: fut.result() for k, fut in futures.items()}
