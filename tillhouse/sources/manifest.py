"""Published tables: data in directories that never change, and a manifest that
names the ones a reader takes (S6, S11, D3).

A table is a folder ``<path>/v<n>/_part=<p>/`` of Parquet files and small JSON
files ``<path>/_manifest/<n>.json``.  A write puts the partitions it replaces
under the next version and then creates that version's manifest, which names a
directory for every partition: the new one where it was replaced, the old one
elsewhere.  The newest manifest is the table.

* Readers resolve it once, so a rebuild that runs meanwhile does not change what
  they see, and one that fails leaves nothing but unnamed files.
* Untouched partitions keep their files and names.
* Two writers of one version: the second one's manifest fails to be created.
* ``retain`` deletes versions that none of the last manifests name.

A manifest's size is the number of partitions (tenants x months, or buckets):
it does not grow with the rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.session import WRITE_OPTIONS

PART = "_part"
WHOLE = "all"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it is missing."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


class PublishedTable:
    """One table.  ``schema`` is that of the rows; where none is given it is
    taken from the manifest, which records what was written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- manifests --------------------------------------------------------------
    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in entries(self.spark, f"{self.path}/_manifest") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict | None:
        """The newest manifest, or that of ``version``; None before the first write."""
        if version is None:
            found = self.versions()
            if not found:
                return None
            version = found[-1]
        fs, p = _fs(self.spark, f"{self.path}/_manifest/{version}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        fs, target = _fs(self.spark, f"{self.path}/_manifest/{manifest['version']}.json")
        _, draft = _fs(self.spark, f"{self.path}/_manifest/.draft-{manifest['version']}")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            raise RuntimeError(f"version {manifest['version']} of {self.path} was published by another writer")

    # ---- reading ----------------------------------------------------------------
    def exists(self) -> bool:
        return bool(self.versions())

    def parts(self) -> list[str]:
        m = self.manifest()
        return sorted(m["parts"]) if m else []

    def meta(self) -> dict:
        m = self.manifest()
        return m["meta"] if m else {}

    def read(self, parts: Collection[str] | None = None, version: int | None = None) -> DataFrame:
        """The table, or some of its partitions; only their files are listed."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"{self.path} has no published version")
        schema = T.StructType.fromJson(m["schema"])
        dirs = [f"{self.path}/{d}" for p, d in sorted(m["parts"].items()) if parts is None or p in parts]
        return self.spark.read.schema(schema).parquet(*dirs) if dirs else self.spark.createDataFrame([], schema)

    # ---- writing ----------------------------------------------------------------
    def replace(self, df: DataFrame, part: Column | None = None, replaced: Iterable[str] | None = None,
                meta: dict | None = None) -> DataFrame:
        """Publish a version in which the partitions of ``df`` are replaced.

        ``part`` gives a row's partition (one for all where it is None).
        ``replaced`` names partitions that are gone unless ``df`` has rows for
        them, by default all: a whole rebuild.  Returns the published table."""
        old = self.manifest()
        version = (old["version"] if old else 0) + 1
        written = self._write(df, F.lit(WHOLE) if part is None else part, version)
        kept = {} if old is None or replaced is None else {p: d for p, d in old["parts"].items() if p not in set(replaced)}
        if replaced is not None and (extra := set(written) & set(kept)):
            raise ValueError(f"rows for partitions that are not replaced: {sorted(extra)[:5]}")
        return self._publish(version, kept | written, df, meta)

    def renew(self, fresh: DataFrame, part: Column, left: Collection[str], kept: Callable[[DataFrame], DataFrame],
              meta: dict | None = None) -> DataFrame:
        """Publish a version with the rows ``fresh``, each computed and written
        once.  Of the partitions they fall in, and of those named by ``left``,
        the rows that ``kept`` takes from the table are written beside them."""
        old = self.manifest()
        version = old["version"] + 1
        written = self._write(fresh, part, version)
        parts = {*left, *written} & set(old["parts"])
        if not parts and not written:
            self.note(meta or {})
            return self.read()
        if parts:
            written |= self._write(kept(self.read(parts)).select(*fresh.columns), part, version, "append")
        return self._publish(version, {p: d for p, d in old["parts"].items() if p not in parts} | written, fresh, meta)

    def _write(self, df: DataFrame, part: Column, version: int, mode: str = "overwrite") -> dict[str, str]:
        """Rows into the folder of ``version`` by partition; the directory of each partition there."""
        target = f"{self.path}/v{version}"
        df.withColumn(PART, part.cast("string")).write.mode(mode).options(**WRITE_OPTIONS).partitionBy(PART).parquet(target)
        return {self._unescaped(n): f"v{version}/{n}" for n in entries(self.spark, target) if n.startswith(f"{PART}=")}

    def _publish(self, version: int, parts: dict[str, str], df: DataFrame, meta: dict | None) -> DataFrame:
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name != PART])
        self._commit({"version": version, "parts": parts, "schema": schema.jsonValue(), "meta": meta or {}})
        return self.read(version=version)

    def note(self, meta: dict) -> None:
        """A version with the same files and other ``meta``."""
        old = self.manifest()
        self._commit({**old, "version": old["version"] + 1, "meta": meta})

    def _unescaped(self, name: str) -> str:
        text = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)
        return text.removeprefix(f"{PART}=")

    def retain(self, last: int = 7) -> list[str]:
        """Delete version folders that none of the ``last`` newest manifests
        names, and the older manifests; returns the folders deleted."""
        found = self.versions()
        keep = found[-last:]
        named = {d.split("/")[0] for v in keep for d in self.manifest(v)["parts"].values()}
        gone = []
        for v in found[:-last]:
            fs, p = _fs(self.spark, f"{self.path}/_manifest/{v}.json")
            fs.delete(p, False)
        for n in entries(self.spark, self.path):
            if n.startswith("v") and n[1:].isdigit() and n not in named and int(n[1:]) <= found[-1]:
                fs, p = _fs(self.spark, f"{self.path}/{n}")
                fs.delete(p, True)
                gone.append(n)
        return sorted(gone)


def publish(df: DataFrame, path: str, meta: dict | None = None) -> DataFrame:
    """Replace a whole table by ``df``; readers of the old one are not disturbed."""
    return PublishedTable(df.sparkSession, path).replace(df, meta=meta)


def published(spark: SparkSession, path: str) -> DataFrame:
    return PublishedTable(spark, path).read()
