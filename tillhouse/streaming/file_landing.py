"""Incremental landing of file-based sources with Structured Streaming.

For sources that arrive as files (one folder per table, tenant in a column),
the high-water mark is kept by the stream checkpoint instead of a watermark
table: each micro-batch holds only new files and is landed as versions with
``_batch_id = batch_offset + epoch id``.  ``availableNow`` processes the
backlog and stops, so the job keeps the scheduled-batch shape of the
reference's load.

Exactly-once: every epoch is a batch of its own in the layout of the batch
landing (``_batch_id=<n>``, by tenant inside), so an epoch that is replayed after a
failure replaces what its first attempt wrote, and one table may be fed by both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillhouse.sources.landing import append_versions


def epoch_writer(landing_path: str, tenant_col: str = "tenant_id", batch_offset: int = 0):
    """The ``foreachBatch`` function: idempotent per epoch id."""

    def write_batch(df: DataFrame, epoch_id: int) -> None:
        append_versions(df, landing_path, batch_offset + epoch_id, tenant_col)

    return write_batch


def land_new_files(spark: SparkSession, source_dir: str, schema: StructType, landing_path: str,
                   checkpoint: str, tenant_col: str = "tenant_id", batch_offset: int = 0):
    """Land rows of files not yet seen under ``source_dir`` into ``landing_path``
    (partitioned by ``_batch_id`` and tenant).  Returns the finished query."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    q = (stream.writeStream.foreachBatch(epoch_writer(landing_path, tenant_col, batch_offset))
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
