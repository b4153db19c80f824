"""Corpus pipeline: five stages, each over all that the one before kept.

quality classifier -> line dedup -> n-gram Jaccard join -> benchmark
decontamination -> byte-level BPE.  ``run`` writes each stage's rows as Parquet
under the shared checkpoint folder and reads them again for the next stage.

A stage takes (spark, docs, sf_dir).  All but the last return the columns of
``documents``.  Null and empty texts: the classifier scores them like others;
an empty text has no line with a word, no shingle and no token.  Empty tables stay
empty through every stage.  Stages judge rows, so rows with a null or repeated
doc_id are kept or dropped by themselves; columns of any other name pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.bpe import digests
from tillhouse.llm.common import at, numbered, ship, store
from tillhouse.llm.decontaminate import decontaminate
from tillhouse.llm.line_dedup import line_dedup
from tillhouse.llm.ngram_join import similar_components
from tillhouse.llm.quality_classifier import quality_scores


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _rows(docs: DataFrame) -> DataFrame:
    """``docs`` with columns in_0, in_1, ... and a number of each row, stored, so
    that every reading of it, also after a lost executor, gives a row the same number."""
    return store(numbered(docs).withColumn("row", F.monotonically_increasing_id()), "rows")


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(at(docs, c)).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score under 0.3) go."""
    scored = quality_scores(numbered(docs, "doc_id", "text"), _table(spark, sf_dir, "labels")).where("predicted = 1")
    return scored.select(*[F.col(c if c in ("doc_id", "text") else at(docs, c)).alias(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines equal to, or one word apart from, an earlier line go; a document
    that had words and keeps none goes with them.  n_chars follows the text."""
    text = at(docs, "text")
    out = line_dedup(numbered(docs).withColumn("had", F.col(text).rlike(r"[^\x20\x09-\x0D]")), at(docs, "doc_id"), text, exact_words=1)
    out = out.where(~F.coalesce("had", F.lit(False)) | F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        n = at(docs, "n_chars")
        out = out.withColumn(n, F.when(F.col("n_exact") + F.col("n_near") > 0, F.length(text).cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col(n)))
    return _back(out, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar rows one stays: that with the smallest doc_id (a
    null one comes last), of equal ids any one.  Rows without shingles all stay."""
    rows = _rows(docs)
    found = similar_components(rows, "row", at(docs, "text")).where("n_shingles > 0").select(F.col("doc_id").alias("row"), "component_id")
    groups = found.where("row <> component_id").select("component_id").distinct()
    ids = rows.select("row", F.col(at(docs, "doc_id")).alias("id"))
    members = store(found.join(groups, "component_id", "left_semi").join(ids, "row"), "members")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "row"))["row"].alias("keep"))
    gone = members.join(first, "component_id").where("row <> keep").select("row")
    return _back(rows.join(gone, "row", "left_anti"), docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold 80 % of a test item's shingles go, others with their doc_id stay."""
    rows = _rows(docs)
    found = decontaminate(rows, _table(spark, sf_dir, "benchmark"), "row", at(docs, "text"))
    return _back(rows.join(found.select(F.col("doc_id").alias("row")).distinct(), "row", "left_anti"), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's number of tokens and digests of its ids and of the bytes they decode to."""
    import public_tokenizers
    ship(spark)
    return digests(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("ngram_jaccard_join", near_duplicates),
          ("benchmark_decontamination", benchmark), ("byte_bpe", tokens)]

#: The trained classifier has no SQL form.  Tests hold every other stage's rows against brute
#: force or a library, over rows with null and repeated ids, and the classifier by its held-out
#: accuracy; of all stages in order, over sf0.001, that columns stay and no stage adds rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
