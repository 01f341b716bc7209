"""A corpus pipeline over documents: quality rules, line dedup, near duplicates,
benchmark decontamination, mixing.

Each stage works on all that the stage before kept. `run` writes each stage's
result and reads it again as the next one's documents.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import decontamination, line_dedup, mixing, near_dup, quality_rules
from trawl.session import checkpoint_dir

NEAR_PERCENT = 80     # similarity of near duplicates, in percent
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20     # of texts that Spark sends to Python at once


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.keep_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; n_chars follows where it is there. A
    document that loses all its lines stays with an empty text."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("__n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dup.drop_near_duplicates(docs, near_dup.Params(percent=NEAR_PERCENT, rows=4))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, numbered by copy_no."""
    return mixing.mix(docs)


def _bounded(stage):
    """The stage with texts sent to Python in batches of about BATCH_BYTES, unless the
    session has a bound of its own. By rows alone a batch holds 10,000 texts, once in the
    JVM and once in Python. The session keeps the bound, as the result is read later."""
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(ARROW_BYTES, None) is None:
            spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


STAGES = [("quality_rules", _bounded(quality)), ("line_dedup", _bounded(lines)), ("near_dup", _bounded(near_duplicates)),
          ("decontamination", _bounded(decontaminate)), ("mixing", _bounded(mixed))]

# Alignment and near-duplicate components have no SQL form; tests/llm compares
# every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex[:12]}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
