"""The registered query of each operator: whole tables, production parameters."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import (bpe, chat, decontamination, language, line_dedup, merkle, mixing, near_dup, quality_classifier,
                       quality_rules, ranked_search, secrets, toxicity)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.explode(F.array(
        *[F.struct(F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text"))
          for k, r in enumerate(("user", "assistant"))])).alias("t")).select("conv_id", "t.*")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.chat_digest(chat.format_chat(rows))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers   # files on the driver's machine

    return bpe.tokens_report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (op1_secrets, op2_chat, op3_quality_rules, op4_language, op5_near_dup, op6_toxicity,
                                   op7_mixing, op8_quality_classifier, op9_line_dedup, op10_decontamination, op11_ranked_search, op12_merkle, op13_bpe)}
