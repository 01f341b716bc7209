"""Mixing sources to target weights, with DataFrame operations only.

Tokens are summed by source, each source gets a target and so a repetition
rate, and each document is emitted floor(rate) times plus one hash-seeded
Bernoulli copy whose probability is the fraction of the rate.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import stored, token_count

WEIGHTS = (3, 1, 2)   # of the sources by code point, repeating
SHARE = 1.5           # all targets together, as a multiple of all sizes
MAX_REPEAT = 2        # a target stops at this multiple of its source's size
SEEDS = 32            # seeds tried for each source
_BITS = 52


def _draw(doc_id: Column) -> Column:
    """A 52-bit hash of the document id."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("long")


def _copies(rate: Column, draw: Column, seed: Column) -> Column:
    """floor(rate), plus 1 where the draw, turned by the source's seed, is below the fraction."""
    turned = F.pmod(draw + seed.cast("long") * F.lit((1 << _BITS) // SEEDS), F.lit(1 << _BITS))
    return F.floor(rate) + (turned < (rate - F.floor(rate)) * F.lit(float(1 << _BITS))).cast("long")


def source_targets(by_source: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> target by source.

    Sharing by weight, stopping at the caps and resharing the excess until none
    is above ends at one level L with target = least(cap, L * weight). Sorted by
    cap / weight the capped sources come first, so L is the largest of
    (all - caps before) / (weights not before). The windows run over one narrow
    row per source, not over documents."""
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     (F.pmod(F.row_number().over(rank) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = by_source.select("source", "source_size", w.alias("weight"),
                         (F.col("source_size") * max_repeat).alias("cap"))
    t = t.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything) * F.lit(float(share))
              - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    t = t.withColumn("own_level", level)
    t = t.withColumn("target", F.least(F.col("cap").cast("double"),
                                       F.max("own_level").over(everything) * F.col("weight")))
    return t.select("source", "source_size", "target",
                    F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)).alias("rate"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of all documents, written once: the text is read once."""
    return stored(docs.select("doc_id", "source", token_count(F.col("text")).alias("size")), "mix-sizes")


def plan_mix(sizes: DataFrame, **params) -> DataFrame:
    """One row per source: source_size, target, rate and the seed (0 .. SEEDS-1)
    under which the words taken come nearest to the target.

    A seed turns the documents' hashes by a fixed step, so that under each seed
    each document's copy is a Bernoulli draw of the same probability."""
    targets = stored(source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), **params),
                     "mix-targets")
    drawn = sizes.join(targets.withColumnRenamed("source", "src"), F.col("source").eqNullSafe(F.col("src")))
    sums = [F.sum(_copies(F.col("rate"), F.col("draw"), F.lit(k)) * F.col("size")).alias(f"t{k}")
            for k in range(SEEDS)]
    tried = drawn.withColumn("draw", _draw(F.col("doc_id"))).groupBy("source", "target").agg(*sums)
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k).alias("seed"))
                                    for k in range(SEEDS)]))
    seeds = tried.select(F.col("source").alias("src"), nearest["seed"].alias("seed"))
    return stored(targets.join(seeds, F.col("source").eqNullSafe(F.col("src")), "left")
                  .select("source", "source_size", "target", "rate", F.coalesce("seed", F.lit(0)).alias("seed")),
                  "mix-plan")


def _with_copies(df: DataFrame, plan: DataFrame) -> DataFrame:
    """`df` (doc_id, source, ...) with the plan as struct column __mix and __mix_copies.

    The plan has one narrow row per source; Spark broadcasts it under its size
    threshold and otherwise joins by source, splitting a hot one."""
    p = plan.select(F.col("source").alias("__mix_source"), F.struct("*").alias("__mix"))
    out = df.join(p, df["source"].eqNullSafe(F.col("__mix_source")), "left").drop("__mix_source")
    return out.withColumn("__mix_copies", _copies(F.col("__mix.rate"), _draw(F.col("doc_id")), F.col("__mix.seed")))


def mix_report(docs: DataFrame, **params) -> DataFrame:
    """One row per row of documents: doc_id, size, source_size, target, taken.

    Nulls: a null text has size 0, a null source is the last source, a null id
    draws as one id. Repeated rows each count and draw alike. A source without
    words has target 0 and rate 0. No documents give no rows. Other columns are ignored."""
    sizes = document_sizes(docs)
    out = _with_copies(sizes, plan_mix(sizes, **params))
    return out.select("doc_id", "size", F.col("__mix.source_size").alias("source_size"),
                      F.col("__mix.target").alias("target"),
                      (F.col("__mix_copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its
    columns and copy_no (1, 2, ...; a column of that name in the input is replaced)."""
    plan = plan_mix(document_sizes(docs), **params)
    out = _with_copies(docs, plan).where("__mix_copies > 0")
    return (out.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("__mix_copies").cast("int"))))
            .drop("__mix", "__mix_copies"))
