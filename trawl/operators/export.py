"""Letter-partitioned export of the index (E1-E3) and its reader."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl import schemas
from trawl.operators.index import letter_of


def export_rows(postings: DataFrame, docs: DataFrame, discoveries: DataFrame) -> DataFrame:
    """Postings ⋈ pages ⋈ discoveries (inner). `field` is not part of a
    line, so one (term, url, origin, depth) may occur once per field."""
    return (postings.select("page_id", "term", "frequency")
            .join(docs.select("page_id", "url"), "page_id")
            .join(discoveries.select("page_id", "origin_url", F.col("depth").cast("long").alias("depth")),
                  "page_id")
            .select("term", "url", "origin_url", "depth", "frequency",
                    letter_of(F.col("term")).alias("letter")))


def write_letter_index(rows: DataFrame, path: str) -> None:
    """Tab-separated lines `term url origin_url depth frequency`, one
    folder per letter, each file sorted by term then frequency descending.
    Rows are dealt by ranges, so a frequent letter or term spans many tasks and
    a task writes few files. The whole folder is replaced."""
    dealt = rows.repartitionByRange("letter", "term", F.desc("frequency"), "url", "origin_url")
    (dealt.sortWithinPartitions("letter", "term", F.desc("frequency"))
     .select("term", "url", "origin_url", "depth", "frequency", "letter")
     .write.mode("overwrite").partitionBy("letter").option("sep", "\t").option("header", "false")
     .csv(path))


def read_letter_index(spark: SparkSession, path: str) -> DataFrame:
    """The exported files as a table (explicit schema, `letter` from the folder)."""
    return (spark.read.schema(schemas.LETTER_INDEX.add("letter", schemas.S))
            .option("sep", "\t").option("header", "false").csv(path))


def lookup(index: DataFrame, term: str) -> DataFrame:
    """Rows of one term; the derived `letter = ...` predicate prunes every
    other letter folder before any file is opened."""
    t = term.lower()
    letter = t[0] if t and (t[0].isascii() and t[0].isalnum()) else "_"
    return index.filter((F.col("letter") == letter) & (F.col("term") == t))
