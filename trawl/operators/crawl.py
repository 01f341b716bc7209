"""Link traversal as a data job.

`crawl` runs a level-synchronous breadth-first traversal over an archive of
fetched pages. Each level is a DataFrame plan:

    frontier(d) ⋈ archive          fetch outcome (C11)
                ⋈ edges            candidate links at depth d+1 (C1)
    groupBy(dst).min(order key)    first discoverer wins (C2, C6); partial
                                   aggregation makes a hot URL cheap
    ⋉̸ seen table                   global de-duplication (C2)

then the level is checkpointed to the shared checkpoint folder, which cuts the
lineage and makes the loop restartable after executor loss, and its URLs are
appended to the seen table. That table is bucketed by URL, so it is never shuffled:
however many levels there were, a level costs one exchange of its own candidates.
The driver loop runs at most max_depth+1 times and moves no rows, only counts.

Times come from one clock that does not depend on when the job runs: a URL is
fetched a minute after the level before, and a second after the link before it
in its page (modulo a minute), counted from its job's creation.

Tie-breaks (the reference's order depends on network timing): among the
candidates for one URL at one level the smallest (job_id, parent page_id,
link position) wins.
"""
from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.urls import with_normalized_url
from trawl.operators.robots import allowed
from trawl.session import checkpoint_dir, cut_lineage, materialize

BLOCKED = "blocked by robots rules"

# Creation time of jobs that come without one, and the clock's step for a level.
EPOCH, LEVEL_SECONDS = "2024-01-01 00:00:00", 60

DISCOVERED_COLS = ["normalized_url", "url", "state", "depth", "job_id", "origin_url",
                   "discovered_from_url", "parent_page_id", "pos", "page_id", "error_message", "fetched_at"]


@dataclass
class CrawlResult:
    discovered: DataFrame            # one row per admitted or dropped URL
    page_discoveries: DataFrame      # (page_id, job_id, origin_url, depth) of indexed pages
    levels: list[dict] = field(default_factory=list)   # per-level metrics
    jobs: DataFrame | None = None    # jobs with status (completed / failed)


ROWS_PER_PARTITION = 200_000


def _partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for the per-level tables: the session's shuffle partitions,
    fewer when the archive is small (tiny levels would write many empty files)."""
    conf = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(conf, -(-rows // ROWS_PER_PARTITION)))


def prepare_archive(docs: DataFrame, fetched: DataFrame | None = None) -> DataFrame:
    """Archive keyed by normalized_url: page_id and whether the page is indexed.

    `docs` are accepted, de-duplicated pages (page_docs); `fetched` optionally
    lists every fetched URL (normalized_url, http_status, content_type), also
    those not accepted as HTML, which count as processed without indexing."""
    a = docs.select("normalized_url", "page_id", F.lit(True).alias("indexed"))
    if fetched is not None:
        extra = (fetched.select("normalized_url", "http_status", "content_type")
                 .join(a.select("normalized_url"), "normalized_url", "left_anti")
                 .select("normalized_url", F.lit(None).cast("long").alias("page_id"),
                         F.lit(False).alias("indexed")))
        a = a.unionByName(extra)
    return a


def crawl(archive: DataFrame, edges: DataFrame, jobs: DataFrame,
          stop_after: int | None = None, rules: DataFrame | None = None) -> CrawlResult:
    """Multi-origin, depth-bounded BFS with global dedup.

    rules:   robots rules (host, path, allow, rank) from `robots.parse_rules`;
    a URL that they block is processed without being fetched: it is not
    indexed and its links are not followed.

    archive: (normalized_url, page_id, indexed) from `prepare_archive`.
    edges:   (src_url, pos, dst_url, stored_url) with normalized src/dst.
    jobs:    (job_id, origin_url, max_depth[, created_at]).
    stop_after: fetch no level deeper than this; the next admitted level is
    left `queued` (a paused crawl, input of C12-C14).
    """
    spark = archive.sparkSession
    archive = materialize(archive, "fetched")
    parts = _partitions(spark, archive.count())
    # static inputs: partitioned once by URL and checkpointed, so each level
    # shuffles only the (small) frontier
    arch = cut_lineage(archive.repartition(parts, "normalized_url"))
    out_edges = cut_lineage(
        edges.select(F.col("src_url").alias("normalized_url"), "pos", "dst_url", "stored_url")
        .filter(F.col("dst_url").isNotNull())
        .repartition(parts, "normalized_url"))

    created = F.col("created_at") if "created_at" in jobs.columns else F.lit(EPOCH)
    seeds = (jobs.select(F.col("job_id").cast("long").alias("job_id"), "origin_url",
                         F.col("max_depth").cast("int").alias("max_depth"), created.cast("timestamp_ntz").alias("created_at")))
    seeds = with_normalized_url(seeds, "origin_url", "normalized_url")
    valid = seeds.filter(F.col("normalized_url").isNotNull())
    # C2 at depth 0: the first job (smallest id) owns a shared origin
    first = (valid.groupBy("normalized_url")
             .agg(F.min(F.struct("job_id", "origin_url", "max_depth", "created_at")).alias("w"))
             .select("normalized_url", "w.job_id", "w.origin_url", "w.max_depth", "w.created_at",
                     F.col("w.origin_url").alias("url"), F.lit(0).alias("depth"),
                     F.lit(None).cast("string").alias("discovered_from_url"),
                     F.lit(None).cast("long").alias("parent_page_id"), F.lit(None).cast("long").alias("pos")))
    if rules is not None:
        rules = cut_lineage(rules)
    seen = SeenTable(spark, parts)
    done: list[DataFrame] = []
    metrics = []
    depth, cands = 0, first
    while True:
        level = _admit(cands, seen if depth else None, arch, parts, rules)
        n_new = level.count()
        metrics.append({"depth": depth, "admitted": n_new})
        paused = stop_after is not None and depth > stop_after
        done.append(level.withColumns({
            "page_id": F.lit(None).cast("long"), "indexed": F.lit(False), "state": F.lit("queued"),
            "error_message": F.lit(None).cast("string"), "fetched_at": F.lit(None).cast("timestamp_ntz")}) if paused else level)
        if n_new == 0 or paused:
            break
        seen.add(level)
        expand = level.filter(F.col("indexed") & (F.col("depth") < F.col("max_depth")))
        cand = (expand.select("normalized_url", "job_id", "origin_url", "max_depth", "created_at", "depth",
                              F.col("page_id").alias("parent_page_id"))
                .join(out_edges, "normalized_url")
                .select(F.col("dst_url").alias("normalized_url"),
                        F.struct("job_id", "parent_page_id", "pos",
                                 F.col("stored_url").alias("url"), "origin_url", "max_depth", "created_at",
                                 F.col("normalized_url").alias("discovered_from_url"),
                                 (F.col("depth") + 1).alias("depth")).alias("c")))
        cands = cand.groupBy("normalized_url").agg(F.min("c").alias("c")).select("normalized_url", "c.*")
        depth += 1
    seen.drop()

    discovered = done[0]
    for d in done[1:]:
        discovered = discovered.unionByName(d)
    discovered = discovered.select(*DISCOVERED_COLS)
    page_disc = (discovered.filter(F.col("state") == "processed")
                 .filter(F.col("page_id").isNotNull())
                 .select("page_id", "job_id", "origin_url", "depth").dropDuplicates())
    status = (seeds.select("job_id", "origin_url", "max_depth", "created_at",
                           F.when(F.col("normalized_url").isNull(), "failed")
                           .otherwise("completed").alias("status")))
    return CrawlResult(discovered, page_disc, metrics, status)


class SeenTable:
    """The URLs of all levels so far, bucketed by URL and appended level by level. It is
    a table of the session's catalog over files in the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name = f"trawl_seen_{uuid.uuid4().hex[:12]}"
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/{self.name}"

    def add(self, level: DataFrame) -> None:
        """`level` is dealt by URL already, so a task writes the file of one bucket."""
        (level.select("normalized_url").write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, "normalized_url").sortBy("normalized_url").saveAsTable(self.name))

    def unseen(self, cands: DataFrame) -> DataFrame:
        return cands.join(self.spark.table(self.name), "normalized_url", "left_anti")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _admit(cands: DataFrame, seen: SeenTable | None, arch: DataFrame, parts: int,
           rules: DataFrame | None = None) -> DataFrame:
    """C2 + C11 for one level: drop URLs seen at any earlier level, look the rest up
    in the archive (fetch outcome), write the level once."""
    new = cands if seen is None else seen.unseen(cands)
    if rules is not None:
        # the robots test reads the level twice
        new = allowed(cut_lineage(new), rules)
    return cut_lineage(_fetch(new, arch).repartition(parts, "normalized_url"))


def _fetched_at() -> Column:
    seconds = F.col("depth") * LEVEL_SECONDS + F.pmod(F.coalesce("pos", F.lit(0).cast("long")), F.lit(LEVEL_SECONDS))
    return F.col("created_at") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _fetch(frontier: DataFrame, arch: DataFrame) -> DataFrame:
    """C11: outcome of fetching each frontier URL from the archive. A URL that
    is not `allowed` (where the column is there) is processed unfetched."""
    f = frontier.join(arch, "normalized_url", "left")
    ok = F.col("allowed") if "allowed" in f.columns else F.lit(True)
    missing = F.col("indexed").isNull()
    return (f.withColumns({
        "state": F.when(ok & missing, "failed").otherwise("processed"),
        "error_message": F.when(~ok, F.lit(BLOCKED)).when(missing, F.lit("not in archive")),
        "fetched_at": _fetched_at(),
        "page_id": F.when(ok, F.col("page_id")),
        "indexed": ok & F.coalesce(F.col("indexed"), F.lit(False))}).drop("allowed"))


# ---------------------------------------------------------------- frontier ops

def frontier_of(discovered: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """Pending frontier rebuilt from URLs still `queued`, with the job's
    origin. `seq` orders the queue (depth, job, parent, position)."""
    q = discovered.filter(F.col("state") == "queued")
    if jobs is not None:
        q = q.drop("origin_url").join(jobs.select("job_id", "origin_url"), "job_id")
    return q.withColumn("seq", F.struct("depth", "job_id", "parent_page_id", "pos"))


def lineage_paths(discovered: DataFrame, max_depth: int) -> DataFrame:
    """Origin-to-page path of every URL, by path doubling: each row holds the path
    from some ancestor on and the URL before it; a round puts the ancestor's own path
    in front, so paths of `max_depth` links need log2 of that many rounds.

    A finished path has no URL before it; its join key is its own URL behind a
    control character, which no URL holds, so finished rows match nothing and
    are spread over the tasks instead of sharing a null key."""
    cur = discovered.select("normalized_url", "job_id", "depth", F.col("discovered_from_url").alias("at"),
                            F.col("normalized_url").alias("path"))
    for _ in range(math.ceil(math.log2(max_depth + 1))):
        cur = materialize(cur, "lineage")
        before = cur.select(F.col("normalized_url").alias("key"), F.col("at").alias("next_at"), F.col("path").alias("front"))
        key = F.coalesce("at", F.concat(F.lit("\x01"), "normalized_url"))
        front = F.coalesce("front", "at")   # a URL that is no row stands for itself
        cur = (cur.withColumn("key", key).join(before, "key", "left")
               .select("normalized_url", "job_id", "depth", F.col("next_at").alias("at"),
                       F.when(F.col("at").isNotNull(), F.concat_ws(" > ", front, F.col("path"))).otherwise(F.col("path")).alias("path")))
    return cur.drop("at")
