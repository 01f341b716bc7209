"""Job and URL reports (J1-J9) and the cascade purge.

All counters are derived from the `discovered` relation of a crawl instead of
being incremented in place: one `groupBy(job_id)` with conditional counts.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value of the reference (default frontier capacity).
DEFAULT_CAPACITY = 10_000
ACTIVE_STATES = ("queued", "running")
RECENT_ERRORS_DEFAULT, RECENT_ERRORS_STATUS = 10, 5


def _indexed(d: DataFrame):
    return (F.col("state") == "processed") & F.col("page_id").isNotNull()


def job_status(jobs: DataFrame, discovered: DataFrame) -> DataFrame:
    """Status per job: failed when its origin is invalid, running while any of
    its URLs is still queued, completed otherwise."""
    pending = (discovered.groupBy("job_id")
               .agg(F.count_if(F.col("state").isin("queued", "processing")).alias("_pending")))
    j = jobs.join(pending, "job_id", "left")
    return j.withColumn(
        "status",
        F.when(F.col("status") == "failed", "failed")
        .when(F.coalesce(F.col("_pending"), F.lit(0)) > 0, "running")
        .otherwise("completed")).drop("_pending")


def job_counters(jobs: DataFrame, discovered: DataFrame) -> DataFrame:
    """Discovered (admitted to the frontier), processed (incl. errors),
    indexed, error and queued (never below 0) counts per job."""
    c = discovered.groupBy("job_id").agg(
        F.count_if(F.col("state") != "skipped").alias("discovered_count"),
        F.count_if(F.col("state").isin("processed", "failed")).alias("processed_count"),
        F.count_if(_indexed(discovered)).alias("indexed_count"),
        F.count_if(F.col("state") == "failed").alias("error_count"))
    out = jobs.select("job_id").join(c, "job_id", "left").na.fill(0, [
        "discovered_count", "processed_count", "indexed_count", "error_count"])
    return out.withColumn("queued_count", F.greatest(F.lit(0), F.col("discovered_count") - F.col("processed_count")))


def active_jobs(jobs_with_status: DataFrame) -> DataFrame:
    """J2."""
    return jobs_with_status.filter(F.col("status").isin(*ACTIVE_STATES))


def job_list(jobs_with_status: DataFrame) -> DataFrame:
    """Newest first."""
    return jobs_with_status.orderBy(F.desc("created_at"), F.desc("job_id"))


def job_summary(jobs_with_status: DataFrame, discovered: DataFrame) -> DataFrame:
    """Job row with its counters."""
    return jobs_with_status.join(job_counters(jobs_with_status, discovered), "job_id")


def url_state_stats(discovered: DataFrame) -> DataFrame:
    """Histogram of URL states."""
    return discovered.groupBy("state").agg(F.count(F.lit(1)).alias("count"))


def frontier_count(discovered: DataFrame) -> DataFrame:
    """How many URLs wait."""
    return discovered.agg(F.count_if(F.col("state") == "queued").alias("count"))


def recent_errors(discovered: DataFrame, limit: int = RECENT_ERRORS_DEFAULT) -> DataFrame:
    """Failed URLs, most recently fetched first."""
    return (discovered.filter(F.col("state") == "failed")
            .orderBy(F.desc("fetched_at"), F.desc("normalized_url"))
            .limit(limit)
            .select("normalized_url", "error_message", F.lit(None).cast("int").alias("http_status"),
                    "fetched_at", "depth", "job_id"))


def status_row(jobs_with_status: DataFrame, discovered: DataFrame,
               capacity: int = DEFAULT_CAPACITY) -> DataFrame:
    """One row: URL state pivot with zero defaults, indexed pages, active
    jobs, queue depth, saturation and dropped URLs."""
    # one aggregate over both inputs (no join): URL rows carry a state, job
    # rows carry a status
    d = discovered.select("state", "page_id", F.lit(None).cast("string").alias("status"))
    j = jobs_with_status.select(F.lit(None).cast("string").alias("state"),
                                F.lit(None).cast("long").alias("page_id"), "status")
    u = d.unionByName(j)
    s = u.agg(
        F.count_if(F.col("state") == "processed").alias("processed_count"),
        F.count_if(F.col("state") == "failed").alias("error_count"),
        F.count_if(F.col("state") == "skipped").alias("skipped_count"),
        F.count_if(F.col("state") == "queued").alias("queue_depth"),
        F.count_distinct(F.when((F.col("state") == "processed") & F.col("page_id").isNotNull(),
                                F.col("page_id"))).alias("indexed_count"),
        F.count_if(F.col("status").isin(*ACTIVE_STATES)).alias("active_jobs"))
    return s.select("processed_count", "error_count", "skipped_count", "indexed_count", "active_jobs",
                    "queue_depth", F.lit(capacity).cast("long").alias("max_queue_depth"),
                    (F.col("queue_depth") >= capacity).alias("queue_saturated"),
                    F.col("skipped_count").alias("dropped_urls"))


def purge_job(job_id: int, jobs: DataFrame, discovered: DataFrame, page_discoveries: DataFrame,
              docs: DataFrame, postings: DataFrame, frontier: DataFrame | None = None) -> dict[str, DataFrame]:
    """Delete a job and everything only it found.

    exclusive pages = pages the job discovered that no other job discovered
    (semi minus anti on page_discoveries); their postings and documents go,
    shared pages survive. Returns the surviving relations."""
    j = F.lit(int(job_id))
    mine = page_discoveries.filter(F.col("job_id") == j).select("page_id").distinct()
    others = page_discoveries.filter(F.col("job_id") != j).select("page_id").distinct()
    exclusive = mine.join(others, "page_id", "left_anti")
    out = {
        "jobs": jobs.filter(F.col("job_id") != j),
        "discovered": discovered.filter(F.col("job_id") != j),
        "page_discoveries": page_discoveries.filter(F.col("job_id") != j),
        "page_docs": docs.join(exclusive, "page_id", "left_anti"),
        "page_terms": postings.join(exclusive, "page_id", "left_anti"),
        "exclusive_pages": exclusive,
    }
    if frontier is not None:
        out["frontier"] = frontier.filter(F.col("job_id") != j)
    return out
