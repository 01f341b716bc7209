"""Explicit schemas of the engine's relations (never inferred)."""
from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Fetched-page archive (the crawl's "web"); only page_id/url/html are required.
ARCHIVE = _st(("page_id", L), ("url", S), ("html", S), ("content_type", S),
              ("content_length", L), ("http_status", I))

JOBS = _st(("job_id", L), ("origin_url", S), ("max_depth", I), ("status", S), ("created_at", TS))

DISCOVERED = _st(("normalized_url", S), ("url", S), ("state", S), ("depth", I), ("job_id", L),
                 ("discovered_from_url", S), ("http_status", I), ("error_message", S),
                 ("content_type", S), ("fetched_at", TS))

PAGE_DOCS = _st(("page_id", L), ("normalized_url", S), ("url", S), ("title", S), ("body_text", S),
                ("content_length", L))

PAGE_TERMS = _st(("page_id", L), ("term", S), ("field", S), ("frequency", L), ("letter", S))

PAGE_DISCOVERIES = _st(("page_id", L), ("job_id", L), ("origin_url", S), ("depth", I))

FRONTIER = _st(("seq", L), ("normalized_url", S), ("url", S), ("job_id", L), ("origin_url", S),
               ("depth", I), ("discovered_from_url", S))

LINKS = _st(("src_url", S), ("pos", L), ("href", S), ("dst_url", S))

ROBOTS = _st(("host", S), ("text", S))

LETTER_INDEX = _st(("term", S), ("url", S), ("origin_url", S), ("depth", L), ("frequency", L))

# URL states and job states (fixed values of the reference)
URL_STATES = ("queued", "processing", "processed", "failed", "skipped")
JOB_STATES = ("queued", "running", "paused", "completed", "failed")
