"""Small shared helpers for the operators."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.session import cut_lineage

# Bounds for a side that may be broadcast. Every broadcast in the library
# goes through `fits_broadcast`, which counts rows and bytes first.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 16


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of `df`, both counted in one aggregate: 8 bytes for a
    fixed-width value, the length in UTF-8 for any other."""
    size = F.lit(ROW_OVERHEAD).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            size = size + F.lit(8)
        else:
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return row["n"], row["b"] or 0


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[bool, int]:
    """Whether rows and bytes of `df` are under both bounds, and the rows."""
    n, size = measured(df)
    return n <= max_rows and size <= max_bytes, n


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES,
                       materialize: bool = True) -> tuple[DataFrame, int]:
    """Checkpoint `df`, measure it, and hint a broadcast only when both the row
    count and the measured bytes are under their bounds.

    Above the bounds the frame is returned unhinted and the join falls back to
    a shuffle join (AQE may still pick a broadcast from runtime sizes)."""
    if materialize:
        df = cut_lineage(df)
    small, n = fits_broadcast(df, max_rows, max_bytes)
    return (F.broadcast(df) if small else df), n
