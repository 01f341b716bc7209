"""Helpers shared by the operators."""
from __future__ import annotations

from zlib import crc32

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from trawl.session import materialize

# Words of a text: maximal runs of characters other than these six. On UTF-8
# bytes, bytes.split(), bytes.strip() and bytes.lower() use just these
# characters and the letters A-Z.
WORD_RE = r"[^\x20\x09-\x0D]+"

# Share of the rows kept from training: crc32(doc_id as text) mod HOLD_OUT = 0.
HOLD_OUT = 5


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def batch_of(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t)
                                       for c, (_, t) in zip(columns, schema, strict=True)],
                                      names=[n for n, _ in schema])


def slices(texts: list[bytes | None], limit: int = 4 << 20):
    """(start, end) of runs of rows that hold about `limit` bytes, one row at
    least, so that what is made of a run stays small beside very long texts."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"") + 64
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def byte_slices(column: pa.Array, limit: int = 1 << 20):
    """(start, end, texts) of runs of rows of a string column that hold about `limit`
    bytes, one row at least. Only one run at a time is turned into Python bytes."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(sizes.tolist()):
        size += n + 64
        if size >= limit or i == len(sizes) - 1:
            yield start, i + 1, as_bytes(column.slice(start, i + 1 - start))
            start, size = i + 1, 0


def with_text(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """`columns` of the documents and the place of the text among them: its own, where
    it is a string column of `columns`, so that no text is sent to Python twice."""
    cols = [F.col(f"`{c}`") for c in columns]
    if "text" in columns and isinstance(docs.schema["text"].dataType, StringType):
        return docs.select(*cols), columns.index("text")
    return docs.select(*cols, F.col("text").cast("string").alias("__text")), len(columns)


def held_out(doc_id: Column) -> Column:
    """True for the rows that training must not see."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HOLD_OUT == 0


def held_out_py(doc_id) -> bool:
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % HOLD_OUT == 0


def token_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


class Shared:
    """A value sent once to each executor. It is pickled by value, so executors need
    no copy of this package. Each task unpickles its own, which goes with the task;
    with `keep`, a worker process unpickles it once and what its tables learn in one
    task stays for the next, as long as the process lives."""

    def __init__(self, spark, value, keep: bool = False):
        self._sent, self._keep = spark.sparkContext.broadcast(cloudpickle.dumps(value)), keep

    @property
    def value(self):
        if not self._keep:
            return cloudpickle.loads(self._sent.value)
        # In a worker the broadcast is one object for all tasks of the process.
        if not hasattr(self._sent, "loaded"):
            self._sent.loaded = cloudpickle.loads(self._sent.value)
        return self._sent.loaded


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared checkpoint folder and read back."""
    return materialize(df, f"llm-{name}")
