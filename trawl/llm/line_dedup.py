"""Line dedup with two Bloom filters.

First pass: every task puts its documents' line keys into a once-seen filter
and, when a key is there already, into a twice-seen filter; the tasks' filters
are merged piece by piece. Second pass: only lines that the twice-seen filter
suspects are shuffled, as 16-byte digests, to confirm in how many documents they
are and which one holds them last. Filters only save shuffling: a full filter
makes more suspects, never another result.
"""
from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import as_bytes, batch_of, stored

MIN_CHARS = 20
MIN_DOCS = 3
BITS = 27               # a filter has 2^BITS bits: 16 MB, whatever the input
PIECE_BITS = 20         # filters are merged in pieces of 2^PIECE_BITS bits
_SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Digest of a line's key, None for keys of fewer than `min_chars` code points."""
    key = line.strip(_SPACE)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()


def line_keys(text: bytes | None, min_chars: int = MIN_CHARS) -> set[bytes]:
    found = {line_key(x, min_chars) for x in (text or b"").split(b"\n")}
    found.discard(None)
    return found


def positions(digests: list[bytes], bits: int = BITS) -> np.ndarray:
    """Two filter positions of each digest."""
    halves = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return (halves >> np.uint64(64 - bits)).astype(np.int64)


def get_bits(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool).all(axis=1)


def set_bits(filter_: np.ndarray, at: np.ndarray) -> None:
    flat = at.ravel()
    np.bitwise_or.at(filter_, flat >> 3, np.left_shift(np.uint8(1), (flat & 7).astype(np.uint8)))


def build_filters(docs: DataFrame, bits: int = BITS, min_chars: int = MIN_CHARS) -> bytes:
    """The merged twice-seen filter, 2^bits bits."""
    piece = 1 << (min(PIECE_BITS, bits) - 3)

    def local(batches):
        once, twice = np.zeros(1 << (bits - 3), np.uint8), np.zeros(1 << (bits - 3), np.uint8)
        for b in batches:
            keys = [k for t in as_bytes(b.column(0)) for k in line_keys(t, min_chars)]
            if not keys:
                continue
            counts = Counter(keys)
            at = positions(list(counts), bits)
            again = np.fromiter(counts.values(), np.int64, len(counts)) > 1
            set_bits(twice, at[again | get_bits(once, at)])
            set_bits(once, at)
        for p in range(len(once) // piece):
            o, t = once[p * piece:(p + 1) * piece], twice[p * piece:(p + 1) * piece]
            if o.any():
                yield pa.RecordBatch.from_pylist([{"piece": p, "once": zlib.compress(o.tobytes(), 1),
                                                   "twice": zlib.compress(t.tobytes(), 1)}])

    def merge(batches):
        # The pieces of a partition stream by; what is held is one pair of arrays for each piece number.
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for r in b.to_pylist():
                o, t = (np.frombuffer(zlib.decompress(r[k]), np.uint8) for k in ("once", "twice"))
                if r["piece"] not in held:
                    held[r["piece"]] = (o.copy(), t.copy())
                else:
                    once, twice = held[r["piece"]]
                    twice |= t | (once & o)
                    once |= o
        for p, (_, twice) in held.items():
            if twice.any():
                yield pa.RecordBatch.from_pylist([{"piece": p, "twice": zlib.compress(twice.tobytes(), 1)}])

    parts = docs.select(F.col("text").cast("string")).mapInArrow(local, "piece long, once binary, twice binary")
    merged = parts.repartition("piece").mapInArrow(merge, "piece long, twice binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in merged.toLocalIterator():   # 2^bits bits in all, by the parameter
        out[r["piece"] * piece:(r["piece"] + 1) * piece] = np.frombuffer(zlib.decompress(bytes(r["twice"])), np.uint8)
    return out.tobytes()


def repeated_lines(docs: DataFrame, bits: int = BITS, min_chars: int = MIN_CHARS,
                   min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, drops): the digests of the lines that each document loses."""
    twice = docs.sparkSession.sparkContext.broadcast(build_filters(docs, bits, min_chars))

    def suspects(batches):
        schema = [("doc_id", pa.int64()), ("digest", pa.binary())]
        for b in batches:
            filter_ = np.frombuffer(twice.value, np.uint8)
            ids, keys = [], []
            for i, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
                found = list(line_keys(t, min_chars))
                ids += [i] * len(found)
                keys += found
            if keys:
                hit = np.flatnonzero(get_bits(filter_, positions(keys, bits))).tolist()
                yield batch_of(schema, [ids[k] for k in hit], [keys[k] for k in hit])

    cols = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    seen = stored(cols.mapInArrow(suspects, "doc_id long, digest binary"), "line-suspects")
    # Stored, so that the join deals both sides anew and Spark can split a line that many documents hold.
    confirmed = stored(seen.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
                       .where(F.col("n") >= min_docs).select(F.col("digest").alias("d"), "last"), "line-confirmed")
    drops = (seen.join(confirmed, F.col("digest") == F.col("d"))
             .where(~F.col("doc_id").eqNullSafe(F.col("last"))))
    return drops.groupBy("doc_id").agg(F.collect_set("digest").alias("drops"))


def drop_lines(text: bytes | None, drops, min_chars: int = MIN_CHARS) -> tuple[bytes, int, int]:
    """The text that stays, the lines before, the lines dropped."""
    lines = (text or b"").split(b"\n")
    if not drops:
        return text or b"", len(lines), 0
    drops = set(map(bytes, drops))
    stay = [x for x in lines if line_key(x, min_chars) not in drops]
    return b"\n".join(stay), len(lines), len(lines) - len(stay)


def dedup_lines(docs: DataFrame, bits: int = BITS, min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of the documents, with the lines left in text, and __n_lines
    and __n_dropped.

    A document is a row. Null and empty texts are one empty line; a null text
    comes back null. A line in rows that all have a null id has no largest id and
    is not dropped from them; beside other ids, null is the smallest. Rows that
    share the largest id all keep the line. No rows give no rows."""
    drops = repeated_lines(docs, bits, min_chars, min_docs).withColumnRenamed("doc_id", "__id")
    t = docs.join(drops, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left").drop("__id")
    names = docs.columns
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    at, was = names.index("text"), len(names)

    def run(batches):
        for b in batches:
            done = [drop_lines(x, d, min_chars) for x, d in zip(as_bytes(b.column(at)), b.column(was).to_pylist())]
            none = b.column(at).is_null().to_pylist()
            texts = pa.array([None if z else x for (x, _, _), z in zip(done, none)], pa.binary()).cast(pa.string())
            cols = [texts if k == at else b.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())],
                names=names + ["__n_lines", "__n_dropped"])

    return t.select(*names, "drops").mapInArrow(run, out + ", __n_lines long, __n_dropped long")


def line_report(docs: DataFrame, **params) -> DataFrame:
    """One row per row of documents: doc_id, n_lines, n_dropped, kept_sha256."""
    t = dedup_lines(docs.select("doc_id", "text"), **params)
    return t.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                    F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
