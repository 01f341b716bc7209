"""Secret scans: base patterns, and zstandard novelty against a dictionary.

An identifier dictionary of the corpus primes a zstandard compressor. A long
token in a sensitive context is measured by the bytes it adds to the compressed
text around it; one that is hardly compressed, beside the text around it and all
frequent identifiers, is reported.
"""
from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import as_bytes, batch_of
from trawl.operators._util import broadcast_if_small

# Fixed patterns: kind, pattern, the group that must be long enough, its least length.
BASE = [
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                          re.IGNORECASE | re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # The same as runs of any length of which short ones are dropped.
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
]
ORDER = ["assign", "access", "hex", "novel"]

LEAST = 16              # characters of a candidate
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}")
_PART = re.compile("[=/+]+")
SENSITIVE = re.compile(r"pass|pwd|secret|token|key|auth|cred|bearer|private|signature|AKIA", re.IGNORECASE)
CONTEXT = 48            # characters before a candidate that are searched for a sensitive word
AROUND = 512            # characters on either side that it is compressed with
MIN_NOVELTY = 0.75      # added compressed bytes per byte
IDENTIFIER = re.compile(rb"[A-Za-z_][A-Za-z0-9_]{5,}")
_RUN = re.compile(CANDIDATE.pattern.encode())
_LETTER, _DIGIT = re.compile(rb"[A-Za-z]"), re.compile(rb"[0-9]")
_PLAIN = re.compile(rb"_*(?:[A-Z]?[a-z]+|[A-Z]+)(?:_+(?:[A-Z]?[a-z]+|[A-Z]+))*_*")
DICTIONARY_BYTES = 32 << 10
DICTIONARY_TERMS = DICTIONARY_BYTES // 7
SHARES = 1 << 32        # parts of a text that its copies divide among them
_FLUSH = 100_000


def looks_secret(run: bytes) -> bool:
    """Whether a run has what a novel candidate needs: letters and digits."""
    return bool(_LETTER.search(run) and _DIGIT.search(run))


def identifiers(text: bytes) -> set[bytes]:
    """The identifiers of a text. Of a run that looks like a candidate only plain words
    count, so that no copied secret, nor a part of it, gets into the dictionary."""
    out, at = set(), 0
    for m in _RUN.finditer(text):
        if looks_secret(m.group()):
            out.update(IDENTIFIER.findall(text, at, m.start()))
            out.update(w for w in IDENTIFIER.findall(m.group()) if _PLAIN.fullmatch(w))
            at = m.end()
    out.update(IDENTIFIER.findall(text, at))
    return out


def identifier_dictionary(docs: DataFrame) -> bytes:
    """The identifiers that occur in the most distinct texts, the most frequent last,
    in DICTIONARY_BYTES at most. Counted in tasks first, then by Spark.

    Each of n equal texts counts as 1/n, in whole parts of SHARES: the sum over all
    rows is less than half a text away from the number of distinct ones."""
    schema = [("term", pa.binary()), ("n", pa.int64())]

    def run(batches):
        counts: Counter = Counter()
        for b in batches:
            for t, n in zip(as_bytes(b.column(0)), b.column(1).to_pylist()):
                share = SHARES // n
                for w in identifiers(t or b""):
                    counts[w] += share
                if len(counts) > _FLUSH:
                    yield batch_of(schema, list(counts), list(counts.values()))
                    counts.clear()
        yield batch_of(schema, list(counts), list(counts.values()))

    texts = docs.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    copies, _ = broadcast_if_small(texts.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    terms = (texts.join(copies, "h", "left").select("text", F.coalesce("n", F.lit(1).cast("long")).alias("n"))
             .mapInArrow(run, "term binary, n long"))
    top = (terms.groupBy("term").agg(F.round(F.sum("n") / SHARES).cast("long").alias("n")).where("n > 1")
           .orderBy(F.desc("n"), "term").limit(DICTIONARY_TERMS).collect())
    out: list[bytes] = []
    room = DICTIONARY_BYTES
    for r in top:
        if (room := room - len(r["term"]) - 1) < 0:
            break
        out.append(bytes(r["term"]))
    return b" ".join(reversed(out))


class Novelty:
    """Added compressed bytes per byte of a candidate in its surroundings."""

    def __init__(self, dictionary: bytes):
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
        self.compress = zstandard.ZstdCompressor(level=9, dict_data=primed, write_checksum=False, write_content_size=False,
                                                 write_dict_id=False).compress

    def __call__(self, before: str, candidate: str, after: str) -> float:
        own = candidate.encode("utf-8", "replace")
        rest = [x.encode("utf-8", "replace") for x in (before, after)]
        return (len(self.compress(rest[0] + own + rest[1])) - len(self.compress(b"".join(rest)))) / len(own)


def surroundings(text: str, i: int, j: int) -> tuple[str, str]:
    """AROUND characters on either side of a candidate, less what repeats it or a long
    part of it, also where the end of the window cuts that: a secret written twice is
    as new as one written once."""
    token = text[i:j]
    parts = {p for p in (token, *token.split("="), *_PART.split(token)) if len(p) >= LEAST}
    again = re.compile("|".join(map(re.escape, sorted(parts, key=lambda p: (-len(p), p)))))
    sides = []
    for lo, hi in ((max(0, i - AROUND), i), (j, min(len(text), j + AROUND))):
        kept, at = [], lo
        for m in again.finditer(text, lo if lo == j else max(0, lo - (j - i)), hi if hi == i else hi + (j - i)):
            kept.append(text[at:min(m.start(), hi)])
            at = max(at, m.end())
        sides.append("".join([*kept, text[at:hi]]))
    return sides[0], sides[1]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), kind) for kind, pattern, group, least in BASE
            for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]


def novel_spans(text: str, base: list[tuple[int, int, str]], novelty) -> list[tuple[int, int, str]]:
    """Candidates outside the base spans, with letters and digits, after a sensitive word."""
    out = []
    for m in CANDIDATE.finditer(text):
        token = m.group()
        if not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)):
            continue
        i, j = m.span()
        if any(i < e and s < j for s, e, _ in base) or not SENSITIVE.search(text, max(0, i - CONTEXT), i):
            continue
        before, after = surroundings(text, i, j)
        if novelty(before, token, after) >= MIN_NOVELTY:
            out.append((i, j, "novel"))
    return out


def join_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], ORDER.index(x[2]), x[1])))


def find_secrets(docs: DataFrame, dictionary: bytes | None = None) -> DataFrame:
    """One row per row of documents: doc_id, n_assign, n_access, n_hex, n_novel,
    base_sha256, spans. Spans are kind:start:end in code points of the whole text.

    Null and empty texts have no spans; a null doc_id stays null; repeated rows
    each have their row. No rows give no rows; other columns are ignored."""
    primed = identifier_dictionary(docs) if dictionary is None else dictionary
    kinds = [k for k, *_ in BASE]
    schema = [("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in ORDER], ("base_sha256", pa.string()), ("spans", pa.string())]

    def run(batches):
        novelty = Novelty(primed)
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                base = base_spans(t or "")
                novel = novel_spans(t or "", base, novelty)
                rows.append((*[sum(x[2] == k for x in base) for k in kinds], len(novel),
                             hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(base + novel)))
            yield batch_of(schema, b.column(0), *([r[k] for r in rows] for k in range(6)))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")
