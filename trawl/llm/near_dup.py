"""MinHash near-dedup with sequential Bayesian verification.

A document's set is its distinct word 5-shingles. Documents with equal sets are
one class; a class is signed with MinHash and banded. Candidate pairs of classes
compare their signatures batch by batch and are pruned once the posterior
probability that they reach the threshold is under `miss`; survivors are
verified on the full sets. Links become components.

Buckets never emit all their pairs. First each bucket pairs its members with one
centre, which joins nearly all copies. Members of buckets that still hold several
components then meet in blocks inside tasks, which verify what survives pruning,
nearest pairs first, and emit only the links that join components.
"""
from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from trawl.llm.common import as_bytes, batch_of, byte_slices, stored, with_text

SHINGLE = 5
BLOCK = 256         # members of a bucket compared at once inside a task; larger buckets try another centre first
FILTER_BITS = 24    # of the filter that spares texts the shuffle; 2 MB, whatever the input


@dataclass(frozen=True)
class Params:
    """Links reach `percent` (100 * intersection >= percent * union). `rows` of a
    band; the number of bands follows from `miss`, the chance to miss a pair just
    at the threshold in banding, and again in pruning."""
    percent: int = 85
    rows: int = 5
    miss: float = 1e-6
    batch: int = 20

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; the whole sequence
    as one with fewer words; none without words."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - SHINGLE + 1)
    # A hash of each word, then a hash of each window of word hashes.
    ids = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = (h ^ ids[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240607)
    return (draw.integers(1, 1 << 63, count, np.uint64) | np.uint64(1),
            draw.integers(0, 1 << 63, count, np.uint64))


def signature(hashes: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the least permuted hash, for each permutation."""
    least = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 4096):   # bounded memory for very long texts
        part = hashes[i:i + 4096, None] * mul[None, :] + add[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def enough(p: Params) -> list[tuple[int, int]]:
    """(hashes compared, least matches to go on) after each batch: with fewer
    matches the posterior probability of a similarity at the threshold or above,
    from a uniform prior, is under `miss`."""
    grid = (np.arange(20000) + 0.5) / 20000
    above = grid >= p.percent / 100
    out = []
    for n in range(p.batch, p.hashes + p.batch, p.batch):
        n = min(n, p.hashes)
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            like = np.exp(log - log.max())
            if like[above].sum() / like.sum() >= p.miss:
                out.append((n, m))
                break
    return out


def survivors(a: np.ndarray, b: np.ndarray, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs of signature rows are not pruned, and their matches."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, least in bounds:
        matches[alive] += (a[alive, done:n] == b[alive, done:n]).sum(axis=1)
        alive, done = alive[matches[alive] >= least], n
    return alive, matches[alive]


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def set_digest(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def sign(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, n_shingles, fp (digest of the set; null if empty) and sig of every whole text."""
    mul, add = permutations(p.hashes)
    schema = [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.binary()), ("sig", pa.binary())]

    def run(batches):
        for b in batches:
            rows = [(len(s), set_digest(s), signature(s, mul, add).tobytes() if len(s) else None)
                    for s in map(shingles, as_bytes(b.column(1)))]
            yield batch_of(schema, b.column(0), *([r[k] for r in rows] for k in range(3)))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, fp binary, sig binary")


def filter_of(classes: DataFrame) -> np.ndarray:
    """A bit for each FILTER_BITS-bit prefix of the classes' fp: 2^FILTER_BITS bits
    at most. A full filter lets more texts pass, never fewer."""
    at = F.shiftright(F.conv(F.hex(F.substring("fp", 1, 4)), 16, 10).cast("long"), 32 - FILTER_BITS)
    words = (classes.select(at.alias("at")).groupBy(F.shiftright("at", 5).alias("w"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 32).cast("int"))).alias("bits")).toPandas())
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[words["w"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def texts_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(fp, text): one whole text of each class in `classes` (fp)."""
    schema, bits = [("fp", pa.binary()), ("text", pa.string())], filter_of(classes)

    def passes(fp: bytes) -> bool:
        at = int.from_bytes(fp[:4], "big") >> (32 - FILTER_BITS)
        return bool(bits[at >> 5] >> (at & 31) & 1)

    def run(batches):
        seen: set[bytes | None] = {None}   # copies go before the shuffle; 16 bytes for each row of the task
        for b in batches:
            fps = [set_digest(shingles(t)) for t in as_bytes(b.column(0))]
            new = [i for i, f in enumerate(fps) if f not in seen and not seen.add(f) and passes(f)]
            yield batch_of(schema, [fps[i] for i in new], b.column(0).take(pa.array(new, pa.int64())))

    named = docs.select(F.col("text").cast("string")).mapInArrow(run, "fp binary, text string")
    return named.join(classes, "fp", "left_semi").groupBy("fp").agg(F.first("text").alias("text"))


def band_keys(signed: DataFrame, p: Params) -> DataFrame:
    """(key, band, fp): each class in each of its bands; the key is a digest of band and rows."""
    width = 4 * p.rows
    return signed.select("fp", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(p.bands - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("sig"), k * width + 1, F.lit(width)))))).select(
        F.col("col").alias("key"), F.col("pos").alias("band"), "fp")


def _sides(pairs: DataFrame, classes: DataFrame, what: str) -> DataFrame:
    """(a, b, x, y): `what` of both sides. A class in many pairs is a hot key,
    which Spark splits (adaptive skew join)."""
    right = classes.select(F.col("fp").alias("b"), F.col(what).alias("y"))
    left = classes.select(F.col("fp").alias("a"), F.col(what).alias("x"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")


_PAIR = [("a", pa.binary()), ("b", pa.binary())]


def prune(pairs: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """The pairs that survive the comparison of signature batches."""
    bounds = enough(p)

    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint32).reshape(b.num_rows, -1) for k in (2, 3))
                keep = pa.array(survivors(x, y, bounds)[0])
                yield batch_of(_PAIR, b.column(0).take(keep), b.column(1).take(keep))

    return _sides(pairs, classes, "sig").mapInArrow(run, "a binary, b binary")


def verify(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """The pairs whose full sets are linked."""
    def run(batches):
        memo: dict[bytes, np.ndarray] = {}   # the last centres: the join leaves pairs sorted by a

        def of(fp, text):
            if fp not in memo:
                if len(memo) > 8:
                    memo.clear()
                memo[fp] = shingles(text)
            return memo[fp]

        for b in batches:
            ok = [linked(of(a, x), shingles(y), p.percent)
                  for a, x, y in zip(b.column(0).to_pylist(), as_bytes(b.column(2)), as_bytes(b.column(3)))]
            keep = pa.array(np.flatnonzero(ok))
            yield batch_of(_PAIR, b.column(0).take(keep), b.column(1).take(keep))

    return _sides(pairs, texts, "text").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(fp, comp): the smallest fp reachable over links (a, b), for classes with a link.

    `known` is the result for earlier links, which it stands for: each of its
    classes is an edge to its component. Alternates hooking larger neighbours to
    the smallest one in reach and pointing it there too, until every component is
    a star around its smallest class; each round is two grouped minima over narrow
    rows, combined on the map side, and one stored table."""
    def both_ways(edges: DataFrame) -> DataFrame:
        return edges.union(edges.select("v", "u"))

    def stars(edges: DataFrame) -> bool:
        """Does every class with a smaller neighbour have that neighbour alone?"""
        return (both_ways(edges).groupBy("u").agg(F.count_if(F.col("v") < F.col("u")).alias("smaller"), F.count("*").alias("n"))
                .where("smaller > 0 AND n > 1").isEmpty())

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if known is not None:
        edges = edges.union(known.where("fp != comp").select("fp", "comp"))
    edges = stored(edges.distinct(), "near-edges")
    while not stars(edges):
        # Large star: larger neighbours of u go to the least of u and its neighbours.
        sides = both_ways(edges)
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (sides.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        # Small star: u and its smaller neighbours go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        edges = stored(small, "near-edges")
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("comp")).union(
        edges.select(F.col("v").alias("fp"), F.col("v").alias("comp")).distinct())


def mixed_buckets(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    """(key, band, fp, comp, n, top, rest) of the buckets of three or more members
    that hold several components: n members, `rest` of them outside the largest
    component, top. In a bucket of two the only pair has been compared."""
    t = members.select("key", "band", "fp")
    if comps is not None:
        t = t.join(comps, "fp", "left").select("key", "band", "fp", F.coalesce("comp", "fp").alias("comp"))
    else:
        t = t.withColumn("comp", F.col("fp"))
    several = (t.groupBy("key", "comp").agg(F.count("*").alias("k"))
               .groupBy("key").agg(F.sum("k").alias("n"), F.count("*").alias("parts"), F.max(F.struct("k", "comp")).alias("m"))
               .where("n > 2 AND parts > 1").select("key", "n", F.col("m.comp").alias("top"), (F.col("n") - F.col("m.k")).alias("rest")))
    return t.join(stored(several, "near-several"), "key")


def star_pairs(members: DataFrame, turn: int) -> DataFrame:
    """(key, fp, comp) -> each member of a bucket with the bucket's centre, if they
    are in different components. The centre is the member of the least hash in
    that turn, a grouped minimum; there is at most one pair for each row."""
    first = F.min(F.struct(F.xxhash64("fp", F.lit(turn)).alias("o"), F.col("fp").alias("c"), F.col("comp").alias("cc")))
    # Stored, so that the join deals both sides anew and Spark can split a large bucket.
    centre = stored(members.groupBy("key").agg(first.alias("m"))
                    .select("key", F.col("m.c").alias("c"), F.col("m.cc").alias("cc")), "near-centres")
    return (members.join(centre, "key").where("comp != cc")
            .select(F.least("fp", "c").alias("a"), F.greatest("fp", "c").alias("b")).distinct())


def cross_links(members: DataFrame, classes: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """Links between different components of one bucket, enough to join them: every
    pair that survives pruning is verified unless links found before join its
    components already. Members outside the bucket's largest component meet all
    members, block by block; a pair is compared in the first band it shares."""
    bounds = enough(p)
    t = (members.join(classes.select("fp", "sig"), "fp").join(texts, "fp")
         .select("key", "band", "n", "rest", "top", F.struct("fp", "comp", "sig", "text", (F.col("comp") == F.col("top")).alias("in_top")).alias("m")))

    def blocks(rows: DataFrame, n: str, name: str) -> DataFrame:
        no = F.pmod(F.xxhash64("m.fp"), F.ceil(F.col(n) / BLOCK).cast("long"))
        return rows.groupBy("key", "band", no.alias("no")).agg(F.collect_list("m").alias(name)).drop("no")

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                band, x, y = (b.column(k)[r].as_py() for k in range(3))
                yield batch_of(_PAIR, *zip(*found)) if (found := list(_block_links(band, x, y, bounds, p))) else batch_of(_PAIR, [], [])

    every, rest = blocks(t, "n", "x"), blocks(t.where("NOT m.in_top"), "rest", "y")
    pairs = every.join(rest.select(F.col("key").alias("k"), "y"), F.col("key") == F.col("k")).select("band", "x", "y")
    return pairs.mapInArrow(run, "a binary, b binary").distinct()


def _block_links(band: int, x: list[dict], y: list[dict], bounds: list[tuple[int, int]], p: Params):
    """(fp, fp) of the links that join components of the members x and y."""
    numbers: dict[bytes, int] = {}
    cx, cy = (np.array([numbers.setdefault(m["comp"], len(numbers)) for m in z]) for z in (x, y))
    order = {f: k for k, f in enumerate(sorted({m["fp"] for m in x + y}))}
    ox, oy = (np.array([order[m["fp"]] for m in z]) for z in (x, y))
    top = np.array([m["in_top"] for m in x])
    sx, sy = (np.frombuffer(b"".join(m["sig"] for m in z), np.uint32).reshape(len(z), -1) for z in (x, y))
    # Two members outside the largest component meet twice; once will do.
    i, j = np.nonzero((cx[:, None] != cy[None, :]) & (top[:, None] | (ox[:, None] < oy[None, :])))
    live, _ = survivors(sx[i], sy[j], bounds[:1])
    i, j = i[live], j[live]
    live, matches = survivors(sx[i], sy[j], bounds)
    i, j = i[live], j[live]
    if band and len(i):
        before = (sx[i, :band * p.rows] == sy[j, :band * p.rows]).reshape(len(i), band, p.rows).all(axis=2).any(axis=1)
        i, j, matches = i[~before], j[~before], matches[~before]
    root = list(range(len(numbers)))

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    sets: dict[bytes, np.ndarray] = {}

    def of(m: dict) -> np.ndarray:
        if m["fp"] not in sets:
            sets[m["fp"]] = shingles(m["text"].encode("utf-8", "replace"))
        return sets[m["fp"]]

    for k in np.argsort(-matches, kind="stable").tolist():
        u, v = find(int(cx[i[k]])), find(int(cy[j[k]]))
        if u != v and linked(of(x[i[k]]), of(y[j[k]]), p.percent):
            root[u] = v
            yield x[i[k]]["fp"], y[j[k]]["fp"]


def class_components(docs: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """(fp, comp) of the classes that are linked with another class."""
    every = band_keys(classes, p)
    # Most classes are alone in all their buckets and go here.
    shared = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = stored(every.join(shared, "key", "left_semi"), "near-bands")
    texts = comps = None

    def with_texts(fps: DataFrame) -> DataFrame:
        nonlocal texts
        wanted = stored(fps.distinct() if texts is None else fps.distinct().join(texts, "fp", "left_anti"), "near-wanted")
        if texts is None or not wanted.isEmpty():
            more = stored(texts_of(docs, wanted), "near-texts")
            texts = more if texts is None else texts.union(more)
        return texts

    def learn(found: DataFrame) -> None:
        nonlocal comps
        if not (found := stored(found, "near-links")).isEmpty():
            comps = components(found, comps)

    def stars(rows: DataFrame, turn: int) -> None:
        found = stored(prune(star_pairs(rows, turn), classes, p), "near-survivors")
        if not found.isEmpty():
            learn(verify(found, with_texts(found.select(F.col("a").alias("fp")).union(found.select("b"))), p))

    stars(members.withColumn("comp", F.col("fp")), 0)
    mixed = stored(mixed_buckets(members, comps), "near-mixed")
    large = mixed.where(F.col("rest") > BLOCK)
    if not large.isEmpty():
        stars(large, 1)
        mixed = stored(mixed_buckets(members, comps), "near-mixed")
    if not mixed.isEmpty():
        learn(cross_links(mixed, classes, with_texts(mixed.select("fp")), p))
    return comps if comps is not None else classes.select("fp", F.col("fp").alias("comp")).limit(0)


def document_components(docs: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, fp) of every row and (fp, comp, component_id) of every class."""
    rows = stored(sign(docs, p), "near-rows")
    classes = stored(rows.where("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least"),
                                                                     F.first("sig").alias("sig")), "near-classes")
    comps = class_components(docs, classes.select("fp", "sig"), p)
    known = classes.select("fp", "least").join(comps, "fp", "left").select("fp", F.coalesce("comp", "fp").alias("comp"), "least")
    ids = known.groupBy("comp").agg(F.min("least").alias("component_id"))
    return rows.drop("sig"), known.join(ids, "comp").select("fp", "comp", "component_id")


def near_duplicates(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """One row per row of documents: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable over links; kept where it is
    the document's own.

    Null and empty texts, and texts without words, have no shingles, are linked
    with nothing and kept. Rows without an id take part, never give a component
    its id, and are kept only where no row of the component has one. Repeated rows
    share a class, and so the component; all rows with its id are kept. No rows
    give no rows; other columns are ignored."""
    rows, known = document_components(docs, params or Params())
    known = known.select(F.col("fp").alias("f"), "component_id")
    out = rows.join(known, F.col("fp") == F.col("f"), "left")
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def with_fp(docs: DataFrame) -> DataFrame:
    """All columns of the documents, and __fp."""
    names = docs.columns
    sent, at = with_text(docs, names)

    def run(batches):
        for b in batches:
            for i, j, texts in byte_slices(b.column(at)):
                fps = pa.array([set_digest(shingles(t)) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in range(len(names))), fps],
                                                 names=[*names, "__fp"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return sent.mapInArrow(run, out + ", __fp binary")


def drop_near_duplicates(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """One row of each component, one that has its smallest doc_id (its least set
    digest, if several do), and all rows without words, with all their columns."""
    p = params or Params()
    rows, known = document_components(docs, p)
    first = stored(rows.join(known, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                   .groupBy("comp", "doc_id", "fp").agg(F.count("*").alias("n"))
                   .groupBy("comp").agg(F.min(F.struct("fp", "doc_id", "n")).alias("m"))
                   .select(F.col("m.fp").alias("__f"), F.col("m.doc_id").alias("__id"), F.col("m.n").alias("__n")),
                   "near-first")
    t = with_fp(docs).join(first, (F.col("__fp") == F.col("__f"))
                           & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left")
    out = t.where("__fp IS NULL OR __n = 1").select(*docs.columns)
    if not first.where("__n > 1").isEmpty():   # repeated rows: any one of them
        out = out.union(t.where("__n > 1").dropDuplicates(["__fp"]).select(*docs.columns))
    return out
