"""Merkle manifest of a dataset by bitmap ranks.

Each row is a leaf; a group's leaves ascend by id. Nothing sorts them: the ids of a
group become a bitmap of 64-bit words, of which only words with an id are kept, and
a directory over the words says how many leaves come before each. A leaf's place is
that count plus the popcount of its word below its own bit. Directories have
several levels, so that no window sees more than a fixed number of entries.

Runs of `FANOUT` places are then reduced, level by level: the nodes of a run meet
by key in an array with a slot for each. The groups' roots are the leaves of one
more such tree. On the way down each run hands its children the siblings around
them, so that every leaf ends with its path to the root.

Ids that repeat make words that hold more leaves than bits. Only the leaves of
such words take a second step, the same ranks over the first 60 bits of their
digests; rows equal in everything are counted once and dealt their places last.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import stored

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Bits of a word's number by which a directory level is coarser than the one below: windows see
# 2^8, 2^14 and 2^18 entries at most, and the last, over 2^18 numbers of 18 bits, as many.
STEPS = (8, 14, 18)
COPIES = 4096            # equal rows that are dealt their places by one row of a task

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = -(1 << 57) - 1  # the word of rows without an id: below all others


def digest(values: list[Column]) -> Column:
    """Hex sha256 of the values: `-` for null, else byte count, `:` and the value."""
    sized = [F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")) for v in values]
    return F.sha2(F.concat(*[F.coalesce(v, F.lit("-")) for v in sized]).cast("binary"), 256)


def _below(df: DataFrame, by: list[str], order: str, n: str) -> Column:
    """Sum of `n` over the rows before, in the same `by`."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(w), F.lit(0))


def directory(words: DataFrame, by: list[str], word: str) -> DataFrame:
    """`words` (by, word, n) with __before, the sum of n over the smaller words of the
    same `by`, and __size, the sum over all of them."""
    levels, key = [words], word
    for k, step in enumerate(STEPS):
        levels[-1] = levels[-1].withColumn(f"__k{k}", F.shiftright(key, step))
        levels.append(levels[-1].groupBy(*by, f"__k{k}").agg(F.sum("n").alias("n")))
        key = f"__k{k}"
    top = levels.pop()
    known = top.select(*by, key, _below(top, by, key, "n").alias("__before"),
                       F.sum("n").over(Window.partitionBy(*by)).alias("__size"))
    for k in reversed(range(len(levels))):
        own = levels[k].withColumn("__own", _below(levels[k], [*by, f"__k{k}"], word if k == 0 else f"__k{k - 1}", "n"))
        known = (own.join(known, [*by, f"__k{k}"]).withColumn("__before", F.col("__before") + F.col("__own"))
                 .drop("__own", f"__k{k}", *(["n"] if k else [])))
    return known


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.cast("int"))


def coordinates(leaves: DataFrame) -> DataFrame:
    """`leaves` (g, id, node, other) with pos, the place in the group, and size, the
    number of the group's leaves. Ties by node; rows without an id come first."""
    t = leaves.withColumns({"__w": F.coalesce(F.shiftright("id", 6), F.lit(_NO_ID)),
                            "__b": F.coalesce(F.col("id").bitwiseAND(63), F.lit(0)).cast("int")})
    words = t.groupBy("g", "__w").agg(F.bit_or(_bit(F.col("__b"))).alias("__bits"), F.count("*").alias("n"))
    known = stored(directory(stored(words, "merkle-words"), ["g"], "__w"), "merkle-directory")
    t = t.join(known, ["g", "__w"])
    below = F.bit_count(F.col("__bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("__b")))))
    single = F.col("n") == F.bit_count("__bits")
    out = ["g", "id", "node", "other", "pos", F.col("__size").alias("size")]
    placed = t.where(single).withColumn("pos", F.col("__before") + below).select(*out)
    if known.where(~single).isEmpty():
        return placed
    return placed.union(_repeated(t.where(~single)).select(*out))


def _repeated(t: DataFrame) -> DataFrame:
    """The rows of words with repeated ids, with pos."""
    one, by = ["g", "__w", "__b"], ["g", "__w", "__b", "__h"]
    rows = stored(t.groupBy("g", "__w", "__b", "node").agg(F.count("*").alias("n"), F.first("id").alias("id"), F.first("other").alias("other"),
                                                           F.first("__before").alias("__at"), F.first("__size").alias("__all"))
                  .withColumn("__h", F.shiftright(F.conv(F.substring("node", 1, 15), 16, 10).cast("long"), 6)), "merkle-repeated")
    # Leaves of smaller ids in the same word (64 ids at most), of smaller digests of the same id, of the same digest word.
    ids = rows.groupBy(*one).agg(F.sum("n").alias("n"))
    ids = ids.select(*one, _below(ids, ["g", "__w"], "__b", "n").alias("__ids"))
    known = directory(stored(rows.groupBy(*by).agg(F.sum("n").alias("n")), "merkle-digests"), one, "__h")
    rows = (rows.withColumn("__same", _below(rows, by, "node", "n")).join(ids, one)
            .join(known.select(*by, F.col("__before").alias("__digests")), by))
    first = F.col("__at") + F.col("__ids") + F.col("__digests") + F.col("__same")
    dealt = (rows.withColumn("__first", first).withColumnRenamed("__all", "__size")
             .withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))))
             .repartition("g", "__first", "__from"))
    return dealt.withColumn("pos", F.explode(F.transform(
        F.sequence(F.col("__from"), F.least(F.col("__from") + COPIES, F.col("n")) - 1), lambda k: k + F.col("__first"))))


def _nodes(slots: Column) -> Column:
    return F.array_join(F.transform(slots, lambda s: s["node"]), "")


def reduce_up(nodes: DataFrame, largest: int, payload: list[str]) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Reduces nodes (g, pos, size, node, payload) of all groups, the largest of which
    has `largest` nodes. Returns for each level the runs (g, run, slots) of the groups
    with several nodes and the nodes of those that end there, and (g, node) of the roots."""
    levels, roots, k = [], None, 0
    while True:
        kept = ["node", *payload] if k == 0 else ["node"]
        done = nodes.where("size = 1").select("g", *kept)
        roots = done.select("g", "node") if roots is None else roots.union(done.select("g", "node"))
        if largest <= 1:
            levels.append((None, done))
            return levels, stored(roots, "merkle-roots")
        slot = F.struct(F.pmod("pos", F.lit(FANOUT)).cast("int").alias("at"), F.struct(*kept).alias("of"))
        runs = (nodes.where("size > 1").groupBy("g", F.floor(F.col("pos") / FANOUT).cast("long").alias("run"))
                .agg(F.first("size").alias("size"), F.map_from_entries(F.collect_list(slot)).alias("held")))
        runs = stored(runs.select("g", "run", "size", F.transform(
            F.sequence(F.lit(0), F.size("held") - 1), lambda i: F.col("held")[i]).alias("slots")), "merkle-runs")
        levels.append((runs, done))
        nodes = runs.select("g", F.col("run").alias("pos"), F.ceil(F.col("size") / FANOUT).cast("long").alias("size"),
                            F.sha2(_nodes(F.col("slots")).cast("binary"), 256).alias("node"))
        largest, k = -(-largest // FANOUT), k + 1


_PATH = "array<struct<l: string, r: string>>"


def hand_down(levels: list[tuple[DataFrame, DataFrame]], groups: DataFrame, payload: list[str]) -> DataFrame:
    """The lowest nodes (node, payload) with path and the other columns of `groups` (g,
    path, ...), which holds the path of each group's root. A path is, for each level
    upward, what stands left and right of the node in its run."""
    more = [c for c in groups.columns if c not in ("g", "path")]
    above = None
    for k in reversed(range(len(levels))):
        runs, done = levels[k]
        kept = ["node", *payload] if k == 0 else []
        rows = done.join(groups, "g").select("g", F.lit(0).cast("long").alias("pos"), *kept, "path", *more)
        if runs is not None:
            slots = F.col("slots")
            sides = F.struct(_nodes(F.slice(slots, 1, F.col("at"))).alias("l"),
                             _nodes(F.slice(slots, F.col("at") + 2, FANOUT)).alias("r"))
            below = (runs.join(above.withColumnRenamed("pos", "run"), ["g", "run"])
                     .select("*", F.posexplode("slots").alias("at", "of"))
                     .select("g", (F.col("run") * FANOUT + F.col("at")).alias("pos"), *[F.col(f"of.{c}").alias(c) for c in kept],
                             F.concat(F.array(sides), F.col("path")).alias("path"), *more))
            rows = below.union(rows)
        above = rows
    return above.drop("g", "pos")


def _ranked(roots: DataFrame) -> DataFrame:
    """The groups' roots as nodes of one group, in the order of g: sorted by ranges, a
    place being the rows of earlier partitions plus those before in the own one."""
    number = F.monotonically_increasing_id()
    t = stored(roots.repartitionByRange("g").sortWithinPartitions("g").withColumn("__no", number), "merkle-groups")
    part = F.shiftright("__no", 33)
    counts = t.groupBy(part.alias("__part")).agg(F.count("*").alias("n"))   # one row for each partition
    counts = counts.select("__part", F.coalesce(F.sum("n").over(
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return (t.join(counts, part == F.col("__part"))
            .select(F.lit("").alias("g"), F.col("g").alias("name"), "node",
                    (F.col("__before") + F.col("__no").bitwiseAND((1 << 33) - 1)).alias("pos")))


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS,
             other: Column | None = None) -> DataFrame:
    """One row per row of documents: key, node (its leaf), other, path, subroot, root.

    `other` is carried along, a second digest to be checked against the same path.
    Groups are ordered by their bytes, rows without one come first. A null key comes
    before all others; rows of one key are ordered by their digests, and rows equal
    in all `fields` take neighbouring places. No rows give no rows; columns outside
    `fields` have no influence."""
    leaves = stored(docs.select(F.coalesce(F.concat(F.lit("v"), F.col(f"`{group}`").cast("string")), F.lit("")).alias("g"),
                                F.col(f"`{key}`").cast("long").alias("id"), digest([F.col(f"`{c}`") for c in fields]).alias("node"),
                                (other if other is not None else F.lit(None).cast("string")).alias("other")), "merkle-leaves")
    placed = stored(coordinates(leaves), "merkle-places")
    largest = placed.agg(F.max("size")).first()[0] or 0
    levels, roots = reduce_up(placed, largest, ["id", "other"])
    n = roots.count()
    top, whole = reduce_up(_ranked(roots).withColumn("size", F.lit(n).cast("long")), n, ["name"])
    groups = hand_down(top, whole.select("g", F.array().cast(_PATH).alias("path"), F.col("node").alias("root")), ["name"])
    groups = stored(groups.select(F.col("name").alias("g"), "path", F.col("node").alias("subroot"), "root"), "merkle-paths")
    return hand_down(levels, groups, ["id", "other"]).select(F.col("id").alias(key), "node", "other", "path", "subroot", "root")


def proof(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), "")


def folded(node: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, node, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]).cast("binary"), 256))


def tampered(docs: DataFrame) -> Column:
    """The leaf with the text's A-Z in lower case where 3 divides the crc32 of the id
    (as decimal text), null elsewhere and for rows without an id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    values = [F.translate("text", _UPPER, _LOWER) if c == "text" else F.col(c) for c in FIELDS]
    return F.when(hit, digest(values))


def manifest_report(docs: DataFrame) -> DataFrame:
    """One row per row of documents: doc_id, leaf, subroot, root, proof_sha256,
    folded_root (from the tampered leaf, where there is one), verified."""
    t = manifest(docs, other=tampered(docs))
    t = t.withColumn("folded_root", folded(F.coalesce("other", "node"), F.col("path")))
    return t.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", F.sha2(proof(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
