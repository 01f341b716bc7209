"""robots.txt rules as data.

Parsing: each line trimmed and lower-cased; a `user-agent:` line sets whether
the following rules apply (agent `*` or containing our own token); a later
agent line overrides an earlier one. Non-empty `disallow:` / `allow:` paths
under an applying agent become rules. Rules are tried longest path first,
file order for ties; the first rule whose path prefixes the URL path decides;
no rule, or no robots file, means allowed. Inline comments and wildcards are
not interpreted (as in the reference).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions.html import js_trim
from trawl.functions.urls import url_parts
from trawl.operators._util import broadcast_if_small
from trawl.session import cut_lineage

DEFAULT_AGENT_TOKEN = "trawl"


def parse_rules(robots: DataFrame, agent_token: str = DEFAULT_AGENT_TOKEN) -> DataFrame:
    """(host, text) -> (host, line, path, allow, rank) with rank 1 = tried first."""
    lines = robots.select("host", F.posexplode(F.split(F.col("text"), "\n")).alias("line", "raw"))
    lines = lines.withColumn("t", F.lower(js_trim(F.col("raw"))))
    token = agent_token.lower()
    agent = F.trim(F.substring(F.col("t"), len("user-agent:") + 1, 1 << 30))
    lines = lines.withColumn(
        "agent_flag",
        F.when(F.col("t").startswith("user-agent:"), (agent == "*") | agent.contains(token)))
    w = Window.partitionBy("host").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("relevant", F.coalesce(F.last("agent_flag", ignorenulls=True).over(w), F.lit(False)))
    dis = F.trim(F.substring(F.col("t"), len("disallow:") + 1, 1 << 30))
    alw = F.trim(F.substring(F.col("t"), len("allow:") + 1, 1 << 30))
    rules = (lines.filter(F.col("relevant"))
             .select("host", F.col("line").cast("long").alias("line"),
                     F.when(F.col("t").startswith("disallow:"), dis)
                     .when(F.col("t").startswith("allow:"), alw).alias("path"),
                     F.col("t").startswith("allow:").alias("allow"))
             .filter(F.col("path").isNotNull() & (F.col("path") != "")))
    order = Window.partitionBy("host").orderBy(F.desc(F.length("path")), "line")
    return rules.withColumn("rank", F.row_number().over(order).cast("long"))


def allowed(urls: DataFrame, rules: DataFrame, url_col: str = "normalized_url") -> DataFrame:
    """Adds `allowed` to every row of `urls`.

    A path is tried only at the lengths that its host's rules have: those prefixes
    meet the rules by equality, never paths times rules. The best-ranked rule
    decides, once for each distinct (host, path)."""
    parts = url_parts(F.col(url_col))
    u = urls.withColumn("_p", parts).withColumn("_host", F.col("_p.host")).withColumn("_path", F.col("_p.path"))
    u = u.drop("_p")
    r = cut_lineage(rules.select(F.col("host").alias("_host"), "path", "allow", "rank"))
    lengths, _ = broadcast_if_small(r.groupBy("_host").agg(F.collect_set(F.length("path")).alias("_lengths")))
    first, _ = broadcast_if_small(r.groupBy("_host", F.col("path").alias("_prefix")).agg(
        F.min(F.struct("rank", "allow")).alias("_rule")))
    tried = u.select("_host", "_path").distinct().join(lengths, "_host").select("_host", "_path", F.explode(F.transform(
        F.filter("_lengths", lambda n: n <= F.length("_path")), lambda n: F.substring(F.col("_path"), F.lit(1), n))).alias("_prefix"))
    m = (tried.join(first, ["_host", "_prefix"])
         .groupBy("_host", "_path").agg(F.min("_rule")["allow"].alias("_allow")))
    return (u.join(m, ["_host", "_path"], "left")
            .withColumn("allowed", F.coalesce(F.col("_allow"), F.lit(True)))
            .drop("_host", "_path", "_allow"))
