"""URL filter (native): rules per host and path, and link-graph propagation
for urls that no rule decides.

Hosts are nodes. Edges: pages' absolute links, and links both ways between a
host and its parent domain. Hosts with pages allowed by rule are trusted
seeds, hosts with blocked pages blocked ones, weighted by their pages.
Trust is a personalised PageRank along the edges from the trusted seeds,
distrust one along reversed edges from the blocked seeds. A host whose distrust
exceeds its trust is blocked. Mass at a host without edges is not passed on.

Pages are aggregated by host before anything is shuffled; the rounds work on
hosts and edges only, and every few rounds the scores are written as a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import cut_lineage, join_side

SALTS = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
LINK = r"""(?:href|src|HREF|SRC)=["']?[A-Za-z][A-Za-z0-9+.-]*://([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), HOST, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), PATH, 1)


def suffixes(host: Column) -> Column:
    """The host and its parent domains: ``a.b.c`` gives ``a.b.c, b.c, c``."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))


def rule_table(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules ``(verdict, "host/path")`` as rows ``rule, verdict, rule_host, rule_path``."""
    rows = sorted({(r, v, r.split("/", 1)[0], "/" + r.split("/", 1)[1]) for v, r in rules})
    if any(v not in ("allow", "block") for _, v, _, _ in rows):
        raise ValueError("a verdict is allow or block")
    return spark.createDataFrame(rows, "rule string, verdict string, rule_host string, rule_path string")


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and the rules of it and its parent domains, longest first
    (as text for equal lengths). A host has at most as many rows here as labels."""
    return (hosts.select("host", F.explode(suffixes(F.col("host"))).alias("rule_host"))
                 .join(rules, "rule_host")
                 .groupBy("host").agg(F.array_sort(F.collect_set(F.struct(
                     (-F.length("rule")).alias("o"), "rule", "verdict", "rule_path"))).alias("rules")))


def longest_hit() -> Column:
    """The first of a row's ``rules`` whose path starts its ``path``, or null."""
    return F.get(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])), 0)


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, weight`` from pages (host, html): counted absolute links to
    other hosts, and one link each way between a host and its parent domain."""
    targets = F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(LINK), F.lit(1))
    links = (pages.where(F.col("host") != "")
                  .select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
                  .select("src", F.translate("dst", UPPER, LOWER).alias("dst")).where(F.col("src") != F.col("dst"))
                  .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    hosts = (pages.where(F.col("host") != "").select("host").distinct()
                  .unionByName(links.select(F.col("dst").alias("host"))).distinct())
    chain = hosts.select(F.explode(suffixes(F.col("host"))).alias("src")).distinct()
    parent = F.regexp_extract("src", r"(?s)^[^.]*\.(.*)$", 1)
    up = chain.select("src", parent.alias("dst")).where(F.col("dst") != "")
    both = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return (links.unionByName(both.withColumn("weight", F.lit(1.0)))
                 .groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 20, write_every: int = 5) -> DataFrame:
    """``host, trust, distrust`` after ``rounds`` rounds. ``seeds``: host, good
    and bad weights. Both walks run in one table, told apart by ``kind``."""
    flow = (edges.select(F.lit("t").alias("kind"), "src", "dst", "weight")
                 .unionByName(edges.select(F.lit("d").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")))
    out = flow.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    flow = cut_lineage(flow.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("p")),
                       "host-edges")
    start = (seeds.select("host", F.lit("t").alias("kind"), F.col("good").alias("w"))
                  .unionByName(seeds.select("host", F.lit("d").alias("kind"), F.col("bad").alias("w"))).where(F.col("w") > 0))
    total = start.groupBy("kind").agg(F.sum("w").alias("all"))          # two rows
    start = cut_lineage(start.join(F.broadcast(total), "kind").select("kind", "host", (F.col("w") / F.col("all")).alias("s")),
                        "host-seeds")
    score = start.select("kind", "host", F.col("s").alias("x"))
    for k in range(1, rounds + 1):
        sent = (score.withColumnRenamed("host", "src").join(flow, ["kind", "src"])
                     .select("kind", F.col("dst").alias("host"), (F.lit(damping) * F.col("x") * F.col("p")).alias("x")))
        score = (sent.unionByName(start.select("kind", "host", (F.lit(1 - damping) * F.col("s")).alias("x")))
                     .groupBy("kind", "host").agg(F.sum("x").alias("x")))
        if k % write_every == 0 or k == rounds:
            score = cut_lineage(score, "host-scores")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("x")).otherwise(0.0))
    return score.groupBy("host").agg(of("t").alias("trust"), of("d").alias("distrust"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html", damping: float = 0.85, rounds: int = 20) -> DataFrame:
    """One row per input row: ``id_col``, host, path, rule, verdict, trust, distrust.

    * null url, or one without ``://``: empty host and path, no rule, allowed
    * null html: no links; ties of trust and distrust (both 0, too): allowed
    * null ids and repeated rows: judged like any row
    * very long pages are one row each; empty table: empty result
    * without rules no seed exists, and everything is allowed; other columns are not read
    """
    spark = pages.sparkSession
    base = pages.select(F.col(id_col).alias("__id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    found = join_side(host_rules(base.select("host").distinct(), rule_table(spark, rules)), "host-rules")
    # salted: a host may hold a third of all pages, and its counts are summed per salt first
    salted = (base.where(F.col("host") != "").withColumn("salt", F.pmod(F.xxhash64("__id", "path"), F.lit(SALTS)))
                  .join(found.withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)"))),
                        ["host", "salt"], "left").withColumn("hit", longest_hit()))
    seeds = (salted.groupBy("host", "salt")
                   .agg(F.sum(F.when(F.col("hit.verdict") == "allow", 1.0).otherwise(0.0)).alias("good"),
                        F.sum(F.when(F.col("hit.verdict") == "block", 1.0).otherwise(0.0)).alias("bad"))
                   .groupBy("host").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    edges = host_edges(pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")))
    scores = propagate(edges, seeds, damping, rounds)
    trust, distrust = (F.round(F.coalesce(c, F.lit(0.0)), 12) for c in ("trust", "distrust"))
    own = F.when(distrust > trust, "block").otherwise("allow")
    hosts = join_side(found.join(scores, "host", "full"), "hosts")
    return (base.join(hosts, "host", "left").withColumn("hit", longest_hit())
                .select(F.col("__id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
                        F.coalesce(F.col("hit.verdict"), own).alias("verdict"), trust.alias("trust"), distrust.alias("distrust")))


def propagation_sql(rounds: int, damping: float) -> str:
    """The rounds as DuckDB common table expressions, from ``flow`` and ``start`` to ``score``."""
    steps = ["r0 AS (SELECT kind, host, s AS x FROM start)"]
    steps += [f"""r{k} AS (SELECT kind, host, sum(x) AS x FROM (
  SELECT f.kind, f.dst AS host, {damping} * r.x * f.p AS x FROM r{k - 1} r JOIN flow f ON r.host = f.src AND r.kind = f.kind
  UNION ALL SELECT kind, host, (1 - {damping}) * s FROM start) GROUP BY kind, host)""" for k in range(1, rounds + 1)]
    return ",\n".join([*steps, f"score AS (SELECT * FROM r{rounds})"])
