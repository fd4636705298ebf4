"""URL filters by a path-template tree.

Per host the paths form a tree of segments. Level by level, every child of at least ``support`` pages whose labelled share of bad pages
differs significantly from that of the rest of its siblings stays a branch of its own, however many there are and however small
their share of the pages. All others are generalised to a wildcard (with their file ending, ``*.html``), and wildcards that do not
differ from the rest are merged (``+``), so that only branches that mean something stay apart. A template is
rejected if its smoothed share of bad pages reaches ``block_at``: its labels count with ``strength`` pseudo-labels at the
rate of its host, which is smoothed likewise towards the rate of all pages.

All counts are partial aggregates by (node, segment), so a host that holds a third of all pages is reduced before
each exchange; its pages are joined with its literal children by (node, segment) in joins that Spark may split. Paths deeper than ``depth``
keep their rest as one segment.

Rules come first: a rule fits its host and all subdomains if the path starts with its path; the longest wins (of host and
path together). Null urls and urls without ``://`` have empty host and path. Repeated rows count each; null labels do not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.text import fold
from quern.session import stage

DEPTH = 8
SUPPORT = 5
DIFFERENT = 1.96
STRENGTH = 10.0
BLOCK_AT = 0.5

Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return fold(host), path


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The rule (as ``host/path``) and the verdict that apply, or nulls. Rules are ``(verdict, host, path)``."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _sums() -> list[Column]:
    return [F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")]


def _any(segment: Column) -> Column:
    return F.concat(F.lit("*"), F.regexp_extract(segment, r"\.[A-Za-z][A-Za-z0-9]{0,4}\z", 0))


def _apart(different: float) -> Column:
    """Two-proportion test of a branch (``labelled``, ``bad``) against its siblings (``all_`` sums of the node less its own)."""
    rate = F.col("all_bad") / F.greatest("all_labelled", F.lit(1))
    other = F.col("all_labelled") - F.col("labelled")
    spread = F.sqrt(rate * (1 - rate) * (1 / F.greatest("labelled", F.lit(1)) + 1 / F.greatest(other, F.lit(1))))
    gap = F.abs(F.col("bad") / F.greatest("labelled", F.lit(1)) - (F.col("all_bad") - F.col("bad")) / F.greatest(other, F.lit(1)))
    return (F.col("labelled") > 0) & (other > 0) & (gap > different * spread)


def templates(urls: DataFrame, depth: int = DEPTH, support: int = SUPPORT, different: float = DIFFERENT) -> DataFrame:
    """Add ``template`` to rows ``(host, path, bad)``; ``bad`` is 1, 0 or null (not labelled). Staged."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    cut = F.when(F.size(segments) > depth, F.concat(F.slice(segments, 1, depth - 1), F.array(
        F.array_join(F.slice(segments, depth, F.greatest(F.size(segments), F.lit(depth))), "/")))).otherwise(segments)
    rows = stage(urls.withColumn("_segments", cut).withColumn("template", F.col("host")), "url-tree")
    levels = rows.agg(F.max(F.size("_segments"))).first()[0] or 0
    for level in range(levels):
        here = rows.filter(F.size("_segments") > level).select(
            F.col("template").alias("node"), F.get("_segments", F.lit(level)).alias("segment"), F.lit(1).alias("n"),
            F.col("bad").isNotNull().cast("int").alias("labelled"), F.coalesce(F.col("bad"), F.lit(0)).alias("bad"))
        children = here.groupBy("node", "segment").agg(*_sums())
        nodes = children.groupBy("node").agg(*(F.sum(c).alias(f"all_{c}") for c in ("labelled", "bad")))
        children = children.join(nodes, "node").withColumn("apart", (F.col("n") >= support) & _apart(different))
        literal = stage(children.filter("apart").select("node", "segment", F.col("segment").alias("literal")), "url-literals")
        branches = children.filter("NOT apart").groupBy("node", _any(F.col("segment")).alias("_wild")).agg(
            *_sums(), *(F.first(f"all_{c}").alias(f"all_{c}") for c in ("labelled", "bad")))
        wild = stage(branches.select("node", "_wild", F.when(_apart(different), F.col("_wild")).otherwise(F.lit("+")).alias("wild")), "url-wildcards")
        row = rows.withColumn("_segment", F.get("_segments", F.lit(level))).withColumn("_any", _any(F.col("_segment")))
        going, done = row.filter("_segment IS NOT NULL"), row.filter("_segment IS NULL")
        joined = going.join(literal, (going["template"] == literal["node"]) & (going["_segment"] == literal["segment"]), "left").drop("node", "segment")
        joined = joined.join(wild, (joined["template"] == wild["node"]) & (joined["_any"] == wild["_wild"]), "left").drop("node", "_wild")
        moved = joined.withColumn("template", F.concat("template", F.lit("/"), F.coalesce("literal", "wild")))
        rows = stage(moved.select(*rows.columns).unionByName(done.select(*rows.columns)), "url-tree")
    return rows.drop("_segments")


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", bad_col: str = "bad",
          strength: float = STRENGTH, block_at: float = BLOCK_AT, **options) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, bad_share)`` per row."""
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(bad_col).cast("int").alias("bad"))
    placed = templates(urls, **options)
    counts = placed.groupBy("host", "template").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    labelled, bad = counts.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    prior = bad / labelled if labelled else 0.0
    hosts = counts.groupBy("host").agg(((F.sum("bad") + strength * prior) / (F.sum("labelled") + strength)).alias("host_share"))
    share = (F.col("bad") + strength * F.col("host_share")) / (F.col("labelled") + strength)
    shares = stage(counts.join(hosts, "host").select("template", share.alias("bad_share")), "url-shares")
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    judged = placed.join(shares, "template")
    return judged.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("bad_share") >= block_at, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                         "template", "bad_share")
