"""URL verdicts from rules, and from a tree of path templates per host.

DataFrame expressions only. The tree grows level by level over all urls of a
host (every count has a map-side combine, so a hot host costs no single
task):

1. *Generalise.* Under a node, a segment stays as it is if at least
   ``MIN_COUNT`` urls and ``MIN_SHARE`` of the node's urls have it, or if its
   share of bad labelled pages differs from that of the node's other pages,
   whatever its share of the urls; all other segments are values of a variable
   and become ``*``.
2. *Merge.* Branches of one node whose share of bad labelled pages does not
   differ from that of their siblings (two-proportion z-test) become one, ``~``.
   Below ``LEVELS`` segments only nodes in which a branch could still differ
   grow on, as deep as their urls go; what tells nothing apart is ``**``.
3. *Judge.* A url's template is its way through the tree. Its purity is the
   share of good labelled pages, smoothed towards its host's, which is smoothed
   towards that of all pages. Templates below ``MIN_PURITY`` are rejected.

A rule, where one fits, overrides the tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelscope.llm.common import land, pick, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
MAX_RULES = 1000

MIN_COUNT = 5
MIN_SHARE = 0.05
# z from which the bad share of a branch differs from its siblings'
MIN_Z = 1.96
# pages that the smoothing adds at the level above
PRIOR_PAGES = 4.0
MIN_PURITY = 0.5
# Segments that are told apart one by one; of those that follow, runs that
# cannot tell urls of a node apart are one, ``**``.
LEVELS = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits; null without one."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _join(rows: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(small(side), keys, "left")


def _z(lab: Column, bad: Column) -> Column:
    """z of the bad share of ``lab`` labels against the node's others; null
    where a side has no label, or all labels agree."""
    rest, rest_bad = F.col("all_lab") - lab, F.col("all_bad") - bad
    pooled = F.try_divide("all_bad", "all_lab")
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), lab) + F.try_divide(F.lit(1), rest)))
    return F.try_divide(F.abs(F.try_divide(bad, lab) - F.try_divide(rest_bad, rest)), error)


def _level(rows: DataFrame) -> DataFrame:
    """``rows`` with their template one of the ``segments`` longer."""
    rows = rows.withColumn("seg", F.get("segments", F.lit(0)))
    counts = (rows.where("seg is not null").groupBy("host", "template", "seg")
              .agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("lab"),
                   F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    counts = land(counts, "url_segments")
    node = land(counts.groupBy("host", "template")
                .agg(F.sum("n").alias("all_n"), F.sum("lab").alias("all_lab"), F.sum("bad").alias("all_bad"),
                     F.count_if(F.col("lab") >= MIN_COUNT).alias("tests")),
                "url_nodes")
    common = (F.col("n") >= MIN_COUNT) & (F.col("n") >= MIN_SHARE * F.col("all_n"))
    # so many tests of one node need more evidence each, or chance would pass some
    differs = _z(F.col("lab"), F.col("bad")) >= F.sqrt(MIN_Z ** 2 + 2 * F.ln("tests"))
    constant = common | F.coalesce((F.col("lab") >= MIN_COUNT) & differs, F.lit(False))
    branches = (counts.join(small(node), ["host", "template"]).withColumn("constant", constant)
                .withColumn("branch", F.when(F.col("constant"), F.col("seg")).otherwise("*"))
                .groupBy("host", "template", "branch", "constant")
                .agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad"),
                     F.first("all_lab").alias("all_lab"), F.first("all_bad").alias("all_bad")))
    label = F.when(_z(F.col("lab"), F.col("bad")) >= MIN_Z, F.col("branch")).otherwise("~")
    branches = land(branches.select("host", "template", "branch", "constant", label.alias("label")), "url_branches")
    fixed = branches.where("constant").select("host", "template", F.col("branch").alias("seg"), "label")
    star = branches.where("not constant").select("host", "template", F.col("label").alias("star"))
    out = _join(_join(rows, fixed, ["host", "template", "seg"]), star, ["host", "template"])
    more = F.concat("template", F.lit("/"), F.coalesce("label", "star"))
    return (out.withColumn("template", F.when(F.col("seg").isNotNull(), more).otherwise(F.col("template")))
            .withColumn("segments", F.slice("segments", 2, F.size("segments")))
            .drop("seg", "label", "star"))


def _skip(rows: DataFrame) -> DataFrame:
    """``rows`` without the next segments that cannot tell the urls of their
    node apart, which are ``**``: those before the first in which two urls
    differ, and all if the labels agree or no segment can be of ``MIN_COUNT``
    urls. A node that goes on thus has two segments to tell apart."""
    names, keys, size = rows.columns, ["host", "template"], F.size("segments")
    node = land(rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("lab"), F.sum("bad").alias("all_bad"),
        F.max_by("segments", size).alias("longest")), "url_deep_nodes")
    mixed = (F.col("n") >= MIN_COUNT) & (F.col("all_bad") > 0) & (F.col("all_bad") < F.col("lab"))
    same = F.zip_with("segments", "longest", lambda a, b: a == b)
    apart = F.when(mixed, F.nullif(F.array_position(same, False), F.lit(0)))
    rows = land(rows.join(node, keys).select(*names, apart.alias("apart")), "url_deep_rows")
    first = land(rows.groupBy(*keys).agg(F.min("apart").alias("first")), "url_deep_runs")
    run = F.least(F.coalesce(F.col("first") - 1, size), size).cast("int")
    return _join(rows, first, keys).withColumn("run", run).select(
        *[c for c in names if c not in ("template", "segments")],
        F.when(F.col("run") > 0, F.concat("template", F.lit("/**"))).otherwise(F.col("template")).alias("template"),
        F.slice("segments", F.col("run") + 1, size).alias("segments"))


def templates(rows: DataFrame) -> DataFrame:
    """``rows`` (host, segments, bad, ...) with the ``template`` of each;
    ``segments`` are used up."""
    rows = land(rows.withColumn("template", F.lit("")), "url_rows")
    deepest = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    for _ in range(min(deepest, LEVELS)):
        rows = land(_level(rows), "url_rows")
    ended, more = F.size("segments") == 0, F.size("segments") > 0
    done, deep = rows.where(ended), rows.where(more)
    while deepest > LEVELS and not deep.isEmpty():
        rows = land(_skip(deep), "url_rows")
        done, deep = done.unionByName(rows.where(ended)), rows.where(more)
        if not deep.isEmpty():
            rows = land(_level(deep), "url_rows")
            done, deep = done.unionByName(rows.where(ended)), rows.where(more)
    return done if deepest > LEVELS else rows


def _purities(rows: DataFrame) -> DataFrame:
    """``(host, template, purity)``."""
    one = rows.groupBy("host", "template").agg(
        F.count("bad").alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    host = one.groupBy("host").agg(F.sum("lab").alias("h_lab"), F.sum("bad").alias("h_bad"))
    lab, bad = rows.agg(F.count("bad"), F.sum("bad")).first()
    every = (bad or 0) / lab if lab else 0.0
    of_host = (F.col("h_bad") + PRIOR_PAGES * every) / (F.col("h_lab") + PRIOR_PAGES)
    return one.join(host, "host").select(
        "host", "template",
        (1 - (F.col("bad") + PRIOR_PAGES * of_host) / (F.col("lab") + PRIOR_PAGES)).alias("purity"))


def url_verdicts(pages: DataFrame, labels: DataFrame,
                 rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` per row.

    ``labels`` (doc_id, quality, toxic) marks a page as bad if any of its
    labels is low quality or toxic; without labels everything is allowed.
    A null url, or one without ``://``, has an empty host and path and is
    judged like the other urls of the empty host. Repeated rows are judged
    alike and all count. An empty table gives an empty one.
    """
    marked = pick(labels, doc_id="bigint", quality="int", toxic="int")
    marked = (marked.where("doc_id is not null and (quality is not null or toxic is not null)")
              .groupBy(F.col("doc_id").alias("page_id"))
              .agg(F.max(F.coalesce((F.col("quality") == 0), F.lit(False)).cast("int")
                         .bitwiseOR(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int"))).alias("bad")))
    host, path = host_and_path(F.col("url"))
    rows = pick(pages, page_id="bigint", url="string").select("page_id", host.alias("host"), path.alias("path"))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = rows.withColumn("segments", segments).join(marked, "page_id", "left")
    rows = templates(rows)
    purities = land(_purities(rows), "url_purities")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    by_tree = F.when(F.col("purity") < MIN_PURITY, "block").otherwise("allow")
    return _join(rows, purities, ["host", "template"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_tree).alias("verdict"),
        "template", "purity")
