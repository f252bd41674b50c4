"""URL verdicts by rules and by per-host trees of path templates.

A path is generalised segment by segment: digits become 0, long or scattered mixtures become
``*``, and where a node of a host's tree has many children with few pages each, all of them
become ``*``. All segments of a path count, however deep. Labelled pages (here those that a
rule decides) give every template a number of pages and of blocked ones. Branches below one
node whose share of blocked pages does not differ significantly from the node's are merged
and counted together. A template is rejected when its share, smoothed towards that of the
same template on all hosts and that one towards the share of all labelled pages, reaches a
limit.

Templates are counted before anything is joined: the table of distinct generalised paths
carries the tree, and pages meet it once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.sources.scratch import new_folder, written

# The rules of the production run, as (verdict, host and path prefix).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Options:
    many_children: int = 20
    few_pages: float = 3.0
    similar_z: float = 1.96
    smoothing: float = 4.0
    reject_share: float = 0.5


def host_of(url: Column) -> Column:
    """What follows the first '://' up to '/', '?', '#' or the end, A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """From the host's end up to '?', '#' or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest fitting rule as struct (verdict, rule), or null."""
    found = F.lit(None).cast("struct<verdict: string, rule: string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, prefix = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(slash + prefix))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def segments_of(path: Column) -> Column:
    """Generalised segments by their looks."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    numberless = lambda s: F.regexp_replace(s, "[0-9]+", "0")
    mixed = lambda s: s.rlike("[0-9]") & ((F.length(s) >= 16) | s.rlike("[0-9][^0-9]+[0-9]+[^0-9]+[0-9]"))
    return F.transform(parts, lambda s: F.when(mixed(s), "*").otherwise(numberless(s)))


# Digests of what stands above each segment, each from the one before it, so that a row of a
# deep path is no longer than that of a flat one.
_ABOVE = """
aggregate(segments, named_struct('at', '', 'all', CAST(array() AS array<string>)),
  (acc, s) -> named_struct('at', sha2(concat(acc.at, '/', s), 256), 'all', concat(acc.all, array(acc.at))),
  acc -> acc.all)"""


def templates(paths: DataFrame, options: Options) -> DataFrame:
    """(host, segments, template, n, blocked) from counted paths (host, segments, n, blocked, pages).

    A segment becomes ``*`` where its node has more than ``many_children`` children with
    fewer than ``few_pages`` pages each on average.
    """
    paths = paths.withColumn("path", F.sha2(F.array_join("segments", "/"), 256))
    levels = paths.where(F.size("segments") > 0).select("host", "path", "pages", "segments", F.expr(_ABOVE).alias("aboves"))
    levels = levels.select(
        "host", "path", "pages", F.posexplode(F.arrays_zip("segments", "aboves")).alias("level", "at")
    ).select("host", "path", "pages", "level", F.col("at.segments").alias("segment"), F.col("at.aboves").alias("above"))
    node = ["host", "level", "above"]
    children = levels.groupBy(*node, "segment").agg(F.sum("pages").alias("pages"))
    wild = children.groupBy(*node).agg(F.count("*").alias("children"), F.sum("pages").alias("pages"))
    wild = wild.where(
        (F.col("children") > options.many_children) & (F.col("pages") < options.few_pages * F.col("children"))
    ).select(*(F.col(c).alias(f"wild_{c}") for c in node))
    same = [F.col(c) == F.col(f"wild_{c}") for c in node]
    named = levels.join(wild, same, "left").select(
        "host", "path", "level", F.when(F.col("wild_host").isNotNull(), "*").otherwise(F.col("segment")).alias("shown")
    )
    # The segments of one path meet again.
    whole = named.groupBy("host", "path").agg(F.sort_array(F.collect_list(F.struct("level", "shown"))).alias("shown"))
    whole = whole.select(F.col("host").alias("h"), F.col("path").alias("p"), F.col("shown.shown").alias("shown"))
    return paths.join(whole, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left").select(
        "host", "segments", F.coalesce("shown", F.array().cast("array<string>")).alias("template"), "n", "blocked"
    )


def purity(found: DataFrame, options: Options) -> DataFrame:
    """(host, template, share): smoothed share of blocked pages per template of each host."""
    spark = found.sparkSession
    own = found.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"))
    own = own.withColumn("above", F.expr("slice(template, 1, greatest(size(template) - 1, 0))"))
    own = written(own, new_folder(spark, "templates"))
    # A node's children: all templates of the host that differ only in their last segment.
    node = own.groupBy("host", "above").agg(F.sum("n").alias("node_n"), F.sum("blocked").alias("node_blocked"))
    node = node.select(F.col("host").alias("h"), F.col("above").alias("a"), "node_n", "node_blocked")
    at_node = (F.col("host") == F.col("h")) & (F.col("above") == F.col("a"))
    expected = F.try_divide("node_blocked", "node_n")
    spread = F.sqrt(F.try_divide(expected * (1 - expected), F.col("n")))
    near = F.abs(F.try_divide("blocked", "n") - expected) <= options.similar_z * spread
    alike = F.coalesce(near, F.lit(True))  # a branch without labels follows its node
    own = own.join(node, at_node).select("host", "template", "above", "n", "blocked", alike.alias("alike"))
    own = written(own, new_folder(spark, "branches"))
    merged = own.where("alike").groupBy("host", "above").agg(F.sum("n").alias("all_n"), F.sum("blocked").alias("all_blocked"))
    merged = merged.select(F.col("host").alias("h"), F.col("above").alias("a"), "all_n", "all_blocked")
    own = own.join(merged, at_node & F.col("alike"), "left").select(
        "host",
        "template",
        F.coalesce("all_n", "n").alias("n"),
        F.coalesce("all_blocked", "blocked").alias("blocked"),
        F.col("n").alias("own_n"),
        F.col("blocked").alias("own_blocked"),
    )
    total = own.agg(F.sum("own_blocked").alias("b"), F.sum("own_n").alias("n")).first()
    share = ((total["b"] or 0) + 1) / ((total["n"] or 0) + 2)
    everywhere = own.groupBy(F.col("template").alias("t")).agg(
        F.sum("own_n").alias("t_n"), F.sum("own_blocked").alias("t_blocked")
    )
    weight = F.lit(options.smoothing)
    prior = (F.col("t_blocked") + weight * share) / (F.col("t_n") + weight)
    return own.join(everywhere, F.col("template") == F.col("t")).select(
        "host", "template", ((F.col("blocked") + weight * prior) / (F.col("n") + weight)).alias("share")
    )


def verdicts(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    options: Options = Options(),
) -> DataFrame:
    """(id, host, path, rule, template, share, verdict) per row.

    A page that a rule decides has the rule's verdict; the others have that of their
    template. A null url, and one without '://', has an empty host and path and is judged
    by their template like any other. Repeated rows count and are judged one by one; ties at
    the limit are blocked; an empty table gives no rows; other columns are not looked at.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("found"), segments_of(F.col("path")).alias("segments"))
    rows = rows.select("id", "host", "path", "segments", "found.rule", "found.verdict")
    paths = rows.groupBy("host", "segments").agg(
        F.count("*").alias("pages"), F.count("verdict").alias("n"), F.count_if(F.col("verdict") == "block").alias("blocked")
    )
    found = written(templates(written(paths, new_folder(spark, "paths")), options), new_folder(spark, "found"))
    shares = purity(found, options).select(F.col("host").alias("h"), F.col("template").alias("t"), "share")
    judged = found.join(shares, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")))
    judged = judged.select(F.col("host").alias("h"), F.col("segments").alias("s"), "template", "share")
    judged = written(judged, new_folder(spark, "judged"))
    by_template = F.when(F.col("share") >= options.reject_share, "block").otherwise("allow")
    return rows.join(judged, (F.col("host") == F.col("h")) & (F.col("segments") == F.col("s"))).select(
        "id",
        "host",
        "path",
        "rule",
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
        "share",
        F.coalesce("verdict", by_template).alias("verdict"),
    )
