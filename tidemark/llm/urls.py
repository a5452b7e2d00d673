"""URL filtering: fixed rules first, then a learnt tree of path templates.

The rules label the pages they fit. For each host a tree of path templates is
grown level by level, until no path has a further segment. A segment is variable
if digits make it so (``471.html`` is ``{n}.html``) or if it is one of many rare
children of its node; variable and unlabelled segments are pooled in a wildcard.
Then sibling branches, the wildcard among them, are compared pairwise by their
shares of blocked labels (two-proportion z test), and the two most similar ones are
merged until no two are similar: ``{a|b}`` is the merged branch of a and b. A node
whose labels do not differ, with one branch left, is a wildcard. A template is
rejected if its smoothed share of blocked labels exceeds ``max_blocked``: the share
is smoothed by the host's, and the host's by that of all labelled pages, so a host
without labels follows them.

A node has at most ``max(max_children, 1 / rare)`` branches beside its wildcard, so
comparing them takes a small list for each node. A shape that is alone in its node
is finished at once, so the rounds are as many as the segments that two different
shapes have in common, and one.

Everything runs on counts of (host, path shape), which partial aggregation makes
before any shuffle; a host that holds a third of all pages is a few counts.

Defined results: a null url, or one without ``://``, has an empty host and path;
the verdict of an empty table's pages is empty; without any label every template
has purity one half and is allowed; repeated rows get equal verdicts; columns
other than ``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

import string
from functools import reduce
from math import sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, table

#: (rule, verdict); a rule is its host, followed by the start of the path.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
#: A node with more children than this has variable segments ...
MAX_CHILDREN = 20
#: ... which are those with less than this share of its pages.
RARE = 0.05
#: z value up to which the shares of blocked labels of two branches are similar.
SIMILAR = 2.576
#: Labels that the share of the level above counts for.
PRIOR = 5.0
MAX_BLOCKED = 0.7


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*(/[^?#]*)?", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the last one that fits wins
        own, _, start = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shape_of(path: Column) -> Column:
    """The segments of a path, digits generalised; empty segments do not count."""
    return F.filter(F.split(F.regexp_replace(path, "[0-9]+", "{n}"), "/"), lambda s: s != "")


def unlike(a: tuple[list[str], int, int], b: tuple[list[str], int, int]) -> float:
    """z of the difference of two groups' shares of blocked labels; a group is (names, blocked, labels)."""
    (_, blocked_a, n_a), (_, blocked_b, n_b) = a, b
    share = (blocked_a + blocked_b) / (n_a + n_b)
    spread = sqrt(share * (1 - share) * (1 / n_a + 1 / n_b))
    difference = abs(blocked_a / n_a - blocked_b / n_b)
    return difference / spread if spread else 0.0


def merged(branches: list[tuple[str, int, int]], similar: float = SIMILAR) -> list[str]:
    """The names of a node's branches (name, blocked, allowed) after merging; ``*`` is the name of the wildcard."""
    groups = [([name], blocked, blocked + allowed) for name, blocked, allowed in branches if blocked + allowed]
    while len(groups) > 1:
        z, i, j = min((unlike(groups[i], groups[j]), i, j) for j in range(len(groups)) for i in range(j))
        if z > similar:
            break
        groups[i] = (groups[i][0] + groups[j][0], groups[i][1] + groups[j][1], groups[i][2] + groups[j][2])
        del groups[j]
    found = {}
    for names, _, _ in groups:
        whole = len(groups) == 1 or "*" in names
        found |= dict.fromkeys(names, "*" if whole else names[0] if len(names) == 1 else "{" + "|".join(sorted(names)) + "}")
    return [found.get(name, "*") for name, _, _ in branches]


def templates(shapes: DataFrame, max_children: int = MAX_CHILDREN, rare: float = RARE, similar: float = SIMILAR) -> DataFrame:
    """(host, shape, pages, blocked, allowed, template) from the same without ``template``."""
    @F.arrow_udf("array<string>")
    def merged_names(nodes: pa.Array) -> pa.Array:
        return pa.array([merged([(b["name"], b["blocked"], b["allowed"]) for b in node], similar) for node in nodes.to_pylist()],
                        pa.list_(pa.string()))

    rows, done, level = shapes.withColumn("template", F.lit("")), [], 0
    node = ["host", "template"]
    while True:
        rows = rows.withColumn("segment", F.get("shape", F.lit(level)))
        done.append(rows.filter("segment IS NULL").drop("segment"))
        further = rows.filter("segment IS NOT NULL")
        if further.isEmpty():
            return reduce(DataFrame.unionByName, done)
        child = further.groupBy(*node, "segment").agg(
            F.count("*").alias("shapes"), *[F.sum(c).alias(c) for c in ("pages", "blocked", "allowed")])
        sums = child.groupBy(*node).agg(F.count("*").alias("children"), F.sum("pages").alias("node_pages"),
                                        F.sum("shapes").alias("node_shapes"))
        variable = (F.col("children") > max_children) & (F.col("pages") < rare * F.col("node_pages"))
        unlabelled = F.col("blocked") + F.col("allowed") == 0
        child = materialize(child.join(sums, node).withColumn("name", F.when(variable | unlabelled, "*").otherwise(F.col("segment"))),
                            "url-children")
        branches = child.groupBy(*node, "name").agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"))
        named = branches.groupBy(*node).agg(F.array_sort(F.collect_list(F.struct("name", "blocked", "allowed"))).alias("branches"))
        named = named.select(*node, "branches", merged_names("branches").alias("merged")).select(
            *node, F.explode(F.arrays_zip(F.col("branches")["name"].alias("name"), F.col("merged").alias("branch"))).alias("b"))
        chosen = child.join(named.select(*node, "b.*"), [*node, "name"]).select(
            *node, "segment", "branch", (F.col("node_shapes") == 1).alias("alone"))
        rest = F.repeat(F.lit("/*"), F.size("shape") - level)
        grown = materialize(further.join(chosen, [*node, "segment"]).select(
            *shapes.columns, "alone", F.concat("template", F.when(F.col("alone"), rest).otherwise(F.concat(F.lit("/"), "branch")))
            .alias("template")), "url-tree")
        done.append(grown.filter("alone").drop("alone"))
        rows, level = grown.filter("NOT alone").drop("alone"), level + 1


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, max_blocked: float = MAX_BLOCKED,
                prior: float = PRIOR) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, blocked_share) for every page."""
    url = F.coalesce("url", F.lit(""))
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path")).withColumn(
        "fit", rule_of(F.col("host"), F.col("path"), rules)).withColumn("shape", shape_of(F.col("path")))
    shapes = materialize(parsed.groupBy("host", "shape").agg(
        F.count("*").alias("pages"),
        F.count_if(F.col("fit.verdict") == "block").alias("blocked"),
        F.count_if(F.col("fit.verdict") == "allow").alias("allowed")), "url-shapes")
    tree = materialize(templates(shapes), "url-templates")
    counts = [F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed")]

    def smoothed(above: Column) -> Column:
        return (F.col("blocked") + prior * above) / (F.col("blocked") + F.col("allowed") + prior)

    total = shapes.agg(*counts).first()
    blocked, allowed = total["blocked"] or 0, total["allowed"] or 0
    hosts = shapes.groupBy("host").agg(*counts).select(
        "host", smoothed(F.lit((blocked + prior / 2) / (blocked + allowed + prior))).alias("host_share"))
    judged = tree.groupBy("host", "template").agg(*counts).join(hosts, "host").select(
        "host", "template", smoothed(F.col("host_share")).alias("blocked_share"))
    by_shape = tree.select("host", "shape", "template").join(judged, ["host", "template"])
    return parsed.join(by_shape, ["host", "shape"]).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("blocked_share") > max_blocked, "block").otherwise("allow")).alias("verdict"),
        "template", "blocked_share")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: host, path, rule and verdict of all pages."""
    return filter_urls(table(spark, sf_dir, "pages"))
