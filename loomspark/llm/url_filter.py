"""URL filter by a tree of path templates, with DataFrame functions only.

Urls that a rule fits take the rule's verdict and are the labels; the others are judged by their template. Per host the paths
are cut into segments, numbers and long hexadecimal names in them become wildcards, and equal shapes are counted before anything is shuffled. Then, level by
level from the root as far as any path goes, the children of each node are generalised: a literal segment becomes a wildcard where its branch is statistically
similar to its siblings: the shares of blocked labels do not differ by a two-proportion test, which is stricter for a child that is rare among many, as some of those differ by chance. A template is rejected where its blocked share, smoothed towards its host's and that
towards the whole table's, is ``reject`` or more. A node's children are compared with the node's sums, never with each
other; hot hosts are counted with partial sums, and the few shapes are joined back to the pages by broadcast, or with
the keys dealt out where they are many.

Defined cases: a null url, or one without ``://``, has host and path empty, and the template of the empty host; repeated rows count
each; without any label nothing is rejected unless ``reject`` is 0.5 or less; an empty table gives an empty table.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import attach, written


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Tree:
    """z: of the test; rare_z: of the test of a segment with less than ``rare`` of its node's urls where the node has more than ``fan`` children;
    weight: of the smoothing, in labels; least: labels either side of a test has to have; reject: smoothed blocked share from which a template is blocked."""

    fan: int = 20
    rare: float = 0.05
    z: float = 1.96
    rare_z: float = 4.0
    least: int = 5
    weight: float = 4.0
    reject: float = 0.7


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def shape(path: Column) -> Column:
    """Segments of a path, with what varies by its form as a wildcard."""
    parts = F.split(F.substring(path, 2, F.length(path)), "/")
    hexes = lambda s: s.rlike("^[0-9a-fA-F-]{16,}$")
    general = F.transform(parts, lambda s: F.when(hexes(s), F.lit("*")).otherwise(F.regexp_replace(s, "[0-9]+", "*")))
    return F.when(path == "", F.array().cast("array<string>")).otherwise(general)


def _differs(n: Column, b: Column, all_n: Column, all_b: Column, z: Column, tree: Tree) -> Column:
    """Whether b of n and the rest of all_b of all_n are shares that differ, by a two-proportion test."""
    m, c = all_n - n, all_b - b
    p = all_b / all_n
    error = F.sqrt(p * (1 - p) * (1 / n + 1 / m))
    return (n >= tree.least) & (m >= tree.least) & (F.abs(b / n - c / m) > z * error)


def templates(shapes: DataFrame, tree: Tree) -> DataFrame:
    """From (key, host, segments, n, labelled, blocked) a row a shape: the same with ``template``, its generalised path."""
    rows, done = shapes.withColumn("__t", F.lit("")), []
    deepest = shapes.agg(F.max(F.size("segments"))).first()[0] or 0
    for d in range(1, deepest + 1):
        # Shapes that end here are done; each level works on those that go on.
        done.append(rows.filter(F.size("segments") < d))
        here = rows.filter(F.size("segments") >= d)
        here = here.withColumn("__s", F.get("segments", F.lit(d - 1)))
        sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
        children = here.groupBy("host", "__t", "__s").agg(*sums)
        nodes = children.groupBy(F.col("host").alias("h"), F.col("__t").alias("t")).agg(F.count("*").alias("fan"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "labelled", "blocked")])
        met = children.join(nodes, (F.col("host") == F.col("h")) & (F.col("__t") == F.col("t")))
        rare = (F.col("fan") > tree.fan) & (F.col("n") < F.lit(tree.rare) * F.col("all_n"))
        z = F.when(rare, tree.rare_z).otherwise(tree.z)
        alike = (F.col("fan") > 1) & ~F.coalesce(_differs(F.col("labelled"), F.col("blocked"), F.col("all_labelled"), F.col("all_blocked"), z, tree), F.lit(False))
        # A dictionary of the literal branches that stay; all other segments at this level are wildcards.
        stay = met.filter(~alike).select(F.col("host").alias("h"), F.col("__t").alias("t"), F.col("__s").alias("s"))
        rows = here.join(stay, (F.col("host") == F.col("h")) & (F.col("__t") == F.col("t")) & (F.col("__s") == F.col("s")), "left")
        step = F.when(F.col("s").isNotNull(), F.concat(F.lit("/"), F.col("__s"))).otherwise("/*")
        rows = rows.withColumn("__t", F.concat("__t", step)).drop("__s", "h", "t", "s")
        rows = written(rows, "url-level")
    for part in done:
        rows = rows.unionByName(part)
    return rows.withColumnRenamed("__t", "template")


def filter_urls(pages: DataFrame, rules: list[Rule], tree: Tree = Tree(), page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, template, purity, rule, verdict): purity is the template's smoothed blocked share."""
    host, path = split_url(F.col(url))
    own = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, said = longest_rule(F.col("host"), F.col("path"), rules)
    own = own.withColumns({"rule": rule, "said": said, "segments": shape(F.col("path"))})
    own = own.withColumn("key", F.to_json(F.struct("host", "segments")))
    own = written(own, "url-shapes")
    labelled, blocked = F.count("said").alias("labelled"), F.count_if(F.col("said") == "block").alias("blocked")
    shapes = own.groupBy("key").agg(F.first("host").alias("host"), F.first("segments").alias("segments"), F.count("*").alias("n"), labelled, blocked)
    found = templates(written(shapes, "url-counts"), tree)
    all_labelled, all_blocked = found.agg(F.sum("labelled"), F.sum("blocked")).first()
    prior = ((all_blocked or 0) + 1) / ((all_labelled or 0) + 2)
    sums = [F.sum(c).alias(c) for c in ("labelled", "blocked")]
    by_template = found.groupBy("host", "template").agg(*sums)
    hosts = by_template.groupBy(F.col("host").alias("h")).agg(F.sum("labelled").alias("host_labelled"), F.sum("blocked").alias("host_blocked"))
    of_host = (F.col("host_blocked") + tree.weight * prior) / (F.col("host_labelled") + tree.weight)
    purity = (F.col("blocked") + tree.weight * of_host) / (F.col("labelled") + tree.weight)
    judged = by_template.join(hosts, F.col("host") == F.col("h")).select(F.col("host").alias("h"), F.col("template").alias("tpl"), purity.alias("purity"))
    decided = found.join(judged, (F.col("host") == F.col("h")) & (F.col("template") == F.col("tpl"))).select("key", "template", "purity")
    met = attach(own, written(decided, "url-verdicts"), "key")
    verdict = F.coalesce("said", F.when(F.col("purity") >= tree.reject, "block").otherwise("allow"))
    return met.select("page_id", "host", "path", "template", "purity", "rule", verdict.alias("verdict"))
