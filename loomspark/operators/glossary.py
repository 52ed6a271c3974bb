"""Glossaries and taxonomies: merging sources and entries, fingerprints, layered assignments, roll-ups through a hierarchy, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_sources(freq: DataFrame) -> DataFrame:
    """From (surface, pattern, n_mentions, n_docs, source) one row a surface: mentions summed, documents the maximum, patterns and sources listed."""
    return freq.groupBy("surface").agg(
        F.sum("n_mentions").alias("n_mentions"), F.max("n_docs").alias("n_docs"), F.min("pattern").alias("pattern"),
        F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"),
    )


def cluster_rollup(members: DataFrame, variants: int = 20) -> DataFrame:
    """From (cluster, surface, n_mentions, n_docs) one row a cluster: the most mentioned surface, sums, and the top variants. Variants are ranked before they are listed, so lists are bounded."""
    order = Window.partitionBy("cluster").orderBy(F.desc("n_mentions"), "surface")
    top = members.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= variants)
    listed = top.groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "surface"))), lambda x: x["surface"]), "; ").alias("variants"))
    sums = members.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("n_mentions").alias("n_mentions"), F.max("n_docs").alias("n_docs"), F.min_by("surface", F.struct((-F.col("n_mentions")).alias("n"), "surface")).alias("canonical"))
    return sums.join(listed, "cluster")


def merge_entries(layers: list[DataFrame], key: str = "term") -> DataFrame:
    """Union of glossary entries; of entries with one term the last layer's, columns absent from a layer null."""
    out = None
    for k, df in enumerate(layers):
        df = df.withColumn("__layer", F.lit(k))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    cols = [c for c in out.columns if c not in ("__layer", key)]
    return out.groupBy(key).agg(F.max_by(F.struct(*cols), "__layer").alias("r")).select(key, "r.*")


def verbose(entry: DataFrame) -> DataFrame:
    """Entries with long names from either vocabulary of keys."""
    names = {"term": "t", "expansion": "e", "category": "c", "definition": "d", "context": "x", "notes": "n", "uncertainty": "u"}
    have = set(entry.columns)
    pick = lambda long, short: F.coalesce(*[F.col(c) for c in (long, short) if c in have]) if {long, short} & have else F.lit(None)
    return entry.select(*[pick(long, short).alias(long) for long, short in names.items()])


def latest_assignments(layers: DataFrame, record: str = "record", cluster: str = "cluster", layer: str = "layer") -> DataFrame:
    """Each record's cluster in its last layer."""
    return layers.groupBy(record).agg(F.max_by(cluster, layer).alias(cluster), F.max(layer).alias(layer))


def as_of(catalogue: DataFrame, iteration: int, created: str = "created_iter") -> DataFrame:
    return catalogue.filter(F.col(created) < iteration)


def rollup_hierarchy(assignments: DataFrame, parents: DataFrame, themes: DataFrame) -> DataFrame:
    """(theme, parent, cluster, n) with subtotals (nulls) over record -> cluster -> parent -> theme; what has no parent or theme is 'unassigned'."""
    met = assignments.join(parents, "cluster", "left").join(themes, "parent", "left")
    met = met.select("record", "cluster", F.coalesce("parent", F.lit("unassigned")).alias("parent"), F.coalesce("theme", F.lit("unassigned")).alias("theme"))
    return met.rollup("theme", "parent", "cluster").agg(F.count("*").alias("n"))


def theme_audit(parents: DataFrame, themes: DataFrame) -> DataFrame:
    """(problem, parent): parents in no theme, in several, and parents of themes that don't exist."""
    counts = themes.groupBy("parent").agg(F.count("*").alias("n"))
    known = parents.select("parent").distinct()
    parts = {"uncovered": known.join(counts, "parent", "left_anti"), "duplicated": counts.filter("n > 1"), "unknown": counts.join(known, "parent", "left_anti")}
    out = None
    for name, df in parts.items():
        rows = df.select(F.lit(name).alias("problem"), "parent")
        out = rows if out is None else out.unionByName(rows)
    return out


def bridge(groups: DataFrame, members: str, values: DataFrame, key: str, value: str) -> DataFrame:
    """(group columns, value): distinct values of a group's members, by way of an array of their keys."""
    cols = [c for c in groups.columns if c != members]
    return groups.select(*cols, F.explode(members).alias(key)).join(values.select(key, F.explode(value).alias(value)), key).select(*cols, value).distinct()


def resolve(rows: DataFrame, candidates: list[tuple[Column, DataFrame, str]], path: str) -> DataFrame:
    """Rows with ``path`` from the first candidate that has one: each is (key of the row, table, its key column), an equi-join."""
    out, found = rows, F.lit(None).cast("string")
    for k, (key, table, name) in enumerate(candidates):
        side = table.groupBy(F.col(name).alias(f"__k{k}")).agg(F.min(path).alias(f"__p{k}"))
        out = out.join(side, key == F.col(f"__k{k}"), "left")
        found = F.coalesce(found, F.col(f"__p{k}"))
    return out.withColumn(path, found).select(*rows.columns, path)


def chain(df: DataFrame, by: str, position: str, item: str, name: str = "prior") -> DataFrame:
    """The item before each in its group's order."""
    return df.withColumn(name, F.lag(item).over(Window.partitionBy(by).orderBy(position)))


def compare_runs(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """One row: rows in both runs, equal values, and those in one run only."""
    met = a.select(key, F.col(value).alias("x")).join(b.select(key, F.col(value).alias("y"), F.lit(1).alias("in_b")), key, "full")
    both = F.col("x").isNotNull() & F.col("in_b").isNotNull()
    return met.agg(F.count_if(both).alias("common"), F.count_if(both & (F.col("x") == F.col("y"))).alias("equal"), F.count_if(F.col("in_b").isNull()).alias("only_a"), F.count_if(F.col("x").isNull()).alias("only_b"))


def inclusion(scores: DataFrame, label: str, run: str, score: str, thresholds: list[float]) -> DataFrame:
    """(threshold, label, in_runs, runs, verdict): in how many runs a label reaches each threshold; in all, in some, in none."""
    runs = scores.agg(F.count_distinct(run).alias("runs"))
    flags = [F.count_distinct(F.when(F.col(score) >= t, F.col(run))).alias(f"t{k}") for k, t in enumerate(thresholds)]
    each = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{k}").alias("in_runs")) for k, t in enumerate(thresholds)]))
    long = scores.groupBy(F.col(label).alias("label")).agg(*flags).select("label", each.alias("e")).select("label", "e.*")
    out = long.join(F.broadcast(runs))
    verdict = F.when(F.col("in_runs") == F.col("runs"), "all").when(F.col("in_runs") > 0, "some").otherwise("none")
    return out.select("threshold", "label", "in_runs", "runs", verdict.alias("verdict"))


def fingerprint(mentions: DataFrame, facts: DataFrame, doc: str, term: str, fact: str, most: int = 8, least: int = 1) -> DataFrame:
    """(term, name, n, obs_share, base_share, distinctiveness, rank): which values of a document's metadata a term's documents have more
    often than all documents; shares of the exploded values, so multi-valued cells count each."""
    base = facts.groupBy(F.col(fact).alias("name")).agg(F.count("*").alias("bn"))
    total = base.agg(F.sum("bn").alias("bt"))
    seen = mentions.select(doc, term).distinct().join(facts, doc).groupBy(F.col(term).alias("term"), F.col(fact).alias("name")).agg(F.count("*").alias("n"))
    of_term = seen.groupBy(F.col("term").alias("t")).agg(F.sum("n").alias("tn"))
    met = seen.filter(F.col("n") >= least).join(of_term, F.col("term") == F.col("t")).join(base, "name").join(F.broadcast(total))
    met = met.withColumns({"obs_share": F.col("n") / F.col("tn"), "base_share": F.col("bn") / F.col("bt")}).withColumn("distinctiveness", F.col("obs_share") / F.col("base_share"))
    order = Window.partitionBy("term").orderBy(F.desc(F.round("distinctiveness", 6)), F.desc("n"), "name")
    return met.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= most).select("term", "name", "n", "obs_share", "base_share", "distinctiveness", "rank")
