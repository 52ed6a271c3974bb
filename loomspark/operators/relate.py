"""Relational operators: stamping joins, deduplication, diffs, votes, ranks, pairs within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import url_path
from ..session import cut
from .terms import ranked


def same(left: list[Column], right: list[Column]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & (a == b)
    return out


def best(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row a group, the first by order; order should break all ties."""
    return ranked(df, by, order, 1, "__rank").drop("__rank")


def latest(df: DataFrame, by: list[str], position: list[str]) -> DataFrame:
    """The last row of each group by position, as an aggregate (partial sums before the shuffle, no sort)."""
    row = F.max_by(F.struct(*df.columns), F.struct(*position)).alias("r")
    return df.groupBy(*by).agg(row).select("r.*")


def union_first_wins(layers: list[DataFrame], key: str) -> DataFrame:
    """Union by name, absent columns null; of rows with one key that of the earliest layer."""
    out = None
    for k, df in enumerate(layers):
        df = df.withColumn("__layer", F.lit(k))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    cols = [c for c in out.columns if c != "__layer"]
    return out.groupBy(key).agg(F.min_by(F.struct(*[c for c in cols if c != key]), "__layer").alias("r")).select(key, "r.*")


def diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, change): new and removed keys of two snapshots."""
    a, b = old.select(key).distinct(), new.select(key).distinct()
    return b.join(a, key, "left_anti").withColumn("change", F.lit("new")).unionByName(a.join(b, key, "left_anti").withColumn("change", F.lit("removed")))


def coverage(expected: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """One row: missing, extra and duplicated keys, and how many are there."""
    counts = got.groupBy(key).agg(F.count("*").alias("n"))
    e = expected.select(key).distinct().withColumn("__e", F.lit(1))
    met = e.join(counts, key, "full")
    return met.agg(
        F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("__e").isNull()).alias("extra"),
        F.count_if(F.col("n") > 1).alias("duplicated"), F.count_if(F.col("n").isNotNull() & F.col("__e").isNotNull()).alias("present"),
    )


def majority(df: DataFrame, by: str, value: str, accept: float = 0.70) -> DataFrame:
    """(by, value, n, total, share, contested): the most frequent filled value, the smaller of equals; contested below ``accept``."""
    votes = df.filter(F.col(value).isNotNull() & (F.trim(value) != "")).groupBy(by, value).agg(F.count("*").alias("n"))
    out = votes.groupBy(by).agg(F.min_by(value, F.struct((-F.col("n")).alias("n"), value)).alias(value), F.max("n").alias("n"), F.sum("n").alias("total"))
    return out.withColumn("share", F.col("n") / F.col("total")).withColumn("contested", F.col("share") < accept)


def signal_groups(df: DataFrame, by: str, signal: Column, least: float = 0.5) -> DataFrame:
    """(by, n, hits, ratio): groups of which a share of ``least`` or more shows the signal."""
    out = df.groupBy(by).agg(F.count("*").alias("n"), F.count_if(signal).alias("hits")).withColumn("ratio", F.col("hits") / F.col("n"))
    return out.filter(F.col("ratio") >= least)


def pairs_within(df: DataFrame, group: list[str], item: str, least: int = 2, most: int = 30) -> DataFrame:
    """(a, b, n): in how many groups of ``least`` to ``most`` rows two different items occur together. Groups are counted first, so that only
    those within the band are gathered; pairs are built from a group's sorted distinct items, of which the band bounds the number."""
    band = df.groupBy(*[F.col(g).alias(f"__{g}") for g in group]).agg(F.count("*").alias("size")).filter(F.col("size").between(least, most))
    kept = df.select(*group, item).join(band, same([F.col(g) for g in group], [F.col(f"__{g}") for g in group]), "left_semi")
    sets = kept.groupBy(*group).agg(F.array_sort(F.collect_set(item)).alias("items"))
    pairs = F.flatten(F.transform("items", lambda x, i: F.transform(F.slice("items", i + 2, F.size("items")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    return sets.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def consensus(df: DataFrame, rep: str, group: str, item: str, least: int = 2) -> DataFrame:
    """(a, b, n): pairs of items that stand in one group in ``least`` or more repetitions. Items meet by their groups in each choice of ``least``
    repetitions, so that only pairs of the result are ever built, whatever a group's size."""
    own = df.select(F.col(item).alias("item"), F.concat_ws("\x01", F.col(rep).cast("string"), F.col(group).cast("string")).alias("g"))
    sets = own.groupBy("item").agg(F.array_sort(F.collect_set("g")).alias("groups"))  # a cell a repetition
    keys = F.transform("groups", lambda g: F.array(g))
    for _ in range(least - 1):
        keys = F.flatten(F.transform(keys, lambda k: F.transform(F.filter("groups", lambda g: g > F.element_at(k, -1)), lambda g: F.array_append(k, g))))
    met = sets.withColumn("key", F.explode(F.transform(keys, lambda k: F.array_join(k, "\x02"))))
    a, b = met.alias("a"), met.alias("b")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.item") < F.col("b.item")))
    return pairs.select(F.col("a.item").alias("a"), F.col("b.item").alias("b"), F.size(F.array_intersect("a.groups", "b.groups")).cast("long").alias("n")).distinct()


def running(df: DataFrame, by: list[str], order: list[str | Column], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` up to each row of its group, in order (which should break all ties). The rows are dealt by ranges of group and order
    and summed within each range; what earlier ranges hold of a group is added, so a group that holds most rows makes no large task."""
    placed = cut(df.withColumn("__value", value).repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id()))
    sums = placed.groupBy(*by, "__range").agg(F.sum("__value").alias("__sum"))  # a row a group and range it spans: as many as groups and ranges
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"__by{k}" for k in range(len(by))]
    base = cut(sums.select(*[F.col(b).alias(n) for b, n in zip(by, names, strict=True)], F.col("__range").alias("__of"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base")))
    within = F.sum("__value").over(Window.partitionBy("__range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    on = F.col("__range") == F.col("__of")
    for b, n in zip(by, names, strict=True):
        on = on & F.col(b).eqNullSafe(F.col(n))
    met = placed.withColumn("__within", within).join(F.broadcast(base) if base.count() <= 100_000 else base, on)
    return met.select(*df.columns, (F.col("__within") + F.col("__base")).alias(name))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, filled, total, share) by one scan and an unpivot of one row."""
    filled = [F.count(F.when(F.trim(F.col(c).cast("string")) != "", 1)).alias(c) for c in columns]
    one = df.agg(F.count("*").alias("total"), *filled)
    long = one.unpivot("total", columns, "column", "filled")
    return long.select("column", "filled", "total", (F.col("filled") / F.col("total")).alias("share"))


def duplicates(df: DataFrame, key: Column, id: str) -> DataFrame:
    """(key, n, first): keys that occur more than once."""
    return df.groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min(id).alias("first")).filter(F.col("n") > 1)


def as_of(events: DataFrame, by: str, time: list[str], value: Column, at: Column, name: str = "previous") -> DataFrame:
    """For each row where ``at`` holds, the last value at or before it among rows of the same ``by``: one sort, no join."""
    w = Window.partitionBy(by).orderBy(*time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.withColumn(name, F.last(value, ignorenulls=True).over(w)).filter(at)


def in_range(left: DataFrame, right: DataFrame, keys: Column, low: Column, x: Column, high: Column, how: str = "inner") -> DataFrame:
    """Range join within an equi-key: low <= x < high."""
    return left.join(right, keys & (x >= low) & (x < high), how)


def seed_walk(df: DataFrame, by: str, size: str, date: str, id: str) -> DataFrame:
    """Reading order of a group: its largest row first, then earlier rows backwards, then later ones (equal dates too), undated last."""
    seed = df.groupBy(F.col(by).alias("__g")).agg(F.max_by(F.struct(F.col(id).alias("i"), F.col(date).alias("d")), F.struct(F.col(size), (-F.col(id)).alias("i"))).alias("__s"))
    met = df.join(seed, F.col(by) == F.col("__g"))
    bucket = F.when(F.col(id) == F.col("__s.i"), 0).when(F.col(date).isNull() | F.col("__s.d").isNull(), 3).when(F.col(date) < F.col("__s.d"), 1).otherwise(2)
    back = F.when(bucket == 1, -F.unix_micros(F.col(date).cast("timestamp"))).otherwise(F.unix_micros(F.col(date).cast("timestamp")))
    order = Window.partitionBy(by).orderBy(bucket, back.asc_nulls_last(), F.col(id))
    return met.withColumn("bucket", bucket.cast("int")).withColumn("position", F.row_number().over(order).cast("int")).drop("__g", "__s")


def stratified(df: DataFrame, cell: list[str], per_cell: int, id: str, seed: int) -> DataFrame:
    """``per_cell`` rows of each cell in the order of md5 of seed and id: the same in any engine and partitioning."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id).cast("string")))
    return ranked(df.withColumn("__o", order), cell, [F.col("__o"), F.col(id)], per_cell).drop("__o")


def batches(df: DataFrame, id: str, value: Column, size: int) -> DataFrame:
    """(batch, n, content): rows in order of id, ``size`` a batch; ranks come from counts of ranges, not from one global sort."""
    spread = df.select(F.col(id).alias("id"), value.alias("v")).repartitionByRange(F.col("id")).sortWithinPartitions("id")
    placed = cut(spread.withColumn("p", F.spark_partition_id()))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("p").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))  # a row a partition
    rank = F.row_number().over(Window.partitionBy("p").orderBy("id")) + F.col("base")
    out = placed.join(F.broadcast(starts.select("p", "base")), "p").withColumn("batch", F.floor((rank - 1) / size).cast("int"))
    return out.groupBy("batch").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "v"))), lambda r: r["v"]), "\n").alias("content"))


def reconcile(members: DataFrame, pool: DataFrame, least: int = 3) -> DataFrame:
    """(cluster, record): members in the pool, each kept by its first cluster, clusters of ``least`` and more, numbered anew."""
    ok = members.join(pool.select("record"), "record", "left_semi").groupBy("record").agg(F.min("cluster").alias("cluster"))
    sizes = ok.groupBy(F.col("cluster").alias("c")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    numbered = sizes.withColumn("number", F.row_number().over(Window.orderBy("c")).cast("int"))  # a row a cluster
    return ok.join(numbered, F.col("cluster") == F.col("c")).select("cluster", "number", "record")


def prefix_dedupe(df: DataFrame, path: str) -> DataFrame:
    """Distinct paths that don't extend a shorter one by further segments. Each path looks up its own prefixes by equality; no
    pair of paths is compared."""
    paths = df.select(F.col(path).alias("path")).filter("path <> ''").distinct()
    parts = F.split("path", "/")
    heads = F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts) - 1, F.lit(2))), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    own = paths.filter(F.size(parts) > 2).select("path", F.explode(heads).alias("head"))
    longer = own.join(paths.select(F.col("path").alias("p")), F.col("head") == F.col("p"), "left_semi").select("path").distinct()
    return paths.join(longer, "path", "left_anti")


#: Paths of navigation, not of documents.
NAVIGATION = ("/about/", "/contact", "/careers/", "/search/", "/login/", "/privacy/", "/accessibility/")


def link_prefixes(df: DataFrame, url: str, id: str, landing: str = "", least: int = 3, samples: int = 5) -> DataFrame:
    """(prefix, n, samples): first two path segments that ``least`` urls and more have, and their first ``samples`` urls by id; without navigation
    and without what lies on the way to the landing page's path or below it. Urls of fewer than two segments have no prefix."""
    parts = F.filter(F.split(url_path(F.col(url)), "/"), lambda p: p != "")
    prefix = F.when(F.size(parts) >= 2, F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, 2), "/"), F.lit("/")))
    own = df.select(F.col(id).alias("id"), F.col(url).alias("url"), prefix.alias("prefix")).filter("prefix is not null")
    if landing:
        own = own.filter(~F.lit(landing).startswith(F.col("prefix")) & ~F.col("prefix").startswith(landing))
    for n in NAVIGATION:
        own = own.filter(~F.col("prefix").contains(n))
    counts = own.groupBy("prefix").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    first = ranked(own, ["prefix"], [F.col("id"), F.col("url")], samples).groupBy("prefix").agg(F.array_sort(F.collect_list(F.struct("rank", "url"))).alias("s"))
    return counts.join(first, "prefix").select("prefix", "n", F.transform("s", lambda r: r["url"]).alias("samples"))
