"""Records: defaults, trimming, namespaces, cohorts, ordered samples, audits and diagnostics of what an extraction produced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import once, strip
from .terms import ranked

#: Words for severities and their places; anything else is the middle.
SEVERITY = {"minor": 1, "moderate": 2, "significant": 3, "major": 4, "severe": 5}


def with_defaults(records: DataFrame, meta: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fields a record lacks, from its document's metadata; what a record has stays."""
    side = meta.select(F.col(key).alias("__key"), *[F.col(f).alias(f"__{f}") for f in fields])
    met = records.join(side, F.col(key) == F.col("__key"), "left")
    return met.withColumns({f: F.coalesce(F.col(f), F.col(f"__{f}")) for f in fields}).select(*records.columns)


def default_ids(records: DataFrame, by: str, position: str, id: str, prefix: str, name: str) -> DataFrame:
    """``name``: the record's id, or prefix-0001 by its place in the document where it has none."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(position))
    return records.withColumn(name, F.coalesce(F.nullif(F.col(id), F.lit("")), F.format_string(f"{prefix}-%04d", place)))


def severity(word: Column) -> Column:
    out = F.lit(3)
    for name, n in SEVERITY.items():
        out = F.when(F.lower(strip(word)) == name, n).otherwise(out)
    return out


def trimmed(records: DataFrame, aliases: dict[str, tuple[str, ...]], level: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Columns under one name each (the first alias that is filled), the severity as 1 to 5, and without the columns an ablation leaves out."""
    for name, options in aliases.items():
        records = records.withColumn(name, F.coalesce(*[F.nullif(F.trim(F.col(o)), F.lit("")) for o in options]))
    return records.withColumn(level, severity(F.col(level))).drop(*drop)


def overridden(df: DataFrame, overrides: DataFrame, key: str, field: str, marker: str = "null") -> DataFrame:
    """``field`` replaced for listed keys; the marker clears it. Overrides are written by hand: a few rows."""
    side = overrides.select(F.col(key).alias("__key"), F.col(field).alias("__new"))
    met = df.join(F.broadcast(side), F.col(key) == F.col("__key"), "left")
    new = F.when(F.col("__new") == marker, F.lit(None)).otherwise(F.coalesce(F.col("__new"), F.col(field).cast("string")))
    return met.withColumn(field, new).select(*df.columns)


def metadata(cells: dict[str, Column]) -> Column:
    """Map of the cells that are neither null nor blank; arrays are joined by commas."""
    whole = F.create_map(*[x for name, c in cells.items() for x in (F.lit(name), F.trim(c.cast("string")))])
    return F.map_filter(whole, lambda k, v: v.isNotNull() & (v != ""))


def whitelisted(values: Column, allowed: list[str], longest: int = 200) -> Column:
    """Map entries under allowed keys (case aside) that look like values: not empty, not over ``longest`` characters, in one line."""
    return F.map_filter(values, lambda k, v: F.lower(k).isin(*allowed) & (F.length(v) > 0) & (F.length(v) <= longest) & ~v.contains("\n"))


def namespaced(doc: Column, local: Column) -> Column:
    """A document's own event id, or array of them, as ids of the corpus."""
    return F.concat_ws("::", doc.cast("string"), local)


def requests(docs: DataFrame, text: str, least: int = 500, most: int = 500_000, marker: str = "\n[truncated]") -> DataFrame:
    """Documents worth a request: tiny ones are skipped, long ones cut and marked as cut."""
    own = F.when(F.length(text) > most, F.concat(F.left(F.col(text), F.lit(most)), F.lit(marker))).otherwise(F.col(text))
    return docs.filter(F.length(text) >= least).withColumn(text, own)


def dominant(df: DataFrame, cluster: str, category: str, least: int = 10, share: float = 0.5, most: int = 50) -> DataFrame:
    """(cluster, size, category, share): clusters of ``least`` rows and more whose largest category holds ``share`` or more, the largest ``most``."""
    counts = df.groupBy(F.col(cluster).alias("cluster"), F.col(category).alias("category")).agg(F.count("*").alias("n"))
    top = counts.groupBy("cluster").agg(F.sum("n").alias("size"), F.min_by(F.struct("category", "n"), F.struct((-F.col("n")).alias("n"), "category")).alias("t"))
    out = top.select("cluster", "size", "t.category", (F.col("t.n") / F.col("size")).alias("share")).filter((F.col("size") >= least) & (F.col("share") >= share))
    return out.orderBy(F.desc("size"), "cluster").limit(most)


def parse_query(text: str) -> tuple[str, dict[str, str]]:
    """Words and filters of a query like ``@corpus %role words``; of several filters of a kind the last counts."""
    filters, words = {}, []
    for token in text.split():
        if token[0] in "@%":
            filters["corpus" if token[0] == "@" else "role"] = token[1:]
        else:
            words.append(token)
    return " ".join(words), {k: v for k, v in filters.items() if v}


def predicate(filters: dict[str, str], absent: tuple[str, ...] = ()) -> Column:
    """All filters at once (none: every row); columns in ``absent`` have to be filled."""
    out = F.lit(True)
    for name, value in filters.items():
        out = out & (F.col(name) == value)
    for name in absent:
        out = out & (F.coalesce(F.col(name), F.lit("")) != "")
    return out


def merge_labels(records: DataFrame, labels: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Records with their labels and whether they were ``matched``."""
    side = labels.select(F.col(key).alias("__key"), *fields, F.lit(True).alias("__seen")).dropDuplicates(["__key"])
    return records.join(side, F.col(key) == F.col("__key"), "left").withColumn("matched", F.coalesce("__seen", F.lit(False))).drop("__key", "__seen")


def grouped(records: DataFrame, types: DataFrame, key: str, kind: str, least: int = 2) -> DataFrame:
    """Records with the type of their event ('unknown' where it has none), in groups of ``least`` records and more."""
    side = types.select(F.col(key).alias("__key"), F.col(kind).alias(kind))
    met = records.join(side, F.col(key) == F.col("__key"), "left").withColumn(kind, F.coalesce(kind, F.lit("unknown"))).drop("__key")
    sizes = records.groupBy(F.col(key).alias("__k")).agg(F.count("*").alias("__n")).filter(F.col("__n") >= least)
    return met.join(sizes, F.col(key) == F.col("__k"), "left_semi")


def layer_counts(layers: DataFrame, catalogue: DataFrame, orphan: str = "orphan") -> DataFrame:
    """(cluster, n): records assigned in any layer, orphans aside; a cluster without any counts the members it was founded with (``seeds``)."""
    counts = layers.filter(F.col("cluster") != orphan).groupBy("cluster").agg(F.count("*").alias("n"))
    return catalogue.join(counts, "cluster", "left").select("cluster", F.coalesce("n", F.size("seeds").cast("long")).alias("n"))


def tally(df: DataFrame, verdict: str, supported: str) -> DataFrame:
    """(verdict, n, share, supported_share): counts of verdicts, and the share of the supported one in all."""
    counts = df.groupBy(F.col(verdict).alias("verdict")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t"), F.sum(F.when(F.col("verdict") == supported, F.col("n")).otherwise(0)).alias("s"))
    return counts.join(F.broadcast(total)).select("verdict", "n", (F.col("n") / F.col("t")).alias("share"), (F.col("s") / F.col("t")).alias("supported_share"))


def escalation(df: DataFrame, kind: str, tiers: dict[str, tuple[str, ...]]) -> DataFrame:
    """(tier, n, share): rows whose kind is in a tier or an earlier one."""
    known: tuple[str, ...] = ()
    sums = {}
    for name, kinds in tiers.items():
        known += kinds
        sums[name] = F.count_if(F.col(kind).isin(*known))
    one = df.agg(F.count("*").alias("total"), *[c.alias(n) for n, c in sums.items()])
    return one.unpivot("total", list(sums), "tier", "n").select("tier", "n", (F.col("n") / F.col("total")).alias("share"))


def diagnostics(picks: DataFrame, pool: DataFrame, key: str) -> DataFrame:
    """One row: picks, distinct keys among them and in the pool, coverage, and the share of the most frequent key."""
    counts = picks.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    one = counts.agg(F.sum("n").alias("picks"), F.count("*").alias("keys"), F.max("n").alias("most"))
    return one.join(F.broadcast(pool.agg(F.count_distinct(key).alias("pool_keys")))).select("picks", "keys", "pool_keys", (F.col("keys") / F.col("pool_keys")).alias("coverage"), (F.col("most") / F.col("picks")).alias("top_share"))


def lengths(df: DataFrame, size: Column, filled: Column) -> DataFrame:
    """One row: n, min, max, mean, upper median and the share of rows where ``filled`` holds. The median comes from counts of equal sizes."""
    counts = df.groupBy(size.alias("s")).agg(F.count("*").alias("c"), F.count_if(filled).alias("f"))
    upto = F.sum("c").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0))  # a row a different size
    total = counts.agg(F.sum("c").alias("n"), F.min("s").alias("min"), F.max("s").alias("max"), (F.sum(F.col("s") * F.col("c")) / F.sum("c")).alias("mean"), (F.sum("f") / F.sum("c")).alias("filled"))
    at = counts.withColumn("upto", upto).join(F.broadcast(total.select("n"))).agg(F.min(F.when(F.col("upto") > F.floor(F.col("n") / 2), F.col("s"))).alias("median"))
    return total.join(F.broadcast(at)).select("n", "min", "max", "mean", "median", "filled")


def checklist(records: DataFrame, page: str, links: str, expected: int, fields: list[str]) -> DataFrame:
    """(check, status, value): seven checks of what a site's discovery found: anything at all, links, addresses, coverage, duplicates, several documents a record, metadata."""
    found = records.select(F.col(page).alias("p"), F.col(links).alias("l"), *fields)
    per = found.agg(
        F.count("*").alias("n"), F.count_if(F.size("l") > 0).alias("with_links"), F.count_if(F.col("p").rlike("^https?://[^/]+")).alias("valid"), F.count_distinct("p").alias("pages"),
        F.sum(F.size("l")).alias("links"), F.count_if(F.size("l") > 1).alias("several"), *[F.count_if(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) != "").alias(f"f_{k}") for k, f in enumerate(fields)],
    )
    distinct = found.select(F.explode("l").alias("u")).agg(F.count_distinct("u").alias("distinct_links"))
    ok = lambda good: F.when(good, "ok").otherwise("warning")
    n, share = F.col("n"), F.coalesce(F.least(*[F.col(f"f_{k}") for k in range(len(fields))]) if len(fields) > 1 else F.col("f_0"), F.lit(0)) / F.greatest(F.col("n"), F.lit(1))
    rows = {
        "discovery": (F.when(n > 0, "ok").otherwise("error"), n), "samples": (ok(F.col("with_links") > 0), F.col("with_links")), "addresses": (ok(F.col("valid") == n), F.col("valid")),
        "coverage": (ok(n >= 0.9 * expected), n / expected), "duplicates": (ok((F.col("pages") == n) & (F.col("distinct_links") == F.col("links"))), n - F.col("pages") + F.col("links") - F.col("distinct_links")),
        "several_documents": (F.lit("ok"), F.col("several")), "metadata": (ok(share >= 0.5), share),
    }
    cells = F.array(*[F.struct(F.lit(k).alias("check"), s.alias("status"), v.cast("double").alias("value")) for k, (s, v) in rows.items()])
    return per.join(F.broadcast(distinct)).select(F.explode(cells).alias("c")).select("c.*")


def seed_tiers(docs: DataFrame, by: str, title: Column, kind: Column, number: Column, size: Column, id: str, words: str = "synthesis", kinds: tuple[str, ...] = ()) -> DataFrame:
    """(by, id, tier): the document to start from: one whose title says so (1), else one of a wanted kind (2), else of those with a number in their series the highest (3), else the largest (4)."""
    tier = F.when(F.lower(title).contains(words), 1).when(kind.isin(*kinds), 2).when(number.isNotNull(), 3).otherwise(4)
    rows = docs.select(F.col(by).alias("by"), F.col(id).alias("id"), tier.alias("tier"), number.alias("number"), size.alias("size"))
    order = F.struct("tier", (-F.coalesce("number", F.lit(0))).alias("n"), (-F.col("size")).alias("s"), "id")
    return rows.groupBy("by").agg(F.min_by(F.struct("id", "tier"), order).alias("r")).select(F.col("by").alias(by), F.col("r.id").alias(id), "r.tier")


def scored_once(rows: DataFrame, by: list[str], score: Column, position: str) -> DataFrame:
    """Of rows with one number the best by score, the first of equals."""
    return ranked(rows.withColumn("__s", score), by, [F.desc("__s"), F.col(position)], 1, "__r").drop("__s", "__r")


def descent(curve: DataFrame, rank: str, value: str, back: int = 10) -> DataFrame:
    """(rank, value, rate): how much a falling curve lost a rank since ``back`` ranks before. For curves of labels or ranks, which are small."""
    w = Window.orderBy(rank)
    return curve.select(F.col(rank).alias("rank"), F.col(value).alias("value"), ((F.lag(value, back).over(w) - F.col(value)) / back).alias("rate"))


def phase_sample(records: DataFrame, by: str, position: str, phase: str, text: str, most: int = 6, cut: int = 200) -> DataFrame:
    """(by, rank, line): up to ``most`` lines a group, the first of each phase before further ones; blank texts and equal lines are left out."""
    line = F.concat(F.lit("["), F.coalesce(F.col(phase), F.lit("")), F.lit("] "), F.left(strip(F.col(text)), F.lit(cut)))
    rows = records.filter(F.coalesce(strip(F.col(text)), F.lit("")) != "").select(F.col(by).alias("by"), F.col(position).alias("pos"), F.coalesce(phase, F.lit("")).alias("phase"), line.alias("line"))
    first = rows.groupBy("by", "line").agg(F.min("pos").alias("pos"), F.min_by("phase", "pos").alias("phase"))
    heads = first.withColumn("again", (F.row_number().over(Window.partitionBy("by", "phase").orderBy("pos")) > 1).cast("int"))
    return ranked(heads, ["by"], [F.col("again"), F.col("pos")], most).select(F.col("by").alias(by), F.col("rank").cast("int").alias("rank"), "line")


def in_custom_order(value: Column, order: list[str], last: int = 99) -> Column:
    """Place of a value in a list, for sorting; what is not listed comes last."""
    at = F.array_position(F.array(*map(F.lit, order)), value)
    return F.when(F.coalesce(at, F.lit(0)) > 0, at.cast("int")).otherwise(last)


def year_or(text: Column, absent: int = 9999) -> Column:
    return F.coalesce(F.expr("try_cast(null as int)") if text is None else F.try_to_number(F.when(text.rlike(r"^\d{4}$"), text), F.lit("9999")).cast("int"), F.lit(absent))


def top_of(values: Column, most: int) -> Column:
    """The most frequent entries of an array as structs (n, value), ties by value."""

    def count(items: Column) -> Column:
        per = F.transform(F.array_distinct(items), lambda v: F.struct((-F.size(F.filter(items, lambda x: x == v))).alias("n"), v.alias("value")))
        return F.transform(F.slice(F.array_sort(per), 1, most), lambda s: F.struct((-s["n"]).alias("n"), s["value"].alias("value")))

    return once(values, count)


def noise_split(entries: DataFrame, flag: Column) -> tuple[DataFrame, DataFrame]:
    """Entries to keep, and those marked as noise."""
    return entries.filter(~F.coalesce(flag, F.lit(False))), entries.filter(F.coalesce(flag, F.lit(False)))


def append_new(known: DataFrame, proposed: DataFrame, key: str) -> DataFrame:
    """The known rows, and of the proposed ones those with a new name, one a name."""
    new = proposed.join(known.select(key).distinct(), key, "left_anti").dropDuplicates([key])
    return known.unionByName(new, allowMissingColumns=True)


def coverage_both(a: DataFrame, b: DataFrame, by: str, item: str) -> DataFrame:
    """(by, only_a, only_b, both): a class's items on either side."""
    met = a.select(by, item, F.lit(1).alias("a")).distinct().join(b.select(by, item, F.lit(1).alias("b")).distinct(), [by, item], "full")
    return met.groupBy(by).agg(F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both"))


def cached_cost(records: Column, calls: Column, prefix: Column, read: float, write: float, tokens_in: float, tokens_out: float, discount: float = 0.5, cache_write: float = 0.625, cache_read: float = 0.05) -> Column:
    """Cost of batch calls that share a cached prefix: fresh input, one write of the prefix, its reads by the other calls, and the output. Prices a million tokens; the cache's as shares of the input's."""
    fresh = F.greatest(records * tokens_in - calls * prefix, F.lit(0.0))
    return (fresh * read * discount + prefix * read * cache_write + (calls - 1) * prefix * read * cache_read + records * tokens_out * write * discount) / 1e6
