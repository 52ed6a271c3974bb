"""Statistics: association, stability, elbows, tiers, descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relate import running


def mutual_information(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, h_x, h_y, mi, nmi (by the smaller entropy, floored at 1e-9), base 2, from the contingency table."""
    cells = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").alias("n"))
    xs = cells.groupBy("x").agg(F.sum("n").alias("nx"))
    ys = cells.groupBy("y").agg(F.sum("n").alias("ny"))
    total = cells.agg(F.sum("n").alias("t"))
    p = F.col("n") / F.col("t")
    mi = cells.join(xs, "x").join(ys, "y").join(F.broadcast(total)).agg(F.sum("n").alias("n"), F.sum(p * F.log2(F.col("n") * F.col("t") / (F.col("nx") * F.col("ny")))).alias("mi"))
    entropy = lambda d, c: d.join(F.broadcast(total)).agg((-F.sum(F.col(c) / F.col("t") * F.log2(F.col(c) / F.col("t")))).alias(f"h_{c[1]}"))
    out = mi.join(F.broadcast(entropy(xs, "nx"))).join(F.broadcast(entropy(ys, "ny")))
    return out.select("n", "h_x", "h_y", "mi", (F.col("mi") / F.greatest(F.least("h_x", "h_y"), F.lit(1e-9))).alias("nmi"))


def distribution(df: DataFrame, column: str, high: float = 0.4, low: float = 0.05) -> DataFrame:
    """(value, n, share, flag) of the filled values, with dominant and rare ones flagged."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    out = counts.join(F.broadcast(counts.agg(F.sum("n").alias("t")))).withColumn("share", F.col("n") / F.col("t"))
    return out.select("value", "n", "share", F.when(F.col("share") > high, "dominant").when(F.col("share") < low, "rare").otherwise("").alias("flag"))


def describe(df: DataFrame, by: list[str], x: str) -> DataFrame:
    """Min, max, mean, sample deviation and the order statistics at floor(.1 n), floor(.5 n), floor(.9 n) of each group.

    Order statistics come from counts of equal values summed in value order, not from a list a group."""
    counts = df.filter(F.col(x).isNotNull()).groupBy(*by, F.col(x).alias("v")).agg(F.count("*").alias("c"))
    upto = running(counts, by, ["v"], F.col("c"), "upto")
    sums = df.groupBy(*by).agg(F.count(x).alias("n"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"))
    at = lambda q: F.min(F.when(F.col("upto") > F.least(F.floor(F.col("n") * q), F.col("n") - 1), F.col("v"))).alias(f"p{int(q * 100)}")
    met = upto.join(sums.select(*by, "n"), by)
    return sums.join(met.groupBy(*by).agg(at(0.1), at(0.5), at(0.9)), by)


def histogram(df: DataFrame, by: list[str]) -> DataFrame:
    """(size, groups): how many groups have how many rows."""
    return df.groupBy(*by).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("groups"))


def size_band(size: Column) -> Column:
    return F.when(size == 1, "1").when(size <= 5, "2-5").when(size <= 20, "6-20").otherwise(">20")


def tiers(share: Column) -> Column:
    return F.when(share >= 0.9, "universal").when(share >= 0.5, "common").when(share >= 0.2, "recurrent").when(share >= 0.04, "occasional").otherwise("rare")


def ensemble(df: DataFrame, run: str, label: str) -> DataFrame:
    """(label, runs, n_runs, share, tier): in what share of the runs a label occurs."""
    n = df.agg(F.count_distinct(run).alias("n_runs"))
    per = df.select(run, label).distinct().groupBy(F.col(label).alias("label")).agg(F.count("*").alias("runs"))
    out = per.join(F.broadcast(n)).withColumn("share", F.col("runs") / F.col("n_runs"))
    return out.select("label", "runs", "n_runs", "share", tiers(F.col("share")).alias("tier"))


def union_sizes(found: DataFrame, least: tuple[int, ...]) -> DataFrame:
    """(least_runs, labels): size of the vocabulary at each minimum number of runs."""
    one = found.agg(*[F.count_if(F.col("runs") >= k).alias(str(k)) for k in least])
    return one.unpivot([], [str(k) for k in least], "least_runs", "labels").select(F.col("least_runs").cast("int"), "labels")


def atomicity(df: DataFrame, run: str, label: str, cls: str) -> DataFrame:
    """(cls, runs, split_runs, most): runs in which a class holds two and more labels."""
    per = df.groupBy(F.col(cls).alias("cls"), run).agg(F.count_distinct(label).alias("k"))
    return per.groupBy("cls").agg(F.count("*").alias("runs"), F.count_if(F.col("k") >= 2).alias("split_runs"), F.max("k").alias("most"))


def split_half(df: DataFrame, run: str, label: str, seeds: int) -> DataFrame:
    """(seed, label, a, b, diff): label frequencies in two halves of the runs, split by md5 of seed and run."""
    seed = F.explode(F.sequence(F.lit(0), F.lit(seeds - 1)))
    half = F.substring(F.md5(F.concat_ws(":", F.col("seed").cast("string"), F.col(run).cast("string"))), 1, 1) < "8"
    runs = df.select(run).distinct().withColumn("seed", seed).withColumn("half", half)
    sizes = runs.groupBy("seed").agg(F.count_if("half").alias("n_a"), F.count_if(~F.col("half")).alias("n_b"))
    seen = df.select(run, F.col(label).alias("label")).distinct().join(F.broadcast(runs), run)
    per = seen.groupBy("seed", "label").agg(F.count_if("half").alias("k_a"), F.count_if(~F.col("half")).alias("k_b"))
    met = per.join(F.broadcast(sizes), "seed").filter("n_a > 0 and n_b > 0").withColumns({"a": F.col("k_a") / F.col("n_a"), "b": F.col("k_b") / F.col("n_b")})
    return met.select("seed", "label", "a", "b", F.abs(F.col("a") - F.col("b")).alias("diff"))


def _curve(counts: DataFrame, value: str, tie: str) -> DataFrame:
    """(i, y): values in falling order from 0; a curve of labels or ranks, which is small."""
    return counts.select(F.col(value).cast("double").alias("y"), (F.row_number().over(Window.orderBy(F.col(value).desc(), F.col(tie))) - 1).cast("int").alias("i"))


def kneedle(counts: DataFrame, value: str, tie: str) -> DataFrame:
    """(i, y): the point of a falling curve farthest from the chord of its ends, the first of equals."""
    c = _curve(counts, value, tie)
    ends = c.agg(F.max("i").alias("x1"), F.max("y").alias("y0"), F.min("y").alias("y1"))
    d = F.abs((F.col("y1") - F.col("y0")) * F.col("i") - F.col("x1") * F.col("y") + F.col("x1") * F.col("y0"))
    return c.join(F.broadcast(ends)).withColumn("d", d).agg(F.min_by(F.struct("i", "y"), F.struct((-F.col("d")).alias("d"), "i")).alias("r")).select("r.*")


def max_curvature(counts: DataFrame, value: str, tie: str, window: int = 5) -> DataFrame:
    """(i, y): the point of largest second difference over ``window`` places, clamped at the ends, the first of equals."""
    c = _curve(counts, value, tie)
    ends = c.agg(F.max("i").alias("last"))
    p = c.join(F.broadcast(ends)).withColumns({"a": F.greatest(F.col("i") - window, F.lit(0)), "b": F.least(F.col("i") + window, F.col("last"))}).filter("b - a >= 2").withColumn("m", F.floor((F.col("a") + F.col("b")) / 2).cast("int"))
    for k in "amb":
        other = c.select(F.col("i").alias(f"i_{k}"), F.col("y").alias(f"y_{k}"))
        p = p.join(other, F.col(k) == F.col(f"i_{k}"))
    v = F.abs(F.col("y_a") - 2 * F.col("y_m") + F.col("y_b"))
    return p.withColumn("v", v).agg(F.min_by(F.struct("i", "y"), F.struct((-F.col("v")).alias("v"), "i")).alias("r")).select("r.*")


def pair_jaccard(df: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """(by, pairs_a, pairs_b, both, jaccard) of two groupings of the same rows, from the contingency table: no pair is built."""
    two = lambda n: n * (n - 1) / 2
    cells = df.groupBy(*by, F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    both = cells.groupBy(*by).agg(F.sum(two(F.col("n"))).alias("both"))
    sums = [cells.groupBy(*by, k).agg(F.sum("n").alias("n")).groupBy(*by).agg(F.sum(two(F.col("n"))).alias(f"pairs_{k}")) for k in "ab"]
    met = both.join(sums[0], by).join(sums[1], by)
    union = F.col("pairs_a") + F.col("pairs_b") - F.col("both")
    return met.select(*by, "pairs_a", "pairs_b", "both", F.when(union > 0, F.col("both") / union).alias("jaccard"))


def upper_median(df: DataFrame, by: list[str], x: str) -> DataFrame:
    """(by, median): the value at place floor(n / 2) of each group."""
    return describe(df, by, x).select(*by, F.col("p50").alias("median"))


def trend(median: Column, corpus: Column, band: float = 1.5) -> Column:
    return F.when(median - corpus >= band, "rising").when(corpus - median >= band, "falling").otherwise("steady")
