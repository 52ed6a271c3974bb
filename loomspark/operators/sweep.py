"""The iterative sweep: classify a batch against the catalogue, group what is left over, add groups to the catalogue, repeat."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .graphs import close_pairs, components, nearest_rows

#: From (batch, catalogue) to (record, cluster or null); and from orphans to proposed (record, cluster).
Provider = tuple[Callable[[DataFrame, DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]


def nearest_seed_provider(least: float) -> Provider:
    """A provider without a model: the nearest catalogue vector at ``least`` cosine or more; orphans by components at the same cosine."""

    def classify(batch: DataFrame, catalogue: DataFrame) -> DataFrame:
        best = nearest_rows(batch.withColumnRenamed("record", "id"), catalogue.select(F.col("cluster").alias("id"), F.col("seed").alias("v")), least)
        return batch.select("record").join(best.select(F.col("id").alias("record"), F.col("nearest").alias("cluster")), "record", "left")

    def group(orphans: DataFrame) -> DataFrame:
        return components(close_pairs(orphans, least, "record", "v").select("a", "b")).select(F.col("node").alias("record"), F.col("component").alias("cluster"))

    return classify, group


#: Below this orphan rate, this batch size.
RAMP = ((0.15, 800), (0.3, 500), (0.5, 300))


def next_batch(rounds: list[tuple[int, int]], batch: int) -> int:
    """Batch size from the (orphans, records) of the rounds so far: larger ones the smaller the last three rounds' common orphan rate; ``batch`` before that."""
    if len(rounds) < 3:
        return batch
    orphans, records = (sum(x) for x in zip(*rounds[-3:], strict=True))
    return next((size for rate, size in RAMP if records and orphans / records < rate), batch)


def sweep(records: DataFrame, provider: Provider, batch: int, rounds: int, least: int = 3, ramp: bool = False) -> DataFrame:
    """(record, cluster, round): a cluster is named by its smallest record, whose vector is its seed; round 0 are the orphans.

    Batches follow the order of md5 of the record. The catalogue grows by clusters of ``least`` and more; each round is checkpointed. With
    ``ramp`` the batches grow as fewer records are left over (``next_batch``). A last pass gives the orphans another chance against the full catalogue, and ids the catalogue doesn't have count as orphans."""
    classify, group = provider
    order = F.md5(F.col("record").cast("string"))
    left = cut(records.withColumn("o", order))
    catalogue = records.sparkSession.createDataFrame([], f"cluster long, seed {records.schema['v'].dataType.simpleString()}")
    done, orphans, history = None, records.limit(0), []
    for r in range(1, rounds + 1):
        now = cut(left.orderBy("o").limit(next_batch(history, batch) if ramp else batch).select("record", "v")) if r < rounds else left.select("record", "v")
        found = cut(classify(now, catalogue).join(catalogue.select("cluster"), "cluster", "left_semi"))
        alone = now.join(found, "record", "left_anti")
        if ramp:
            history.append((alone.count(), now.count()))
        pool = cut(orphans.unionByName(alone))
        proposed = group(pool).join(pool.select("record"), "record", "left_semi")
        sizes = proposed.groupBy("cluster").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
        new = cut(proposed.join(sizes.select("cluster"), "cluster", "left_semi"))
        orphans = cut(pool.join(new, "record", "left_anti"))
        placed = found.select("record", "cluster").unionByName(new.select("record", "cluster")).withColumn("round", F.lit(r))
        done = placed if done is None else done.unionByName(placed)
        seeds = new.select(F.col("cluster")).distinct().join(records, F.col("cluster") == F.col("record")).select("cluster", F.col("v").alias("seed"))
        catalogue = cut(catalogue.unionByName(seeds))
        left = cut(left.join(now.select("record"), "record", "left_anti"))
    again = cut(classify(orphans, catalogue).filter("cluster is not null"))
    done = done.unionByName(again.withColumn("round", F.lit(rounds + 1)))
    return done.unionByName(orphans.join(again, "record", "left_anti").select("record", F.lit(None).cast("long").alias("cluster"), F.lit(0).alias("round")))


def residual(orphans: DataFrame, provider: Provider, least: int = 3) -> DataFrame:
    """(record, cluster) of what is left over, grouped once more: clusters of ``least`` and more, null for the singletons that remain. A record
    that is proposed for several clusters goes to the smallest."""
    orphans = cut(orphans)
    proposed = provider[1](orphans).join(orphans.select("record"), "record", "left_semi").groupBy("record").agg(F.min("cluster").alias("cluster"))
    large = proposed.groupBy("cluster").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("cluster")
    return orphans.select("record").join(proposed.join(large, "cluster", "left_semi"), "record", "left").select("record", "cluster")


def converge(records: DataFrame, provider: Provider, batch: int, first: int = 1, least: int = 3, seed: int = 2026) -> DataFrame:
    """(record, chunk, cluster, status) of singletons of a finished sweep: each chunk is classified against the clusters that earlier chunks of this run formed,
    and the rest of the chunk is grouped. Clusters are numbered on from ``first``; statuses are existing, new and singleton.

    Chunks follow the order of md5 of seed and record. A chunk's rest is not carried into the next. A driver loop, a job a chunk, as each
    chunk needs its predecessors' clusters; every chunk is checkpointed. No records give an empty table."""
    classify, _ = provider
    left = cut(records.withColumn("o", F.md5(F.concat(F.lit(f"{seed}:"), F.col("record").cast("string")))))
    kind = records.schema["v"].dataType.simpleString()
    catalogue = records.sparkSession.createDataFrame([], f"cluster long, seed {kind}")
    done = records.sparkSession.createDataFrame([], "record long, chunk int, cluster long, status string")
    for chunk in range(1, -(-left.count() // batch) + 1):
        now = cut(left.orderBy("o", "record").limit(batch).select("record", "v"))
        left = cut(left.join(now.select("record"), "record", "left_anti"))
        found = cut(classify(now, catalogue).join(catalogue.select("cluster"), "cluster", "left_semi").select("record", "cluster"))
        grouped = residual(now.join(found, "record", "left_anti"), provider, least)
        numbers = grouped.filter("cluster is not null").groupBy(F.col("cluster").alias("c")).agg(F.min("record").alias("founder"))
        numbers = cut(numbers.withColumn("number", F.row_number().over(Window.orderBy("founder")).cast("long") + (first - 1)))  # a row a cluster of one chunk
        new = grouped.join(numbers, F.col("cluster") == F.col("c"), "left").select("record", F.col("number").alias("cluster"))
        status = new.withColumn("status", F.when(F.col("cluster").isNull(), "singleton").otherwise("new")).unionByName(found.withColumn("status", F.lit("existing")))
        done = cut(done.unionByName(status.select("record", F.lit(chunk).alias("chunk"), "cluster", "status")))
        seeds = numbers.join(now, F.col("founder") == F.col("record")).select(F.col("number").alias("cluster"), F.col("v").alias("seed"))
        catalogue = cut(catalogue.unionByName(seeds))
        first += numbers.count()
    return done
