"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

The words the mix shall have are shared over the sources by weight; a source's target stops at ``epochs`` times its
size and what it can't take goes to the others by their weights, until none is above. That fixpoint is
min(cap, level * weight), and the capped sources are a prefix of the sources in order of cap / weight, so it is found
with prefix sums over the table of sources instead of rounds. Each source then repeats its documents a whole number of
times, and gives a seeded fraction once more: documents in the order of a seeded hash, up to the target; the last of
these gives only the words still missing. Where that document is, is found by counting words by leading hash digits first
and then only among the documents of the cell that the target falls into, so that no task ever sees all rows of a source.

Defined cases: null text has size 0, a null source is a source of its own and comes last; rows of size 0 take 0; repeated
rows count as rows of their own and share a cut evenly; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import attach, word_count, written

#: Leading hash digits (of 15) by which words are counted first: 65,536 cells a source.
DIGITS = 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: tuple[int, int] = (3, 2), epochs: int = 2) -> DataFrame:
    """From (source, source_size): the same with ``target`` double.

    Weights repeat over the sources by code point, null last. ``share`` is the mix's size as a fraction of all sizes.
    All comparisons are exact, in decimals. Sources of size 0 get the target 0. One row a source: a few bytes each.
    """
    scale = 1
    for w in weights:
        scale *= w
    big = "decimal(38,0)"
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    up, rest = Window.orderBy("__ratio", F.col("source").asc_nulls_last()), Window.partitionBy()
    before, after = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(0, Window.unboundedFollowing)
    nth = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("__w", nth.cast("long")).withColumn("__cap", F.col("source_size") * epochs)
    ranked = ranked.withColumn("__ratio", F.col("__cap").cast(big) * (F.lit(scale).cast("long") / F.col("__w")).cast("long"))
    ranked = ranked.withColumns({
        "__all": F.sum("source_size").over(rest),
        "__caps": F.coalesce(F.sum("__cap").over(before), F.lit(0)),
        "__ws": F.sum("__w").over(after),
    })
    num, den = share
    left = F.col("__all").cast(big) * num - F.col("__caps").cast(big) * den  # den times the words still to share here
    ranked = ranked.withColumn("__capped", left * F.col("__w") >= F.col("__cap").cast(big) * den * F.col("__ws"))
    # Once one source is not capped, none after it is: the level is that of the first of them.
    free = F.when(~F.col("__capped"), F.struct("__ratio", "__caps", "__ws"))
    ranked = ranked.withColumn("__level", F.min(free).over(rest))
    shared = (F.col("__all") * num - F.col("__level.__caps") * den) * F.col("__w") / (F.col("__level.__ws") * den)
    return ranked.select("source", "source_size", F.when(F.col("__capped"), F.col("__cap").cast("double")).otherwise(shared.cast("double")).alias("target"))


def _crossed(sums: DataFrame, cell: str) -> DataFrame:
    """The cell of each source in which the running sum of ``__words`` reaches ``__need``; ``__need`` less what precedes it."""
    run = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = sums.withColumn("__to", F.sum("__words").over(run)).filter((F.col("__to") >= F.col("__need")) & (F.col("__to") - F.col("__words") < F.col("__need")))
    return at.select("source", cell, "__words", (F.col("__need") - F.col("__to") + F.col("__words")).alias("__need"))


def _cuts(sized: DataFrame, weights: tuple[int, ...], share: tuple[int, int], epochs: int) -> DataFrame:
    """For each source its size and target, ``whole`` repetitions, and the hash ``cut`` of the last document taken once
    more, of whose ``cut_size`` words ``cut_words`` are taken. cut is null where nothing is left to take."""
    cells = written(sized.groupBy("source", F.substring("__order", 1, DIGITS).alias("__cell")).agg(F.sum("size").alias("__words")), "mix-cells")
    targets = source_targets(cells.groupBy("source").agg(F.sum("__words").alias("source_size")), weights, share, epochs)
    size, target = F.col("source_size"), F.col("target")
    whole = F.when(size > 0, F.floor(target / size)).otherwise(0)
    plan = written(targets.withColumn("whole", whole.cast("long")).withColumn("__need", F.floor(target - F.col("whole") * size).cast("long")), "mix-plan")
    needs = plan.select("source", "__need").filter("__need > 0")
    first = _crossed(attach(cells, needs, "source", how="inner"), "__cell")
    near = attach(sized.filter("size > 0"), first.select("source", "__need", "__cell"), "source", how="inner").filter(F.col("__order").startswith(F.col("__cell")))
    found = _crossed(near.groupBy("source", "__need", "__order").agg(F.sum("size").alias("__words")), "__order")
    found = found.select(F.col("source").alias("__s"), F.col("__order").alias("cut"), F.col("__need").alias("cut_words"), F.col("__words").alias("cut_size"))
    return plan.drop("__need").join(found, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")


def _planned(docs: DataFrame, own: list[str], options: dict) -> DataFrame:
    """The columns ``own`` of docs with ``__source, __size, __order``, the plan of the source, and ``__taken``."""
    o = {"weights": (5, 2, 1), "share": (3, 2), "epochs": 2, "seed": 17, "doc_id": "doc_id", "text": "text", "source": "source"} | options
    order = F.substring(F.md5(F.concat(F.lit(f"{o['seed']}:"), F.coalesce(F.col(o["doc_id"]).cast("string"), F.lit("null")))), 1, 15)
    rows = docs.select(*own, F.col(o["source"]).alias("__source"), word_count(F.col(o["text"])).alias("__size"), order.alias("__order"))
    if o["text"] not in own:
        rows = written(rows, "mix-sizes")
        sized = rows
    else:
        sized = written(rows.select("__source", "__size", "__order"), "mix-sizes")
    sized = sized.select(F.col("__source").alias("source"), F.col("__size").alias("size"), "__order")
    cuts = written(_cuts(sized, o["weights"], o["share"], o["epochs"]), "mix-cuts")
    cuts = cuts.select(*[F.col(c).alias(f"__{c}") for c in cuts.columns])
    more = F.when(F.col("__order") < F.col("__cut"), F.col("__size")).when(F.col("__order") == F.col("__cut"), F.expr("__size * __cut_words div __cut_size")).otherwise(0)
    cuts = cuts.withColumnRenamed("__source", "__of")
    return attach(rows.withColumn("__of", F.col("__source")), cuts, "__of").withColumn("__taken", (F.col("__whole") * F.col("__size") + more).cast("long"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source, source_size, target, taken (words, repeats counted).

    Options and their defaults: weights (5, 2, 1), share (3, 2), epochs 2, seed 17, and the names of the columns doc_id, text, source."""
    out = _planned(docs.select(*{options.get(k, k): 0 for k in ("doc_id", "text", "source")}), [options.get("doc_id", "doc_id")], options)
    names = {"__size": "size", "__source": "source", "__source_size": "source_size", "__target": "target", "__taken": "taken"}
    return out.select(F.col(options.get("doc_id", "doc_id")).alias("doc_id"), *[F.col(k).alias(v) for k, v in names.items()])


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, a cut one once more if half of it or more is taken."""
    out = _planned(docs, docs.columns, options)
    times = F.when(F.col("__size") > 0, F.floor(F.col("__taken") / F.col("__size") + 0.5)).otherwise(0).cast("int")
    out = out.withColumn("__times", times).filter("__times > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)
