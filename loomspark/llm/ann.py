"""Approximate nearest neighbours by cross-polytope hashing.

Each table rotates the unit vectors by three rounds of random signs and a fast Hadamard transform and hashes them to the
nearest signed axis; with many rows a table may join several such hashes. Every row is in every table. A query looks into
the cells of its nearest axes (multiprobe), and each cell ranks its rows exactly, by distance between the original
vectors; the tables' findings are merged. How many hashes and probes is chosen on the table itself: some queries are ranked
against all rows, and of the choices that find RECALL of their neighbours the one with the least work is taken. Cells larger than CELL rows are dealt into parts, queries of one cell likewise,
so neither a common vector nor a popular cell makes a large task. Queries that find fewer than k rows are searched
against all cells of one table, which is all rows.

Defined cases: null ids, null vectors, zero vectors and vectors with a null or non-finite component take no part; shorter
vectors count as filled up with zeros; a row with the query's id is the query's own; rows equal in id and components count
once; fewer candidates than k: all of them; no queries, no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import attach, written
from ._vectors import matrix, packed

#: Rows of a cell, and queries, that meet in one task at most, about; rows a cell should have, which bounds the hashes a table.
CELL, ASKED, AIM = 8192, 1024, 400
#: Share of the nearest rows to be found; queries, and rows, by which the choice is made; rows that are ranked in the time a query is sent to a cell.
RECALL, TRIED, SAMPLE, COPY = 0.95, 100, 1000, 100


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows, orthonormal; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def axes(unit: np.ndarray, tables: int, hashes: int, seed: int) -> np.ndarray:
    """Rotated coordinates against all signed axes: rows x tables x hashes x 2 * width."""
    width = 1 << max(0, unit.shape[1] - 1).bit_length()
    x = np.pad(unit, ((0, 0), (0, width - unit.shape[1])))
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, hashes, 3, width))
    out = np.empty((len(x), tables, hashes, 2 * width), np.float32)
    for t in range(tables):
        for h in range(hashes):
            y = x
            for s in signs[t, h]:
                y = hadamard(y * s)
            out[:, t, h, :width], out[:, t, h, width:] = y, -y
    return out


def probe_cells(near: np.ndarray, probes: int) -> np.ndarray:
    """Cells to look into, the likeliest first: rows x tables x probes ** hashes. near: as axes() gives it."""
    n, tables, hashes, wide = near.shape
    order = np.argsort(-near, axis=3)[..., :probes]
    gap = near.max(3, keepdims=True) - np.take_along_axis(near, order, 3)
    cells, cost = order[:, :, 0].astype(np.int64), gap[:, :, 0] ** 2
    for h in range(1, hashes):
        cells = (cells[..., None] * wide + order[:, :, h][:, :, None]).reshape(n, tables, -1)
        cost = (cost[..., None] + (gap[:, :, h] ** 2)[:, :, None]).reshape(n, tables, -1)
    return np.take_along_axis(cells, np.argsort(cost, axis=2, kind="stable"), 2)


def nearest(q: np.ndarray, q_id: int, v: np.ndarray, ids: np.ndarray, squares: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact distances of the k nearest rows other than the query's own, ties to the smaller id."""
    rough = squares - 2.0 * (v @ q) + q @ q
    rough[ids == q_id] = np.inf
    some = np.flatnonzero(ids != q_id)
    if len(some) > k:
        kth = np.partition(rough, k - 1)[k - 1]
        some = np.flatnonzero(rough <= kth + 1e-9 * (1.0 + abs(kth) + float(q @ q)))
    exact = np.sqrt(((v[some] - q) ** 2).sum(1))
    order = np.lexsort((ids[some], exact))[:k]
    return some[order], exact[order]


def probes_needed(asks: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Probes a hash with which each query looks into a cell of each row: queries x rows, for 1, 2, ... hashes. As axes() gives them."""
    places = np.empty(asks.shape, np.int32)
    np.put_along_axis(places, np.argsort(-asks, axis=3), np.arange(asks.shape[3], dtype=np.int32), 3)
    own = rows.argmax(3)
    out = np.empty((asks.shape[2], len(asks), len(rows)), np.int32)
    for q in range(len(asks)):
        at = np.take_along_axis(places[q][None], own[..., None], 3)[..., 0]  # rows x tables x hashes
        out[:, q] = np.maximum.accumulate(at, axis=2).min(1).T + 1
    return out


def chosen(own: DataFrame, rows: int, dim: int, k: int, query_every: int, tables: int, probes: int, hashes: int, seed: int) -> tuple[int, int]:
    """Hashes (at most ``hashes``) and probes (at least ``probes``) that find RECALL of the neighbours of some queries, for the least work."""
    asks = own.filter(F.col("vec_id") % query_every == 0).orderBy(F.xxhash64("vec_id"), "vec_id", "v").select("vec_id", "v").limit(TRIED).toArrow()
    if not len(asks):
        return 1, probes
    ids, q = asks.column("vec_id").to_pylist(), matrix(asks.column("v"), dim)

    def closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k nearest rows of each query among a task's."""
        best: list = [(np.empty(0, np.int64), np.empty((0, dim)))] * len(ids)
        for batch in batches:
            own_ids, v = np.array(batch.column(0)), matrix(batch.column(1), dim)
            squares = (v * v).sum(1)
            for n, (i, x) in enumerate(zip(ids, q, strict=True)):
                some, _ = nearest(x, i, v, own_ids, squares, k)
                all_ids, all_v = np.concatenate([best[n][0], own_ids[some]]), np.concatenate([best[n][1], v[some]])
                some, _ = nearest(x, i, all_v, all_ids, (all_v * all_v).sum(1), k)
                best[n] = all_ids[some], all_v[some]
        for n, (x, (found, v)) in enumerate(zip(q, best, strict=True)):
            score = np.sqrt(((v - x) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(found), pa.int32()), pa.array(found, pa.int64()), pa.array([y.tobytes() for y in v], pa.binary()), pa.array(score, pa.float64())], ["n", "vec_id", "v", "score"])

    order = Window.partitionBy("n").orderBy("score", "vec_id")
    near = own.select("vec_id", "v").mapInArrow(closest, "n int, vec_id long, v binary, score double").distinct()
    near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("n", "v").toArrow()
    if not len(near):
        return 1, probes
    some = own.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id", "v").select("v").limit(SAMPLE).toArrow()

    def hashed(v: np.ndarray) -> np.ndarray:
        return axes(v / np.sqrt((v * v).sum(1))[:, None], tables, hashes, seed)

    x, of = hashed(q), np.array(near.column("n"))
    pairs = hashed(matrix(near.column("v"), dim))
    true = np.concatenate([probes_needed(x[n : n + 1], pairs[of == n])[:, 0] for n in range(len(ids))], axis=1)
    any_row = probes_needed(x, hashed(matrix(some.column("v"), dim)))
    found = []
    for h in range(hashes):
        p = max(probes, int(np.sort(true[h])[math.ceil(RECALL * true.shape[1]) - 1]))
        found.append(((any_row[h] <= p).mean() * rows + COPY * tables * float(p) ** (h + 1), h + 1, p))
    return min(found)[1:]


def search(vectors: DataFrame, k: int, query_every: int, tables: int = 16, probes: int = 6, seed: int = 7, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found, by Euclidean distance, of each row whose id divides by ``query_every``; ``probes`` or more."""
    spark = vectors.sparkSession
    own = written(packed(vectors, id, vector, zero=False), "ann-vectors")
    rows, dim = own.agg(F.count("*"), F.max("dim")).first()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = 1 << max(0, dim - 1).bit_length()
    hashes = max(1, round(math.log(max(1, rows / AIM), 2 * width)))
    hashes, probes = chosen(own, rows, dim, k, query_every, tables, probes, hashes, seed)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a vector and table: its cell; for a query also the cells to look into, else none."""
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = matrix(part.column("v"), dim)
                near = axes(x / np.sqrt((x * x).sum(1))[:, None], tables, hashes, seed)
                mine = probe_cells(near, 1)[:, :, 0]
                ids = np.array(part.column("vec_id"))
                asks = ids % query_every == 0
                look: list = [None] * part.num_rows
                if asks.any():
                    for r, c in zip(np.flatnonzero(asks), probe_cells(near[asks], probes).tolist(), strict=True):
                        look[r] = c
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("v"), pa.array(mine.tolist(), pa.list_(pa.int64())), pa.array(look, pa.list_(pa.list_(pa.int64())))], ["vec_id", "v", "mine", "look"])

    hashed = written(own.select("vec_id", "v").mapInArrow(cells, "vec_id long, v binary, mine array<long>, look array<array<long>>"), "ann-hashed")
    placed = hashed.select("vec_id", "v", F.posexplode("mine").alias("t", "cell"))
    asked = hashed.filter("look is not null").select("vec_id", "v", F.posexplode("look").alias("t", "cells")).select("vec_id", "v", "t", F.explode("cells").alias("cell"))
    name = F.col("cell") * tables + F.col("t")  # of a cell, over all tables
    sizes = hashed.select(F.posexplode("mine").alias("t", "cell")).groupBy(name.alias("name")).count()
    crowds = asked.groupBy(name.alias("name_q")).count().withColumnRenamed("count", "q")
    plan = sizes.join(crowds, F.col("name") == F.col("name_q"), "left").select("name", F.ceil(F.col("count") / CELL).cast("int").alias("parts"), F.ceil(F.coalesce("q", F.lit(0)) / ASKED).cast("int").alias("q_parts"))
    plan = written(plan, "ann-cells")

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        """Rows of a cell (name, parts, q_parts, vec_id, v) and queries looking into it, dealt over the cell's parts."""
        ours = left.filter("q_parts > 0").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).withColumn("q_part", F.explode(F.expr("sequence(0, q_parts - 1)")))
        theirs = right.withColumn("q_part", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("q_parts")).cast("int")).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        keys = ["name", "part", "q_part"]

        def rank(ours: pa.Table, theirs: pa.Table) -> pa.Table:
            out: tuple[list, list, list] = ([], [], [])
            if len(ours) and len(theirs):
                ids, v = np.array(ours.column("vec_id")), matrix(ours.column("v"), dim)
                squares = (v * v).sum(1)
                for q_id, q in zip(theirs.column("vec_id").to_pylist(), matrix(theirs.column("v"), dim), strict=True):
                    some, exact = nearest(q, q_id, v, ids, squares, k)
                    out[0].extend([q_id] * len(some))
                    out[1].extend(ids[some].tolist())
                    out[2].extend(exact.tolist())
            return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

        cols = [F.col(c).alias(c) for c in (*keys, "vec_id", "v")]  # names of their own on either side
        return ours.select(*cols).groupBy(*keys).cogroup(theirs.select(*cols).groupBy(*keys)).applyInArrow(rank, "query_id long, vec_id long, score double")

    def merged(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.distinct().withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    left = attach(placed.select("vec_id", "v", name.alias("name")), plan, "name", how="inner")
    found = written(merged(meet(left, attach(asked.select("vec_id", "v", name.alias("name")), plan, "name", how="inner"))), "ann-found")
    queries = hashed.filter("look is not null").select("vec_id", "v")
    full = found.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = written(queries.join(full, "vec_id", "left_anti"), "ann-short")
    few = short.count()
    if not few:
        return found
    # All cells of the first table hold all rows.
    all_cells = plan.filter(F.col("name") % tables == 0).withColumn("q_parts", F.lit(math.ceil(few / ASKED)))
    every = attach(placed.filter("t = 0").select("vec_id", "v", name.alias("name")), all_cells, "name", how="inner")
    looked = short.withColumn("t", F.lit(0)).join(all_cells.withColumn("t", F.lit(0)), "t").drop("t")
    again = merged(meet(every, looked))
    return found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select("query_id", "rank", "vec_id", "score").unionByName(again)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the true (query_id, vec_id) pairs that were found."""
    pairs = ["query_id", "vec_id"]
    return exact.select(*pairs).join(found.select(*pairs), pairs, "left_semi").count() / max(1, exact.count())
