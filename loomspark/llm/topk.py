"""Exact top-k search by inner product, with vectors bucketed by length.

All vectors are grouped by length (norm) into buckets, each dealt into groups of bounded size; queries are packed into
blocks. A first look at the longest vectors gives each query a score that its k-th best reaches at least. Groups are dealt over
shelves and blocks over desks, of some MB each, and a task has one shelf and one desk: what is sent grows with groups times desks and
blocks times shelves, not with blocks times groups. A block visits a shelf's groups from the longest on, and a group only for the queries whose
length times the group's largest length reaches their score, which rises with what was found. Inside a group the
score becomes a local cosine threshold, score / (query length * largest length): where lengths alone cut the group (sorted by
length) short enough the query prunes by length, else by its largest coordinates, whose feasible range follows from the
threshold by Cauchy-Schwarz; queries of which a sample of the group shows that this would leave most of it are multiplied together.
What is left is verified by whole products, in integers.

Defined cases: null ids, null vectors and vectors with a null or non-finite component take no part; shorter vectors count as
filled up with zeros, so an empty vector scores 0; rows equal in id and components count once; a row with the query's id is the query's own; of several
query rows with one id the smallest vector is the query; sums beyond a long are clamped; no queries, no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import deal, lean, release, written
from ._vectors import matrix, packed

#: Vectors a group and queries a block hold about; buckets by length at most.
GROUP, BLOCK, BUCKETS = 4096, 512, 1024
#: Bytes a shelf of groups and a desk of blocks hold about; every how many vectors of a group pruning by coordinates is tried on.
TILE, STRIDE = 32 << 20, 32
#: Coordinates by which a query prunes; the share of a group below which length pruning is taken.
FOCUS, SHORT = 4, 0.25
_EXACT, _SHORT_EXACT = 2.0**53, 2.0**24
_LONG = (-(2**63), 2**63 - 1)
_SLACK = 1e-9


def quantise(x: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * x)


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where no partial sum can leave their whole numbers, else in Python's."""
    if float(np.abs(vectors).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, len(query)) < _EXACT:
        return (vectors @ query).astype(np.int64)
    whole = [int(x) for x in query]
    return np.array([min(max(sum(int(a) * b for a, b in zip(v, whole, strict=True)), _LONG[0]), _LONG[1]) for v in vectors], np.int64)


def all_products(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Integer inner products, a row a query: as floats that hold whole numbers where no partial sum can leave those, else in Python's."""
    bound = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1])
    if bound < _EXACT:
        kind = np.float32 if bound < _SHORT_EXACT else np.float64
        return queries.astype(kind) @ vectors.astype(kind).T
    return np.array([products(vectors, q) for q in queries], np.int64).reshape(len(queries), len(vectors))


def floors(scores: np.ndarray) -> np.ndarray:
    """Scores as doubles, never above them."""
    x = scores.astype(np.float64)
    return np.where(np.abs(x) < _EXACT, x, np.nextafter(x, -np.inf))


def survivors(unit: np.ndarray, norms: np.ndarray, query: np.ndarray, length: float, least: float) -> np.ndarray:
    """Places of a group's vectors (norms falling) that can score ``least``; unit: the vectors divided by their norms."""
    if least == -math.inf or length == 0 or norms[0] == 0:
        return np.arange(len(norms))
    if least > 0:
        # No vector shorter than least / length can reach it.
        within = int(np.searchsorted(-norms, -(least / length) * (1 - _SLACK), side="right"))
    else:
        within = len(norms)
    local = least / (length * norms[0])  # of cosines in this group; a longer vector needs no more than it
    if within <= SHORT * len(norms) or not 0 < local <= 1:
        return np.arange(within)
    direction = query / length
    focus = np.argsort(-np.abs(direction))[:FOCUS]
    spread = np.sqrt(np.maximum(0, 1 - local * local)) * np.sqrt(np.maximum(0, 1 - direction[focus] ** 2))
    cells = unit[:within][:, focus]
    # For cosines of at least `local`, a coordinate lies this near to local * direction (above, where direction is the larger cosine).
    low = np.where(direction[focus] > 0, direction[focus] * local - spread, -1.0)
    high = np.where(direction[focus] < 0, direction[focus] * local + spread, 1.0)
    return np.flatnonzero(((cells >= low - _SLACK) & (cells <= high + _SLACK)).all(1))


def tight(unit: np.ndarray, norms: np.ndarray, queries: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which queries prune a group well, by length or by coordinates, going by every STRIDE-th of its vectors."""
    unit, norms = unit[::STRIDE], norms[::STRIDE]

    def well(k: int) -> bool:
        return len(survivors(unit, norms, queries[k], float(lengths[k]), float(least[k]))) <= SHORT * len(norms)

    n = len(queries)
    if not any(map(well, range(0, n, 1 + n // 16))):  # none of some queries: none is tried
        return np.zeros(n, bool)
    return np.array(list(map(well, range(n))), bool)


def _kept(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query, by query, and how many those are for each entry."""
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]][: len(query)])
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    top = rank < k
    return query[top], ids[top], scores[top], rank[top]


def _pack(group: pa.Table) -> pa.Table:
    """One row of a group's distinct vectors, longest first (then by id), with ids and norms."""
    dim = max(group.column("dim").to_pylist())
    ids, v, norms = np.array(group.column("vec_id")), matrix(group.column("v"), dim), np.array(group.column("norm"))
    order = np.lexsort((*v.T[::-1], ids, -norms))
    ids, v, norms = ids[order], v[order], norms[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (v[1:] != v[:-1]).any(1)]
    return pa.table([pa.array([group.column("at")[0].as_py()], pa.int32()), *_row(ids[new], v[new], norms[new])], _PACKED_NAMES)


_PACKED, _PACKED_NAMES = "at int, dim int, kind string, ids binary, vs binary, norms binary", ["at", "dim", "kind", "ids", "vs", "norms"]


def _row(ids: np.ndarray, v: np.ndarray, norms: np.ndarray) -> list[pa.Array]:
    kind = "<i2" if np.abs(v).max(initial=0) < 2**15 else "<f8"
    return [pa.array([x], t) for x, t in ((v.shape[1], pa.int32()), (kind, pa.string()), (ids.astype("<i8").tobytes(), pa.binary()), (v.astype(kind).tobytes(), pa.binary()), (norms.astype("<f8").tobytes(), pa.binary()))]


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i = np.frombuffer(row["ids"], "<i8")
    return i, np.frombuffer(row["vs"], row["kind"]).reshape(len(i), row["dim"]).astype(np.float64), np.frombuffer(row["norms"], "<f8")


def _even(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, d - x.shape[1]))) if x.shape[1] < d else x for x in (a, b))


def top_k(vectors: DataFrame, k: int, query_every: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id divides by ``query_every``, the k highest integer products."""
    spark = vectors.sparkSession
    own = written(packed(vectors, id, vector, quantise), "topk-vectors")
    rows, longest, widest = own.agg(F.count("*"), F.max("norm"), F.max("dim")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not rows:
        return empty
    # Buckets by length: bounds at quantiles, as many as give groups of about GROUP rows but no more than BUCKETS.
    n = min(BUCKETS, math.ceil(rows / GROUP))
    bounds = np.array(sorted(set(own.agg(F.percentile_approx("norm", [j / n for j in range(1, n)], 10_000)).first()[0])) if n > 1 else [])

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("bucket", pa.array(np.searchsorted(bounds, np.array(batch.column(3)), side="left"), pa.int32()))

    placed = own.mapInArrow(bucketed, "vec_id long, v binary, dim int, norm double, bucket int")
    counts = {r["bucket"]: (r["n"], r["most"]) for r in placed.groupBy("bucket").agg(F.count("*").alias("n"), F.max("norm").alias("most")).collect()}  # at most BUCKETS rows
    parts = [math.ceil(counts.get(b, (0, 0))[0] / GROUP) for b in range(max(counts) + 1)]
    before = np.cumsum([0, *parts]).tolist()
    part = F.pmod(F.xxhash64("vec_id"), F.greatest(F.lit(1), F.element_at(F.lit(parts), F.col("bucket") + 1)))
    placed = placed.withColumn("at", (F.element_at(F.lit(before), F.col("bucket") + 1) + part).cast("int"))
    groups = written(placed.groupBy("at").applyInArrow(lean(_pack), _PACKED), "topk-groups")
    asked = own.filter(F.col("vec_id") % query_every == 0)
    blocks = max(1, math.ceil(asked.count() / BLOCK))
    asked = asked.withColumn("at", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    asked = written(asked.groupBy("at").applyInArrow(lean(_pack), _PACKED), "topk-blocks")
    seed = groups.filter(F.col("at") == before[max(counts)]).collect()  # one group: GROUP vectors about
    first = [r.asDict() for r in seed]
    longest_of = np.array([counts[b][1] for b, p in enumerate(parts) for _ in range(p)])
    per_tile = max(1, TILE // (2 * max(1, widest)))  # vectors
    shelves = max(math.ceil(before[-1] / max(1, per_tile // GROUP)), min(before[-1], deal(spark)))
    desks = math.ceil(blocks / max(1, per_tile // BLOCK))

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each block: the score each query's k-th best reaches, and the shelves to visit."""
        for batch in batches:
            for row in batch.to_pylist():
                ids, v, norms = _open(row)
                keep = np.r_[True, np.sort(ids)[1:] != np.sort(ids)[:-1]] if len(ids) else np.zeros(0, bool)
                order = np.lexsort((*v.T[::-1], ids))[keep]  # of rows with one id the smallest vector
                ids, v, norms = ids[order], v[order], norms[order]
                least = np.full(len(ids), -np.inf)
                for s_ids, s_v, _ in map(_open, first):
                    a, b = _even(s_v, v)
                    score = floors(all_products(a, b))
                    score[ids[:, None] == s_ids[None]] = -np.inf
                    if len(s_ids) >= k:
                        least = np.maximum(least, np.partition(score, len(s_ids) - k, axis=1)[:, len(s_ids) - k])
                to = sorted({g % shelves for g, m in enumerate(longest_of) if (norms * m * (1 + _SLACK) >= least).any()})
                yield pa.RecordBatch.from_arrays([pa.array([to], pa.list_(pa.int32())), pa.array([row["at"] % desks], pa.int32()), *_row(ids, v, norms), pa.array([least.astype("<f8").tobytes()], pa.binary())], ["to", "desk", *_PACKED_NAMES[1:], "least"])

    def verify(shelf: pa.Table, desk: pa.Table) -> pa.Table:
        try:
            return whole(shelf, desk)
        finally:
            release()

    def whole(shelf: pa.Table, desk: pa.Table) -> pa.Table:
        asking = []
        for row in desk.to_pylist():
            none = np.zeros(0, np.int64)
            asking.append([row, np.frombuffer(row["least"], "<f8").copy(), (none, none, none)])
        order = np.argsort(-longest_of[np.array(shelf.column("at"), np.int64)], kind="stable") if len(asking) else []
        for at in order:
            ids, v, norms = _open(shelf.slice(int(at), 1).to_pylist()[0])
            unit = v / np.where(norms > 0, norms, 1)[:, None]
            for block in asking:
                q_ids, q_v, q_norms = _open(block[0])
                least, (query, found, score) = block[1:]
                v_wide, q_v = _even(v, q_v)
                unit_wide = unit if v_wide is v else _even(unit, q_v)[0]
                some = np.flatnonzero(q_norms * norms[0] * (1 + _SLACK) >= least)
                if not len(some):
                    continue
                prunes = tight(unit_wide, norms, q_v[some], q_norms[some], least[some])
                new = [(query, found, score)]
                for q in some[prunes]:
                    left = survivors(unit_wide, norms, q_v[q], float(q_norms[q]), float(least[q]))
                    value = all_products(v_wide[left], q_v[q : q + 1])[0]
                    good = (value >= least[q]) & (ids[left] != q_ids[q])
                    new.append((np.full(good.sum(), q), ids[left][good], value[good].astype(np.int64)))
                if len(many := some[~prunes]):
                    value = all_products(v_wide, q_v[many])
                    x, y = np.nonzero(value >= least[many].astype(value.dtype if value.dtype == np.float32 else np.float64)[:, None])
                    good = ids[y] != q_ids[many[x]]
                    x, y = x[good], y[good]
                    new.append((many[x], ids[y], value[x, y].astype(np.int64)))
                query, found, score, rank = _kept(*(np.concatenate(c) for c in zip(*new, strict=True)), k)
                full = rank == k - 1
                least[query[full]] = np.maximum(least[query[full]], floors(score[full]))
                block[2] = (query, found, score)
        out = [(np.frombuffer(row["ids"], "<i8")[query], found, score) for row, _, (query, found, score) in asking]
        return pa.table([pa.array(np.concatenate([o[c] for o in out] or [np.zeros(0, np.int64)]), pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])

    ready = asked.mapInArrow(lean(plan), "to array<int>, desk int, dim int, kind string, ids binary, vs binary, norms binary, least binary")
    right = ready.select(F.explode("to").alias("shelf"), *ready.columns[1:])
    left = groups.withColumn("shelf", F.col("at") % shelves).withColumn("desk", F.explode(F.sequence(F.lit(0), F.lit(desks - 1))))
    found = left.groupBy("shelf", "desk").cogroup(right.groupBy("shelf", "desk")).applyInArrow(verify, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
