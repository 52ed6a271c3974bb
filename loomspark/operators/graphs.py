"""Connected components, vector search and clustering, sequential samplers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import dot, norm
from ..session import cut


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, component): smallest node reachable over edges (a, b); nodes (node) without edges are their own.

    Alternating large and small stars; each round's links are checkpointed, and rounds are logarithmic in the number of nodes."""
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = cut(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("n")).select(F.col("b").alias("x"), F.col("m").alias("y")).filter("x <> y").unionByName(low.select(F.col("n").alias("x"), F.col("m").alias("y")))
        new = cut(small.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
        if new.exceptAll(links).isEmpty() and links.exceptAll(new).isEmpty():
            break
        links = new
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    if nodes is None:
        return found
    own = nodes.select("node").distinct().join(found, "node", "left")
    return own.select("node", F.coalesce("component", "node").alias("component"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id: str, vector: str) -> DataFrame:
    """(id, score, rank): best cosine to any query, the k best rows. The queries are broadcast: they are what a user typed, a few rows."""
    q = queries.select(F.col(vector).alias("__q"), norm(F.col(vector)).alias("__nq"))
    scored = vectors.select(id, F.col(vector).alias("__v")).withColumn("__n", norm(F.col("__v"))).join(F.broadcast(q)).select(id, (dot(F.col("__v"), F.col("__q")) / (F.col("__n") * F.col("__nq"))).alias("score"))
    return scored.groupBy(id).agg(F.max("score").alias("score")).orderBy(F.desc("score"), id).limit(k)


def top_k_balanced(vectors: DataFrame, queries: DataFrame, group: str, per_group: int, k: int, id: str, vector: str) -> DataFrame:
    """As top_k, from the best ``per_group`` rows of each group."""
    q = queries.select(F.col(vector).alias("__q"), norm(F.col(vector)).alias("__nq"))
    scored = vectors.join(F.broadcast(q)).select(id, group, (dot(F.col(vector), F.col("__q")) / (norm(F.col(vector)) * F.col("__nq"))).alias("score"))
    best = scored.groupBy(id, group).agg(F.max("score").alias("score"))
    w = Window.partitionBy(group).orderBy(F.desc("score"), id)
    return best.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= per_group).drop("r").orderBy(F.desc("score"), id).limit(k)


def close_pairs(vectors: DataFrame, least: float, id: str, vector: str, block: int = 2048) -> DataFrame:
    """(a, b, cosine) of all pairs at ``least`` or more, a < b: vectors are packed into blocks of unit rows, a row a block, and each pair of blocks
    meets once and is multiplied as two matrices. The work is that of an exact all-pairs search, quadratic in the number of blocks."""
    spread = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    blocks = max(1, -(-spread.count() // block))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["v"].tolist())
        return pd.DataFrame([(key[0], pdf["id"].to_numpy().astype("<i8").tobytes(), (x / np.linalg.norm(x, axis=1, keepdims=True)).astype("<f8").tobytes())], columns=["block", "ids", "xs"])

    packed = cut(spread.groupBy("block").applyInPandas(pack, "block int, ids binary, xs binary"))
    left = packed.withColumn("other", F.explode(F.expr(f"sequence(block, {blocks - 1})")))
    right = packed.select(F.col("block").alias("other"), F.col("ids").alias("ids_b"), F.col("xs").alias("xs_b"))

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                i, j = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.ids_b, "<i8")
                x, y = np.frombuffer(r.xs, "<f8").reshape(len(i), -1), np.frombuffer(r.xs_b, "<f8").reshape(len(j), -1)
                a, b = np.nonzero(x @ y.T >= least - 1e-9)
                good = i[a] < j[b] if r.block == r.other else i[a] != j[b]
                a, b = a[good], b[good]
                out = pd.DataFrame({"a": np.minimum(i[a], j[b]), "b": np.maximum(i[a], j[b]), "cosine": (x[a] * y[b]).sum(1)})
                yield out[out["cosine"] >= least]

    return left.join(right, "other").select("block", "other", "ids", "xs", "ids_b", "xs_b").mapInPandas(near, "a long, b long, cosine double")


def nearest_rows(left: DataFrame, right: DataFrame, least: float, block: int = 2048) -> DataFrame:
    """(id, nearest, cosine) of each (id, v) of ``left`` with a row (id, v) of ``right`` at ``least`` or more; ties to the smaller id of ``right``.

    Both sides are packed into blocks of unit rows and each pair of blocks is multiplied as two matrices, of which the best of each left row goes on: nothing is
    broadcast, and a task holds two blocks. Vectors that are null, zero or hold nulls take no part."""

    def packed(df: DataFrame, name: str) -> tuple[DataFrame, int]:
        rows = cut(df.select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v")).filter("id is not null and v is not null and not exists(v, x -> x is null) and exists(v, x -> x <> 0)"))
        blocks = max(1, -(-rows.count() // block))

        def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            x = np.array(pdf["v"].tolist())
            return pd.DataFrame([(key[0], pdf["id"].to_numpy().astype("<i8").tobytes(), (x / np.linalg.norm(x, axis=1, keepdims=True)).astype("<f8").tobytes())], columns=[name, f"ids_{name}", f"xs_{name}"])

        dealt = rows.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        return cut(dealt.groupBy(name).applyInPandas(pack, f"{name} int, ids_{name} binary, xs_{name} binary")), blocks

    (a, _), (b, blocks) = packed(left, "a"), packed(right, "b")

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                i, j = np.frombuffer(r.ids_a, "<i8"), np.frombuffer(r.ids_b, "<i8")
                order = np.argsort(j)
                y = np.frombuffer(r.xs_b, "<f8").reshape(len(j), -1)[order]
                score = np.frombuffer(r.xs_a, "<f8").reshape(len(i), -1) @ y.T
                at = score.argmax(axis=1)  # the first of equals, the smallest id
                top = score[np.arange(len(i)), at]
                near = top >= least - 1e-9
                yield pd.DataFrame({"id": i[near], "nearest": j[order][at[near]], "cosine": top[near]})

    met = a.withColumn("b", F.explode(F.expr(f"sequence(0, {blocks - 1})"))).join(b, "b")
    found = met.select("ids_a", "xs_a", "ids_b", "xs_b").mapInPandas(best, "id long, nearest long, cosine double")
    top = F.max(F.struct("cosine", (-F.col("nearest")).alias("n")))
    return found.groupBy("id").agg(top.alias("t")).select("id", (-F.col("t.n")).alias("nearest"), F.col("t.cosine").alias("cosine"))


def kmeans(vectors: DataFrame, k: int, seed: int, rounds: int, id: str, vector: str) -> DataFrame:
    """(id, cluster): k-means by cosine."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    df = vectors.select(id, array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=rounds, distanceMeasure="cosine").fit(df)
    return model.transform(df).select(id, F.col("prediction").alias("cluster"))


def average_linkage(pdf: pd.DataFrame, least: float) -> pd.DataFrame:
    """(id, cluster) of one block of vectors (id, v): average linkage down to cosine ``least``; clusters by smallest id.

    Chains of nearest neighbours, which merge what the greedy order merges (but among ties): the mean cosine of two clusters is the product of their mean
    unit vectors, so a step is one product with all live means. Memory is linear in the block, time quadratic."""
    ids, x = pdf["id"].to_numpy(), np.array(pdf["v"].tolist(), float)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    n = len(x)
    up, own, sizes, dead, n_dead = np.arange(n), np.arange(n), np.ones(n), np.zeros(n, bool), 0
    chain: list[int] = []
    first = 0
    while n - n_dead > 1:
        if n_dead * 2 > n:
            to = np.cumsum(~dead) - 1
            chain = [int(to[c]) for c in chain]
            x, own, sizes = x[~dead], own[~dead], sizes[~dead]
            n, n_dead, dead, first = len(x), 0, np.zeros(len(x), bool), 0
        if not chain:
            while dead[first]:
                first += 1
            chain = [first]
        top = chain[-1]
        s = x @ x[top]
        s[dead] = -np.inf
        s[top] = -np.inf
        j = int(s.argmax())
        if len(chain) > 1 and s[chain[-2]] >= s[j] - 1e-12:  # sums differ by their order: no chain in circles
            j = chain[-2]
        if s[j] < least:  # nothing that others merge into comes nearer
            gone = chain.pop()
        elif len(chain) > 1 and j == chain[-2]:
            del chain[-2:]
            a, gone = min(j, top), max(j, top)
            x[a] = (x[a] * sizes[a] + x[gone] * sizes[gone]) / (sizes[a] + sizes[gone])
            sizes[a] += sizes[gone]
            up[own[gone]] = own[a]
        else:
            chain.append(j)
            continue
        dead[gone] = True
        n_dead += 1
    while (up[up] != up).any():
        up = up[up]
    low = pd.Series(ids).groupby(up).transform("min")
    return pd.DataFrame({"id": ids, "cluster": low.to_numpy()})


def linkage_clusters(vectors: DataFrame, least: float, block: str, id: str, vector: str) -> DataFrame:
    own = vectors.select(F.col(block).alias("block"), F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return own.groupBy("block").applyInPandas(lambda pdf: average_linkage(pdf, least), "id long, cluster long")


def nearest_tour(vectors: DataFrame, id: str, vector: str, start: int) -> DataFrame:
    """(position, id): greedy tour to the nearest unvisited vector. Inherently sequential; for small sets (a prompt's rows)."""

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, x = pdf["id"].to_numpy(), np.array(pdf["v"].tolist(), float)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        at, left, out = int(np.flatnonzero(ids == start)[0]), np.ones(len(ids), bool), []
        for p in range(len(ids)):
            out.append((p, ids[at]))
            left[at] = False
            s = np.where(left, x @ x[at], -np.inf)
            at = int(s.argmax())
        return pd.DataFrame(out, columns=["position", "id"])

    own = vectors.select(F.lit(1).alias("one"), F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return own.groupBy("one").applyInPandas(walk, "position int, id long")


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * longest common subsequence / (len a + len b)."""
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b))


def token_sort(name: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(name, r"\s+"), lambda w: w != "")), " ")


def segments_of(n: int, parts: int) -> list[tuple[int, int]]:
    """Starts and lengths of ``parts`` segments of a text of n characters, as even as can be."""
    return [(k * n // parts, (k + 1) * n // parts - k * n // parts) for k in range(parts)]


def fuzzy_keys(name: str, least: float) -> tuple[list[str], list[str]]:
    """Keys of a name as the shorter (or equal) of a pair, and as the longer: a pair at the ratio has an equal one.

    With lengths x <= y a ratio of ``least`` leaves d = (x + y) (1 - least / 100) characters that are inserted or deleted. Of d + 1 segments of the shorter one at least
    one therefore stands unchanged in the longer, moved by d places at most."""
    share, y = 1 - least / 100, len(name)
    distance = lambda m, n: int((m + n) * share + 1e-9)
    own = []
    for longer in range(y, int(y * (1 + share) / (1 - share) + 1e-9) + 1):
        d = distance(y, longer)
        if d < y:
            own += [f"{y}.{longer}.{k}.{name[a : a + n]}" for k, (a, n) in enumerate(segments_of(y, d + 1))]
        else:
            own.append(f"{y}.{longer}")
    other = set()
    for shorter in range(max(1, -int(-(y * (1 - share) / (1 + share)) // 1) - 1), y + 1):
        d = distance(shorter, y)
        if d < shorter:
            other |= {f"{shorter}.{y}.{k}.{name[p : p + n]}" for k, (a, n) in enumerate(segments_of(shorter, d + 1)) for p in range(max(0, a - d), min(y - n, a + d) + 1)}
        else:
            other.add(f"{shorter}.{y}")
    return own, sorted(other)


def fuzzy_pairs(names: DataFrame, least: float, id: str, name: str, apart: DataFrame | None = None) -> DataFrame:
    """(a, b, ratio): names (normalised) whose sorted tokens have an indel ratio of ``least`` or more, without the pairs (a, b) in ``apart``. Names meet by
    segments (fuzzy_keys), which loses no pair, and only names that share one are compared."""
    own = names.select(F.col(id).alias("id"), token_sort(F.col(name)).alias("s")).filter("s <> ''")

    @F.pandas_udf("shorter array<string>, longer array<string>")
    def keys(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fuzzy_keys(x, least) for x in s], columns=["shorter", "longer"])

    keyed = cut(own.withColumn("k", keys("s")))
    a = keyed.select(F.col("id").alias("x_id"), F.col("s").alias("x"), F.explode("k.shorter").alias("k"))
    b = keyed.select(F.col("id").alias("y_id"), F.col("s").alias("y"), F.explode("k.longer").alias("k"))
    met = a.join(b, "k").filter("x_id <> y_id").select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b"), F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    if apart is not None:
        gone = apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        met = met.join(gone, ["a", "b"], "left_anti")

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([indel_ratio(p, q) for p, q in zip(x, y, strict=True)])

    return met.withColumn("ratio", ratio("x", "y")).filter(F.col("ratio") >= least).select("a", "b", "ratio")


def greedy_classes(labels: DataFrame, run: str, position: str, name: str, least: float = 0.30, stop: frozenset[str] = frozenset()) -> DataFrame:
    """(run, name, cls): labels in order of run and position join the class whose first label's words (4 letters and more) are most alike, at
    ``least`` Jaccard or more, else found one. Sequential by definition; for the labels of an ensemble, not for documents."""
    import re

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        anchors: list[set[str]] = []
        out = []
        for r, n in pdf.sort_values(["run", "position"])[["run", "name"]].itertuples(index=False):
            t = {w.lower() for w in re.findall("[a-zA-Z]{4,}", n or "")} - stop
            score = [len(t & c) / max(len(t | c), 1) for c in anchors]
            k = int(np.argmax(score)) if score else -1
            if k < 0 or score[k] < least or score[k] == 0:
                anchors.append(t)
                k = len(anchors) - 1
            out.append((str(r), n, k))
        return pd.DataFrame(out, columns=["run", "name", "cls"])

    own = labels.select(F.lit(1).alias("one"), F.col(run).alias("run"), F.col(position).alias("position"), F.col(name).alias("name"))
    return own.groupBy("one").applyInPandas(fold, "run string, name string, cls int")


def diverse_sample(df: DataFrame, bucket: Column, diversify: Column, unique: Column, id: str, per_bucket: int, seed: int) -> DataFrame:
    """(id, bucket, step): up to ``per_bucket`` rows a bucket, bucket after bucket; in each first rows with both keys unseen anywhere so far, then
    with the unique key unseen, then any, in an order seeded by md5. An empty or null unique key is never seen.

    At most T = buckets * per_bucket keys are ever seen. So a first-step pick is among the first T + 1 keys of the other kind under each of its own two
    keys, and after that thinning among its bucket's first 2 T (T + 1) + 1 rows; a second-step pick is among the first T + 1 unique keys of its bucket, a third-step pick among
    its first T + 1 rows. The sequential part gets those rows only, whatever the size of the table, and loses none it could pick."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id).cast("string")))
    own = df.select(F.col(id).cast("long").alias("id"), bucket.cast("string").alias("bucket"), diversify.cast("string").alias("d"), F.nullif(unique.cast("string"), F.lit("")).alias("u"), order.alias("o"))
    own = cut(own.withColumn("k", F.coalesce(F.concat(F.lit("u"), F.col("u")), F.concat(F.lit("i"), F.col("id").cast("string")))))
    most = own.select("bucket").distinct().count() * per_bucket
    first = F.struct(F.col("o").alias("o"), F.col("id").alias("id"))

    def ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy("f")))

    pairs = own.groupBy("bucket", "d", "k").agg(F.min(first).alias("f"))
    pairs = ranked(ranked(pairs, ["bucket", "d"], "r"), ["bucket", "k"], "s").filter((F.col("r") <= most + 1) & (F.col("s") <= most + 1))
    step1 = ranked(pairs, ["bucket"], "n").filter(F.col("n") <= 2 * most * (most + 1) + 1)
    step2 = ranked(own.groupBy("bucket", "k").agg(F.min(first).alias("f")), ["bucket"], "n").filter(F.col("n") <= most + 1)
    step3 = ranked(own.withColumn("f", first), ["bucket"], "n").filter(F.col("n") <= most + 1)
    ids = step1.select("f.id").unionByName(step2.select("f.id")).unionByName(step3.select("f.id")).distinct()

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        seen_d, seen_u, out = set(), set(), []
        for name, rows in pdf.sort_values(["bucket", "o", "id"]).groupby("bucket", sort=True, dropna=False):
            taken: set[int] = set()
            for step in (1, 2, 3):
                for r in rows.itertuples(index=False):
                    if len(taken) >= per_bucket:
                        break
                    if r.id in taken or (step < 3 and r.u and r.u in seen_u) or (step == 1 and r.d in seen_d):
                        continue
                    taken.add(r.id)
                    seen_d.add(r.d)
                    if r.u:
                        seen_u.add(r.u)
                    out.append((r.id, name, step))
        return pd.DataFrame(out, columns=["id", "bucket", "step"])

    kept = own.join(ids, "id", "left_semi").drop("k").withColumn("one", F.lit(1))
    return kept.groupBy("one").applyInPandas(pick, "id long, bucket string, step int")
