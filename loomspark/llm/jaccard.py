"""N-gram Jaccard join with signature trees.

A document's set holds the 64-bit hashes of its distinct word shingles; two documents link when 100 * shared >= t * all.

Documents that can link are brought together first. Sets of sizes x <= y that link differ in at most
d = (x + y) (1 - t) / (1 + t) shingles. The hash space is cut into bins, a power of two that follows from y; at most d bins then hold different
shingles, so among any d + 1 of a set's bins, taken in an order all sets share (fuller bins first), one is in the other
set's choice, equal in whole: the chosen bins' contents are the set's keys. (Sets that fill no more than d bins, which among larger ones are very
rare, use single shingles the same way; small sets always do.) Equal keys of sets of compatible sizes
are candidates; each task sends on only one entry for a run of sizes under a key, so a key that a third of all documents
have makes no large group. Candidates are gathered by connected components.

Shingles that many documents have, as of a line that a site repeats, come last in the order: else documents that have no more than such a line in
common would meet, and the more documents there are, the more of these would chain into one component. Any order that all sets share
gives the same links, so which shingles count as common is only looked up in a sample of documents.

Within a component the documents form a signature tree: nodes hold OR-combined token bitmaps (with the most tokens a
document has behind each bit) and the range of sizes. Two trees, or a tree with itself, are traversed together; a pair of nodes whose greatest
possible overlap is too small for their smallest sizes is pruned, as is a pair that is connected already, and what is left at the
leaves is verified on the whole sets. Components beyond BLOCK bytes are dealt into blocks and each pair of blocks is a task.

Defined cases: null or wordless text has an empty set, size 0, and links with nothing; a null id has a null component;
rows that share an id are one document for linking; repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import by_deal, is_small, lean, slices, written
from .components import components, stars

#: Set sizes from which bins are used; bytes of keys a task of the exchange gets about; bytes of text a verifying task gets about.
BINS_FROM, EXCHANGE, BLOCK = 64, 24 << 20, 8 << 20
#: Documents in which common shingles are looked for, about; of how many of these a common one is; the most that are kept, the most frequent ones; tasks that count.
SAMPLE, COMMON_FROM, COMMON_MOST, SAMPLE_DEALS = 16_384, 3, 65_536, 16
#: Children of a tree's node.
FAN = 16
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class _Words(dict):
    """Hash of each word met; bounded by clearing."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int, words: _Words) -> np.ndarray:
    """Sorted hashes of the distinct shingles of k words; of all words together if they are fewer."""
    found = text.encode("utf-8", "replace").translate(_LOWER).split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = min(k, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i])
    return np.unique(out)


def keys(s: np.ndarray, percent: int, common: np.ndarray | None = None) -> np.ndarray:
    """Keys of which two linking sets share at least one (see above). ``common``: sorted shingles that come last in the order."""
    n = len(s)
    if not n:
        return s
    often = np.zeros(n, bool)
    if common is not None and len(common):
        often = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
    most = n * 100 // percent  # the largest set it can link with
    out = []
    single = n < BINS_FROM
    if most >= BINS_FROM:
        differ = (n + most) * (100 - percent) // (100 + percent)
        for r in sorted({_level(max(n, BINS_FROM), percent), _level(most, percent)}):
            bins = s >> np.uint64(64 - r)
            starts = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
            counts = np.diff(np.r_[starts, n])
            key = _mix(np.add.reduceat(_mix(s), starts) + _mix(bins[starts] * np.uint64(64) + np.uint64(r)))
            if len(key) > differ + 1:
                order = np.uint64(127) - np.minimum(counts, 127).astype(np.uint64) + np.logical_and.reduceat(often, starts).astype(np.uint64) * np.uint64(128)
                order = (order << np.uint64(56)) | (key >> np.uint64(8))
                key = key[np.argpartition(order, differ)[: differ + 1]]
            out.append(key)
            single |= len(key) <= differ  # too few bins to be sure of an equal one
    if single:
        prefix = n - (n * percent + 99) // 100 + 1
        out.append(_mix(np.r_[s[~often], s[often]][:prefix] ^ np.uint64(0x5851F42D4C957F2D)))
    return np.concatenate(out)


def _level(larger: int, percent: int) -> int:
    return max(1, math.ceil(math.log2(1.25 * (2 * larger * (100 - percent) // (100 + percent) + 1))))


def links_needed(x: int, y: int, percent: int) -> int:
    """Shared shingles that sets of these sizes need."""
    return -(-percent * (x + y) // (100 + percent))


def _runs(key: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Entries (key, document, smallest size, largest size) joined into runs without a gap in compatible sizes; and the links
    of each entry to its run's first."""
    order = np.lexsort((doc, low, key))
    key, doc, low, high = key[order], doc[order], low[order], high[order]
    if not len(key):
        return key, doc, low, high, doc, doc
    new = np.r_[True, key[1:] != key[:-1]]
    group = np.cumsum(new)
    # Largest size so far under the same key: sizes stay below 2**31, so groups don't mix.
    reach = np.maximum.accumulate(group * (1 << 32) + high) - group * (1 << 32)
    first = new | np.r_[True, low[1:] * percent > reach[:-1] * 100]
    starts = np.flatnonzero(first)
    run = np.cumsum(first) - 1
    head = doc[starts][run]
    linked = head != doc
    return key[starts], doc[starts], low[starts], np.maximum.reduceat(high, starts), doc[linked], head[linked]


class SignatureTree:
    """Over sets in order of size: level 0 are the documents, each node above covers FAN nodes below."""

    def __init__(self, sets: list[np.ndarray], width: int):
        self.sets, bits = sets, np.uint64(64 - int(math.log2(width)))
        counts = np.zeros((len(sets), width), np.uint16)
        for k, s in enumerate(sets):
            counts[k] = np.minimum(np.bincount((_mix(s) >> bits).astype(np.int64), minlength=width), 65535)
        sizes = np.array([len(s) for s in sets])
        self.peaks, self.lows, self.highs = [counts], [sizes], [sizes]
        while len(self.peaks[-1]) > 1:
            at = np.arange(0, len(self.peaks[-1]), FAN)
            self.peaks.append(np.maximum.reduceat(self.peaks[-1], at, axis=0))
            self.lows.append(np.minimum.reduceat(self.lows[-1], at))
            self.highs.append(np.maximum.reduceat(self.highs[-1], at))


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x


def traverse(a: SignatureTree, b: SignatureTree, percent: int, base: int, union: _Union) -> Iterator[tuple[int, int]]:
    """Pairs of document places (in a, in b) that link and were not connected; b's places count from ``base`` in ``union``.
    A tree meets itself when a is b (base 0)."""
    stack = [(len(a.peaks) - 1, 0, len(b.peaks) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        if la == 0 and lb == 0:
            x, y = union.find(i), union.find(base + j)
            if x == y:
                continue
            n, m = len(a.sets[i]), len(b.sets[j])
            shared = np.intersect1d(a.sets[i], b.sets[j], assume_unique=True).size
            if n and m and 100 * shared >= percent * (n + m - shared):
                union.up[max(x, y)] = min(x, y)
                yield i, j
            continue
        # Open the higher node (both, when level): all pairs of their children, bounded at once.
        ca = range(i * FAN, min(i * FAN + FAN, len(a.peaks[la - 1]))) if la >= lb else range(i, i + 1)
        cb = range(j * FAN, min(j * FAN + FAN, len(b.peaks[lb - 1]))) if lb >= la else range(j, j + 1)
        na, nb = la - (la >= lb), lb - (lb >= la)
        lows_a, lows_b = a.lows[na][ca.start : ca.stop], b.lows[nb][cb.start : cb.stop]
        highs_a, highs_b = a.highs[na][ca.start : ca.stop], b.highs[nb][cb.start : cb.stop]
        fits = (highs_a[:, None] * 100 >= percent * lows_b[None]) & (highs_b[None] * 100 >= percent * lows_a[:, None])
        if a is b and na == nb:
            fits &= np.array(ca)[:, None] <= np.array(cb)[None]
            if na == 0:
                fits &= np.array(ca)[:, None] < np.array(cb)[None]
        if na == nb == 0 and fits.any():
            ra = np.array([union.find(x) for x in ca])
            rb = np.array([union.find(base + x) for x in cb])
            fits &= ra[:, None] != rb[None]
        x, y = np.nonzero(fits)
        if not len(x):
            continue
        overlap = np.minimum(a.peaks[na][ca.start + x], b.peaks[nb][cb.start + y]).sum(1, dtype=np.int64)
        need = -(-percent * (lows_a[x] + lows_b[y]) // (100 + percent))
        good = overlap >= need
        stack.extend((na, int(ca.start + p), nb, int(cb.start + q)) for p, q in zip(x[good][::-1], y[good][::-1], strict=True))


def _linked(group: list[tuple[int, int, np.ndarray]], percent: int) -> Iterator[tuple[int, int]]:
    """Links (enough to connect what links do) among (id, block, set) of one component; of two blocks only those across."""
    group.sort(key=lambda r: (len(r[2]), r[0]))
    widest = len(group[-1][2])
    width = min(4096, max(256, 1 << (2 * widest).bit_length()))
    blocks = sorted({r[1] for r in group})
    parts = [[r for r in group if r[1] == b] for b in blocks]
    trees = [SignatureTree([r[2] for r in p], width) for p in parts]
    union = _Union(len(group))
    a, b = (0, 0) if len(parts) == 1 else (0, 1)
    base = 0 if len(parts) == 1 else len(parts[0])
    for i, j in traverse(trees[a], trees[b], percent, base, union):
        yield parts[a][i][0], parts[b][j][0]


def common_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """Sorted hashes of the shingles that several documents of a sample of (doc_id, text) have. They only order keys: no link depends on them."""
    one_in = max(1, docs.count() // SAMPLE)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            for a, b in slices(batch.column(0), 8 << 20):
                s = np.concatenate([shingles(t.as_py(), k, words) for t in batch.column(0).slice(a, b - a)])
                yield by_deal(shingles=((s % np.uint64(SAMPLE_DEALS)).astype(np.int64), s[None]))

    def counted(group: pa.Table) -> pa.Table:
        found, n = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]), return_counts=True)
        often = n >= COMMON_FROM
        return pa.table([pa.array(found[often].view(np.int64)), pa.array(n[often])], ["shingle", "n"])

    some = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_in)) == 0).select("text")
    found = some.mapInArrow(lean(dealt), "deal int, shingles binary").groupBy("deal").applyInArrow(lean(counted), "shingle long, n long")
    found = found.orderBy(F.desc("n"), "shingle").limit(COMMON_MOST).select("shingle").toArrow()
    return np.sort(found.column(0).to_numpy().view(np.uint64))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the smallest id reachable by links, itself included."""
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    common = common_shingles(own, k)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch, (a, b) in ((x, y) for x in batches for y in slices(x.column(1), 8 << 20)):
            out: tuple[list, list, list] = ([], [], [])
            for t in batch.column(1).slice(a, b - a):
                s = shingles(t.as_py(), k, words)
                out[0].append(len(s))
                out[1].append(xxhash.xxh3_128_digest(s.tobytes()))
                out[2].append(keys(s, percent, common).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.binary(), pa.binary()), strict=True))], ["doc_id", "n", "same", "keys"])

    sets = written(own.mapInArrow(lean(described), "doc_id long, n long, same binary, keys binary"), "jaccard-sets")
    size = sets.agg(F.sum(F.length("keys"))).first()[0] or 0
    deals = max(4, math.ceil(size * 3 / EXCHANGE))
    schema = "deal int, entries binary, links binary"

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(b, np.uint64) for b in batch.column(2).to_pylist()]
            lengths = [len(x) for x in own]
            key = np.concatenate([*own, np.zeros(0, np.uint64)])
            doc = np.repeat(np.array(batch.column(0)), lengths)
            n = np.repeat(np.array(batch.column(1)), lengths)
            key, doc, low, high, a, b = _runs(key, doc, n, n, percent)
            a, b = stars(a, b)
            to = (key % np.uint64(deals)).astype(np.int64)
            yield by_deal(entries=(to, np.stack([key.view(np.int64), doc, low, high])), links=(a % deals, np.stack([a, b])))

    def met(group: pa.Table) -> pa.Table:
        e = np.concatenate([np.frombuffer(x, np.int64).reshape(4, -1) for x in group.column("entries").to_pylist()], axis=1)
        l = np.concatenate([np.frombuffer(x, np.int64).reshape(2, -1) for x in group.column("links").to_pylist()], axis=1)
        *_, a, b = _runs(e[0].view(np.uint64), e[1], e[2], e[3], percent)
        a, b = stars(np.r_[a, l[0]], np.r_[b, l[1]])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    known = sets.filter("doc_id is not null and n > 0")
    candidates = known.select("doc_id", "n", "keys").mapInArrow(lean(dealt), schema).groupBy("deal").applyInArrow(lean(met), "a long, b long")
    near = components(candidates)
    # One document stands for all with the same set; components of one set need no verifying.
    copies = written(known.groupBy("same").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").drop("copies"), "jaccard-copies")
    members = near.join(known.select(F.col("doc_id").alias("node"), "same", "n").distinct(), "node")
    members = members.groupBy("component", "same").agg(F.min("node").alias("id"), F.max("n").alias("n"))
    sums = members.groupBy(F.col("component").alias("c")).agg(F.count("*").alias("many"), F.sum(F.col("n") * 8).alias("bytes")).filter("many > 1")
    members = members.join(sums, F.col("component") == F.col("c")).select("id", "component", F.ceil(F.col("bytes") / BLOCK).cast("int").alias("blocks"), "bytes")
    members = written(members, "jaccard-members")
    light = written(members.select("component", "bytes", "blocks").distinct().filter("blocks = 1"), "jaccard-light")
    shares = max(1, math.ceil((light.agg(F.sum("bytes")).first()[0] or 0) / BLOCK))
    # Small components share tasks; of a large one each pair of its blocks is a task.
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    members = members.withColumn("block", block)
    pairs = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(F.transform(F.expr("sequence(0, blocks - 1)"), lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j"))))
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(shares))).otherwise(F.xxhash64("component", "p.i", "p.j"))
    placed = members.withColumn("p", F.explode(pairs)).select("id", "component", "block", task.alias("task"))
    placed = F.broadcast(placed) if is_small(placed) else placed  # a member of a large component has a row for each of its blocks
    texts = own.join(placed, own["doc_id"] == placed["id"]).select("task", "component", "block", "id", "text")

    def verified(group: pa.Table) -> pa.Table:
        words, found = _Words(), {}
        for c, b, i, t in zip(*(group.column(x) for x in ("component", "block", "id", "text")), strict=True):
            found.setdefault(c.as_py(), []).append((i.as_py(), b.as_py(), shingles(t.as_py(), k, words)))
        out = [pair for rows in found.values() for pair in _linked(rows, percent)]
        return pa.table([pa.array([p[x] for p in out], pa.int64()) for x in (0, 1)], ["a", "b"])

    reached = components(texts.groupBy("task").applyInArrow(lean(verified), "a long, b long"))
    reached = reached.select(F.col("node").alias("first"), F.col("component").alias("reached"))
    rows = sets.select("doc_id", "n", "same").join(copies, "same", "left").withColumn("first", F.when(F.col("n") > 0, F.coalesce("first", "doc_id")).otherwise(F.col("doc_id")))
    return rows.join(reached, "first", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "first")).alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The table with one document of each component left, that with the smallest id; of rows that share an id, one.
    Rows with a null id or an empty set link with nothing and stay."""
    found = written(jaccard_components(docs, k, percent, doc_id, text), "jaccard-found")
    gone = written(found.filter("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "jaccard-gone")
    gone = F.broadcast(gone) if is_small(gone) else gone
    kept = docs.join(gone, docs[doc_id] == gone["__gone"], "left_anti")
    again = found.filter("n_shingles > 0 and component_id = doc_id").groupBy("doc_id").count().filter("count > 1")
    if again.isEmpty():
        return kept
    again = written(again.select(F.col("doc_id").alias("__again")), "jaccard-again")
    once = docs.join(again, docs[doc_id] == again["__again"], "left_semi").filter(F.trim(F.coalesce(F.col(text), F.lit(""))) != "").dropDuplicates([doc_id])
    return kept.join(again, kept[doc_id] == again["__again"], "left_anti").unionByName(once)
