"""Removal of repeated strings, by merging Burrows-Wheeler transforms.

A byte goes where it is covered by a string of ``length`` bytes that also starts anywhere else, in the same or another text. Strings of words
(between ASCII white space) are found in the same pass, by the same steps over word hashes, to report passages that stand elsewhere too.

1. Every window of ``length`` symbols has an anchor, its smallest hash of half a window (the leftmost of equals), which depends on the window's
   symbols alone; consecutive windows with one anchor are a segment. Equal windows lie in segments with equal anchors at equal
   offsets, so segments meet by anchor hash. Segments equal in whole are repeated in whole, and one of them stands for all.
2. Where segments with one anchor differ, they are sorted out by suffix order. A task takes a MB of segments in shards; each
   shard has a Burrows-Wheeler transform over an alphabet of STEP-symbol strings (the string STEP places before each suffix, in the order of the
   suffixes' first ROUNDS strings). The shards' transforms are merged by refining their interleave (Holt and McMillan, 2014): in round j the
   interleave is right for the first j strings, and carrying it through the transforms makes it right for j + 1 (suffixes that no window's start will
   reach any more drop out). No suffix is compared with one of another shard. Of neighbours in the merged order the common prefix is taken (as Egidi and
   Manzini, 2017, but from the final order); an interval within which it is ROUNDS or more is a string and all its places. What ``length``
   leaves beyond ROUNDS strings is covered by a second interval at the window's end.
3. Under an anchor with more than MANY different segments, which would make a large task, each window is a segment of its own
   and goes through step 1 by its own hash: equal windows are then counted, with copies joined before they are sent.

Texts are known by digest, so copies of a text share one result: past step 1, one of them is sent and merged, and each place is held once. Documents without repeated segments never move.

Defined cases: null and empty texts have 0 bytes and nothing removed; texts shorter than ``length`` keep all; repeated rows repeat each other,
so rows of ``length`` bytes and more lose everything; null ids are passed through; an empty table gives an empty table; a length below 8 or beyond CHUNK is an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import by_deal, lean, written
from .jaccard import _mix, _Words

#: Strings a window is cut into.
ROUNDS = 8
#: Symbols of a text handled at once; bytes of entries a task of the exchange gets about; of segments a merging task and one of its shards get about.
CHUNK, EXCHANGE, TASK, SHARD = 1 << 20, 24 << 20, 1 << 20, 256 << 10
#: Different segments under one anchor up to which they are merged in one task.
MANY = 400


@dataclass(frozen=True)
class Unit:
    """Windows of ``length`` bytes, or words; ``number`` tells the units of one pass apart."""

    length: int
    words: bool = False
    number: int = 0

    def __post_init__(self):
        if not ROUNDS <= self.length <= CHUNK:
            raise ValueError(f"length {self.length} is not within {ROUNDS} and {CHUNK}")

    @property
    def gram(self) -> int:
        return self.length // 2

    @property
    def step(self) -> int:
        return self.length // ROUNDS

    @property
    def width(self) -> int:
        return 8 if self.words else 1

    def codes(self, raw: bytes, known: _Words) -> np.ndarray:
        """The symbols of a text: its bytes, or the hashes of its words."""
        if not self.words:
            return np.frombuffer(raw, np.uint8)
        found = raw.split()
        return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


@dataclass(frozen=True)
class Places:
    """Packed places: first start, number of windows less one, unit, and whether the entry stands for several."""

    span: int

    @staticmethod
    def of(units: list[Unit]) -> Places:
        return Places(max((u.length - u.gram).bit_length() for u in units) + 2)

    def pack(self, s: np.ndarray, e: np.ndarray, unit: int) -> np.ndarray:
        return (s.astype(np.int64) << self.span) | ((e - s).astype(np.int64) << 2) | unit << 1

    def open(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First starts, numbers of windows, units."""
        return p >> self.span, (p >> 2 & (1 << self.span - 2) - 1) + 1, p >> 1 & 1


class Powers:
    """Polynomial hashes modulo 2**64 of all strings of one length in a text, and their tables of powers."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = np.uint64(int(rng.integers(1 << 61, 1 << 62)) * 4 + 3 & (1 << 64) - 1)
        self.up = self.down = np.ones(1, np.uint64)

    def strings(self, raw: np.ndarray, n: int) -> np.ndarray:
        size = len(raw) + 1
        if size > len(self.up):
            size = max(size, 1 << 16)
            inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)]) for b in (self.base, inverse))
        run = np.zeros(len(raw) + 1, np.uint64)
        values = self.values[raw] if raw.dtype == np.uint8 else _mix(raw + self.values[0])
        np.cumsum(values * self.up[: len(raw)], out=run[1:])
        return _mix((run[n:] - run[: len(run) - n]) * self.down[: len(run) - n])


def segments(codes: np.ndarray, unit: Unit, powers: Powers) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor hashes, content hashes, first and last window starts of a text's segments; chunk by chunk."""
    length, wide = unit.length, unit.length - unit.gram + 1
    for at in range(0, max(0, len(codes) - length + 1), CHUNK):
        part = codes[at : at + CHUNK + length - 1]
        g = powers.strings(part, unit.gram)
        mask = np.uint64((1 << 24) - 1)
        key = (g & ~mask) | np.arange(len(g), dtype=np.uint64)
        blocks = -(-len(key) // wide)
        grid = np.full(blocks * wide, np.iinfo(np.uint64).max)
        grid[: len(key)] = key
        grid = grid.reshape(blocks, wide)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(key) - wide + 1
        anchor = (np.minimum(behind[:windows], ahead[wide - 1 : wide - 1 + windows]) & mask).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:] - 1, windows - 1]
        own = anchor[first]
        view, w = memoryview(np.ascontiguousarray(part)).cast("B"), unit.width
        content = np.fromiter((xxhash.xxh3_64_intdigest(view[a * w : (b + length) * w], c - a) for a, b, c in zip(first.tolist(), last.tolist(), own.tolist(), strict=True)), np.uint64, len(first))
        yield _mix(g[own] + np.uint64(unit.number)), content, first + at, last + at


def collapse(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries (anchor, content, text high, text low, place; 5 x n) with one left of equal ones, marked; and the equal ones themselves."""
    if not e.shape[1]:
        return e, e[2:]
    e = e[:, np.lexsort((e[4], e[1], e[0]))]
    new = np.r_[True, (e[0, 1:] != e[0, :-1]) | (e[1, 1:] != e[1, :-1])]
    at = np.flatnonzero(new)
    several = np.add.reduceat((e[4] & 1) + 1, at) > 1
    own = np.repeat(several, np.diff(np.r_[at, e.shape[1]])) & (e[4] & 1 == 0)
    kept = e[:, at].copy()
    kept[4] |= several
    return kept, _distinct(e[2:, own])


def _distinct(found: np.ndarray) -> np.ndarray:
    """Columns of (text high, text low, place), one of equal ones: copies of a text give the same."""
    found = found[:, np.lexsort((found[2], found[1], found[0]))]
    return found[:, np.r_[True, (found[:, 1:] != found[:, :-1]).any(0)][: found.shape[1]]]


def _by_text(found: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """Text key and packed columns of each text among (text high, text low, more ...)."""
    if not found.shape[1]:
        return
    found = found[:, np.lexsort((found[1], found[0]))]
    at = np.flatnonzero(np.r_[True, (found[0, 1:] != found[0, :-1]) | (found[1, 1:] != found[1, :-1])])
    for a, b in zip(at, [*at[1:], found.shape[1]], strict=True):
        yield found[:2, a].tobytes(), found[2:, a:b].tobytes()


def _exchange(entries: DataFrame, deals: int, many: int, units: list[Unit]) -> DataFrame:
    """Rows (text binary, kind, places binary): kind 0 are places repeated in whole (1 x n); 1 and 2 are segments still to be told
    apart (place, anchor; 2 x n), under an anchor with few or with many different ones. entries: (entries) binary. size: bytes of the segments."""
    packing = Places.of(units)

    def size(places: bytes) -> int:
        _, n, u = packing.open(np.frombuffer(places, np.int64).reshape(2, -1)[0])
        return sum(int((n[u == x.number] - 1 + x.length).sum()) * x.width for x in units)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in (x for batch in batches for x in batch.column(0)):
            kept, found = collapse(np.frombuffer(cell.as_buffer(), np.int64).reshape(5, -1))
            to, found_to = ((x[0].view(np.uint64) % np.uint64(deals)).astype(np.int64) for x in (kept, found))
            yield by_deal(entries=(to, kept), found=(found_to, found))

    def met(group: pa.Table) -> pa.Table:
        e = np.concatenate([np.frombuffer(x, np.int64).reshape(5, -1) for x in group.column("entries").to_pylist()], axis=1)
        old = np.concatenate([np.frombuffer(x, np.int64).reshape(3, -1) for x in group.column("found").to_pylist()], axis=1)
        kept, found = collapse(e)
        rows = [(t, 0, p, 0) for t, p in _by_text(_distinct(np.concatenate([old, found], axis=1)))]
        if kept.shape[1] and many:
            at = np.flatnonzero(np.r_[True, kept[0, 1:] != kept[0, :-1]])
            n = np.diff(np.r_[at, kept.shape[1]])
            n = np.repeat(n, n)
            for kind, own in ((1, (n > 1) & (n <= many)), (2, n > many)):
                rows += [(t, kind, p, size(p)) for t, p in _by_text(kept[:, own][[2, 3, 4, 0]])]
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.int32(), pa.binary(), pa.int64()))], ["text_key", "kind", "places", "size"])

    return entries.mapInArrow(lean(dealt), "deal int, entries binary, found binary").groupBy("deal").applyInArrow(lean(met), "text_key binary, kind int, places binary, size long")


def in_order(x: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers from 0, by sorting them with their places packed in, which is much faster where both fit."""
    bits = len(x).bit_length()
    if int(x.max(initial=0)).bit_length() + bits > 63:
        return np.argsort(x, kind="stable")
    return np.sort(x << bits | np.arange(len(x))) & (1 << bits) - 1


class ShardTransform:
    """Order and transform of one shard: ``order`` of its suffixes by their first ROUNDS strings, ``before`` each the string a step
    earlier (-1: none), and how many strings each has ahead (``reach``). place, reach: within the segment; symbols: numbers of the strings."""

    def __init__(self, symbols: np.ndarray, place: np.ndarray, reach: np.ndarray, step: int):
        at = np.arange(len(symbols))
        rank, known = symbols, 1
        while known < ROUNDS:  # doubling: by 2, 4, 8 strings
            further = reach > known
            pair = rank * (int(rank.max(initial=0)) + 2)
            pair[further] += rank[at[further] + known * step] + 1
            order = in_order(pair)
            rank = np.empty(len(pair), np.int64)
            rank[order] = np.cumsum(np.r_[False, pair[order][1:] != pair[order][:-1]][: len(pair)])
            known *= 2
        self.order = in_order(rank)
        self.first, self.reach = symbols[self.order], reach[self.order]
        self.before = np.where(place[self.order] >= step, symbols[self.order - step], -1)


def merge_transforms(shards: list[ShardTransform]) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each suffix that has ROUNDS strings ahead in the merged order, and whether it differs from its predecessor within them."""
    number = np.arange(len(shards), dtype=np.min_scalar_type(len(shards)))  # 8 and 16 bits sort fastest
    before, reach = (np.concatenate([getattr(s, x) for s in shards]) for x in ("before", "reach"))
    symbol, mixed = np.concatenate([s.first for s in shards]), np.repeat(number, [len(s.order) for s in shards])
    old = np.zeros(len(mixed), np.int64)
    for j in range(1, ROUNDS + 1):
        order = in_order(symbol)
        symbol, old, mixed = symbol[order], old[order], mixed[order]
        border = np.r_[True, (symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1])][: len(mixed)]
        if j == ROUNDS:
            return mixed, border
        here = reach >= j
        before, reach = before[here], reach[here]
        carried = np.empty(len(mixed), np.int64)
        carried[np.argsort(mixed, kind="stable")] = before  # each shard's transform, in the places the interleave gives it
        some = carried >= 0
        symbol, mixed, old = carried[some], mixed[some], (np.cumsum(border) - 1)[some]


def repeated_windows(parts: list[np.ndarray], unit: Unit, powers: Powers, check: Powers) -> np.ndarray:
    """Whether the window at each place of each segment (as concatenated) also starts elsewhere among the segments."""
    length, step = unit.length, unit.step
    if not parts:
        return np.zeros(0, bool)
    sizes = np.array([len(p) for p in parts])
    raw, base = np.concatenate(parts), np.r_[0, np.cumsum(sizes)[:-1]]
    many = sizes - step + 1  # places where a string starts
    starts, owner = np.r_[0, np.cumsum(many)[:-1]], np.repeat(np.arange(len(parts)), many)
    place = np.arange(int(many.sum())) - starts[owner]
    flat, reach = base[owner] + place, (sizes[owner] - place) // step
    _, symbols = np.unique(powers.strings(raw, step)[flat], return_inverse=True)  # one alphabet for all shards
    block = np.cumsum(many) // (SHARD // unit.width)
    cuts = np.r_[starts[np.flatnonzero(np.r_[True, block[1:] != block[:-1]])], len(place)]
    shards = [ShardTransform(symbols[a:b], place[a:b], reach[a:b], step) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    mixed, border = merge_transforms(shards)
    at = np.empty(len(mixed), np.int64)
    at[np.argsort(mixed, kind="stable")] = np.concatenate([s.order[s.reach >= ROUNDS] + a for s, a in zip(shards, cuts, strict=False)])
    # Common prefix of neighbours, in strings; an interval ends where it is shorter than all rounds.
    common, same = np.zeros(len(at), np.int8), np.ones(max(0, len(at) - 1), bool)
    for j in range(ROUNDS):
        same &= symbols[at[1:] + j * step] == symbols[at[:-1] + j * step]
        common[1:] += same
    if ((common < ROUNDS) != border).any():
        raise AssertionError("the merged order and its common prefixes disagree")
    interval = np.zeros(len(place), np.int64)
    interval[at] = np.cumsum(common < ROUNDS)
    windows = np.flatnonzero(place <= sizes[owner] - length)
    name = interval[windows]
    if rest := length - ROUNDS * step:
        name = name * (len(place) + 1) + interval[windows + rest]
    order = np.argsort(name)
    new = np.r_[True, name[order][1:] != name[order][:-1]][: len(order)]
    again = ~(new & np.r_[new[1:], True][: len(order)])
    out = np.zeros(len(raw), bool)
    out[flat[windows[order[again]]]] = True
    if again.any():  # the same windows by a second, independent hash: an interval's strings must agree
        second = check.strings(raw, length)[flat[windows[order]]]
        if (~new[1:] & (second[1:] != second[:-1])).any():
            raise AssertionError("two strings share their symbols but not their hash")
    return out


def _text_key():
    return F.unhex(F.md5(F.col("text").cast("binary")))


def repeats(docs: DataFrame, units: list[Unit], text: str = "text") -> DataFrame:
    """(text_key binary, places binary), some rows a text: packed first starts and numbers of repeated windows. units: up to two, numbered 0 and 1."""
    texts = docs.select(F.col(text).cast("string").alias("text")).withColumn("size", F.octet_length("text"))
    # A text of n words has 2 n - 1 bytes at least.
    texts = texts.filter(F.col("size") >= min(2 * u.length - 1 if u.words else u.length for u in units)).withColumn("text_key", _text_key())
    size = texts.agg(F.sum("size")).first()[0] or 0
    packing = Places.of(units)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, known = Powers(1), _Words()
        for batch in batches:
            held, rows = [], 0
            for t, key in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                high, low = np.frombuffer(key, np.int64)
                raw = t.as_py().encode("utf-8", "replace")
                for u in units:
                    for anchor, content, s, e in segments(u.codes(raw, known), u, powers):
                        held.append(np.stack([anchor.view(np.int64), content.view(np.int64), np.full(len(s), high), np.full(len(s), low), packing.pack(s, e, u.number)]))
                        rows += len(s)
                if rows > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held, axis=1).tobytes()], pa.binary())], ["entries"])
                    held, rows = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held, axis=1).tobytes()], pa.binary())], ["entries"])

    deals = max(4, math.ceil(sum(size / (6 if u.words else 1) * 40 / (u.length - u.gram) * 2 for u in units) / EXCHANGE))
    cuts = texts.select("text", "text_key").mapInArrow(lean(cut), "entries binary")
    found = written(_exchange(cuts, deals, MANY, units), "suffix-segments")
    unsure = found.filter("kind > 0").groupBy("text_key", "kind").agg(F.collect_list("places").alias("places"))
    unsure = written(unsure, "suffix-unsure")
    # One of the copies of a text stands for all: its segments that other copies hold are marked as repeated.
    own = texts.groupBy("text_key").agg(F.first("text").alias("text")).join(unsure, "text_key").select("text_key", "text", "kind", "places")
    volume = found.filter("kind = 1").agg(F.sum("size")).first()[0] or 0
    tasks = max(1, math.ceil(volume / TASK))

    def opened(cells: list[bytes]) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, np.int64).reshape(2, -1) for x in cells], axis=1)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The symbols of segments under anchors with few different ones, dealt by anchor."""
        known = _Words()
        for batch in batches:
            out: dict[int, list] = {}
            for key, t, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(3).to_pylist(), strict=True):
                raw = t.as_py().encode("utf-8", "replace")
                codes = [u.codes(raw, known) for u in units]
                p = opened(places)
                to = (_mix(p[1].view(np.uint64)) % np.uint64(tasks)).astype(np.int64)
                for place, d, s, n, u in zip(p[0].tolist(), to.tolist(), *(x.tolist() for x in packing.open(p[0])), strict=True):
                    out.setdefault(d, []).append((key, place, codes[u][s : s + n - 1 + units[u].length].tobytes()))
            rows = [(d, b"".join(x[0] for x in v), np.array([x[1] for x in v], np.int64).tobytes(), np.array([len(x[2]) for x in v], np.int64).tobytes(), b"".join(x[2] for x in v)) for d, v in out.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)], ["task", "keys", "place", "sizes", "raw"])

    def merged(group: pa.Table) -> pa.Table:
        parts, keys, places = [], [], []
        for k, p, n, raw in zip(*(group.column(c).to_pylist() for c in ("keys", "place", "sizes", "raw")), strict=True):
            ends = np.cumsum(np.frombuffer(n, np.int64)).tolist()
            parts += [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            keys += [k[i : i + 16] for i in range(0, len(k), 16)]
            places += np.frombuffer(p, np.int64).tolist()
        out: dict[bytes, list] = {}
        for u in units:
            mine = [k for k, p in enumerate(places) if p >> 1 & 1 == u.number]
            codes = [np.frombuffer(parts[k], np.uint64 if u.words else np.uint8) for k in mine]
            again, at = repeated_windows(codes, u, Powers(2), Powers(3)), 0
            for k, part in zip(mine, codes, strict=True):
                if not places[k] & 1:  # one that stands for several is known to be repeated
                    edge = np.flatnonzero(np.diff(np.r_[False, again[at : at + len(part)], False].astype(np.int8)))
                    s = (places[k] >> packing.span) + edge
                    out.setdefault(keys[k], []).extend(packing.pack(s[::2], s[1::2] - 1, u.number).tolist())
                at += len(part)
        out = {k: v for k, v in out.items() if v}
        return pa.table([pa.array(list(out), pa.binary()), pa.array([np.array(v, np.int64).tobytes() for v in out.values()], pa.binary())], ["text_key", "places"])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each window of segments under anchors with many different ones, as a segment of its own."""
        one, two, known = Powers(4), Powers(5), _Words()
        for batch in batches:
            for key, t, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(3).to_pylist(), strict=True):
                raw = t.as_py().encode("utf-8", "replace")
                codes = [u.codes(raw, known) for u in units]
                p = opened(places)[0]
                high, low = np.frombuffer(key, np.int64)
                held = []
                for place, s, n, u in zip(p.tolist(), *(x.tolist() for x in packing.open(p)), strict=True):
                    length = units[u].length
                    part, at = codes[u][s : s + n - 1 + length], np.arange(s, s + n)
                    first = _mix(one.strings(part, length) + np.uint64(u))
                    held.append(np.stack([first.view(np.int64), two.strings(part, length).view(np.int64), np.full(n, high), np.full(n, low), packing.pack(at, at, u) | place & 1]))
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held, axis=1).tobytes()], pa.binary())], ["entries"])

    few = own.filter("kind = 1").mapInArrow(lean(strings), "task int, keys binary, place binary, sizes binary, raw binary").groupBy("task").applyInArrow(lean(merged), "text_key binary, places binary")
    crowds = found.filter("kind = 2").agg(F.sum(F.length("places"))).first()[0] or 0
    all_found = found.filter("kind = 0").select("text_key", "places").unionByName(few)
    if crowds:
        many = _exchange(own.filter("kind = 2").mapInArrow(lean(single), "entries binary"), max(1, math.ceil(crowds / 16 * 100 * 40 / EXCHANGE)), 0, units)
        all_found = all_found.unionByName(many.select("text_key", "places"))
    return all_found


def covered(places: list[bytes], unit: Unit, packing: Places) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of symbols that repeated windows of the unit cover."""
    p = np.sort(np.concatenate([np.frombuffer(x, np.int64) for x in places]))
    s, n, u = packing.open(p)
    s, n = s[u == unit.number], n[u == unit.number]
    reach = np.maximum.accumulate(s + n - 1 + unit.length)
    first = np.r_[True, s[1:] > reach[:-1]][: len(s)]
    return s[first], reach[np.r_[first[1:], True][: len(s)]]


def remove_repeats(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", content: bool = False, passage: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document; with ``content`` also ``kept`` binary; with ``passage`` also
    ``passage_words`` long: words covered by a string of so many words that also starts anywhere else (they are reported, not removed)."""
    units = [Unit(length), *([Unit(passage, True, 1)] if passage else [])]
    packing = Places.of(units)
    found = written(repeats(docs, units, text).groupBy("text_key").agg(F.collect_list("places").alias("places")), "suffix-repeats")
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    least = min(length, 2 * (passage or length) - 1)
    sized = own.withColumn("text_key", F.when(F.octet_length("text") >= least, _text_key()))
    # Texts without repeats stay where they are; the result of a text is computed once a row.
    met = sized.join(found, "text_key", "left").select("doc_id", "text", "places")
    kinds = [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), *([("passage_words", "long")] if passage else []), *([("kept", "binary")] if content else [])]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name, _ in kinds}
            for t, places in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = (t.as_py() or "").encode("utf-8", "replace")
                kept, spans, words = raw, 0, 0
                if places:
                    a, b = covered(places, units[0], packing)
                    kept, spans = b"".join(raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)], strict=True)), len(a)
                    words = sum(int((y - x).sum()) for x, y in (covered(places, u, packing) for u in units[1:]))
                row = {"n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest(), "passage_words": words, "kept": kept}
                for name in out:
                    out[name].append(row[name])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(out[name], types[kind]) for name, kind in kinds)], ["doc_id", *out])

    kind = docs.schema[doc_id].dataType.simpleString()
    return met.mapInArrow(lean(run), ", ".join([f"doc_id {kind}", *(f"{name} {kind}" for name, kind in kinds)]))
