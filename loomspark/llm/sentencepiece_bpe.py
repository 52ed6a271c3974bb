"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by piece score, as the vocabulary's library does. No piece
of such a vocabulary holds the space mark after another character, so a text falls apart, exactly, into chunks of one or
more space marks and the characters up to the next mark; equal chunks are merged once per worker and remembered in a
bounded table. Every chunk new to that table has its ids compared with those of the sentencepiece library, which also
decodes them; of every slice of an Arrow batch (some MB) one whole text is encoded and decoded by the library and compared as well. A
difference ends the job. A vocabulary without that property is handled, and compared, in whole texts.

Defined cases: null is the empty text; the empty text has no ids, and decodes to itself; repeated rows are encoded row
by row; other columns are passed through; a column name already present is an error, not overwritten.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._shared import lean, slices

MARK = "▁"
NORMAL, UNKNOWN, USER, UNUSED, BYTE = 1, 2, 4, 5, 6
#: Chunks of up to so many characters are merged side by side; longer ones singly.
WIDTHS = (6, 10, 16, 32)


class Slots:
    """Places of distinct keys (0 or more) by open addressing, for many look-ups at once."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, (8 * len(keys)).bit_length())
        self.shift, self.mask, self.none = np.uint64(64 - bits), (1 << bits) - 1, len(keys)
        self.keys, self.places = np.full(1 << bits, -1, np.int64), np.full(1 << bits, self.none, np.int32)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = np.flatnonzero(self.keys[at] == -1)
            slot, first = np.unique(at[free], return_index=True)
            self.keys[slot], self.places[slot] = keys[left[free[first]]], left[free[first]]
            rest = np.delete(np.arange(len(left)), free[first])
            left, at = left[rest], at[rest] + 1 & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, the number of keys where it is none (so for -1)."""
        at = self._home(keys)
        held = self.keys[at]
        out = self.places[at]
        out[held != keys] = self.none
        on = np.flatnonzero((held != keys) & (held != -1) & (keys != -1))
        while len(on):
            at[on] = at[on] + 1 & self.mask
            held = self.keys[at[on]]
            hit = held == keys[on]
            out[on[hit]] = self.places[at[on[hit]]]
            on = on[~hit & (held != -1)]
        return out


class MergeVocabulary:
    """A merge-type SentencePiece model: encode by score-ordered agenda, decode by pieces and bytes."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2:
            raise ValueError("not a merge-type (BPE) vocabulary")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or any(p.type in (USER, UNUSED) for p in model.pieces):
            raise ValueError("vocabulary with a normaliser, user-defined or unused pieces: not supported")
        self.prefix = spec.add_dummy_prefix
        self.texts = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.merges = {p.piece: (-p.score, i) for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self._pairs = self.symbols = None
        self.splits = not any(MARK in p.lstrip(MARK) for p in self.merges)

    def merge(self, chunk: str) -> list[int]:
        """Ids of a chunk that already has space marks: the best pair merges first, the leftmost of equals."""
        known = self.merges
        whole = known.get(chunk)
        if whole and len(chunk) == 1:
            return [whole[1]]
        parts, n = list(chunk), len(chunk)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(known[pair][0], i, i + 1, pair) for i in range(n - 1) if (pair := parts[i] + parts[i + 1]) in known]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if after[left] != right or not parts[left] or parts[left] + parts[right] != pair:
                continue  # one of its symbols has merged since
            parts[left], parts[right] = pair, ""
            after[left] = nxt = after[right]
            if nxt >= 0:
                before[nxt] = left
                if (new := pair + parts[nxt]) in known:
                    heapq.heappush(agenda, (known[new][0], left, nxt, new))
            if (prev := before[left]) >= 0 and (new := parts[prev] + pair) in known:
                heapq.heappush(agenda, (known[new][0], prev, left, new))
        ids: list[int] = []
        for p in filter(None, parts):
            if found := known.get(p):
                ids.append(found[1])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in p.encode())
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids

    def merge_all(self, chunks: list[str], width: int) -> list[list[int]]:
        """merge() of many chunks of at most ``width`` characters at once: each round takes the head of every agenda."""
        slots, ranks, made = self.pairs()
        none = len(ranks)
        held = np.full((len(chunks), width + 1), -1, np.int32)
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        held[np.arange(width + 1) < sizes[:, None]] = self.symbols[points]
        v = len(self.texts)

        def look(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            want = np.where((a >= 0) & (b >= 0), a.astype(np.int64) * v + b, -1)
            return slots.find(want.ravel()).reshape(want.shape)

        best = np.append(ranks, np.iinfo(np.int32).max).astype(np.int32)
        agenda = np.full((len(chunks), width + 1), none, np.int32)
        agenda[:, :-1] = look(held[:, :-1], held[:, 1:])
        live, place = np.arange(len(chunks)), np.arange(width + 1)
        while len(live):
            pairs = agenda[live]
            order = best[pairs]
            j = order.argmin(1)
            row = np.arange(len(live))
            pair = pairs[row, j]
            go = pair < none
            live, j, pair = live[go], j[go], pair[go]
            if not len(live):
                break
            moved = np.minimum(place + (place > j[:, None]), width)
            now, then = np.take_along_axis(held[live], moved, 1), np.take_along_axis(pairs[go], moved, 1)
            now[:, -1], then[:, -1] = -1, none
            row = row[: len(live)]
            now[row, j] = made[pair]
            then[row, j] = look(now[row, j], now[row, np.minimum(j + 1, width)])
            left = np.maximum(j - 1, 0)
            then[row, left] = np.where(j > 0, look(now[row, left], now[row, j]), then[row, left])
            held[live], agenda[live] = now, then
        out = [r[:n] for r, n in zip(held.tolist(), (held != -1).sum(1).tolist(), strict=True)]
        for k in np.flatnonzero((held < -1).any(1)):
            ids: list[int] = []
            for i in out[k]:
                if i >= 0:
                    ids.append(i)
                elif self.bytes:
                    ids.extend(self.bytes[b] for b in chr(-2 - i).encode())
                elif not ids or ids[-1] != self.unknown:
                    ids.append(self.unknown)
            out[k] = ids
        return out

    def pairs(self) -> tuple[Slots, np.ndarray, np.ndarray]:
        """Table of the pairs that merge, the score rank of the piece each makes (equal scores: equal rank), its id."""
        if self._pairs is None:
            v, known = len(self.texts), self.merges
            rank = {s: k for k, s in enumerate(sorted({s for s, _ in known.values()}))}
            found = sorted((known[p[:k]][1] * v + known[p[k:]][1], rank[s], i) for p, (s, i) in known.items() for k in range(1, len(p)) if p[:k] in known and p[k:] in known)
            key, ranks, made = (np.array(x, np.int64) for x in zip(*found, strict=True))
            self._pairs = Slots(key), ranks, made
            self.symbols = -2 - np.arange(0x110000, dtype=np.int32)  # of each character: its piece, or a negative name
            for p, (_, i) in known.items():
                if len(p) == 1:
                    self.symbols[ord(p)] = i
        return self._pairs

    def chunks(self, text: str) -> list[str]:
        marked = (MARK if self.prefix else "") + text.replace(" ", MARK)
        return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", marked) if self.splits else [marked]

    def encode(self, text: str) -> list[int]:
        return [i for chunk in self.chunks(text) for i in self.merge(chunk)] if text else []

    def pieces_text(self, ids: list[int]) -> str:
        """Text of the ids, marks as spaces, the leading one included; bytes that are no UTF-8 become U+FFFD one by one."""
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i is not None and self.kinds[i] == BYTE:
                run.append(int(self.texts[i][3:5], 16))
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if i is not None and self.kinds[i] == NORMAL:
                out.append(self.texts[i].replace(MARK, " "))
            elif i is not None and self.kinds[i] == UNKNOWN:
                out.append(" ⁇ ")
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.pieces_text(ids)
        return text[1:] if self.prefix and text.startswith(" ") and ids and self.kinds[ids[0]] == NORMAL else text


def _utf8(run: bytes) -> str:
    try:
        return run.decode()
    except UnicodeDecodeError:
        return "".join(c if c != "�" else c * max(1, n) for c, n in _singly(run))


def _singly(run: bytes) -> Iterator[tuple[str, int]]:
    at = 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                yield run[at : at + n].decode(), 1
                at += n
                break
            except UnicodeDecodeError:
                pass
        else:
            yield "�", 1
            at += 1


class ChunkTable:
    """Per worker: the ids of each chunk met so far, bounded; a chunk goes by its characters after its first space mark.

    ``odd`` holds the chunks that the library decodes from their ids to anything but themselves. ``entries`` bounds both tables, give or
    take the chunks of one slice; chunks of more than ``longest`` characters are not kept.
    """

    def __init__(self, path: str, entries: int = 500_000, longest: int = 64):
        from sentencepiece import SentencePieceProcessor

        self.vocabulary, self.library = MergeVocabulary(path), SentencePieceProcessor(model_file=path)
        self.entries, self.longest = entries, longest
        self.numbers = [str(i) for i in range(len(self.vocabulary.texts))]
        self.ids: dict[str, str] = {}
        self.odd: dict[str, str] = {}

    def learn(self, names: list[str]) -> dict[str, str]:
        """Ids of chunks that the table lacks, each compared with the library; all but very long ones are also put into it."""
        v, number = self.vocabulary, self.numbers.__getitem__
        found: dict[str, str] = {}
        by_width: dict[int, list[str]] = {}
        for c in names:
            n = len(c) + 1
            by_width.setdefault(next((w for w in WIDTHS if n <= w), 0), []).append(c)
        for width, group in by_width.items():
            for at in range(0, len(group), 20_000):
                part = group[at : at + 20_000]
                mine = v.merge_all([MARK + c for c in part], width) if width else [v.merge(MARK + c) for c in part]
                said = [c.replace(MARK, " ") for c in part]
                theirs = self.library.encode(said, num_threads=1)
                if mine != theirs:
                    for c, ids, other in zip(part, mine, theirs, strict=True):
                        if c:  # a lone mark is a text of its own for no one
                            same(c, ids, other)
                for c, ids, text, back in zip(part, mine, said, self.library.decode(mine), strict=True):
                    found[c] = ",".join(map(number, ids))
                    if back != text:
                        self.odd[c] = back
        self.ids.update(found if max(map(len, by_width.get(0, [])), default=0) <= self.longest else {c: i for c, i in found.items() if len(c) <= self.longest})
        return found

    def names(self, text: str) -> list[str]:
        if MARK in text or "  " in text or text[:1] == " " or text[-1:] == " ":
            return [c[1:] for c in self.vocabulary.chunks(text)]
        return text.split(" ")

    def batch(self, texts: list[str]) -> tuple[list[str], list[str]]:
        """For each text its decimal ids joined by commas, and the text decoded from them."""
        v = self.vocabulary
        if not (v.splits and v.prefix):
            ids = [v.encode(t) for t in texts]
            for t, mine in zip(texts, ids, strict=True):
                same(t, mine, self.library.encode(t))
            return [",".join(map(str, i)) for i in ids], [self.library.decode(i) for i in ids]
        if len(self.ids) > self.entries or len(self.odd) > self.entries:
            self.ids.clear()
            self.odd.clear()
        flat: list[str] = []
        ends = [0]
        for t in texts:
            if t:
                flat += self.names(t)
            ends.append(len(flat))
        got = list(map(self.ids.get, flat))
        gaps = [k for k, x in enumerate(got) if x is None]
        if gaps:
            found = self.learn(list({flat[k] for k in gaps}))
            for k in gaps:
                got[k] = found[flat[k]]
        said, back = [], []
        for a, b in zip(ends, ends[1:], strict=False):
            said.append(",".join(got[a:b]))
            own = flat[a:b]
            if self.odd and not self.odd.keys().isdisjoint(own):
                back.append(" ".join([self.odd.get(c, c.replace(MARK, " ")) for c in own]))
            else:
                back.append(" ".join(own).replace(MARK, " "))
        for k in [k for k, t in enumerate(texts) if t][:1]:
            theirs = self.library.encode(texts[k])
            same(texts[k], said[k], ",".join(map(str, theirs)))
            same(texts[k], back[k], self.library.decode(theirs))
        return said, back


def same(text: str, mine: object, theirs: object) -> None:
    if mine != theirs:
        raise AssertionError(f"differs from the library for {text[:200]!r}: {str(mine)[:200]!r}, {str(theirs)[:200]!r}")


def encode_decode(docs: DataFrame, model_path: str, text: str = "text", ids: str | None = "ids", digests: bool = False, keep_text: bool = True) -> DataFrame:
    """Encode every whole text and decode it again.

    Adds ``n_tokens`` long and ``decoded`` string, and ``ids`` array<int> under the name given (None: leave it out).
    With ``digests`` it adds ``ids_sha256`` and ``decoded_sha256`` (lower-case hex of the comma-joined decimal ids, of
    the decoded UTF-8) instead of ids and decoded text. Without ``keep_text`` the text itself is left out.
    """
    own = [T.StructField("n_tokens", T.LongType())]
    if digests:
        own += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    else:
        own += [T.StructField(ids, T.ArrayType(T.IntegerType()))] if ids else []
        own += [T.StructField("decoded", T.StringType())]
    if clash := {f.name for f in own} & set(docs.columns):
        raise ValueError(f"columns already present: {sorted(clash)}")
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*kept, *own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ChunkTable(model_path)
        for batch in batches:
            parts, passed = batch.column(batch.schema.get_field_index(text)), batch.select([f.name for f in kept])
            for a, b in slices(parts):
                said, back = known.batch([t or "" for t in parts.slice(a, b - a).to_pylist()])
                counts = pa.array([s.count(",") + 1 if s else 0 for s in said], pa.int64())
                if digests:
                    more = [pa.array([hashlib.sha256(x.encode()).hexdigest() for x in y], pa.string()) for y in (said, back)]
                else:
                    more = [pa.array([[int(i) for i in s.split(",")] if s else [] for s in said], pa.list_(pa.int32()))] if ids else []
                    more += [pa.array(back, pa.string())]
                yield pa.RecordBatch.from_arrays([*passed.slice(a, b - a).columns, counts, *more], [f.name for f in schema])

    return docs.mapInArrow(lean(run), schema)
