"""Operators against brute force, on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["s"])[i % len(sources or ["s"])], len(t) if t else 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


# --- WARC


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, offset long, file string")


def test_warc_round_trip(spark):
    from loomspark.llm.warc import archive_round_trip

    long, other = "é" * 700, "x" * 1000
    rows = [(1, "http://a/ b\n", long, 1, "f"), (7, "http://a/2", long, 1, "f"), (3, None, long, 1, "f"), (4, "u", "short", 1, "f"), (5, "u", "short", 1, "f"), (6, "u", None, 1, "f"), (None, "u", other, 1, "f"), (8, "u", other, 1, "f"), (9, "u", "y" * 200_000, 1, "f"), (9, "u", "y" * 200_000, 1, "f")]
    got = archive_round_trip(pages(spark, rows)).collect()
    seen = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got)
    want = Counter()
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == body]
        revisit = len(body) >= 1000 and i != max((x for x in same if x is not None), default=None)
        want[(i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", max(x for x in same if x is not None) if revisit else None)] += 1
    twice = (9, 200_000, hashlib.sha1(b"y" * 200_000).hexdigest())  # equal ids: one of the two is the original
    assert want.pop((*twice, "response", None)) == 2
    assert seen.pop((*twice, "response", None)) == 1 and seen.pop((*twice, "revisit", 9)) == 1
    assert seen == want
    assert archive_round_trip(pages(spark, []).select("page_id", "url", "html")).count() == 0


def test_warc_hot_digest_is_dealt_out(spark, monkeypatch):
    from loomspark.llm import _shared
    from loomspark.llm.warc import archive_round_trip

    monkeypatch.setattr(_shared, "BROADCAST_ROWS", 0)
    rows = [(i, f"u{i}", "h" * 1500 if i % 3 else f"{i} " * 500, 1, "f") for i in range(120)]
    got = {r.page_id: r for r in archive_round_trip(pages(spark, rows)).collect()}
    assert all(r.record_type == "response" for i, r in got.items() if i % 3 == 0 or i == 119)
    assert all(r.refers_to == 119 for i, r in got.items() if i % 3 and i != 119) and len(got) == 120


def test_warc_records_can_be_read():
    from loomspark.llm.warc import members, parse, record
    import io
    import zlib

    digest = hashlib.sha1(b"body\r\n\r\nmore").hexdigest()
    made = record(5, "http://x/é y", b"body\r\n\r\nmore", digest, 12)
    revisit = record(6, "u", None, digest, 12, (5, "http://x"))
    zipped = []
    for x in (made, revisit):
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        zipped.append(z.compress(x) + z.flush())
    for chunk in (1, 7, 1 << 20):
        found = list(members(io.BytesIO(b"".join(zipped)), chunk))
        assert found == [(0, made), (len(zipped[0]), revisit)]
    assert parse(made)[2] == b"body\r\n\r\nmore"
    assert parse(revisit)[0]["warc-type"] == "revisit" and parse(revisit)[2] == b""
    with pytest.raises(ValueError):
        list(members(io.BytesIO(zipped[0][:-3])))


# --- SentencePiece


def test_sentencepiece_equals_library(spark):
    from loomspark.llm.sentencepiece_bpe import MergeVocabulary, encode_decode

    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab ▁\n\t\0é😀<s>́ the") for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    texts += ["", None, " ", "  ", "▁", " a", "a ", "⁇", "<unk>", "x" * 20_000, "word " * 3000, "the the", "the the"]
    library, own = sentencepiece.SentencePieceProcessor(model_file=MODEL), MergeVocabulary(MODEL)
    df = docs(spark, texts)
    for r in encode_decode(df, MODEL).join(encode_decode(df.select("doc_id", "text"), MODEL, digests=True).drop("text", "n_tokens"), "doc_id").collect():
        want = library.encode(r.text or "")
        assert r.ids == want == own.encode(r.text or "") and r.n_tokens == len(want)
        assert r.decoded == library.decode(want) == own.decode(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want).encode()).hexdigest()
    for ids in ([3, 4, 5, 300], [28705, 198, 68], [229, 133, 264], [243, 162, 155, 264, 258], []):
        assert own.decode(ids) == library.decode(ids)
    with pytest.raises(ValueError):
        encode_decode(df.withColumnRenamed("lang", "ids"), MODEL)
    assert encode_decode(docs(spark, []), MODEL).count() == 0


@pytest.mark.parametrize("wrong", ["encode", "decode"])
def test_sentencepiece_difference_ends_the_job(wrong):
    from loomspark.llm.sentencepiece_bpe import ChunkTable

    class Other:
        def __init__(self, own):
            self.own = own

        def encode(self, x, **k):
            found = self.own.encode(x, **k)
            return [i + [5] if i else i for i in found] if wrong == "encode" and isinstance(x, list) else found

        def decode(self, x):
            found = self.own.decode(x)
            return found + "!" if wrong == "decode" and isinstance(found, str) else found

    table = ChunkTable(MODEL)
    assert table.batch(["some text", "more"])[1] == ["some text", "more"]
    table.library = Other(table.library)
    with pytest.raises(AssertionError):
        table.batch(["some new text", "more"])


# --- mixing


def water_fill(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left, ws = total - sum(2 * sizes[s] for s in capped), sum(w[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and left * w[s] / ws > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else (left * w[s] / ws if ws else 0.0) for s in names}
        capped |= over


@pytest.mark.parametrize("sources", [["a", "b", None], ["x"], ["a", "b", "c", "d", "e", "f", "g", None]])
def test_mixing(spark, sources):
    from loomspark.llm.mixing import mix, mixed_rows

    rnd = random.Random(len(sources))
    texts = [words(rnd, rnd.choice([0, 1, 5, 40, 300])) if rnd.random() < 0.95 else None for _ in range(300)]
    df = docs(spark, texts, sources).withColumnRenamed("lang", "size")
    rows = mix(df).collect()
    sizes = defaultdict(int)
    for i, t in enumerate(texts):
        sizes[sources[i % len(sources)]] += len((t or "").split())
    want = water_fill(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").split()) and 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert sorted(rows, key=lambda r: r.doc_id) == sorted(mix(df.repartition(5)).collect(), key=lambda r: r.doc_id)
    copies = Counter(r.doc_id for r in mixed_rows(df).collect())
    assert all(abs(copies[r.doc_id] * r.size - r.taken) <= r.size / 2 for r in rows)
    assert mixed_rows(df).columns == df.columns


def test_mixing_long_text(spark):
    from loomspark.llm.mixing import mix

    texts = ["word " * 200_000, "a b c", "d", None, "\u00a0 \u3000"]
    rows = {r.doc_id: r for r in mix(docs(spark, texts, ["s", "t"])).collect()}
    assert [rows[i].size for i in range(5)] == [200_000, 3, 1, 0, 2]
    assert sum(r.taken for r in rows.values()) <= 1.5 * 200_006 + 1 and all(r.taken <= 2 * r.size for r in rows.values())


def test_mixing_repeats_and_empty(spark):
    from loomspark.llm.mixing import mix

    df = docs(spark, ["a b c"] * 2, ["s"])
    rows = mix(df.union(df)).collect()
    assert len(rows) == 4 and all(r.size == 3 for r in rows) and 17 <= sum(r.taken for r in rows) <= 18
    assert mix(docs(spark, [])).count() == 0
    assert [r.taken for r in mix(docs(spark, ["", None])).collect()] == [0, 0]


# --- vectors


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, v int")


def random_vectors(n, d, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d)) * np.exp(rng.normal(size=(n, 1)) * spread)
    return [(i, [float(np.float32(x)) for x in r], 0, 1) for i, r in enumerate(v)]


def top_brute(rows, k, every):
    good = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    q = {i: [math.floor(256 * float(x)) for x in v] for i, v in good}
    out = {}
    for i in (i for i in q if i % every == 0):
        scores = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)
        out[i] = [(j, -s) for s, j in scores[:k]]
    return out


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_top_k(spark, spread, monkeypatch):
    from loomspark.llm import topk

    monkeypatch.setattr(topk, "GROUP", 60)
    rows = random_vectors(400, 9, spread=spread)
    rows += [(400 + i, rows[3][1], 0, 1) for i in range(150)]  # a common vector: ties
    rows += [(600, None, 0, 1), (601, [1.0, None], 0, 1), (602, [float("nan")] * 9, 0, 1), (603, [float("inf")] * 9, 0, 1), (None, rows[0][1], 0, 1), (604, [0.0] * 9, 0, 1), (650, [0.0] * 9, 0, 1), rows[50], rows[7]]
    got = defaultdict(list)
    for r in sorted(topk.top_k(vectors(spark, rows).repartition(3), 5, 50).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    assert got == top_brute(rows, 5, 50)


def test_top_k_small_and_large(spark):
    from loomspark.llm.topk import top_k

    assert top_k(vectors(spark, []), 5, 50).count() == 0
    assert top_k(vectors(spark, random_vectors(1, 4)), 5, 50).count() == 0
    rows = [(0, [3e6, 1.0], 0, 1), (1, [2e6, 3.0], 0, 1), (2, [-1e6, 5.0], 0, 1), (3, [1e30, 0.0], 0, 1)]
    got = {(r.query_id, r.vec_id): r.score for r in top_k(vectors(spark, rows), 5, 50).collect()}
    want = {(0, j): min(s, 2**63 - 1) for j, s in top_brute([(i, [float(np.float32(x)) for x in v], *r) for i, v, *r in rows], 5, 50)[0]}  # beyond a long: clamped
    assert got == want


def test_ann(spark, monkeypatch):
    from loomspark.llm import ann

    rows = random_vectors(3000, 20, spread=0.2)
    rows += [(3000 + i, rows[5][1], 0, 1) for i in range(1200)]
    rows += [(5000, None, 0, 1), (5001, [0.0] * 20, 0, 1), (5002, [None] * 20, 0, 1), (5003, [float("inf")] * 20, 0, 1), (None, rows[1][1], 0, 1), rows[100], rows[9]]
    monkeypatch.setattr(ann, "CELL", 300)
    monkeypatch.setattr(ann, "ASKED", 4)
    found = ann.search(vectors(spark, rows).repartition(3), 10, 100).collect()
    x = {i: np.array(v, float) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    ids = np.array(sorted(x))
    m = np.stack([x[i] for i in ids])
    by = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        assert math.isclose(r.score, float(np.sqrt(((x[r.query_id] - x[r.vec_id]) ** 2).sum())), rel_tol=1e-12, abs_tol=1e-12)
        by[r.query_id].append(r.vec_id)
    hit = 0
    assert set(by) == {i for i in x if i % 100 == 0}
    for q, got in by.items():
        d = np.sqrt(((m - x[q]) ** 2).sum(1))
        order = [int(i) for i in ids[np.lexsort((ids, d))] if i != q][:10]
        assert len(got) == len(set(got)) == 10 and q not in got
        hit += len(set(got) & set(order))
    assert hit >= 9 * len(by)


def test_ann_few(spark):
    from loomspark.llm.ann import search

    assert search(vectors(spark, []), 10, 100).count() == 0
    got = search(vectors(spark, random_vectors(12, 30)), 10, 10).collect()
    assert Counter(r.query_id for r in got) == {0: 10, 10: 10}
    got = search(vectors(spark, random_vectors(4, 30)), 10, 10).collect()
    assert sorted(r.vec_id for r in got) == [1, 2, 3]


def test_ann_recall_with_several_hashes(spark, monkeypatch):
    from loomspark.llm import ann

    monkeypatch.setattr(ann, "AIM", 1)
    monkeypatch.setattr(ann, "COPY", 0, raising=False)
    rows = random_vectors(3000, 64, spread=0.0)
    seen, chosen = [], getattr(ann, "chosen", None)
    monkeypatch.setattr(ann, "chosen", lambda *a: seen.append(chosen(*a)) or seen[-1], raising=False)
    got = {(r.query_id, r.vec_id) for r in ann.search(vectors(spark, rows).repartition(3), 10, 50).collect()}
    m = np.array([r[1] for r in rows])
    want = {(q, int(j)) for q in range(0, 3000, 50) for j in np.argsort(((m - m[q]) ** 2).sum(1), kind="stable")[1:11]}
    assert len(got & want) >= 0.93 * len(want)
    assert seen[0][0] == 2


# --- repeated strings


def removed_brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[s : s + length] for r in raws for s in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for s in range(len(r) - length + 1):
            if seen[r[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((len(r), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("many,task", [(1000, 4 << 20), (1, 4 << 20), (1000, 3000)])
def test_suffix_dedup(spark, many, task, monkeypatch):
    from loomspark.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "MANY", many)
    monkeypatch.setattr(suffix_dedup, "TASK", task)
    monkeypatch.setattr(suffix_dedup, "SHARD", 2500)
    rnd = random.Random(5)
    passages = [words(rnd, 120) for _ in range(3)]
    texts = [words(rnd, rnd.randint(0, 200)) + rnd.choice(["", " " + rnd.choice(passages) + " "]) + words(rnd, rnd.randint(0, 150)) for _ in range(60)]
    texts += [texts[0], texts[1][:450] + "x" + texts[1][450:], "z" * 1000, "z" * 399, "ab" * 400, texts[2][7:407], texts[3][:399], "", None, "é" * 400, words(rnd, 3000) + passages[0] + passages[0]]
    df = docs(spark, texts).withColumnRenamed("lang", "places").withColumnRenamed("source", "text_key")
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == removed_brute(texts, 400)


def test_suffix_dedup_empty(spark):
    from loomspark.llm.suffix_dedup import remove_repeats

    assert remove_repeats(docs(spark, [])).count() == 0


def test_merged_transforms_equal_sorting():
    from loomspark.llm import suffix_dedup as s

    rng = np.random.default_rng(3)
    parts = [bytes(rng.integers(97, 99, 600, dtype=np.uint8)) for _ in range(6)] + [b"q" * 700]
    parts.append(parts[0][20:580])
    again = s.repeated_windows([np.frombuffer(p, np.uint8) for p in parts], s.Unit(400), s.Powers(2), s.Powers(3))
    seen = Counter(p[i : i + 400] for p in parts for i in range(len(p) - 399))
    want = np.concatenate([[i + 400 <= len(p) and seen[p[i : i + 400]] > 1 for i in range(len(p))] for p in parts])
    assert (again == want).all()


def test_suffix_dedup_copies_are_sent_once(spark, monkeypatch):
    from loomspark.llm import suffix_dedup

    rnd = random.Random(6)
    base = words(rnd, 500)
    texts = [base] * 40 + [base[:700] + "x" + base[700:]] * 30 + [words(rnd, 200) + base[300:900]]
    merge = suffix_dedup.repeated_windows

    def checked(parts, *a):
        assert len({p.tobytes() for p in parts}) == len(parts)
        return merge(parts, *a)

    monkeypatch.setattr(suffix_dedup, "repeated_windows", checked)
    for many in (1000, 1):
        monkeypatch.setattr(suffix_dedup, "MANY", many)
        df = docs(spark, texts)
        held = defaultdict(list)
        for r in suffix_dedup.repeats(df, [suffix_dedup.Unit(400)]).collect():
            held[bytes(r.text_key)] += np.frombuffer(r.places, np.int64).tolist()
        assert len(held) == 3 and all(len(set(p)) == len(p) for p in held.values())
        got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(df).collect()}
        assert [got[i] for i in range(len(texts))] == removed_brute(texts, 400)


def test_merged_transforms_of_many_shards(monkeypatch):
    from loomspark.llm import suffix_dedup as s

    monkeypatch.setattr(s, "SHARD", 400)
    rng = np.random.default_rng(4)
    parts = [bytes(rng.integers(97, 123, 420, dtype=np.uint8)) for _ in range(300)]
    parts.append(parts[7][5:415])
    again = s.repeated_windows([np.frombuffer(p, np.uint8) for p in parts], s.Unit(400), s.Powers(2), s.Powers(3))
    assert again.sum() == 22


@pytest.mark.parametrize("length", [8, 9, 150, 203, 420])
def test_merged_transforms_of_any_length(length, monkeypatch):
    from loomspark.llm import suffix_dedup as s

    monkeypatch.setattr(s, "SHARD", 3 * length)
    rng = np.random.default_rng(length)
    parts = [rng.integers(0, 2, length + int(rng.integers(0, 60)), dtype=np.uint64) for _ in range(12)]
    parts += [np.concatenate([p[:-1], [9]]).astype(np.uint64) for p in parts[:4]] + [parts[5][3:] if len(parts[5]) > length + 3 else parts[5]]
    for words in (False, True):
        own = [p.astype(np.uint64 if words else np.uint8) for p in parts]
        again = s.repeated_windows(own, s.Unit(length, words), s.Powers(2), s.Powers(3))
        seen = Counter(tuple(p[i : i + length].tolist()) for p in own for i in range(len(p) - length + 1))
        assert (again == np.concatenate([[i + length <= len(p) and seen[tuple(p[i : i + length].tolist())] > 1 for i in range(len(p))] for p in own])).all()


@pytest.mark.parametrize("length,many", [(420, 400), (150, 1)])
def test_suffix_dedup_of_other_lengths_and_passages(spark, length, many, monkeypatch):
    from loomspark.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "MANY", many)
    rnd = random.Random(length)
    shared = [words(rnd, n) for n in (49, 51, 60, 90)]
    texts = [words(rnd, rnd.randint(0, 90)) + rnd.choice(["", *[f"\n{x}\t" for x in shared]]) + words(rnd, rnd.randint(0, 90)) for _ in range(50)]
    texts += [texts[0], "", None, "a " * 51, "b " * 50, "c", shared[3], "  " + shared[2].replace(" ", "  ")]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs(spark, texts), length, passage=51, content=True).collect()}
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for _, r in sorted(got.items())] == removed_brute(texts, length)
    own = [(t or "").split() for t in texts]
    seen = Counter(tuple(w[i : i + 51]) for w in own for i in range(len(w) - 50))
    for k, w in enumerate(own):
        cover = {j for i in range(len(w) - 50) if seen[tuple(w[i : i + 51])] > 1 for j in range(i, i + 51)}
        assert got[k].passage_words == len(cover)
        assert hashlib.sha256(got[k].kept).hexdigest() == got[k].kept_sha256
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs(spark, texts), 7)


# --- lines


def test_line_dedup(spark):
    from loomspark.llm.line_dedup import drop_lines

    rnd = random.Random(4)
    hosts = ["h", "h", "h", "g", None]
    texts = ["\n".join([words(rnd, 4), *(["Menu "] if rnd.random() < 0.7 else []), "", " about" if rnd.random() < 0.1 else words(rnd, 3), "Menu"][: rnd.randint(0, 5)]) for _ in range(100)] + [None, "", "Menu", "Menu"]
    df = docs(spark, texts, hosts).withColumnRenamed("lang", "lines")
    got = {r.doc_id: r for r in drop_lines(df, 0.3, 4, counts=True).collect()}
    pages = Counter(hosts[i % 5] for i in range(len(texts)))
    having = Counter((hosts[i % 5], x) for i, t in enumerate(texts) for x in {x.strip(" \t\r") for x in (t or "").split("\n")} if x)
    for i, t in enumerate(texts):
        h = hosts[i % 5]
        kept = None if t is None else [x for x in t.split("\n") if not x.strip(" \t\r") or having[h, x.strip(" \t\r")] < 4 or having[h, x.strip(" \t\r")] <= 0.3 * pages[h]]
        assert got[i].text == (None if t is None else "\n".join(kept)) and got[i].lines_dropped == (0 if t is None else len(t.split("\n")) - len(kept))
    assert drop_lines(docs(spark, [])).count() == 0


def test_line_dedup_long_text_and_clashes(spark):
    from loomspark.llm.line_dedup import drop_lines

    rnd = random.Random(10)
    long = "\n".join(["Menu", *[words(rnd, 6) for _ in range(20_000)], "Menu"])
    texts = [long, *["Menu\nown " + words(rnd, 3) for _ in range(9)]]
    got = {r.doc_id: r.text for r in drop_lines(docs(spark, texts), 0.3, 4).collect()}
    assert got[0] == long[5:-5] and all(t.startswith("own") for i, t in got.items() if i)
    for name in ("lines_total", "lines_dropped", "__lines"):
        with pytest.raises(ValueError):
            drop_lines(docs(spark, texts).withColumnRenamed("lang", name), counts=True)


# --- urls


def test_url_filter_rules_and_templates(spark):
    from loomspark.llm.url_filter import Rule, Tree, filter_urls

    rules = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "shop.com", "/buy/pills/"), Rule("allow", "shop.com", "/about/")]
    urls = {1: "http://A.Example.ORG/es/1?x=/", 2: "https://example.org/en/1", 3: "http://example.org", 4: None, 5: "nothing", 6: "http://notexample.org/es/", 7: "x://h?q", 8: "ftp://ORG/", 9: "http://shop.com/about/us"}
    n = 100
    rows = [(i, u, "c") for i, u in urls.items()]
    rows += [(n + i, f"http://shop.com/buy/{'pills' if i % 2 else 'drugs'}/{i}", "c") for i in range(40)]
    rows += [(200 + i, f"http://shop.com/about/{i}", "c") for i in range(40)]
    rows += [(300, "http://shop.com/buy/9/9", "c"), (300, "http://shop.com/buy/9/9", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, template string")
    got = {r.page_id: r for r in filter_urls(df, rules, Tree()).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert (got[2].rule, got[2].verdict) == ("org/", "allow")
    assert (got[3].host, got[3].path, got[3].rule) == ("example.org", "", None)
    assert all((got[i].host, got[i].path, got[i].rule) == ("", "", None) for i in (4, 5))
    assert got[6].rule == "org/" and got[7].host == "h" and got[8].rule == "org/"
    # The unlabelled siblings of blocked pages are blocked with them; those of allowed ones are not.
    assert got[100].rule is None and got[100].verdict == "block" and got[300].verdict == "block"
    assert got[9].verdict == "allow" and len(got) == len({r[0] for r in rows})
    assert filter_urls(df, rules, Tree()).count() == len(rows)
    assert filter_urls(df.limit(0), rules).count() == 0


def test_url_filter_deep_long_and_rare_branches(spark):
    from loomspark.llm.url_filter import Rule, filter_urls

    rules = [Rule("block", "h.com", "/a/b/c/d/e/bad/"), Rule("allow", "h.com", "/a/b/c/d/e/good/"), Rule("block", "w.com", "/rare/blocked/")]
    urls = [f"http://h.com/a/b/c/d/e/{k}/{i}" for k in ("bad", "good") for i in range(30)]
    urls += ["http://o.com/" + "x/" * 12 + "y" * 5000, "http://o.com//", "http://o.com/a/b"]
    # A wide host: the rare branch's own labels are all blocked, its siblings' urls have a rule of their own each.
    urls += [f"http://w.com/rare/{'blocked' if i % 2 else 'other'}/{i}" for i in range(40)] + [f"http://w.com/s{chr(97 + k)}x/p{i}" for k in range(26) for i in range(60)]
    rules += [Rule("allow", "w.com", f"/s{chr(97 + k)}x/") for k in range(26)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in filter_urls(df, rules).collect()}
    assert len(got) == len(urls)
    assert {got[i].template for i in range(30)} == {"/a/b/c/d/e/bad/*"} and {got[i].template for i in range(30, 60)} == {"/a/b/c/d/e/good/*"}
    assert got[0].purity > 0.7 > 0.3 > got[30].purity
    rare = [got[i] for i in range(len(urls)) if "w.com/rare" in urls[i]]
    assert all(r.template.startswith("/rare/") for r in rare) and {r.verdict for r in rare if r.rule is None} == {"block"}


# --- Jaccard


def components_brute(texts, k, percent):
    low = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(low))
        sets.append({tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def edited(rnd, text, share):
    return " ".join(f"e{rnd.randrange(999)}" if rnd.random() < share else w for w in text.split())


@pytest.mark.parametrize("k,percent,block", [(4, 85, 8 << 20), (5, 80, 8 << 20), (4, 85, 2000)])
def test_jaccard(spark, k, percent, block, monkeypatch):
    from loomspark.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK", block)
    rnd = random.Random(k)
    texts = [words(rnd, rnd.choice([3, 8, 15, 40, 70, 120, 400])) for _ in range(40)]
    texts += [edited(rnd, rnd.choice(texts[:40]), rnd.choice([0.0, 0.005, 0.02, 0.03])) for _ in range(160)]
    base = words(rnd, 66)
    texts += [edited(rnd, base, 0.015) for _ in range(60)] + [" ".join(base.split()[:n]) for n in range(50, 67)]  # around the change of keys
    texts += ["", None, " \n", "one", "One", "two words", "TWO  words", "é É", "É É", "x " * 3000, "x " * 3000]
    df = docs(spark, texts).withColumnRenamed("lang", "component").withColumnRenamed("source", "first")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, k, percent).collect()}
    assert [got[i] for i in range(len(texts))] == components_brute(texts, k, percent)


def test_jaccard_sets_in_few_bins(spark, monkeypatch):
    from loomspark.llm import jaccard

    # With one bin or two, sets of over 64 fill no more bins than they may differ in.
    monkeypatch.setattr(jaccard, "_level", lambda larger, percent: 1)
    rnd = random.Random(12)
    base = words(rnd, 120)
    texts = [edited(rnd, base, 0.01) for _ in range(30)] + [words(rnd, 100) for _ in range(10)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, texts), 4, 85).collect()}
    assert [got[i] for i in range(len(texts))] == components_brute(texts, 4, 85)


def test_jaccard_odd_rows(spark):
    from loomspark.llm.jaccard import jaccard_components, keep_one

    text = words(random.Random(1), 50)
    df = spark.createDataFrame([(3, text), (3, text), (None, text), (1, text + " more"), (5, "else"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_components(df).collect()), key=str)
    assert got == sorted([(3, 1), (3, 1), (None, None), (1, 1), (5, 5), (None, None)], key=str)
    assert sorted((r.doc_id for r in keep_one(df).collect()), key=str) == sorted([1, 5, None, None], key=str)
    assert [r.doc_id for r in keep_one(spark.createDataFrame([(3, text), (3, text)], "doc_id long, text string")).collect()] == [3]
    assert jaccard_components(df.limit(0)).count() == 0 and keep_one(df.limit(0)).count() == 0


# --- quality


def test_quality_on_held_out_rows(spark):
    from pyspark.sql import functions as F

    from loomspark.llm.quality import classify

    df, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = classify(df, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
    again = {r.doc_id: r.score for r in classify(df.repartition(7), labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))).collect()}
    assert all(math.isclose(again[r.doc_id], r.score, rel_tol=1e-6, abs_tol=1e-9) for r in got)  # held-out labels are never read


def test_risk_and_its_minimum_against_brute_force():
    from loomspark.llm.quality import calibrate, fit_nnpu

    rng = np.random.default_rng(5)
    p = np.c_[rng.normal(1.5, 1, (300, 3)), np.ones(300)]
    u = np.c_[np.r_[rng.normal(1.5, 1, (120, 3)), rng.normal(-1.5, 1, (280, 3))], np.ones(400)]
    prior, decay = 0.3, 1e-3

    def parts(w):
        loss = lambda x: math.log1p(math.exp(-abs(x))) + max(0.0, -x)  # noqa: E731  of a margin
        positive = prior * sum(loss(x @ w) for x in p) / len(p)
        return positive, sum(loss(-(x @ w)) for x in u) / len(u) - prior * sum(loss(-(x @ w)) for x in p) / len(p)

    def risk(w):
        a, b = parts(w)
        return a + max(0.0, b) + decay * (w @ w) / 2

    w = fit_nnpu(p, u, prior, rounds=600)
    assert risk(w) < risk(np.zeros(4)) and parts(w)[1] > -0.02
    for k in range(4):  # no coordinate step lowers the risk by much
        for h in (0.05, -0.05):
            assert risk(w + h * np.eye(4)[k]) > risk(w) - 1e-3
    # One step from a given place goes along the gradient (central differences), or against that of the second part where it is negative.
    one = fit_nnpu(p, u, prior, rounds=1)
    grad = np.array([(risk(1e-5 * e) - risk(-1e-5 * e)) / 2e-5 for e in np.eye(4)])
    assert (np.sign(one) == -np.sign(grad)).all()
    # Platt: the minimum of the cross entropy with smoothed targets, by a grid around it.
    margin = rng.normal(0, 2, 500)
    label = (rng.random(500) < 1 / (1 + np.exp(-(1.3 * margin - 0.4)))).astype(int)
    a, b = calibrate(margin, label)
    y = np.where(label > 0, (label.sum() + 1) / (label.sum() + 2), 1 / ((1 - label).sum() + 2))
    cross = lambda a, b: -(y * np.log(1 / (1 + np.exp(-(a * margin + b)))) + (1 - y) * np.log(1 / (1 + np.exp(a * margin + b)))).sum()
    assert all(cross(a, b) <= cross(a + i, b + j) + 1e-4 for i in (-0.02, 0, 0.02) for j in (-0.02, 0, 0.02))
    assert abs(a - 1.3) < 0.4 and abs(b + 0.4) < 0.4


def test_quality_repeats_long_texts_and_other_ids(spark):
    from pyspark.sql import functions as F

    from loomspark.llm.quality import classify, score

    rnd = random.Random(9)
    good, bad = [words(rnd, 60) for _ in range(40)], [" ".join("###" + w for w in words(rnd, 60).split()) for _ in range(40)]
    texts = good + bad + [words(rnd, 40_000), good[0]]
    rows = [(f"d{i}", t, "x") for i, t in enumerate(texts)] + [("d0", bad[0], "x")] * 50
    df = spark.createDataFrame(rows, "doc_id string, text string, score string")
    labels = spark.createDataFrame([(f"d{i}", int(i < 40)) for i in range(80)], "doc_id string, quality int")
    got = classify(df, labels).collect()
    again = {(r.doc_id, r.score) for r in classify(df.repartition(5), labels).collect()}
    assert len(got) == len(rows) and {(r.doc_id, r.score) for r in got} == again
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.score)
    assert len(by["d0"]) == 2 and by["d81"] <= by["d0"]  # equal texts, equal scores
    assert np.mean([min(by[f"d{i}"]) for i in range(1, 40)]) > np.mean([max(by[f"d{i}"]) for i in range(40, 80)]) + 0.3
    with pytest.raises(ValueError):
        score(df, np.zeros(10))
    assert df.select(F.col("score")).count() == len(rows)


def test_quality_odd_tables(spark):
    from loomspark.llm.quality import classify

    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = classify(docs(spark, ["text", "", None]), none).collect()
    assert len(got) == 3 and all(r.score == 0.5 and r.predicted == 0 for r in got)
    marked = spark.createDataFrame([(0, 1, 0), (1, None, 0), (None, 1, 0), (0, 1, 1)], none.schema)
    assert all(0 <= r.score <= 1 for r in classify(docs(spark, ["text", "", None]), marked).collect())
    assert classify(docs(spark, []), none).count() == 0


def test_quality_prior_is_of_all_labels(spark):
    from pyspark.sql import functions as F

    from loomspark.llm.quality import Samples, fit, held_out

    labels = spark.createDataFrame([(i, int(i % 10 == 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    learnt = [r.quality for r in labels.filter(~held_out(F.col("doc_id"))).collect()]
    prior = (sum(learnt) + 1) / (len(learnt) + 2)
    found = fit(docs(spark, ["some text"] * 400), labels, Samples(unlabelled=0, labelled=3))
    assert math.isclose(found[-1], math.log(prior / (1 - prior)))


# --- pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(8)
    clean = [". ".join(words(rnd, 9, 60) for _ in range(12)) for _ in range(60)]
    junk = [" ".join(w + "$$$" for w in words(rnd, 80, 60).split()) for _ in range(30)]
    texts = [t + "\nAll rights reserved" for t in clean] + junk + [clean[0] + "\nAll rights reserved"]
    df = docs(spark, texts, ["a", "b", "c"])
    labels = spark.createDataFrame([(i, int(i < 60 or i == 90), 0) for i in range(91)], "doc_id long, quality int, toxic int")
    for name, table in (("documents", df), ("labels", labels)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    at = df
    for name, stage in corpus_pipeline.STAGES:
        before, at = at, stage(spark, at, str(tmp_path))
        if name != "tokens":
            assert at.columns == df.columns
        rows = at.collect()
        if name == "quality":
            assert {r.doc_id for r in rows} == {*range(60), 90}
        if name == "lines":
            assert all(r.text == clean[r.doc_id % 90] and r.n_chars == len(r.text) for r in rows)
        if name == "near_copies":
            assert {r.doc_id for r in rows} == set(range(60)) and len(rows) == 60
        at = spark.createDataFrame(rows, at.schema)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(rows)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert all(r.n_tokens == len(library.encode(clean[r.doc_id])) for r in rows)


def test_pipeline_odd_rows(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(18)
    good = [words(rnd, 80, 60) for _ in range(40)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(good)]
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0), (None, good[0] + " tail", "en", None, 1), (None, words(rnd, 90, 60), "en", "s", 1), (3, good[3], "en", "s", 1), (102, words(rnd, 60_000, 60), "en", "t", 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/b/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    for name in "ab":
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    ids = [r.doc_id for r in got]
    assert 102 in ids and set(range(40)) & set(ids) and 100 not in ids and 101 not in ids  # a text without words is never taken
    assert ids.count(3) <= 2 and corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_queries_are_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_attach_deals_out_large_sides(spark, monkeypatch):
    from pyspark.sql import functions as F

    from loomspark.llm import _shared

    big = spark.createDataFrame([(i, None if i % 3 == 0 else f"k{i % 5}") for i in range(60)], "i int, k string")
    small = spark.createDataFrame([(None, 0), *[(f"k{i}", i + 1) for i in range(4)]], "k string, v int")
    for how, rnd in (("left", "BROADCAST_ROWS"), ("inner", "BROADCAST_ROWS"), ("left", "BROADCAST_BYTES")):
        plain = sorted(map(str, _shared.attach(big, small, "k", how=how).collect()))
        with monkeypatch.context() as m:
            m.setattr(_shared, rnd, 0)
            dealt = _shared.attach(big, small, "k", how=how)
            assert sorted(map(str, dealt.collect())) == plain and dealt.columns == ["i", "k", "v"]
            assert dealt.filter(F.col("k").isNull()).count() == 20


def test_native_operators_run_no_python(spark):
    from loomspark.llm.mixing import mix
    from loomspark.llm.url_filter import Rule, filter_urls

    df = docs(spark, ["a b", "c"]).select("doc_id", "text", "source")
    found = filter_urls(df.selectExpr("doc_id page_id", "'http://a/b' url"), [Rule("block", "a", "/")])
    for out in (mix(df), found):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
