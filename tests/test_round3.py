"""Queries against their SQL on tables that are larger or odder than the given ones."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from loomspark.plans.catalogue import QUERIES, SQL


def both(spark, folder, name, **tables):
    """Sorted rows of the query and of its SQL over these tables."""
    duck = duckdb.connect()
    for t, rows in tables.items():
        pq.write_table(rows, folder / f"{t}.parquet")
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    df = QUERIES[name](spark, str(folder))
    got = sorted(map(repr, (tuple(r) for r in df.collect())))
    return got, sorted(map(repr, duck.execute(f"SELECT {', '.join(df.columns)} FROM ({SQL[name]})").fetchall()))


def test_body_size_orders_places_as_its_sql_does(spark, tmp_path):
    # Places (line * 100,000 + part) of long part keys pass the next line's; keys, quantities and flags may be null.
    lines = [(1, 1, 500_000, 3.0, "N"), (1, 2, 5, 6.0, "N"), (2, 1, None, 3.0, "N"), (2, 2, 7, 6.0, "N"), (3, 1, 1, 9.0, None), (3, 2, 2, 12.0, "N"), (None, 1, 1, 3.0, "N")]
    lines += [(4, 1, 1, None, "N"), (4, 2, 2, None, "N"), (4, 3, 3, 3.0, "N"), (5, 1, 1, 0.45, "N"), (6, 1, 1, None, "N"), (6, 1, 1, 3.0, "N"), (7, 6, 1, 3.0, "N")]
    kinds = {"l_orderkey": pa.int64(), "l_linenumber": pa.int32(), "l_partkey": pa.int64(), "l_quantity": pa.float64(), "l_returnflag": pa.string()}
    table = pa.table({n: pa.array(x, k) for (n, k), x in zip(kinds.items(), zip(*lines, strict=True), strict=True)})
    got, want = both(spark, tmp_path, "body_size", lineitem=table)
    assert got == want


def test_global_event_key_pads_and_cuts_as_its_sql_does(spark, tmp_path):
    turns = [(k // 7, k % 7, "user") for k in range(10_050)] + [(1, 1, None), (None, 1, "user"), (2, None, "user"), (3, 1, "assistant")]
    table = pa.table({n: pa.array(x, k) for n, k, x in zip(("conv_id", "turn", "role"), (pa.int64(), pa.int64(), pa.string()), zip(*turns, strict=True), strict=True)})
    got, want = both(spark, tmp_path, "global_event_key", conversations=table)
    assert got == want


def test_corpus_event_key_pads_and_cuts_as_its_sql_does(spark, tmp_path):
    nations = pa.table({"n_nationkey": pa.array([1, 2, 3, 7, 8], pa.int64()), "n_name": ["B A", "B-A!", None, "C", "b a"]})
    kinds = [1 + k % 4 for k in range(4_400)] + [1] * 10_050 + [None, None]
    customers = pa.table({"c_custkey": pa.array([*range(len(kinds) - 1), None], pa.int64()), "c_nationkey": pa.array(kinds, pa.int64())})
    got, want = both(spark, tmp_path, "corpus_event_key", nation=nations, customer=customers)
    assert got == want


def test_top_k_of_many_buckets_and_tiles(spark, monkeypatch):
    import numpy as np

    from loomspark.llm import topk

    rnd = np.random.default_rng(5)
    rows = [(k, (rnd.normal(size=6) * (1 + k % 9)).tolist()) for k in range(900)] + [(k, [1.0, 2.0]) for k in range(900, 1000)]
    want = {}
    x = {k: np.floor(256 * np.r_[v, np.zeros(6 - len(v))]).astype(np.int64) for k, v in rows}
    for q in range(0, 1000, 50):
        want[q] = [(k, s) for s, k in sorted((-int(x[q] @ v), k) for k, v in x.items() if k != q)[:5]]
    for name, value in {"GROUP": 8, "BLOCK": 3, "TILE": 12 * 24}.items():  # 125 buckets, shelves of three groups, desks of eight blocks
        monkeypatch.setattr(topk, name, value, raising=False)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(topk.top_k(df, 5, 50).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, -r.score))
    assert got == want


def test_average_linkage_merges_as_the_greedy_order_in_linear_memory():
    import tracemalloc

    import numpy as np
    import pandas as pd

    from loomspark.operators.graphs import average_linkage

    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(12, 8))

    def drawn(n):
        return pd.DataFrame({"id": rnd.permutation(n), "v": list(centres[rnd.integers(0, 12, n)] + rnd.normal(size=(n, 8)) * 0.7)})

    def greedy(pdf, least):
        x = np.array(pdf["v"].tolist())
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        s = x @ x.T
        groups = [[k] for k in range(len(x))]
        while len(groups) > 1:
            m = np.array([[-2 if a is b else s[np.ix_(a, b)].mean() for b in groups] for a in groups])
            i, j = sorted(divmod(int(m.argmax()), len(groups)))
            if m[i, j] < least:
                break
            groups[i] += groups.pop(j)
        return sorted(sorted(pdf["id"].iloc[g]) for g in groups)

    for least in (0.3, 0.8):
        pdf = drawn(80)
        assert sorted(map(sorted, average_linkage(pdf, least).groupby("cluster")["id"].agg(list))) == greedy(pdf, least)
    pdf = drawn(4_000)
    tracemalloc.start()
    average_linkage(pdf, 0.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6  # a matrix of all pairs takes 128 MB


def test_jaccard_broadcasts_no_more_rows_than_allowed_for_components_of_many_blocks(spark, monkeypatch):
    from loomspark.llm import _shared, jaccard

    sent, broadcast = [], jaccard.F.broadcast
    monkeypatch.setattr(jaccard.F, "broadcast", lambda df: (sent.append(df.count()), broadcast(df))[1])
    monkeypatch.setattr(_shared, "BROADCAST_ROWS", 100)
    monkeypatch.setattr(jaccard, "BLOCK", 1_000)  # the group's 60 sets of some 40 shingles make 20 blocks
    words = [f"w{k}" for k in range(43)]
    rows = [(k, " ".join([*words[:-1], f"x{k}"])) for k in range(60)] + [(100 + k, f"alone {k}") for k in range(20)]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert got == {k: 0 if k < 60 else k for k, _ in rows}
    assert all(n <= 100 for n in sent), sent


def test_jaccard_documents_with_no_more_than_lines_in_common_do_not_meet(spark, monkeypatch):
    import random

    from loomspark.llm import jaccard

    met, written = {}, jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, tag: met.setdefault(tag, written(df, tag)))
    rnd = random.Random(3)
    line = " ".join(f"line{k}" for k in range(12))
    rows = [(k, f"{line}\n" + " ".join(f"w{rnd.randrange(10**9)}" for _ in range(30 + k % 90))) for k in range(300)]
    rows += [(1000 + k, t + (" more" if k % 2 else "")) for k, t in rows[:20]]  # near and exact copies
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()}
    assert got == {k: k % 1000 for k, _ in rows}
    assert met["jaccard-members"].count() <= 40  # all 300 and more before


def test_jaccard_keys_meet_whatever_is_common():
    import numpy as np

    from loomspark.llm.jaccard import keys

    rnd = np.random.default_rng(7)
    for n in [*range(1, 140), 300, 700]:
        s = np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
        other = np.unique(np.r_[s[rnd.permutation(len(s))[: len(s) - len(s) // 10]], rnd.integers(0, 2**64, n // 10, dtype=np.uint64)])
        shared = len(np.intersect1d(s, other))
        if shared * 100 < 80 * (len(s) + len(other) - shared):
            continue
        for part in (0, 0.1, 0.5, 1):
            pool = np.unique(np.r_[s, other, rnd.integers(0, 2**64, 9, dtype=np.uint64)])
            common = pool[rnd.random(len(pool)) < part]
            assert len(np.intersect1d(keys(s, 80, common), keys(other, 80, common))), (n, part)


def test_tfidf_top_makes_few_of_all_pairs_and_is_their_head(spark):
    import random

    from loomspark.operators import terms as T

    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    rows = [(k, "ab"[k % 2], " ".join(rnd.choices(words, k=12))) for k in range(120)]
    rows += [(200 + k, "a", rows[k % 3 * 2][2]) for k in range(40)] + [(300, None, words[0]), (None, "a", words[1]), (301, "b", None), (0, "a", words[2])]
    docs = spark.createDataFrame(rows, "doc long, grp string, text string")
    pairs = T.tfidf_pairs(T.tfidf_weights(docs, "doc", "grp", "text"))
    want = sorted(((-round(r.cosine, 6), r.a, r.b, r.grp) for r in pairs.collect()))
    vectors = T.tfidf_vectors(docs, "doc", "grp", "text")
    for most in (1, 5, 1000):  # the last needs pairs of lower cosines
        got = sorted((-round(r.cosine, 6), r.a, r.b, r.grp) for r in T.tfidf_top(vectors, most).collect())
        assert got == want[:most]
    heads = T._heads(vectors, 1 - 1e-6)
    met = heads.alias("x").join(heads.alias("y"), ["grp", "term"]).filter("x.doc < y.doc").count()
    assert met < len(want) / 4  # pairs of terms that both have, of all pairs that were joined before
