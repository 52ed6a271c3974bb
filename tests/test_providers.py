"""Providers, loaders and the convergence loop, against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.operators import providers as P
from loomspark.operators import terms as T
from loomspark.operators.sweep import converge, nearest_seed_provider, residual
from loomspark.sources import api, sinks, tables


def test_tfidf_pairs_and_their_terms(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdef") for _ in range(4)) for _ in range(60)]
    rows = [(f"d{i:02}", "xy"[i % 3 > 0], " ".join(rnd.choices(words, k=rnd.randint(0, 12)))) for i in range(70)] + [("n1", "x", None), ("n2", None, "abcd")]
    weights = T.tfidf_weights(spark.createDataFrame(rows, "doc string, grp string, text string"), "doc", "grp", "text")
    vectors = {}
    for r in weights.collect():
        vectors.setdefault((r.grp, r.doc), {})[r.term] = r.w
    want = {}
    for (g, a), x in vectors.items():
        for (h, b), y in vectors.items():
            if g == h and a < b:
                cosine = sum(w * y.get(t, 0) for t, w in x.items()) / np.sqrt(sum(w * w for w in x.values()) * sum(w * w for w in y.values()))
                if cosine >= 0.15:
                    want[g, a, b] = round(cosine, 9)
    pairs = T.tfidf_pairs(weights)
    assert {(r.grp, r.a, r.b): round(r.cosine, 9) for r in pairs.collect()} == want and want
    for r in T.shared_terms(pairs, weights).collect():
        x, y = vectors[r.grp, r.a], vectors[r.grp, r.b]
        assert r.shared.split() == sorted(x.keys() & y.keys(), key=lambda t: (-round(x[t] + y[t], 6), t))[:5]


def brute_converge(rows, batch, least, first, seed):
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    order = sorted(unit, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    seeds, out = {}, {}
    for c, low in enumerate(range(0, len(order), batch), 1):
        now, rest = order[low : low + batch], []
        for i in now:
            best = max(seeds, key=lambda k: (unit[i] @ unit[seeds[k]], -k), default=None)
            if best is not None and unit[i] @ unit[seeds[best]] >= least:
                out[i] = (c, best, "existing")
            else:
                rest.append(i)
        group = {i: i for i in rest}
        for _ in rest:
            for i in rest:
                for j in rest:
                    if unit[i] @ unit[j] >= least:
                        group[i] = group[j] = min(group[i], group[j])
        fresh = {}
        for g in sorted(set(group.values())):
            members = [i for i in rest if group[i] == g]
            if len(members) >= 3:
                fresh[first] = min(members)
                out |= {i: (c, first, "new") for i in members}
                first += 1
            else:
                out |= {i: (c, None, "singleton") for i in members}
        seeds |= fresh
    return out


def test_converge(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(5, 6))
    rows = [(i, (centres[i % 5] + 0.35 * rng.normal(size=6)).tolist() if i % 4 else rng.normal(size=6).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "record long, v array<double>")
    got = {r.record: (r.chunk, r.cluster, r.status) for r in converge(df, nearest_seed_provider(0.85), batch=25, first=7).collect()}
    assert got == brute_converge(rows, 25, 0.85, 7, 2026)
    assert {s for _, _, s in got.values()} == {"existing", "new", "singleton"}
    assert converge(df.limit(0), nearest_seed_provider(0.85), batch=25).isEmpty()
    left = residual(df, (None, lambda o: o.select("record", F.explode(F.array(F.col("record") % 20, F.lit(50))).alias("cluster"))), 3)
    assert {(r.record, r.cluster) for r in left.collect()} == {(i, i % 20) for i in range(60)}


def test_templates_by_priority(spark, tmp_path):
    for k, names in enumerate((["a"], ["a", "b"], ["a", "b", "c"])):
        (tmp_path / str(k)).mkdir()
        for n in names:
            (tmp_path / str(k) / f"{n}.md").write_text(f"{n}{k}")
    at = tmp_path.as_uri()
    known = tables.templates(spark, [(f"{at}/0", None), (f"{at}/1", "one"), (f"{at}/2", None)])
    asked = spark.createDataFrame([("a", "one"), ("b", "one"), ("b", "two"), ("b", None), ("c", None), ("z", "one")], "name string, stage string")
    got = {(r.name, r.stage): (r.level, r.text) for r in P.resolved(asked, known).collect()}
    assert got == {("a", "one"): (0, "a0"), ("b", "one"): (1, "b1"), ("b", "two"): (2, "b2"), ("b", None): (2, "b2"), ("c", None): (2, "c2"), ("z", "one"): (None, None)}


def test_embedded(spark):
    docs = spark.createDataFrame([(1, "alpha beta beta"), (2, "beta alpha beta gamma"), (3, None), (4, ""), (5, "x" * 9000 + " tail")], "id long, text string")
    rows = {r.id: np.array(r.vector) for r in P.embedded(docs, F.col("text"), size=64).collect()}
    assert all(abs(np.linalg.norm(rows[i]) - 1) < 1e-9 for i in (1, 2, 5)) and not rows[3].any() and not rows[4].any() and rows[1] @ rows[2] > 0.8
    lengths = {r.id: r.vector for r in P.embedded(docs, F.col("text"), lambda texts: [[len(t), 3000.0] for t in texts]).collect()}
    assert np.allclose(lengths[5], [0.8, 0.6]) and np.allclose(lengths[3], [0, 1])


def test_entities(spark):
    text = "Anna  Lee met <table><tr><td>Bob</td></tr></table> Carla <b>in</b> Rome. " + "y" * 40 + " Oslo"
    clean = "Anna  Lee met   Carla  in  Rome. " + "y" * 40 + " Oslo"

    def call(part):
        import re

        if part.startswith("boom"):
            raise ValueError("no")
        return [("PERSON" if "a" in m.group() else "PLACE", m.group(), m.start()) for m in re.finditer(r"[A-Z]\w+(\s+[A-Z]\w+)?|\bin\b", part)]

    docs = spark.createDataFrame([("1", text), ("2", None), ("3", ""), ("4", "boom")], "id string, text string")
    got = sorted((r.id, r.label, r.surface, r.position, r.error) for r in P.entities(docs, "id", "text", call, ("PERSON", "PLACE"), block=60).collect() if r.error is None)
    assert got == sorted([("1", "PLACE", s, clean.index(f), None) if s in ("Rome", "Oslo") else ("1", "PERSON", s, clean.index(f), None) for s, f in (("Anna Lee", "Anna"), ("Carla", "Carla"), ("Rome", "Rome"), ("Oslo", "Oslo"))])
    assert [(r.id, r.position, r.error) for r in P.entities(docs, "id", "text", call, ("PLACE",), block=60).collect() if r.error] == [("4", 0, "no")]


def test_one_prompt(spark):
    docs = spark.createDataFrame([(2, "b{x}"), (1, "a"), (3, None)], "id long, text string")
    assert P.one_prompt(docs, "For {who}:\n{samples}", "id", F.col("text"), who=F.lit("us")).first().prompt == "For us:\na\n\nb{x}"


def test_progress_by_landing_page(spark, tmp_path):
    at, page = tmp_path.as_uri(), "https://h.org/list"
    frame = lambda *rows: spark.createDataFrame(rows, "page_url string, title string")
    assert api.load_progress(spark, at, page) is None
    api.save_progress(frame(("u1", "a"), ("u2", "b")), at, page, "pages", 1)
    api.save_progress(frame(("u2", "c"), ("u3", "d")), at, page, "pages", 2)
    got = {(r.page_url, r.title, r.last_page, r.strategy) for r in api.load_progress(spark, at, page).collect()}
    assert got == {("u1", "a", 1, "pages"), ("u2", "c", 2, "pages"), ("u3", "d", 2, "pages")}
    assert api.load_progress(spark, at, page + "2") is None
    api.clear_progress(spark, at, page)
    assert api.load_progress(spark, at, page) is None


def test_unindexed(spark, tmp_path):
    at = tmp_path.as_uri() + "/index"
    docs = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "source string, n long")
    assert sinks.unindexed(docs, at, "source").count() == 4
    sinks.upsert(spark, docs.filter("n = 1"), at, "source")
    assert {r.n for r in sinks.unindexed(docs, at, "source").collect()} == {2, 3, 4}


def test_files_that_are_left_out(spark, tmp_path):
    from pyspark.sql import types as S

    for name in ("one.json", "event_index.json"):
        (tmp_path / name).write_text('{"records": [{"id": "x"}, {"id": "y"}]}')
    schema = S.StructType([S.StructField("id", S.StringType())])
    got = tables.records(spark, tmp_path.as_uri(), schema, skip=tables.RESERVED).collect()
    assert [(r.doc_id, r.id) for r in got] == [("one", "x"), ("one", "y")] and tables.records(spark, tmp_path.as_uri(), schema).count() == 4


def test_yaml_records(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "doc_1.yaml").write_text("- id: a\n  n: 1\n- id: b\n")
    (tmp_path / "doc_2.yaml").write_text("")
    (tmp_path / "other.yaml").write_text("- id: z\n")
    got = tables.yaml_records(spark, tmp_path.as_uri(), "doc_stem string, id string, n double").collect()
    assert sorted((r.doc_stem, r.id) for r in got) == [("doc_1", "a"), ("doc_1", "b")]


def test_link_prefixes_leave_the_landing_page_out(spark):
    from loomspark.operators.relate import link_prefixes

    urls = [f"https://h.org/docs/2020/{i}" for i in range(7)] + [f"https://h.org/list/all/{i}" for i in range(4)] + ["https://h.org/one"] * 5 + [f"https://h.org/about/us/{i}" for i in range(4)] + [None]
    df = spark.createDataFrame(list(enumerate(urls)), "id long, url string")
    assert {(r.prefix, r.n) for r in link_prefixes(df, "url", "id").collect()} == {("/docs/2020/", 7), ("/list/all/", 4)}
    (row,) = link_prefixes(df, "url", "id", landing="/list/all/").collect()
    assert (row.prefix, row.samples) == ("/docs/2020/", urls[:5])
