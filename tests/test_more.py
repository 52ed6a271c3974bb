"""Operators that SQL can't check, against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F


def test_fuzzy_pairs_lose_none(spark):
    from loomspark.operators.graphs import fuzzy_pairs, indel_ratio

    rnd = random.Random(3)
    names = ["hydropower", "hydro power", "hidropower", "a", "ab", "b a", "", "solar farm north", "north solar farm", "solar farm n", "aaaa", "aaab"]
    names += ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(1, 14))) for _ in range(150)]
    names += [n[:k] + rnd.choice("abcxyz") + n[k + rnd.randint(0, 1) :] for n in names[:80] for k in [rnd.randint(0, max(0, len(n) - 1))]]
    df = spark.createDataFrame(list(enumerate(names)), "id long, s string")
    sorted_names = [" ".join(sorted(n.split())) for n in names]
    for least in (82.0, 60.0):
        got = {(r.a, r.b) for r in fuzzy_pairs(df, least, "id", "s").collect()}
        want = {(i, j) for j in range(len(names)) for i in range(j) if sorted_names[i] and sorted_names[j] and indel_ratio(sorted_names[i], sorted_names[j]) >= least}
        assert got == want
    apart = spark.createDataFrame([(1, 0)], "a long, b long")
    assert (0, 1) not in {(r.a, r.b) for r in fuzzy_pairs(df, 82.0, "id", "s", apart).collect()}


def picks_brute(rows, per, seed):
    """rows: (id, bucket, d, u)"""
    order = {r[0]: hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest() for r in rows}
    seen_d, seen_u, out = set(), set(), []
    for b in sorted({r[1] for r in rows}):
        pool, taken = sorted((r for r in rows if r[1] == b), key=lambda r: (order[r[0]], r[0])), []
        for step in (1, 2, 3):
            for r in pool:
                if len(taken) >= per:
                    break
                if r in taken or (step < 3 and r[3] and r[3] in seen_u) or (step == 1 and r[2] in seen_d):
                    continue
                taken.append(r)
                seen_d.add(r[2])
                if r[3]:
                    seen_u.add(r[3])
                out.append((r[0], b, step))
    return out


@pytest.mark.parametrize("case", range(6))
def test_diverse_sample(spark, case):
    from loomspark.operators.graphs import diverse_sample

    rnd = random.Random(case)
    rows = [(i, rnd.choice("abc"), rnd.choice("xyzw"[: 1 + case % 4]), rnd.choice([None, "", *[f"u{k}" for k in range(1 + 3 * case)]])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, b string, d string, u string")
    got = [tuple(r) for r in diverse_sample(df, F.col("b"), F.col("d"), F.col("u"), "id", 4 + case, case).collect()]
    assert sorted(got) == sorted(picks_brute(rows, 4 + case, case))


def test_running_sums(spark):
    from loomspark.operators.relate import running

    rnd = random.Random(1)
    rows = [(rnd.choice([None, "hot", "hot", "hot", "g"]), k, rnd.randint(0, 5)) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(3)
    sums = {}
    want = set()
    for g, k, v in rows:
        sums[g] = sums.get(g, 0) + v
        want.add((g, k, v, sums[g]))
    assert {tuple(r) for r in running(df, ["g"], ["k"], F.col("v"), "s").collect()} == want
    assert running(df.limit(0), ["g"], ["k"], F.col("v"), "s").count() == 0


def test_emphasis(spark):
    from loomspark.functions.text import fix_emphasis

    def plain(s):
        subs = [(r"\*\*[ \t]+([^*\n]+?)\*\*", r"**\1**"), (r"\*\*([^*\n]+?)[ \t]+\*\*", r"**\1**"), (r"(?<!\*)\*[ \t]+([^*\n]+?)\*(?!\*)", r"*\1*"), (r"(?<!\*)\*([^*\n]+?)[ \t]+\*(?!\*)", r"*\1*")]
        for _ in range(5):
            for p, r in subs:
                s = re.sub(p, r, s)
        return re.sub(r" +\n", "\n", re.sub(r"[ \t]+", " ", s))

    rnd = random.Random(2)
    texts = ["".join(rnd.choice(["*", "**", " ", "\t", "a", "b", "\n", "** x **", "* y *"]) for _ in range(40)) for _ in range(200)]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(fix_emphasis(F.col("t"))).collect()]
    assert got == [plain(t) for t in texts]


def test_ngrams_of_odd_texts(spark):
    from loomspark.functions.text import letters3, ngrams

    texts = ["", None, "one", "one two", "one two three four " * 500]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(ngrams(letters3(F.col("t")), 2)).collect()]
    words = [re.findall("[a-z]{3,}", t or "") for t in texts]
    assert got == [[" ".join(w[i : i + 2]) for i in range(len(w) - 1)] for w in words]


def test_consensus(spark):
    from loomspark.operators.relate import consensus

    rnd = random.Random(4)
    rows = [(r, i, rnd.choice("abc" if i % 2 else "a")) for r in range(4) for i in range(40)]
    df = spark.createDataFrame(rows, "r int, i int, g string")
    at = {(r, i): g for r, i, g in rows}
    for least in (1, 2, 3):
        want = {(a, b, n) for a in range(40) for b in range(a + 1, 40) if (n := sum(at[r, a] == at[r, b] for r in range(4))) >= least}
        assert {tuple(r) for r in consensus(df, "r", "g", "i", least).collect()} == want


def test_simple_yaml():
    from loomspark.functions.tolerant import events, simple_yaml, yaml_records

    assert simple_yaml("- a: 1\n  b: 'x: y'\n- a: |\n    two\n    lines\n  b:") == [{"a": "1", "b": "x: y"}, {"a": "two\nlines", "b": ""}]
    assert simple_yaml("records:\n  - a: 1\n  - a: 2") == [{"a": "1"}, {"a": "2"}]
    assert simple_yaml("plain text") is None and simple_yaml("") is None
    assert yaml_records(None) == ([], "none") and yaml_records("prose only") == ([], "failed")
    assert yaml_records("```yaml\n- record_id: 1\n  t: x\n- record_id: 2\n  t: \"cut")[1] == "recovered"
    assert events("## events\n\n- event_id: 1\n  event_name: x\n") == [{"event_id": "1", "event_name": "x"}] and events(None) == []


def test_refresh_keeps_the_latest(spark, tmp_path):
    from loomspark.sources.sinks import current
    from loomspark.streaming.incremental import refresh

    rows = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 5, "b"), (2, 4, "a")], "k long, v int, t string")
    rows.write.parquet(f"{tmp_path}/in")
    refresh(spark, f"{tmp_path}/in", "k long, v int, t string", f"{tmp_path}/out", "k", f"{tmp_path}/cp", ["v"])
    assert sorted(tuple(r) for r in current(spark, f"{tmp_path}/out").collect()) == [(1, 2, "new"), (2, 5, "b")]
