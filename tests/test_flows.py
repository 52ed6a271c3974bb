"""Loops around model calls: sweep, jobs, axes, incremental log; against plain Python."""

import numpy as np
from pyspark.sql import functions as F

from loomspark.operators import providers as P
from loomspark.operators.axes import derive_axes
from loomspark.operators.graphs import nearest_rows
from loomspark.operators.sweep import nearest_seed_provider, next_batch, sweep
from loomspark.sources.tables import sitemap
from loomspark.streaming.incremental import refresh


def test_nearest_rows_against_brute_force(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(40, 6)), rng.normal(size=(30, 6))
    b[7] = b[3]  # a tie goes to the smaller id
    a[0] = b[3]
    frame = lambda x: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 6), (902, [None] * 6)], "id long, v array<double>")
    got = {r.id: (r.nearest, round(r.cosine, 9)) for r in nearest_rows(frame(a), frame(b), 0.5, block=8).collect()}
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    score = unit(a) @ unit(b).T
    want = {i: (int(np.flatnonzero(s >= s.max() - 1e-12)[0]), round(float(s.max()), 9)) for i, s in enumerate(score) if s.max() >= 0.5}
    assert got == want and got[0][0] == 3
    assert nearest_rows(frame(a), frame(b[:0]), 0.5).isEmpty() and nearest_rows(frame(a[:0]), frame(b), 0.5).isEmpty()


def test_batches_ramp_by_the_common_orphan_rate():
    assert next_batch([(9, 10)] * 2, 200) == 200 and next_batch([(6, 10)] * 3, 200) == 200
    assert next_batch([(4, 10)] * 3, 200) == 300 and next_batch([(2, 10)] * 3, 200) == 500 and next_batch([(1, 10)] * 3, 200) == 800
    assert next_batch([(10, 10), (0, 45), (0, 45)], 200) == 800  # one rate over all records, not a mean of rates
    assert next_batch([(0, 0)] * 3, 200) == 200


def test_sweep_with_ramp_places_every_record_once(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(4, 8)) * 5
    rows = [(i, (centres[i % 4] + rng.normal(size=8) * 0.1).tolist()) for i in range(120)]
    got = sweep(spark.createDataFrame(rows, "record long, v array<double>"), nearest_seed_provider(0.9), batch=20, rounds=5, ramp=True).collect()
    assert sorted(r.record for r in got) == list(range(120))
    assert {len({r.record % 4 for r in got if r.cluster == c}) for c in {r.cluster for r in got}} == {1} and len({r.cluster for r in got}) == 4


def test_jobs_are_submitted_worked_off_and_collected(spark, tmp_path):
    folder = (tmp_path / "jobs").as_uri()
    asked = spark.createDataFrame([("1", "a"), ("2", "bad"), ("3", "c")], "id string, prompt string")
    job = P.submit(asked, folder)
    assert P.submit(asked, folder) == job and P.submit(asked.limit(0), folder) != job
    assert P.collect_replies(spark, folder) is None

    def call(prompt):
        if prompt == "bad":
            raise ValueError("no")
        return prompt.upper()

    P.answer(spark, folder, job, call, attempts=1)
    P.answer(spark, folder, job, call, attempts=1)  # nothing is left to do
    row = P.status(spark, folder).filter(F.col("job") == job).first()
    assert (row.n_requests, row.processing, row.succeeded, row.errored, row.ended) == (3, 0, 2, 1, True)
    assert sorted((r.id, r.text, r.error) for r in P.collect_replies(spark, folder).collect()) == [("1", "A", None), ("2", None, "no"), ("3", "C", None)]


def test_axes_are_revised_until_they_differ(spark):
    docs = spark.range(400).withColumnRenamed("id", "n")
    tag = lambda rows, axes: rows.select("n", *[{"half": F.col("n") % 2, "same": F.col("n") % 2, "third": F.floor(F.col("n") / 2) % 2}[a].alias(a) for a in axes])
    axes, history = derive_axes(docs, "n", lambda _: ["half", "same"], tag, lambda r: [r.worst.a, "third"])
    assert axes == ["half", "third"] and len(history) == 2 and history[0].worst.nmi > 0.99 and history[1].worst.nmi <= 0.15
    stuck, history = derive_axes(docs, "n", lambda _: ["half", "same"], tag, lambda r: r.axes, rounds=3)
    assert stuck == ["half", "same"] and len(history) == 3
    assert derive_axes(docs.limit(0), "n", lambda _: ["half", "same"], tag, lambda r: r.axes)[1][0].worst.nmi == 0.0


def test_refresh_logs_each_batch_once(spark, tmp_path):
    at = tmp_path.as_uri()
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string").coalesce(1).write.parquet(f"{at}/in")
    for _ in range(2):
        refresh(spark, f"{at}/in", "k long, v string", f"{at}/out", "k", f"{at}/state", log=f"{at}/log")
    assert [(r.n_rows, r.n_keys) for r in spark.read.parquet(f"{at}/log").collect()] == [(3, 2)]


def test_sitemap_takes_a_pattern(spark, tmp_path):
    (tmp_path / "s.xml").write_text("<loc>http://h.org/a/1.pdf</loc><loc> http://h.org/a/x </loc><loc>http://h.org/b/2.pdf</loc>")
    assert [r.url for r in sitemap(spark, (tmp_path / "s.xml").as_uri(), "http://h.org/a", r"\.pdf$").collect()] == ["http://h.org/a/1.pdf"]
