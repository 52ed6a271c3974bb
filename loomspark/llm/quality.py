"""Quality classifier by positive-unlabelled learning.

A linear model of text features minimises the non-negative unbiased risk (Kiryo et al., 2017): with class prior p, logistic
loss l, trusted positives P and unlabelled texts U the risk is p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]), and where
the second part falls below zero the step goes against it. The prior is estimated from the labelled rows of the learning folds.
Last, one slope and one offset map the margin to a probability on the labelled learning rows (Platt), which leaves the order of
the scores as it is. The model is fitted in one task on bounded samples, ``positives``, ``unlabelled`` and ``labelled`` rows at most,
the first by a seeded hash; it is a fixed number of weights. Scoring reads every text whole.

Features of a text, from its UTF-8 bytes: square roots of the shares of each byte and of hashed byte pairs, and shares of
kinds of characters, of short, repeated and cut-off words, of distinct words and lines. Neither labels nor language, source or id are among them.

Defined cases: null text is the empty text, whose features are the offset alone, and is scored; null ids are never held out and
never labelled; repeated rows are scored alike, and of rows with one id one text is learnt from; of several labels of one id the smallest counts; without any labelled positive every score is the prior (0.5 where
that can't be estimated either); an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import lean, slices, written

#: Buckets of hashed byte pairs, and features in all.
PAIRS, SHARES = 1024, 15
WIDTH = 256 + PAIRS + SHARES + 1


@dataclass(frozen=True)
class Samples:
    """Bounds of the samples the model is fitted on, and the seed of the hash that picks them."""

    positives: int = 4000
    unlabelled: int = 6000
    labelled: int = 4000
    seed: int = 11


def shares(raw: np.ndarray, words: list[str], lines: list[str]) -> list[float]:
    """Of a text that is not empty: shares of kinds of characters, and how its words and lines are made."""
    n, m = len(raw), max(1, len(words))
    count = np.bincount(raw, minlength=256)
    upper, lower, digit, other = (int(count[a:b].sum()) for a, b in ((65, 91), (97, 123), (48, 58), (128, 256)))
    blank = int(count[9:14].sum() + count[32])
    space = np.concatenate([[True], (raw == 32) | ((raw >= 9) & (raw <= 13)), [True]])
    first, end = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    sizes, last = end - first, raw[np.maximum(end - 1, 0)]
    letter = ((last | 32) >= 97) & ((last | 32) <= 122) | (last >= 128)
    top = Counter(words).most_common(1)[0][1] if words else 0
    return [
        upper / n, (upper + lower + other) / n, digit / n, blank / n, (n - upper - lower - digit - other - blank) / n,
        float(sizes.mean()) / 10 if len(sizes) else 0.0, float(sizes.std()) / 10 if len(sizes) else 0.0, float((sizes <= 3).mean()) if len(sizes) else 0.0,
        float(letter.mean()) if len(sizes) else 0.0, (count[33] + count[46] + count[63]) / m, np.log1p(m) / 10, len(set(words)) / m, top / m, len(set(lines)) / len(lines), m / len(lines) / 100,
    ]


def features(text: str | None) -> np.ndarray:
    out = np.zeros(WIDTH, np.float32)
    out[-1] = 1
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = len(raw)
    out[:256] = np.sqrt(np.bincount(raw, minlength=256) / n)
    if n > 1:
        wide = raw.astype(np.uint32)
        pair = ((wide[:-1] * 256 + wide[1:]) * np.uint32(2654435761)) >> np.uint32(22)
        out[256 : 256 + PAIRS] = np.sqrt(np.bincount(pair, minlength=PAIRS) / (n - 1))
    out[-1 - SHARES : -1] = shares(raw, text.split(), text.split("\n"))
    out[-1 - SHARES : -1] *= 2  # they tell most where labels are few
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, rounds: int = 300, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights that minimise the non-negative unbiased risk, by Adam over all rows."""
    w, m, v = np.zeros(p.shape[1]), np.zeros(p.shape[1]), np.zeros(p.shape[1])
    for t in range(1, rounds + 1):
        fp, fu = p @ w, u @ w
        # Of the logistic loss: l(f)' = -s(-f), l(-f)' = s(f).
        part = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        negative = u.T @ _sigmoid(fu) / len(u) - prior * (p.T @ _sigmoid(fp)) / len(p)
        grad = -prior * (p.T @ _sigmoid(-fp)) / len(p) + negative if part >= 0 else -negative
        grad = grad + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def calibrate(margin: np.ndarray, label: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope (never negative) and offset of the probability, by Newton's method with smoothed targets."""
    if label.min(initial=1) == label.max(initial=0):
        return 1.0, 0.0
    pos, neg = label.sum(), (1 - label).sum()
    y = np.where(label > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        s = _sigmoid(x @ w)
        step = np.linalg.solve((x.T * (s * (1 - s))) @ x + 1e-6 * np.eye(2), x.T @ (s - y) + 1e-6 * w)
        w = w - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return max(1e-6, float(w[0])), float(w[1])


def held_out(doc_id: Column) -> Column:
    """Ids whose crc32 as text leaves 2 when divided by 4: never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, samples: Samples = Samples(), doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray:
    """Weights, slope and offset (WIDTH + 2 numbers)."""
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(~held_out(F.col("id")))
    marks = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label")).filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    marks = marks.groupBy("id").agg(F.min("label").cast("int").alias("label"))
    order = F.xxhash64(F.lit(samples.seed), "id")
    n_marks, n_good = marks.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    prior = float(np.clip((n_good + 1) / (n_marks + 2), 0.02, 0.98)) if n_marks else 0.5

    def first(df: DataFrame, n: int, use: str) -> DataFrame:
        return df.orderBy(order, "id").limit(n).withColumn("use", F.lit(use))

    chosen = first(marks.filter("label = 1"), samples.positives, "p").unionByName(first(marks, samples.labelled, "l"))
    any_row = first(own.select("id").withColumn("label", F.lit(None).cast("int")), samples.unlabelled, "u")
    chosen = written(chosen.unionByName(any_row), "quality-sample")  # at most the sum of the bounds, ids only
    texts = own.join(F.broadcast(chosen), "id").groupBy("id", "use").agg(F.min_by(F.struct("text", "label"), F.struct(F.xxhash64("text"), "text")).alias("r"))
    texts = texts.select(F.col("id").cast("string").alias("id"), "r.text", "r.label", "use")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary()), batch.column(2), batch.column(3)], ["id", "x", "label", "use"])

    rows = texts.mapInArrow(lean(described), "id string, x binary, label int, use string")

    def learn(group: pa.Table) -> pa.Table:
        ids, use = np.array(group.column("id")), np.array(group.column("use").to_pylist())
        x = np.zeros((len(ids), WIDTH), np.float32)
        for k, cell in enumerate(group.column("x")):
            x[k] = np.frombuffer(cell.as_buffer(), np.float32)
        label = np.array([-1 if v is None else v for v in group.column("label").to_pylist()])
        order = np.lexsort((x[:, :256].sum(1), use, ids))  # whatever the order rows come in
        use, label = use[order], label[order]

        def own(kind: str) -> np.ndarray:
            return x[order[use == kind]].astype(np.float64)  # one use at a time: all at once takes hundreds of MB

        out = np.zeros(WIDTH + 2)
        out[-2:] = 1.0, np.log(prior / (1 - prior))
        if (use == "p").any() and (use == "u").any():
            w = fit_nnpu(own("p"), own("u"), prior)
            out = np.r_[w, calibrate(own("l") @ w, label[use == "l"])]
        return pa.table({"w": pa.array([out.tolist()], pa.list_(pa.float64()))})

    found = rows.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(lean(learn), "w array<double>").first()
    if found is None:
        return np.r_[np.zeros(WIDTH), 1.0, 0.0]
    return np.array(found["w"])


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", name: str = "score") -> DataFrame:
    """The table with the column ``name`` double: the probability that the whole text is of quality."""
    if name in docs.columns:
        raise ValueError(f"column already present: {name}")
    w, slope, offset = weights[:WIDTH].astype(np.float32), weights[-2], weights[-1]
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, (a, b) in ((x, y) for x in batches for y in slices(x.column(x.schema.get_field_index(text)), 8 << 20)):
            batch = whole.slice(a, b - a)
            texts = batch.column(batch.schema.get_field_index(text))
            margin = np.array([float(features(t.as_py()) @ w) for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_sigmoid(slope * margin + offset), pa.float64())], schema.names)

    return docs.mapInArrow(lean(run), schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, samples: Samples = Samples()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; fitted first, on rows that are not held out."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, samples))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
