"""Terms: candidate extraction, frequencies, lift, TF-IDF, n-grams, novelty."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import cut, scratch


def ranked(df: DataFrame, by: list[str], order: list[Column], most: int, name: str = "rank") -> DataFrame:
    """The first ``most`` rows of each group; order should break all ties."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= most)


def candidates(docs: DataFrame, doc: str, text: str, stop: list[str] = X.ACRONYM_STOP, least: int = 2, most: int = 8) -> DataFrame:
    """(doc, pattern, surface): every initialism, acronym and title-case phrase."""
    kinds = {"initialism": X.matches(F.col(text), X.INITIALISM), "acronym": F.filter(X.matches(F.col(text), X.ACRONYM), lambda s: ~s.isin(*stop)), "titlecase": F.filter(X.matches(F.col(text), X.title_case_pattern(least, most)), X.passes_title_filter)}

    def named(kind: str) -> Column:
        return F.transform(kinds[kind], lambda s: F.struct(F.lit(kind).alias("pattern"), s.alias("surface")))

    found = F.flatten(F.array(*map(named, kinds)))
    return docs.select(F.col(doc).alias("doc"), F.explode(found).alias("m")).select("doc", "m.pattern", "m.surface")


def frequencies(found: DataFrame, least: int = 1) -> DataFrame:
    """(pattern, surface, n_mentions, n_docs) with at least ``least`` mentions. Counted per document first, so that
    common surfaces shuffle one row a document at most and partial sums before that."""
    per_doc = found.groupBy("pattern", "surface", "doc").agg(F.count("*").alias("n"))
    return per_doc.groupBy("pattern", "surface").agg(F.sum("n").alias("n_mentions"), F.count("*").alias("n_docs")).filter(F.col("n_mentions") >= least)


def pattern_stats(found: DataFrame) -> DataFrame:
    per = found.groupBy("pattern", "surface").agg(F.count("*").alias("n"))
    return per.groupBy("pattern").agg(F.sum("n").alias("n_mentions"), F.count("*").alias("n_surfaces"))


def token_counts(docs: DataFrame, group: str, text: str, stopwords: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(F.col(group).alias("grp"), F.explode(X.letters3(F.col(text), stopwords)).alias("term")).groupBy("grp", "term").agg(F.count("*").alias("n"))


def lift(counts: DataFrame, least_n: int = 2, least_ratio: float = 3.0, least_group: int = 10, least_base: int = 1) -> DataFrame:
    """(grp, term, n, obs_share, base_share, lift): a term's share within its group over its share in all groups.

    Totals are aggregates joined back (windows over a group would gather its rows in one task)."""
    counts = cut(counts)
    groups = counts.groupBy(F.col("grp").alias("g")).agg(F.sum("n").alias("group_n"))
    terms = counts.groupBy(F.col("term").alias("t")).agg(F.sum("n").alias("term_n"))
    total = counts.agg(F.sum("n").alias("all_n"))
    met = counts.filter(F.col("n") >= least_n).join(groups.filter(F.col("group_n") >= least_group), F.col("grp") == F.col("g"))
    met = met.join(terms.filter(F.col("term_n") >= least_base), F.col("term") == F.col("t")).join(F.broadcast(total))
    met = met.withColumns({"obs_share": F.col("n") / F.col("group_n"), "base_share": F.col("term_n") / F.col("all_n")})
    return met.withColumn("lift", F.col("obs_share") / F.col("base_share")).filter(F.col("lift") >= least_ratio).select("grp", "term", "n", "obs_share", "base_share", "lift")


def tfidf_weights(docs: DataFrame, doc: str, group: str, text: str, most_df: float = 0.7) -> DataFrame:
    """(grp, doc, term, w): tf * ln(n / df) within a group; terms in ``most_df`` of its documents and more are out."""
    tf = docs.select(F.col(group).alias("grp"), F.col(doc).alias("doc"), F.explode(X.letters3(F.col(text))).alias("term")).groupBy("grp", "doc", "term").agg(F.count("*").alias("tf"))
    tf = cut(tf)
    sizes = docs.groupBy(F.col(group).alias("g")).agg(F.count("*").alias("size"))
    df = tf.groupBy(F.col("grp").alias("g2"), F.col("term").alias("t2")).agg(F.count("*").alias("df"))
    w = tf.join(df, (F.col("grp") == F.col("g2")) & (F.col("term") == F.col("t2"))).join(sizes, F.col("grp") == F.col("g")).filter(F.col("df") < F.col("size") * most_df)
    return cut(w.select("grp", "doc", "term", (F.col("tf") * F.log(F.col("size") / F.col("df"))).alias("w")))


def tfidf_pairs(w: DataFrame, least: float = 0.15) -> DataFrame:
    """(grp, a, b, cosine) of document pairs within a group of weights (grp, doc, term, w) at ``least`` or more, a < b."""
    norms = w.groupBy("grp", "doc").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    a, b = w.alias("a"), w.alias("b")
    dots = a.join(b, (F.col("a.grp") == F.col("b.grp")) & (F.col("a.term") == F.col("b.term")) & (F.col("a.doc") < F.col("b.doc")))
    dots = dots.groupBy(F.col("a.grp").alias("grp"), F.col("a.doc").alias("a"), F.col("b.doc").alias("b")).agg(F.sum(F.col("a.w") * F.col("b.w")).alias("dot"))
    na, nb = (norms.select(F.col("grp").alias(f"g_{x}"), F.col("doc").alias(f"d_{x}"), F.col("norm").alias(f"n_{x}")) for x in "ab")
    met = dots.join(na, (F.col("grp") == F.col("g_a")) & (F.col("a") == F.col("d_a"))).join(nb, (F.col("grp") == F.col("g_b")) & (F.col("b") == F.col("d_b")))
    return met.withColumn("cosine", F.col("dot") / (F.col("n_a") * F.col("n_b"))).filter(F.col("cosine") >= least).select("grp", "a", "b", "cosine")


def tfidf_vectors(docs: DataFrame, doc: str, group: str, text: str, most_df: float = 0.7) -> DataFrame:
    """(grp, doc, norm, v): the weights of ``tfidf_weights`` with a row for each document, as a written table. v holds (df, term, w) in order, without
    the terms of one document, which count in the norm only."""
    spark = docs.sparkSession
    own = docs.select(F.col(group).alias("grp"), F.col(doc).alias("doc"), F.col(text).alias("text")).filter("grp is not null")
    # Dealt by document, so that terms are counted where the text is.
    tf = own.repartition("grp", "doc").select("grp", "doc", F.explode(X.letters3(F.col("text"))).alias("term")).groupBy("grp", "doc", "term").agg(F.count("*").alias("tf"))
    tf.groupBy("grp", "doc").agg(F.collect_list(F.struct("term", "tf")).alias("t")).write.parquet(path := scratch(spark, "tfidf-counts"))
    counts = spark.read.parquet(path).select("grp", "doc", F.explode("t").alias("t")).select("grp", "doc", "t.term", "t.tf")
    sizes = own.groupBy(F.col("grp").alias("g")).agg(F.count("*").alias("size"))
    df = counts.groupBy(F.col("grp").alias("g2"), F.col("term").alias("t2")).agg(F.count("*").alias("df"))
    w = counts.filter("doc is not null").join(df, (F.col("grp") == F.col("g2")) & (F.col("term") == F.col("t2"))).join(F.broadcast(sizes), F.col("grp") == F.col("g")).filter(F.col("df") < F.col("size") * most_df)
    w = w.select("grp", "doc", F.struct("df", "term", (F.col("tf") * F.log(F.col("size") / F.col("df"))).alias("w")).alias("t"))
    all_of = w.groupBy("grp", "doc").agg(F.array_sort(F.collect_list("t")).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
    all_of.select("grp", "doc", norm.alias("norm"), F.filter("v", lambda x: x["df"] > 1).alias("v")).filter("size(v) > 0").write.parquet(path := scratch(spark, "tfidf-vectors"))
    return spark.read.parquet(path)


def tfidf_rows(vectors: DataFrame) -> DataFrame:
    """(grp, doc, term, w) of vectors."""
    return vectors.select("grp", "doc", F.explode("v").alias("t")).select("grp", "doc", "t.term", "t.w")


def _heads(vectors: DataFrame, least: float) -> DataFrame:
    """(grp, term, doc): the terms of which two vectors with a cosine of ``least`` or more share one, in the heads of both. If the first term they share, by
    (df, term), is at i, their cosine is at most the norm of the rest from i on over the norm; where that is less than ``least``, the head ends."""
    kinds = dict(vectors.dtypes)

    def cut_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            if not len(lists):
                continue
            lengths, flat = np.array(lists.value_lengths()), lists.flatten()
            w = np.array(flat.field("w"))
            row = np.repeat(np.arange(len(lengths)), lengths)
            sums = np.r_[0.0, np.cumsum(w * w)]
            ends = np.cumsum(lengths)
            rest = sums[ends][row] - sums[:-1]
            bound = np.square(least * np.array(batch.column("norm")))[row]
            kept = np.flatnonzero(rest >= bound * (1 - 1e-9) - sums[-1] * 1e-12)  # with room for rounding
            at = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays([batch.column("grp").take(at), flat.field("term").take(pa.array(kept)), batch.column("doc").take(at)], ["grp", "term", "doc"])

    return vectors.select("grp", "doc", "norm", "v").mapInArrow(cut_off, f"grp {kinds['grp']}, term string, doc {kinds['doc']}")


def _cosines(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(grp, a, b, cosine) of pairs (grp, a, b)."""
    kinds = dict(pairs.dtypes)
    x, y = (vectors.select("grp", F.col("doc").alias(d), F.col("norm").alias(f"n_{d}"), F.col("v.term").alias(f"t_{d}"), F.col("v.w").alias(f"w_{d}")) for d in "ab")

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n_a, n_b, t_a, w_a, t_b, w_b in zip(*(batch.column(c) for c in ("n_a", "n_b", "t_a", "w_a", "t_b", "w_b")), strict=True):
                own = dict(zip(t_a.as_py(), w_a.as_py(), strict=True))
                out.append(sum(own.get(t, 0.0) * w for t, w in zip(t_b.as_py(), w_b.as_py(), strict=True)) / (n_a.as_py() * n_b.as_py()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("grp", "a", "b")), pa.array(out, pa.float64())], ["grp", "a", "b", "cosine"])

    return pairs.join(x, ["grp", "a"]).join(y, ["grp", "b"]).mapInArrow(multiplied, f"grp {kinds['grp']}, a {kinds['a']}, b {kinds['b']}, cosine double")


def tfidf_top(vectors: DataFrame, most: int, least: float = 0.15, digits: int = 6) -> DataFrame:
    """The first ``most`` pairs (grp, a, b, cosine) of ``tfidf_pairs`` by cosine, rounded to ``digits``, descending, then a and b.

    Pairs are looked for down to a threshold, from 1 on, until the last pair wanted is above it; if all pairs are fewer, that is ``least``.
    Of documents with the same vector the first most + 1 do: one beyond has ``most`` pairs of the same cosine before each of its own.
    """
    same = Window.partitionBy("grp", "norm", "__same").orderBy("doc")
    few = vectors.withColumn("__same", F.sha2(F.to_json("v"), 256)).withColumn("__nth", F.row_number().over(same)).filter(F.col("__nth") <= most + 1).drop("__same", "__nth")
    few.write.parquet(path := scratch(vectors.sparkSession, "tfidf-few"))
    few = vectors.sparkSession.read.parquet(path)
    step = 10.0**-digits
    at, lower = 1 - step, [0.9, 0.6, 0.3]
    while True:
        at = max(at, least * (1 - 1e-9))
        heads = _heads(few, at)
        met = heads.alias("x").join(heads.alias("y"), (F.col("x.grp") == F.col("y.grp")) & (F.col("x.term") == F.col("y.term")) & (F.col("x.doc") < F.col("y.doc")))
        pairs = met.select("x.grp", F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).distinct()
        found = _cosines(pairs, few).filter(F.col("cosine") >= least)
        top = cut(found.orderBy(F.round("cosine", digits).desc(), "a", "b").limit(most))
        n, last = top.agg(F.count("*"), F.min(F.round("cosine", digits))).first()
        if at <= least or n == most and last - 0.6 * step >= at:
            return top
        at = last - step if n == most else next((x for x in lower if x < at), least)


def shared_terms(pairs: DataFrame, weights: DataFrame, most: int = 5) -> DataFrame:
    """The columns of pairs (grp, a, b) and ``shared``, the terms both documents have with the largest sums of weights, the smaller of equals first."""
    x, y = (weights.select("grp", F.col("doc").alias(d), "term", F.col("w").alias(f"w_{d}")) for d in "ab")
    met = pairs.join(x, ["grp", "a"]).join(y, ["grp", "b", "term"]).withColumn("__sum", F.round(F.col("w_a") + F.col("w_b"), 6))
    top = ranked(met, ["grp", "a", "b"], [F.desc("__sum"), F.col("term")], most, "__rank")
    kept = top.groupBy(*pairs.columns).agg(F.array_sort(F.collect_list(F.struct("__rank", "term"))).alias("__t"))
    return kept.select(*pairs.columns, F.array_join(F.transform("__t", lambda r: r["term"]), " ").alias("shared"))


def gram_rates(docs: DataFrame, text: str, n: int) -> DataFrame:
    """(gram, n, per_million) of hyphen-word n-grams."""
    grams = docs.select(F.explode(X.ngrams(X.hyphen_words(F.col(text)), n)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    return grams.join(F.broadcast(grams.agg(F.sum("n").alias("total")))).select("gram", "n", (F.col("n") * 1e6 / F.col("total")).alias("per_million"))


def voice_ratio(ours: DataFrame, theirs: DataFrame, least: int = 5) -> DataFrame:
    """Rates of grams against another corpus: (gram, n, rate, other_rate, ratio, verdict)."""
    o = theirs.select(F.col("gram").alias("g"), F.col("per_million").alias("other_rate"))
    met = ours.filter(F.col("n") >= least).join(o, F.col("gram") == F.col("g"), "left")
    ratio = F.col("per_million") / F.col("other_rate")
    return met.select("gram", "n", F.col("per_million").alias("rate"), "other_rate", ratio.alias("ratio"), F.when(F.col("other_rate").isNull(), "absent").when(ratio >= 3, "amplified").otherwise("shared").alias("verdict"))


def novelty(docs: DataFrame, doc: str, text: str, known: DataFrame, n: int = 3) -> DataFrame:
    """(doc, grams, known, share, band): distinct n-grams of a document that the known table (gram) has."""
    own = docs.select(F.col(doc).alias("doc"), F.explode(F.array_distinct(X.ngrams(X.letters3(F.col(text)), n))).alias("gram"))
    met = own.join(known.select(F.col("gram").alias("g")).distinct(), F.col("gram") == F.col("g"), "left")
    out = met.groupBy("doc").agg(F.count("*").alias("grams"), F.count("g").alias("known")).withColumn("share", F.col("known") / F.col("grams"))
    return out.withColumn("band", F.when(F.col("share") >= 0.5, "copied").when(F.col("share") > 0, "partial").otherwise("novel"))
