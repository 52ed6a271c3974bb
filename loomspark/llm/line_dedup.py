"""Dropping boilerplate lines by how frequent they are within their site.

A line goes where the pages of its host that contain it, divided by all pages of that host, exceed ``ratio`` (and are at
least ``least`` pages, so that small hosts keep their lines). Lines are compared without surrounding blanks, by their 64-bit
hash within the host; a page counts once however often it has the line. Distinct lines a page are counted with partial sums, so a
host that holds a third of all pages sends only counts. A host has at most (mean distinct lines a page) / ratio such
lines, so its list is one small row, joined to the pages by broadcast if the table of hosts is small enough and otherwise
by key with the hot hosts dealt out; pages are never exploded and put together again.

Defined cases: a null host is a host of its own; null text stays null and has no lines; blank lines are always kept; repeated rows
are pages of their own; a text all of whose lines go becomes empty; a column name this adds or uses inside (``__host``, ``__lines``, ``__kept``) that is
already present is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import attach, written


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(" \t\r")))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r")) == ""


def boilerplate(docs: DataFrame, ratio: float, least: int, text: str = "text", host: str = "source") -> DataFrame:
    """(host, lines array<long>): hashes of the lines to drop, for hosts that have any."""
    pages = docs.select(F.col(host).alias("host"), F.transform(F.filter(F.split(text, "\n"), lambda x: ~_blank(x)), _key).alias("lines"))
    # Each page also counts under the line null, which is the host's total.
    keys = F.concat(F.array(F.lit(None).cast("long")), F.coalesce(F.array_distinct("lines"), F.array()))
    counts = pages.select("host", F.explode(keys).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    counts = written(counts.filter((F.col("n") >= least) | F.col("line").isNull()), "line-counts")
    totals = written(counts.filter("line is null").select("host", F.col("n").alias("total")), "line-totals")
    common = attach(counts.filter("line is not null"), totals, "host", how="inner").filter(F.col("n") > F.col("total") * F.lit(ratio))
    return written(common.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines")), "line-common")


def drop_lines(docs: DataFrame, ratio: float = 0.05, least: int = 5, text: str = "text", host: str = "source", counts: bool = False) -> DataFrame:
    """The table with the boilerplate lines taken out of ``text``; with ``counts`` also ``lines_total`` and ``lines_dropped``."""
    if clash := {"__host", "__lines", "__kept", *(("lines_total", "lines_dropped") if counts else ())} & set(docs.columns):
        raise ValueError(f"columns already present: {sorted(clash)}")
    common = boilerplate(docs, ratio, least, text, host).select(F.col("host").alias("__host"), F.col("lines").alias("__lines"))
    met = attach(docs.withColumn("__host", F.col(host)), common, "__host")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x: _blank(x) | ~F.array_contains(F.col("__lines"), _key(x)))
    met = met.withColumn("__kept", F.when(F.col("__lines").isNull(), lines).otherwise(kept))
    new = F.when(F.col("__lines").isNull(), F.col(text)).otherwise(F.array_join("__kept", "\n"))
    cols = [new.alias(text) if c == text else F.col(c) for c in docs.columns]
    more = [F.coalesce(F.size(lines), F.lit(0)).alias("lines_total"), F.coalesce(F.size(lines) - F.size("__kept"), F.lit(0)).alias("lines_dropped")] if counts else []
    return met.select(*cols, *more)
