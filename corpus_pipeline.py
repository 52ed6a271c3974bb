"""Corpus preparation: quality, boilerplate lines, near copies, mixture, tokens. Each stage reads what its predecessor wrote.

Defined cases: null and empty texts are scored as empty ones and go in the first stage if the classifier rejects them, else they stay, have no words, link with nothing and are not taken by the mixture;
rows that share an id are one document to the near copies, of which one row stays, and rows with a null id are each their own; a null source is a source; columns beyond those of ``documents`` are passed through up to the
last stage; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm._shared import table, written
from loomspark.llm.jaccard import keep_one
from loomspark.llm.line_dedup import drop_lines
from loomspark.llm.mixing import mixed_rows
from loomspark.llm.quality import fit, score
from loomspark.llm.sentencepiece_bpe import encode_decode

#: The classifier is no SQL; the pipeline is tested against a version without Spark.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is 0.7 or more."""
    weights = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, weights, name="__score").filter("__score >= 0.7").drop("__score")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that exceed the boilerplate ratio of their source; n_chars follows the text."""
    return drop_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return keep_one(docs, k=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With the number of tokens and the token ids of the text; decoding them gave the text's digest."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode_decode(docs.select("doc_id", "lang", "source", "n_chars", "text"), path, digests=True, keep_text=False)


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("mixture", mixture), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
