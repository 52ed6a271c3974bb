"""Model calls behind providers: a replay table by prompt digest is the default, so that runs need no network and can be repeated."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import letters3, unfenced, without_tables


def render(template: str, **blocks: Column) -> Column:
    """A template with {name} marks replaced by columns; braces that name no block stay as they are."""
    out = F.lit(template)
    for name, value in blocks.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def render_layers(template: str, layers: list[dict[str, Column]]) -> Column:
    """A template with the blocks of all layers: defaults, tokens, those of a sub-pipeline, arguments. A later layer's value wins where it is not null."""
    names = list(dict.fromkeys(n for layer in layers for n in layer))
    return render(template, **{n: F.coalesce(*[layer[n] for layer in reversed(layers) if n in layer]) for n in names})


def fingerprint_line(shares: DataFrame, least: float = 0.10, strong: float = 0.20, lift: float = 1.5) -> DataFrame:
    """(term, line) from (term, name, share, base): values a term has in ``least`` of its documents and ``lift`` times as often as all, as percentages, strong ones marked."""
    kept = shares.filter((F.col("share") >= least) & (F.col("share") / F.col("base") >= lift))
    said = F.concat("name", F.lit(" "), F.round(F.col("share") * 100).cast("long"), F.lit("%"), F.when(F.col("share") >= strong, "!").otherwise(""))
    rows = kept.groupBy("term").agg(F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("s"), "name", said.alias("said")))).alias("r"))
    return rows.select("term", F.array_join(F.transform("r", lambda x: x["said"]), ", ").alias("line"))


def record_block(id: Column, narrative: Column, evidence: Column, axes: dict[str, Column], most: int = 600) -> Column:
    """A record's lines in a prompt: id, the axes that say yes, the narrative, and the evidence where it says something else."""
    yes = F.array_join(F.filter(F.array(*[F.when(c == "yes", F.lit(n)) for n, c in axes.items()]), lambda x: x.isNotNull()), ", ") if axes else F.lit("")
    other = F.when(evidence.isNotNull() & (evidence != narrative), F.concat(F.lit("evidence: "), F.left(evidence, F.lit(most))))
    return F.concat_ws("\n", F.concat_ws(" | ", id.cast("string"), yes), narrative, other)


def replay(requests: DataFrame, table: DataFrame, prompt: str = "prompt") -> DataFrame:
    """Requests with the replies (prompt_sha, text, stop_reason, input_tokens, output_tokens) recorded for their prompts, else nulls."""
    return requests.withColumn("prompt_sha", F.sha2(F.col(prompt), 256)).join(table, "prompt_sha", "left")


def complete(requests: DataFrame, call: Callable[[str], str], id: str = "id", prompt: str = "prompt", attempts: int = 4, wait: float = 1.0) -> DataFrame:
    """(id, text, error) by a callable on the executors; tries again with doubled waits, and a request that fails for good is a row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for i, p in f.itertuples(index=False):
                for k in range(attempts):
                    try:
                        out.append((str(i), call(p), None))
                        break
                    except Exception as e:  # noqa: BLE001  the provider's, whatever it is
                        if k + 1 == attempts:
                            out.append((str(i), None, str(e)))
                        else:
                            time.sleep(wait * 2**k)
            yield pd.DataFrame(out, columns=["id", "text", "error"])

    return requests.select(id, prompt).mapInPandas(run, "id string, text string, error string")


def validate(replies: DataFrame, expected: DataFrame, key: str, value: str, allowed: list[str]) -> DataFrame:
    """(problem, n): missing, extra and duplicated keys, and values outside the vocabulary."""
    got = replies.groupBy(key).agg(F.count("*").alias("n"))
    e = expected.select(key).distinct()
    parts = {
        "missing": e.join(got, key, "left_anti"), "extra": got.join(e, key, "left_anti"), "duplicated": got.filter("n > 1"),
        "out_of_vocabulary": replies.filter(F.col(value).isNotNull() & ~F.col(value).isin(allowed)),
    }
    out = None
    for name, df in parts.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("problem"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def pending(requests: DataFrame, done: DataFrame, id: str = "id") -> DataFrame:
    """Requests without a reply yet: what a resumed or mopping-up run has to do."""
    return requests.join(done.filter("text is not null").select(id), id, "left_anti")


def waves(docs: DataFrame, by: str, position: str) -> Iterator[tuple[int, DataFrame]]:
    """Rows by position within their group, wave after wave: each wave may use what earlier ones produced."""
    for (w,) in sorted(tuple(r) for r in docs.select(position).distinct().collect()):  # a row a wave
        yield w, docs.filter(F.col(position) == w)


def _jobs(spark: SparkSession, folder: str, what: str, schema: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{what}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{schema}, job string")
    return spark.read.schema(f"{schema}, job string").parquet(f"{folder}/{what}")


def submit(requests: DataFrame, folder: str, id: str = "id", prompt: str = "prompt") -> str:
    """Put requests down as a job in a shared folder and return its id, which follows from the requests: the same ones again are the same job."""
    rows = requests.select(F.col(id).cast("string").alias("id"), F.col(prompt).cast("string").alias("prompt"))
    job = "{:x}".format(rows.agg(F.coalesce(F.sum(F.xxhash64("id", "prompt").cast("decimal(38,0)")), F.lit(0)).alias("h"), F.count("*").alias("n")).select(F.abs(F.xxhash64("h", "n"))).first()[0])
    rows.write.mode("overwrite").parquet(f"{folder}/requests/job={job}")
    return job


def answer(spark: SparkSession, folder: str, job: str, call: Callable[[str], str], **how) -> None:
    """Work off what a job has no reply for yet, by ``complete``; every call writes a part of its own, so that a stopped run goes on where it was."""
    asked = _jobs(spark, folder, "requests", "id string, prompt string").filter(F.col("job") == job)
    had = _jobs(spark, folder, f"replies/job={job}", "id string, text string, error string")
    complete(asked.join(had.select("id"), "id", "left_anti"), call, **how).write.mode("append").parquet(f"{folder}/replies/job={job}")


def status(spark: SparkSession, folder: str) -> DataFrame:
    """(job, n_requests, processing, succeeded, errored, ended) of every job in the folder."""
    asked = _jobs(spark, folder, "requests", "id string, prompt string").groupBy("job").agg(F.count("*").alias("n_requests"))
    had = _jobs(spark, folder, "replies", "id string, text string, error string").groupBy("job").agg(F.count_if(F.col("error").isNull()).alias("succeeded"), F.count("error").alias("errored"))
    both = asked.join(had, "job", "left").na.fill(0, ["succeeded", "errored"]).withColumn("processing", F.col("n_requests") - F.col("succeeded") - F.col("errored"))
    return both.select("job", "n_requests", "processing", "succeeded", "errored", (F.col("processing") <= 0).alias("ended"))


def collect_replies(spark: SparkSession, folder: str) -> DataFrame | None:
    """(job, id, text, error) of all jobs, failed requests with their error; None until every job has ended."""
    if not status(spark, folder).filter("not ended").isEmpty():
        return None
    return _jobs(spark, folder, "replies", "id string, text string, error string").select("job", "id", "text", "error")


def resolved(requests: DataFrame, templates: DataFrame) -> DataFrame:
    """(name, stage, level, text) of each requested (name, stage): of the templates (level, name, stage, text) with that name the one of the lowest level.
    A template with a stage is for requests of that stage only. Nulls where there is none."""
    t = templates.select("level", F.col("name").alias("__n"), F.col("stage").alias("__s"), "text")
    met = requests.select("name", "stage").distinct().join(t, (F.col("name") == F.col("__n")) & (F.col("__s").isNull() | (F.col("__s") == F.col("stage"))), "left")
    return met.groupBy("name", "stage").agg(F.min_by(F.struct("level", "text"), F.col("level")).alias("r")).select("name", "stage", "r.*")


def expanded(queries: DataFrame, query: Column, reply: Column) -> DataFrame:
    """A row an angle (pos, angle): the query itself at 0, then the strings of the JSON list in the reply, however many; a reply that holds no list adds none."""
    body = unfenced(reply)
    more = F.from_json(F.when(body.rlike(r"(?s)^\[.*\]$"), body), "array<string>")
    return queries.select("*", F.posexplode(F.concat(F.array(query), F.coalesce(more, F.array().cast("array<string>")))).alias("pos", "angle"))


def checked_tags(replies: DataFrame, reply: Column, vocabulary: dict[str, list[str]]) -> DataFrame:
    """The replies with a column an axis, null where the reply has no value of its vocabulary, ``invalid`` (axis, value) for the values it
    does not have, and whether an object was found at all."""
    tags = F.from_json(F.nullif(F.regexp_extract(unfenced(reply), r"(?s)\{.*\}", 0), F.lit("")), "map<string,string>")
    out = replies.withColumn("__tags", tags)
    said = {axis: F.try_element_at("__tags", F.lit(axis)) for axis in vocabulary}
    wrong = F.array(*[F.struct(F.lit(a).alias("axis"), F.when(~v.isin(vocabulary[a]), v).alias("value")) for a, v in said.items()])
    more = {a: F.when(v.isin(vocabulary[a]), v) for a, v in said.items()}
    return out.withColumns(more | {"invalid": F.filter(wrong, lambda x: x["value"].isNotNull()), "parsed": F.col("__tags").isNotNull()}).drop("__tags")


def repeated(requests: DataFrame, runs: int) -> DataFrame:
    """Each request ``runs`` times, numbered by ``run`` from 0: an ensemble of equal requests, for ``measure.ensemble``."""
    return requests.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))


def reply_cost(model: Column, tokens_in: Column, tokens_out: Column, prices: dict[str, tuple[float, float]]) -> Column:
    """Price of a reply by prices per million tokens read and written; null for a model without a price."""
    out = F.lit(None).cast("double")
    for name, (read, written) in prices.items():
        out = F.when(model == name, tokens_in * read / 1_000_000 + tokens_out * written / 1_000_000).otherwise(out)
    return out


def embedded(docs: DataFrame, text: Column, call: Callable[[list[str]], list[list[float]]] | None = None, most: int = 4000, size: int = 256, name: str = "vector") -> DataFrame:
    """The rows with a unit vector of the first ``most`` characters of their text: by a callable on the executors for the texts of an Arrow batch, else by hashed
    word counts, inside the JVM. The cut is the provider's limit. Texts without words (null, empty) have a vector of zeros by hashing; a callable gets null as the empty text."""
    head = F.coalesce(F.left(text, F.lit(most)), F.lit(""))
    if call is not None:

        @F.pandas_udf("array<double>")
        def vector(texts: pd.Series) -> pd.Series:
            x = np.array(call(texts.tolist()), float).reshape(len(texts), -1)
            return pd.Series(list(x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)), index=texts.index, dtype=object)

        return docs.withColumn(name, vector(head))
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    hashed = HashingTF(numFeatures=size, inputCol="__words", outputCol="__counts").transform(docs.withColumn("__words", letters3(head)))
    return Normalizer(inputCol="__counts", outputCol="__unit").transform(hashed).withColumn(name, vector_to_array("__unit")).drop("__words", "__counts", "__unit")


def entities(docs: DataFrame, id: str, text: str, call: Callable[[str], list[tuple[str, str, int]]], labels: tuple[str, ...], block: int = 500_000) -> DataFrame:
    """(id, label, surface, position, error): names that a callable finds in whole texts without tables and tags, ``block`` characters a call, as (label, surface, position).

    Kept are the labels asked for and surfaces of 2 to 100 characters with a capital, white space collapsed. Positions are those in the
    cleaned text. A block whose call fails is a row with its error; null and empty texts have no rows."""
    own = docs.select(F.col(id).cast("string").alias("id"), without_tables(F.col(text)).alias("t")).filter("t <> ''")
    blocks = own.withColumn("start", F.explode(F.sequence(F.lit(0), F.length("t") - 1, F.lit(block)))).select("id", "start", F.substring(F.col("t"), F.col("start") + 1, F.lit(block)).alias("part"))
    columns = ["id", "label", "surface", "position", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for i, start, part in f.itertuples(index=False):
                try:
                    found = call(part)
                except Exception as e:  # noqa: BLE001  the provider's, whatever it is
                    out.append((i, None, None, start, str(e)))
                    continue
                for label, surface, at in found:
                    surface = " ".join(surface.split())
                    if label in labels and 2 <= len(surface) <= 100 and any(c.isupper() for c in surface):
                        out.append((i, label, surface, start + at, None))
            if out:
                yield pd.DataFrame(out, columns=columns)

    return blocks.mapInPandas(run, "id string, label string, surface string, position long, error string")


def one_prompt(samples: DataFrame, template: str, order: str, cell: Column, **blocks: Column) -> DataFrame:
    """(prompt): one prompt over all rows of a sample, their cells in order in the block {samples}; for a corpus' first settings or axes. The sample is bounded by
    whoever drew it."""
    gathered = samples.agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), cell.alias("c")))).alias("s"))
    joined = F.array_join(F.transform("s", lambda r: r["c"]), "\n\n")
    return gathered.select(render(template, samples=joined, **blocks).alias("prompt"))
