"""Readers: catalogues, record files, tag files, documents by path, snapshots."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import normalise_project, stem
from ..operators.relate import best


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column a string, quoted line breaks allowed; no inference pass."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def manifest(spark: SparkSession, path: str, status: str = "downloaded") -> DataFrame:
    return catalogue(spark, path).filter(F.lower(F.trim("status")) == status.lower())


def portfolio(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A dimension by normalised project name; of several rows with one name the last in the file."""
    df = catalogue(spark, path).withColumn("join_key", normalise_project(F.lower(F.col(name)))).withColumn("__pos", F.monotonically_increasing_id())
    return best(df, ["join_key"], [F.desc("__pos")]).drop("__pos")


def documents(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(doc_id, path, text): whole files; the id is the file's normalised stem."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folder, wholetext=True)
    path = F.col("_metadata.file_path")
    return df.select(stem(F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?$", 1)).alias("doc_id"), path.alias("path"), F.col("value").alias("text"))


#: Files beside the event files of a folder that hold no events.
RESERVED = ("batch_state.json", "event_index.json", "project_index.json", "discovery_summary.json", "canonical_taxonomy.json", "reconciled_classifications.json")


def records(spark: SparkSession, folder: str, schema: T.StructType, field: str = "records", skip: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, pos, record columns) of JSON files that each hold an array of records; files that don't parse and those named in ``skip`` (RESERVED, for events) are
    left out."""
    whole = T.StructType([T.StructField(field, T.ArrayType(schema)), T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(whole).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(folder)
    if skip:
        df = df.filter(~F.col("_metadata.file_name").isin(*skip))
    doc = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    return df.select(doc.alias("doc_id"), F.posexplode(field).alias("pos", "r")).select("doc_id", "pos", "r.*")


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def tags(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """(id, fields): tag maps, either {"tags": {id: {...}}} or the map itself."""
    kind = f"map<string,struct<{','.join(f'{f}:string' for f in fields)}>>"
    raw = spark.read.text(path, wholetext=True)
    wrapped = F.from_json("value", f"struct<tags:{kind}>")["tags"]
    return raw.select(F.explode(F.coalesce(wrapped, F.from_json("value", kind))).alias("id", "t")).select("id", "t.*")


def stoplist(spark: SparkSession, path: str) -> DataFrame:
    """(term): lines without comments and blanks."""
    line = F.trim(F.regexp_replace("value", "#.*$", ""))
    return spark.read.text(path).select(line.alias("term")).filter("term <> ''").distinct()


def yaml_records(spark: SparkSession, folder: str, schema: str, load: Callable[[str], list[dict]] | None = None, pattern: str = "doc_*.yaml") -> DataFrame:
    """Records of YAML files that each hold a list, a file at a time on the executors; ``doc_stem`` in the schema is the file's stem. Without ``load`` by
    yaml.safe_load, which has to be installed. Empty files hold none."""
    if load is None:
        from yaml import safe_load as load
    raw = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True).select("value", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]+$", 1).alias("stem"))
    names = T.StructType.fromDDL(schema).names

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [{"doc_stem": stem, **r} for text, stem in f.itertuples(index=False) for r in load(text) or []]
            if rows:
                yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names)

    return raw.mapInPandas(run, schema)


def templates(spark: SparkSession, folders: list[tuple[str, str | None]], pattern: str = "*.md") -> DataFrame:
    """(level, name, stage, text): whole files of folders (path, stage or None) in order of priority, for ``providers.resolved``."""
    out = None
    for level, (folder, stage) in enumerate(folders):
        name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]+$", 1)
        own = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True).select(F.lit(level).alias("level"), name.alias("name"), F.lit(stage).cast("string").alias("stage"), F.col("value").alias("text"))
        out = own if out is None else out.unionByName(own)
    return out


def sitemap(spark: SparkSession, path: str, prefix: str = "", pattern: str = "") -> DataFrame:
    """(url) of saved sitemap files, those under a prefix in which a pattern is found."""
    raw = spark.read.text(path, wholetext=True)
    found = raw.select(F.explode(F.regexp_extract_all("value", F.lit(r"<loc>\s*([^<]+?)\s*</loc>"), F.lit(1))).alias("url"))
    return found.filter(F.col("url").startswith(prefix) & F.col("url").rlike(pattern)).distinct()


def doc_range(spec: str) -> Column:
    """Predicate over ``number`` of a specification like 1-5,9."""
    out = F.lit(False)
    for part in filter(None, (p.strip() for p in spec.split(","))):
        low, _, high = part.partition("-")
        out = out | F.col("number").between(int(low), int(high or low))
    return out


class SavedPages(DataSource):
    """format("saved_pages"): items of saved API pages (JSON files given by the option ``paths``, comma-separated), one partition a page, without
    the network: connectors save pages, this reads them. Items are the largest array of objects in a page."""

    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def schema(self) -> str:
        return "page int, item string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SavedPagesReader(self.options.get("paths", "").split(","))


class _SavedPagesReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = [p for p in paths if p]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition((k, p)) for k, p in enumerate(self.paths)]

    def read(self, partition: InputPartition) -> Iterator[tuple[int, str]]:
        number, path = partition.value
        with open(path, encoding="utf-8") as f:
            for item in largest_array(json.load(f)):
                yield number, json.dumps(item, sort_keys=True)


def largest_array(value: object) -> list[dict]:
    """The longest list of objects anywhere in a parsed response."""
    found: list[list[dict]] = []
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            stack.extend(v.values())
        elif isinstance(v, list):
            if v and all(isinstance(x, dict) for x in v):
                found.append(v)
            stack.extend(v)
    return max(found, key=len, default=[])
