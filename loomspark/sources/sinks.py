"""Writers: sorted JSON lines with a summary, appended layers, upserts, snapshots, audit logs, Markdown tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str, order: str) -> None:
    """JSON lines in order, in as many files as the range partitioning gives."""
    df.orderBy(order).write.mode("overwrite").json(path)


def summary(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in counts.items()])


def append_layer(df: DataFrame, path: str, layer: int) -> None:
    """One more layer of assignments; a layer that runs again replaces itself."""
    df.withColumn("layer", F.lit(layer)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("layer").parquet(path)


def upsert(spark: SparkSession, df: DataFrame, folder: str, key: str) -> str:
    """Rows of df replace those with their key, in a new version of the table; returns its path. A version is never changed, so readers
    of an older one are not disturbed, and a run that fails leaves no version behind."""
    versions = versions_of(spark, folder)
    new = f"{folder}/v{(versions[-1] if versions else 0) + 1:06d}"
    if versions:
        old = spark.read.parquet(f"{folder}/v{versions[-1]:06d}")
        df = old.join(df.select(key), key, "left_anti").unionByName(df, allowMissingColumns=True)
    df.write.parquet(new)
    return new


def versions_of(spark: SparkSession, folder: str) -> list[int]:
    """Finished versions, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path)]
    done = [p.getName() for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n[1:]) for n in done if n[:1] == "v" and n[1:].isdigit())


def current(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/v{versions_of(spark, folder)[-1]:06d}")


def unindexed(df: DataFrame, folder: str, key: str) -> DataFrame:
    """Rows whose key the table's current version does not have: one scan of its key column. All rows, where there is no version yet."""
    if not versions_of(df.sparkSession, folder):
        return df
    return df.join(current(df.sparkSession, folder).select(key).distinct(), key, "left_anti")


def audit_log(before: DataFrame, after: DataFrame, key: str, fields: list[str], reason: str) -> DataFrame:
    """(key, field, old, new, reason) of every changed cell."""
    met = before.select(key, *[F.col(f).cast("string").alias(f"o_{f}") for f in fields]).join(after.select(key, *[F.col(f).cast("string").alias(f"n_{f}") for f in fields]), key)
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"o_{f}").alias("old"), F.col(f"n_{f}").alias("new")) for f in fields])
    return met.select(key, F.explode(cells).alias("c")).filter(~F.col("c.old").eqNullSafe(F.col("c.new"))).select(key, "c.*", F.lit(reason).alias("reason"))


def markdown_rows(df: DataFrame) -> DataFrame:
    """(line): the rows as lines of a Markdown table, without its head."""
    cells = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[|\n]", " ") for c in df.columns]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quotes doubled inside quoted cells, nulls empty."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
