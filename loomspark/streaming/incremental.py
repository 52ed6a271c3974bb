"""Incremental forms: refresh of a catalogue, upsert by micro-batch, first-declaration registry with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.sinks import upsert


def refresh(spark: SparkSession, source: str, schema: str, target: str, key: str, checkpoint: str, position: list[str] | None = None, log: str | None = None) -> None:
    """Bring a versioned table up to date with the files that arrived since the last call. The stream's checkpoint knows which those
    are. Of a micro-batch's rows with one key the last by ``position`` (else by all columns) is kept, so a micro-batch that runs again writes
    the same rows and its effect is the same once or twice. ``log`` is a folder for a row a micro-batch: rows that arrived, and keys."""

    def merge(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            last = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), F.struct(*(position or batch.columns))).alias("r")).select("r.*")
            upsert(spark, last, target, key)
            if log:
                batch.agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_keys")).write.mode("overwrite").parquet(f"{log}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def registry(events: DataFrame, group: str, item: str, position: str) -> DataFrame:
    """(grp, item, position, number) of the first declaration of each item in its group, as rows arrive; state holds a group's items."""

    def walk(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = list(state.get[0]) if state.exists else []
        seen, out = set(known), []
        for f in frames:
            for r in f.sort_values(position).itertuples(index=False):
                if (v := getattr(r, item)) not in seen:
                    seen.add(v)
                    known.append(v)
                    out.append((key[0], v, getattr(r, position), len(known)))
        state.update((known,))
        yield pd.DataFrame(out, columns=["grp", "item", "position", "number"])

    kind = dict(events.dtypes)
    return events.groupBy(group).applyInPandasWithState(walk, f"grp {kind[group]}, item string, position long, number int", "known array<string>", "append", GroupStateTimeout.NoTimeout)
