"""What the operators of this subpackage share: the shared folder, written tables, size-checked joins, packed columns."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes (as JSON) up to which a small side is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 10 << 20
#: Pieces into which each key of a join is dealt when its small side is too large to broadcast.
SALTS = 16


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver share: spark.checkpoint.dir of the session.

    Where it is unset, a local session (tests) gets a temporary folder of its own; any other session is an error, as
    a machine-local folder would be invisible to the other machines.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="loomspark-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", Path(own).as_uri())
    return Path(own).as_uri()


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path of its own in this application's part of the shared folder, which goes when the application's JVM ends."""
    run = f"{shared_dir(spark)}/loomspark/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(run)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{run}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts lineage, survives lost executors, is computed once."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deal(spark: SparkSession) -> int:
    """Partitions for a packed exchange."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def is_small(df: DataFrame) -> bool:
    """Whether a written table may be broadcast, by its rows and its bytes."""
    rows, size = df.agg(F.count("*"), F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def attach(big: DataFrame, small: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join a table with one row per key to a large one, nulls matching nulls, however skewed the key.

    The small side is measured (it should be a written table): up to BROADCAST_ROWS rows and BROADCAST_BYTES it is broadcast and the large
    side stays where it is. Beyond, each small row is repeated for SALTS pieces and the large rows of a key are dealt
    over those, so no key lands in one task.
    """
    right = small.withColumnRenamed(key, "__key")
    if is_small(small):
        return big.join(F.broadcast(right), big[key].eqNullSafe(right["__key"]), how).drop("__key")
    right = right.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = big.withColumn("__salt", F.pmod(F.xxhash64(*big.columns), F.lit(SALTS)).cast("int"))
    joined = left.join(right, left[key].eqNullSafe(right["__key"]) & (left["__salt"] == right["__salt_r"]), how)
    return joined.drop("__key", "__salt", "__salt_r")


def word_count(text: Column) -> Column:
    """Number of maximal runs outside ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def release() -> None:
    """Give the memory a Python worker has freed back to the machine: idle workers stay beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to trim
        pass


def lean(run: Callable) -> Callable:
    """A function for mapInArrow or applyInArrow that gives its memory back when it ends."""

    def whole(data):
        if isinstance(data, pa.Table):
            try:
                return run(data)
            finally:
                release()
        return stream(data)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def slices(texts: pa.Array, size: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows with some MB of text, one row at least, whatever the rows a batch has."""
    start = held = 0
    for k, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
        held += n or 0
        if held > size:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def by_deal(**held: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """Columns (as bytes) of each packed table, given with the deal of each of its columns: a row for each deal that has any."""
    packed: dict[str, dict[int, bytes]] = {}
    for name, (to, columns) in held.items():
        order = np.argsort(to, kind="stable")
        to, columns = to[order], columns[:, order]
        at = np.flatnonzero(np.r_[True, to[1:] != to[:-1]][: len(to)])
        packed[name] = {int(to[a]): columns[:, a:b].tobytes() for a, b in zip(at, [*at[1:], len(to)], strict=True)} if len(to) else {}
    deals = sorted(set().union(*packed.values()))
    return pa.RecordBatch.from_arrays([pa.array(deals, pa.int32()), *(pa.array([own.get(d, b"") for d in deals], pa.binary()) for own in packed.values())], ["deal", *packed])
