"""A session with the settings the library is made for; on a cluster most come from its own configuration."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("loomspark").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """The frame as a checkpoint in the folder of spark.checkpoint.dir. Where that is unset, a local session (tests) gets a temporary
    folder of its own; any other session is an error, as a machine-local folder would be invisible to the other machines."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        if not (found := spark.conf.get("spark.checkpoint.dir", None)):
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            found = Path(tempfile.mkdtemp(prefix="loomspark-")).as_uri()
            atexit.register(shutil.rmtree, found.removeprefix("file://"), ignore_errors=True)
        spark.sparkContext.setCheckpointDir(found)
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share, which goes with the application's JVM."""
    cut(spark.range(0))  # makes sure there is such a folder
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{spark.sparkContext.getCheckpointDir()}/scratch")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{path.toString()}/{name}-{uuid.uuid4().hex}"
