"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "agorascope", **overrides: str) -> SparkSession:
    """A session with the library's defaults; cluster sizing is left to the caller.

    ``spark.sql.shuffle.partitions`` is not set here: on a cluster pick a high number
    and let AQE coalesce, in tests pass a low one.
    """
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Hours and weekdays are defined in UTC, whatever zone the session started with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for written intermediate tables.

    It lies in the shared folder named by ``spark.checkpoint.dir``, so that every executor
    reaches it and the table outlives lost executors. Only a session in one process, as in
    tests, may leave that setting out; a cluster without it is an error, since a folder of the
    driver's machine would not be seen by the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local($|\[)", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="agorascope-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import this library from where the driver did.

    On a cluster the library is installed on every node, or sent with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [environment.get("PYTHONPATH"), root]))


#: Bytes of rows that Spark hands to a Python worker at once; texts of any length then need little memory.
ARROW_BYTES = 4 << 20
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Have batches of at most ``ARROW_BYTES`` or the session's lower limit."""
    if not 0 < int(re.sub(r"\D", "", spark.conf.get(_ARROW_LIMIT)) or 0) <= ARROW_BYTES:
        spark.conf.set(_ARROW_LIMIT, str(ARROW_BYTES))


def stored(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: this cuts the lineage.

    The files outlive the executors that wrote them, so nothing before them runs again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.partitionBy(*by).parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the tables in the scratch folder that frames read, once what was made of them is written."""
    for frame in frames:
        spark = frame.sparkSession
        scratch = scratch_dir(spark, "").rsplit("/", 1)[0]
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if scratch.split(":", 1)[-1].strip("/") in folder:
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Have shuffle files removed that nothing needs any more.

    They stay until the driver's collector finds that; a job of many steps asks it to look, so as
    not to hold the shuffles of all steps. What ended just now is found in the second round.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
