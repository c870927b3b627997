"""Session settings and shared tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: The tables written inside each open scratch(), innermost last.
_open: list[list[str]] = []


def build_session(app: str = "quakeframe", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the operators are written for."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one only where none is set and all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext.getCheckpointDir()
    if not held:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-quakeframe-"))
        held = spark.sparkContext.getCheckpointDir()
    return held.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    The lineage ends there, so a lost executor costs only the tasks that read
    the table, and a plan that uses df several times computes it once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables that materialize wrote inside it. Write what you need of a lazy result before:

    with scratch(spark):
        jobs.detection_dataset(...).write.parquet(target)
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
