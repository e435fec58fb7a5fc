"""Sessions for tests and benches, and tables written to the cluster's shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "12g", partitions: int | None = None) -> SparkSession:
    """A local session with the settings the operators are tested under."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tessellum")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or in a local session without one a temporary folder.

    A cluster that names no such folder is an error, as a folder of one machine cannot be read by the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _own
    if _own is None:
        _own = tempfile.mkdtemp(prefix="tessellum-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return _own


_own: str | None = None
_written: list[str] = []


def clear_materialized(spark: SparkSession) -> int:
    """Delete the tables that materialize wrote for this process, once no result that reads them is needed; gives their number."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += path.getFileSystem(conf).delete(path, True)
    return n


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df as parquet into the shared folder and read it back: cuts the lineage, survives lost executors.

    Use it where a result of Python work is read more than once. An empty df keeps its schema.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
