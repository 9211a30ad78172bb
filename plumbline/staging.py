"""Tables between two steps of a plan, written to the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local master may do without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        root = getattr(spark, "_plumbline_root", None)
        if root is None:
            root = spark._plumbline_root = "file://" + tempfile.mkdtemp(prefix="plumbline-")
    return root.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session may have ended before the interpreter
        pass


def remove_staged(df: DataFrame) -> None:
    """Removes the written tables that ``df`` reads, once nothing needs them."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/plumbline/" in f}:
        remove(df.sparkSession, path)


#: Shuffle files of a written table go when it is written, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: computed once, so every later read sees the same rows in the same parts."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/plumbline/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove_at_exit, spark, path)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
