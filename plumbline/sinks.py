"""Writers: JSON lines, routed sub-paths with counts, attribute side tables, publication marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import accounting, attributes
from plumbline.plans.indexing import with_running


def write_lines(df: DataFrame, path: str, compression: str = "gzip") -> None:
    df.write.option("compression", compression).json(path)


def write_routed(df: DataFrame, path: str, route: str, dropped: Column, sums: dict[str, Column]) -> DataFrame:
    """Rows that stay, in one folder a route; returns counts by route and over all (``_``)."""
    kept = df.where(~F.coalesce(dropped, F.lit(False)))
    kept.write.partitionBy(route).json(path)
    return accounting.roll_up(df, route, {"rows": F.when(~F.coalesce(dropped, F.lit(False)), 1).otherwise(0), "dropped": F.when(dropped, 1).otherwise(0), **sums})


def write_attribute(df: DataFrame, path: str, file: str, order: str, value: str) -> None:
    """A side table of file, order column, ``pos`` and value, in a file's order; arrays also carry length and offset."""
    keyed = df.select(file, order, value)
    array = df.schema[value].dataType.typeName() == "array"
    sums = {"off": F.size(F.col(value)).cast("long")} if array else {}
    placed = with_running(keyed, file, [order], pos="pos", sums=sums)
    if array:
        placed = placed.withColumn("len", F.size(value).cast("long"))
    placed.write.partitionBy(file).parquet(path)


def write_documents(df: DataFrame, path: str, file: str, order: str) -> DataFrame:
    """JSON lines by file, and the address of every document in the text of its file.

    The previous address (``doc_loc``) joins ``track_loc``; the new one is returned, keyed
    by file and order, as a line cannot hold its own length.
    """
    columns = [c for c in df.columns if c not in ("doc_loc", "track_loc")]
    text = "array<string>"
    old = F.col("doc_loc") if "doc_loc" in df.columns else F.lit(None).cast("string")
    history = F.col("track_loc") if "track_loc" in df.columns else F.lit(None).cast(text)
    moved = df.select(*columns, attributes.track(history, old, F.lit(None))[1].alias("track_loc"))
    lines = moved.select(file, order, F.to_json(F.struct(*moved.columns)).alias("value"))
    lines.repartition(file).sortWithinPartitions(file, order).select("value", file).write.partitionBy(file).text(path)
    return attributes.record_offsets(lines, file, order, F.col("value"))


def write_mark(spark: SparkSession, path: str, name: str, body: str = "") -> None:
    """A mark file of a job (success, failure, summary) below its output."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        stream.write(bytearray(body.encode()))
    finally:
        stream.close()


def write_summary(spark: SparkSession, path: str, counts: DataFrame) -> None:
    """Counts by sub-path (a row each) as one JSON object in ``_SUMMARY``."""
    import json

    rows = [r.asDict() for r in counts.collect()]  # a row a sub-path
    write_mark(spark, path, "_SUMMARY", json.dumps(rows, ensure_ascii=False, default=str))


def all_published(spark: SparkSession, path: str) -> bool:
    """Whether a folder, or else every folder right below it, has its success mark."""
    if is_published(spark, path):
        return True
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return False
    below = [s.getPath().toString() for s in fs.listStatus(at) if s.isDirectory()]
    return bool(below) and all(is_published(spark, p) for p in below)


def is_published(spark: SparkSession, path: str) -> bool:
    """Whether the committer has left its success mark."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def output_name(path: Column) -> Column:
    """Name of the output of an input file: its base name with ``_output.json``."""
    return F.concat(F.regexp_extract(path, r"([^/]+?)(\.jsonl)?(\.gz)?$", 1), F.lit("_output.json"))
