"""Readers: JSON, JSON lines, Parquet, CSV tables, manifests, and binary media by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.selection import union_all


def manifest(spark: SparkSession, path: str) -> list[str]:
    """Paths listed one a line; blank lines are skipped."""
    return [r[0].strip() for r in spark.read.text(path).where(F.trim("value") != "").collect()]


def is_json_lines(spark: SparkSession, path: str) -> bool:
    """Whether the first line is a JSON value by itself."""
    head = spark.read.text(path).limit(1).select(F.try_parse_json("value").isNotNull()).first()
    return bool(head and head[0])


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A list of rows, JSON lines, or an envelope with the rows under ``data``."""
    lines = path.endswith((".jsonl", ".jsonl.gz")) or is_json_lines(spark, path)
    df = spark.read.option("multiLine", not lines).json(path)
    if "data" in df.columns and df.schema["data"].dataType.typeName() == "array":
        return df.select(F.explode("data").alias("d")).select("d.*")
    return df


def read_rows(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Rows of one file or folder by extension; a folder is read with its sub-folders."""
    fmt = fmt or path.rsplit(".", 1)[-1]
    if fmt == "parquet":
        return spark.read.option("recursiveFileLookup", True).parquet(path)
    if fmt in ("csv", "tsv"):
        return spark.read.option("header", True).option("sep", "\t" if fmt == "tsv" else ",").csv(path)
    if fmt in ("json", "jsonl", "gz"):
        return read_json(spark, path)
    raise ValueError(f"no reader for .{fmt}")


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """All JSON lines and Parquet files below a folder; other files are ignored."""
    found = []
    for glob, read in (("*.parquet", "parquet"), ("*.jsonl", "json")):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path").limit(1)
        if not files.isEmpty():
            found.append(getattr(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob), read)(path))
    if not found:
        raise FileNotFoundError(f"no rows below {path}")
    return union_all(found)


def with_media(meta: DataFrame, root: str, column: str, glob: str = "*") -> DataFrame:
    """Rows joined with the bytes of the file that a column names, by path below ``root``."""
    spark = meta.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    top = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toUri().getPath().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    plain = F.regexp_replace("path", r"^[a-z0-9]+:(//[^/]*)?", "")
    named = files.select(F.substring(plain, len(top) + 2, 1 << 30).alias("__name"), "content")
    wanted = F.regexp_replace(F.regexp_replace(F.col(column), r"^[a-z0-9]+:(//[^/]*)?", ""), f"^({_quoted(top)})?/*", "")
    return meta.join(named, wanted == F.col("__name"), "left").drop("__name")


def _quoted(literal: str) -> str:
    return "\\Q" + literal + "\\E"


def with_pictures(rows: DataFrame, encoded: str | None = None, content: str | None = None) -> DataFrame:
    """Picture bytes from base64 text, or else from a bytes column; what begins like no known picture
    is null, with ``error``, and is skipped later."""
    data = F.coalesce(*[c for c in (F.try_to_binary(F.col(encoded), F.lit("base64")) if encoded else None, F.col(content) if content else None) if c is not None])
    head = F.hex(F.substring(data, 1, 12))
    known = head.startswith("FFD8FF") | head.startswith("89504E470D0A1A0A") | head.startswith("47494638") | (head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250")) | head.startswith("424D")
    ok = F.coalesce(known, F.lit(False))
    return rows.withColumns({"picture": F.when(ok, data), "error": F.when(~ok, F.lit("no picture"))})


def read_hub_folder(spark: SparkSession, root: str, split: str = "train", config: str | None = None) -> DataFrame:
    """A downloaded hub dataset: the Parquet or JSON files of a split, below a configuration's folder if there is one."""
    top = f"{root.rstrip('/')}/{config}" if config else root.rstrip("/")
    for glob, read in ((f"*{split}*.parquet", "parquet"), (f"*{split}*.json*", "json")):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(top).select("path").limit(1)
        if not files.isEmpty():
            return getattr(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob), read)(top)
    raise FileNotFoundError(f"no {split} files below {top}")


def load_dataset(spark: SparkSession, *, path: str | None = None, manifest_path: str | None = None, hub: str | None = None, split: str = "train", config: str | None = None) -> DataFrame:
    """A downloaded hub dataset, the files of a list, an object store's path, or a local file or folder; without any it raises."""
    if hub:
        return read_hub_folder(spark, hub, split, config)
    if manifest_path:
        return read_manifest(spark, manifest_path)
    if not path:
        raise ValueError("no dataset: give a path, a list of files or a hub folder")
    path = path.replace("s3://", "s3a://", 1) if path.startswith("s3://") else path
    return read_rows(spark, path) if path.rsplit("/", 1)[-1].count(".") else read_folder(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files of a list; files that do not exist are skipped, with none left it raises."""
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    found = []
    for name in manifest(spark, path):
        at = jvm.org.apache.hadoop.fs.Path(name)
        if at.getFileSystem(conf).exists(at):
            found.append(name)
    by: dict[str, list[str]] = {}
    for name in found:
        by.setdefault("parquet" if name.endswith(".parquet") else "json", []).append(name)
    if not found:
        raise FileNotFoundError(f"none of the files in {path} exists")
    return union_all([getattr(spark.read, kind)(*names) if kind == "parquet" else spark.read.json(names) for kind, names in by.items()])


def read_media(spark: SparkSession, meta: str, root: str, column: str, *, key: str | None = None, caption: str | None = None) -> DataFrame:
    """``id, path, content`` and ``caption`` of the pictures or videos that a table lists; the id defaults to the path.

    Missing files stay, with null content; a table of another format than CSV, TSV, JSON
    or Parquet raises.
    """
    rows = with_media(read_rows(spark, meta), root, column)
    return rows.select(F.col(key or column).alias("id"), F.col(column).alias("path"), "content", *([F.col(caption).alias("caption")] if caption else []))
