"""Object storage: connection settings by bucket, listings, lines with byte ranges, single rows by address."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import bucket_and_key
from plumbline.plans.indexing import with_running

_KEYS = {"access_key": "access.key", "secret_key": "secret.key", "endpoint": "endpoint", "path_style": "path.style.access"}


def profile_of(bucket: str, buckets: Mapping[str, Mapping], prefixes: Mapping[str, Mapping] | None = None) -> Mapping:
    """Settings of a bucket: its own, those of the first prefix that it starts with, or the default's."""
    if bucket in buckets:
        return buckets[bucket]
    for prefix, profile in (prefixes or {}).items():
        if bucket.startswith(prefix):
            return profile
    return buckets["[default]"]


def spark_settings(buckets: Mapping[str, Mapping]) -> dict[str, str]:
    """Settings of a Spark session: the default's, and what a bucket has different from it."""
    default = buckets["[default]"]
    out = {f"spark.hadoop.fs.s3a.{_KEYS[k]}": str(v) for k, v in default.items() if k in _KEYS}
    for name, profile in buckets.items():
        if name != "[default]":
            out |= {f"spark.hadoop.fs.s3a.bucket.{name}.{_KEYS[k]}": str(v) for k, v in profile.items() if k in _KEYS and v != default.get(k)}
    return out


def list_files(spark: SparkSession, path: str, glob: str = "*", limit: int | None = None) -> DataFrame:
    """``path, size, modified`` of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    out = files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return out if limit is None else out.orderBy("path").limit(limit)


def with_bucket(files: DataFrame) -> DataFrame:
    bucket, key = bucket_and_key(F.col("path"))
    return files.withColumns({"bucket": bucket, "key": key})


def read_ranges(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Lines with ``file, offset, n_bytes, loc``, for files whose lines end in a line feed.

    Spark cuts large files into parts and reads each in order; part and running number
    order the lines of a file, and their sizes add up to offsets.  Compressed files are
    addressed in their text.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "\n").text(path)
    rows = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__row"))
    rows = rows.withColumn("n_bytes", (F.octet_length("value") + 1).cast("long"))
    placed = with_running(rows, "file", ["__start", "__row"], pos="line", sums={"offset": F.col("n_bytes")}).drop("__start", "__row")
    return placed.withColumn("loc", F.concat("file", F.lit("?bytes="), F.col("offset").cast("string"), F.lit(","), F.col("n_bytes").cast("string")))


def parse_address(loc: str) -> tuple[str, int, int]:
    path, _, span = loc.partition("?bytes=")
    offset, _, size = span.partition(",")
    return path, int(offset), int(size)


def read_row(spark: SparkSession, loc: str) -> str:
    """The line at an address, by one ranged read through the file system that Spark uses."""
    path, offset, size = parse_address(loc)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        stream.seek(offset)
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)).decode("utf-8").rstrip("\n")
    finally:
        stream.close()


def rows_at(ranges: DataFrame, addresses: DataFrame, column: str = "loc") -> DataFrame:
    """Many rows by address: a join with the lines of the files."""
    return addresses.select(F.col(column).alias("loc")).join(ranges, "loc")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records by extension: web archives, or lines with addresses; formats without a reader raise."""
    name = path.lower()
    if name.endswith((".warc", ".warc.gz")):
        from plumbline.sources.warc import read_warc

        return read_warc(spark, path)
    if name.endswith((".7z", ".h5", ".hdf5")):
        raise ValueError(f"no reader for {path.rsplit('.', 1)[-1]} files")
    return read_ranges(spark, path)
