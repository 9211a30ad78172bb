"""Scores over streams: the row scorers unchanged, replays dropped, windowed statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score_stream(stream: DataFrame, scores: dict[str, Column]) -> DataFrame:
    """Row scorers are expressions, so a stream takes them as a table does."""
    return stream.withColumns(scores)


def _timed(stream: DataFrame, time: str) -> DataFrame:
    """Watermarks need an instant; local timestamps of a stream count as session time."""
    return stream.withColumn(time, F.col(time).cast("timestamp")) if stream.isStreaming else stream


class LateRows(RuntimeError):
    """A stateful operator left rows out because they came later than its watermark allows."""


def covering_delay(table: DataFrame, time: str) -> str:
    """A watermark delay that no row of a table exceeds, whatever the order its files are read in: the span of its times."""
    t = F.unix_micros(F.col(time).cast("timestamp"))
    low, high = table.agg(F.min(t), F.max(t)).first()
    return f"{0 if low is None else (high - low) // 1_000_000 + 2} seconds"


def drop_replays(stream: DataFrame, key: str, time: str, late: str | None = "1 hour") -> DataFrame:
    """At-least-once sources: one row a key.

    Keys are remembered for ``late`` beyond their event time, and rows older than the
    watermark are left out, which ``drain`` counts.  ``late=None`` remembers every key and
    leaves nothing out; the state grows with the keys.
    """
    if late is None:
        return stream.dropDuplicates([key])
    return _timed(stream, time).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, time: str, value: str, by: list[str], length: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Count, mean, least and largest value of each window and group."""
    w = F.window(time, length)
    out = _timed(stream, time).withWatermark(time, late).groupBy(w, *by).agg(F.count(F.lit(1)).alias("num"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))
    return out.select(F.col("window.start").alias("window_start"), *by, "num", "mean", "min", "max")


def write_idempotent(stream: DataFrame, path: str, checkpoint: str):
    """Each micro-batch replaces its own folder, so a replayed batch writes the same files."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_available(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Drains what is there into a table in memory (tests and small reports)."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def process_files(inputs: DataFrame, outputs: DataFrame, key: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Only inputs that have no output yet."""
    return transform(inputs.join(outputs.select(key).distinct(), key, "left_anti"))


def guarded(df: DataFrame, columns: dict[str, Column], where: Column, message: str) -> DataFrame:
    """Columns computed where a condition holds; other rows stay, with the message in ``error``."""
    out = df.withColumns({k: F.when(where, c) for k, c in columns.items()})
    return out.withColumn("error", F.when(~F.coalesce(where, F.lit(False)), F.lit(message)))


def dropped_rows(query) -> int:
    """Rows that a finished query's stateful operators left out as too late."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def drain(
    spark,
    folder: str,
    schema,
    plan: Callable[[DataFrame], DataFrame],
    name: str,
    mode: str = "append",
    per_batch: int | None = None,
    keys: list[str] | None = None,
    allow_late: bool = False,
) -> DataFrame:
    """Reads the Parquet files of a folder as a stream, applies a plan until nothing is left, and returns what was written to the shared folder.

    A batch has ``per_batch`` files, by default so many that there are some sixteen batches.
    ``update`` keeps, for each of ``keys``, what the last batch said, so windows that are
    still open at the end count as well.  Rows that came too late raise ``LateRows``,
    unless they are allowed.
    """
    import uuid

    from plumbline.staging import shared_root

    at = f"{shared_root(spark)}/plumbline/stream-{name}-{uuid.uuid4().hex}"
    files = len(spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder).inputFiles())
    per_batch = per_batch or -(-files // 16) or 1
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).option("recursiveFileLookup", True).parquet(folder)
    out = plan(rows)
    remembered = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(remembered)
    spark.conf.set(remembered, str(max(100, 4 * files)))  # a count of dropped rows needs the report of every batch
    try:
        writer = out.writeStream.option("checkpointLocation", f"{at}/state").outputMode(mode).trigger(availableNow=True)
        if mode == "append":
            query = writer.format("parquet").option("path", f"{at}/out").start()
        elif mode == "update":
            query = writer.foreachBatch(lambda batch, n: batch.withColumn("__batch", F.lit(n)).write.mode("overwrite").parquet(f"{at}/out/__n={n}")).start()
        else:
            query = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{at}/out")).start()
        query.awaitTermination()
    finally:
        spark.conf.set(remembered, before)
    late = dropped_rows(query)
    if late and not allow_late:
        raise LateRows(f"{late} rows of {folder} came after the watermark")
    if mode != "update":
        return spark.read.schema(out.schema).parquet(f"{at}/out")
    from pyspark.sql.types import LongType, StructType

    states = spark.read.schema(StructType([*out.schema.fields]).add("__batch", LongType())).option("recursiveFileLookup", True).parquet(f"{at}/out")
    rest = [c for c in out.columns if c not in (keys or [])]
    last = states.groupBy(*(keys or [])).agg(F.max_by(F.struct(*rest), "__batch").alias("__last"))
    return last.select(*[F.col(c) if c in (keys or []) else F.col(f"__last.{c}").alias(c) for c in out.columns])


class Throughput:
    """Rows a batch and a second of a running query, from its progress reports."""

    def __init__(self, query):
        self.query = query

    def rows(self) -> list[dict]:
        return [{"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p.get("processedRowsPerSecond")} for p in self.query.recentProgress]
