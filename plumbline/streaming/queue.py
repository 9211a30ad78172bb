"""Message queues: a streaming source with bounded batches, and messages for work that is not done.

Offsets are Spark's: a batch is committed as a whole after the one before it, so commits
are contiguous by construction, and a lost worker's batch is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(servers: str, topic: str, *, most: int = 100, start: str = "earliest", group: str | None = None) -> dict[str, str]:
    """Options of the reader; ``most`` messages a batch."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "maxOffsetsPerTrigger": str(most), "startingOffsets": start, "failOnDataLoss": "false"}
    return out | ({"kafka.group.id": group} if group else {})


def read_queue(spark: SparkSession, servers: str, topic: str, **more) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **more)).load()


def parse_messages(messages: DataFrame, schema: str) -> DataFrame:
    """Messages as rows of a schema, with topic, partition and offset; broken ones keep their text in ``error``."""
    text = F.col("value").cast("string")
    parsed = messages.select(*[c for c in ("topic", "partition", "offset", "timestamp") if c in messages.columns], text.alias("__text"), F.from_json(text, schema).alias("m"))
    names = [c for c in parsed.schema["m"].dataType.names]
    broken = F.col("m").isNull() | F.forall(F.array(*[F.col(f"m.{c}").isNull() for c in names]), lambda x: x)
    return parsed.select(*[c for c in parsed.columns if c not in ("m", "__text")], "m.*", F.when(broken, F.col("__text")).alias("error"))


def messages(df: DataFrame, key: Column, *columns: str) -> DataFrame:
    """``key, value`` rows: the columns as one JSON object."""
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct(*columns)).alias("value"))


def missing_work(inputs: DataFrame, outputs: DataFrame, key: str, *columns: str) -> DataFrame:
    """A message for each input that has no output."""
    return messages(inputs.join(outputs.select(key).distinct(), key, "left_anti"), F.col(key), *(columns or (key,)))


def write_queue(df: DataFrame, servers: str, topic: str) -> None:
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def follow_up(batch: DataFrame, servers: str, topic: str, key: str, *columns: str) -> None:
    """For ``foreachBatch``: a message about each row that a batch has written."""
    write_queue(messages(batch, F.col(key), *(columns or (key,))), servers, topic)


def message_states(events: DataFrame, keys: list[str], done: Column) -> DataFrame:
    """``keys, acknowledged``: whether any of a message's rows (sent, sent again, acknowledged) says so.

    On a stream this is the running state of every message, for ``drain`` in update mode; repeated and late
    rows change nothing, as the largest of two values does not depend on their order.
    """
    return events.groupBy(*keys).agg(F.max(F.coalesce(done, F.lit(False))).alias("acknowledged"))


def commit_points(states: DataFrame, partition: str, offset: str) -> DataFrame:
    """What each partition may commit: the offset below which every message that was seen is acknowledged.

    Also how many acknowledged messages wait behind it, and the first that holds them up.  Two
    aggregates with partial sums, so a partition of any size is never on one task.
    """
    head = states.groupBy(partition).agg(F.min(F.when(~F.col("acknowledged"), F.col(offset))).alias("head"), F.max(offset).alias("last"))
    behind = F.col("acknowledged") & (F.col(offset) > F.col("head"))
    named = head.withColumnRenamed(partition, "__p")
    joined = states.join(F.broadcast(named), F.col(partition).eqNullSafe(F.col("__p")))  # a row a partition of the queue
    waiting = joined.groupBy(partition).agg(F.first("head").alias("head"), F.first("last").alias("last"), F.count(F.when(behind, 1)).alias("waiting"))
    return waiting.select(partition, F.coalesce(F.col("head"), F.col("last") + 1).alias("commit"), "head", "waiting")


def stalled(points: DataFrame, capacity: int) -> DataFrame:
    """Heads to send again: more than three times the capacity waits behind them."""
    return points.where(F.col("head").isNotNull() & (F.col("waiting") > 3 * capacity))
