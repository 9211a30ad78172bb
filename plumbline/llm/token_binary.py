"""Operator 1: token ids in a packed binary file, and back.

Format.  A data set is a folder of Parquet shards that Spark's committer publishes
(a lost executor never leaves half a shard).  Shards hold ascending ranges of the
document id.  One row is one block of whole documents::

    shard, block       place of the block; blocks of a shard ascend
    start              ids of the shard that stand before the block
    bits               width of an id: the least that holds the vocabulary
    n_ids              ids in the block
    first_doc, last_doc  least and largest document id (nulls aside)
    doc_ids, offsets   the documents, and n + 1 places in the block
    payload            ids of ``bits`` bits, groups of 64 ids as ``bits`` 64-bit words

``offsets`` give random access to one document; a group of 64 ids starts at a known
word, so a range of ids is unpacked with a few numpy shifts and nothing before it is read.

Edge cases: null or empty text holds only the end id; a null id sorts first; rows of
one id are ordered by text; repeated rows stay repeated; an empty table gives an empty
folder of shards; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import fast_tokenizer
from plumbline.llm.common import Workspace, table

#: Ids after which a block ends with its document.
BLOCK_IDS = 1 << 16

FILE_SCHEMA = "shard int, block int, start long, bits int, n_ids int, first_doc long, last_doc long, doc_ids array<long>, offsets array<int>, payload binary"
READ_SCHEMA = "doc_id long, shard int, start_in_shard long, n_tokens long, ids binary"


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits, least significant bit first, in groups of 64."""
    groups = -(-len(ids) // 64)
    padded = np.zeros(groups * 64, np.uint64)
    padded[: len(ids)] = ids
    padded = np.ascontiguousarray(padded.reshape(groups, 64).T)
    words = np.zeros((bits, groups), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        words[word] |= padded[j] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= padded[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").tobytes()


def unpack(payload: bytes, bits: int, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a payload; reads only the groups that hold them."""
    first, last = start // 64, -(-end // 64)
    words = np.frombuffer(payload, "<u8", (last - first) * bits, first * bits * 8).reshape(-1, bits).T
    out = np.empty((64, last - first), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[j] = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            out[j] |= words[word + 1] << np.uint64(64 - shift)
    return (out & mask).T.reshape(-1)[start - 64 * first : end - 64 * first].astype("<u4")


def write(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, tokenizer: str | None = None, shards: int | None = None) -> None:
    """Tokenise every whole text, append ``end_id`` and write the ids in id order."""
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(fast_tokenizer.load_json(tokenizer))
    bits = width(max(fast_tokenizer.vocabulary_size(spec.value), end_id + 1))
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    end = int(end_id).to_bytes(4, "little")
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("bits", pa.int32()), ("n_ids", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int32())), ("payload", pa.binary())])

    def blocks(batches):
        from pyspark import TaskContext

        tok = fast_tokenizer.engine(spec.value)
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        held, names, offsets = [], [], [0]

        def close():
            nonlocal block, start, held, names, offsets
            ids = np.frombuffer(b"".join(held), "<u4")
            known = [x for x in names if x is not None]
            row = [[shard], [block], [start], [bits], [len(ids)], [min(known, default=None)], [max(known, default=None)], [names], [offsets], [pack(ids, bits)]]
            block, start = block + 1, start + len(ids)
            held, names, offsets = [], [], [0]
            return pa.record_batch([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                ids = tok.encode(text.as_py()) + end
                held.append(ids)
                names.append(name.as_py())
                offsets.append(offsets[-1] + len(ids) // 4)
                if offsets[-1] >= BLOCK_IDS:
                    yield close()
        if names:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(blocks, FILE_SCHEMA).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written folder: id, shard, place in the shard, ids as 32-bit little-endian."""
    schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("start_in_shard", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, at = unpack(row["payload"], row["bits"], 0, row["n_ids"]), row["offsets"]
                data = [ids[a:b].tobytes() for a, b in zip(at, at[1:])]
                n = len(data)
                cols = [row["doc_ids"], [row["shard"]] * n, [row["start"] + a for a in at[:-1]], [len(d) // 4 for d in data], data]
                yield pa.record_batch([pa.array(v, f.type) for v, f in zip(cols, schema)], schema=schema)

    return spark.read.schema(FILE_SCHEMA).parquet(path).mapInArrow(documents, READ_SCHEMA)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each shard; one row per shard, so it is bounded by the number of shards."""
    sizes = spark.read.schema(FILE_SCHEMA).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    base, rows = 0, []
    for r in sorted(sizes, key=lambda r: r["shard"]):
        rows.append((r["shard"], base))
        base += r["n"]
    return spark.createDataFrame(rows, "shard int, base long")


def token_of(spark: SparkSession, path: str, doc_id: int) -> np.ndarray:
    """Random access: the ids of one document; only the block that holds it is unpacked.

    Shards and blocks are in id order, so the range test, which Parquet's statistics
    answer, leaves one block or two to look into.
    """
    near = spark.read.schema(FILE_SCHEMA).parquet(path).where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    rows = near.where(F.array_contains("doc_ids", doc_id)).limit(1).collect()
    if not rows:
        return np.zeros(0, "<u4")
    k = rows[0]["doc_ids"].index(doc_id)
    return unpack(bytes(rows[0]["payload"]), rows[0]["bits"], rows[0]["offsets"][k], rows[0]["offsets"][k + 1])


def op1_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the packed ids of ``documents`` to the shared folder, read them back, digest each document."""
    ws = Workspace(spark, "token-binary")
    path = f"{ws.path}/ids"
    write(table(spark, sf_dir, "documents"), path)
    base = F.broadcast(shard_starts(spark, path))
    return read(spark, path).join(base, "shard").select("doc_id", (F.col("base") + F.col("start_in_shard")).alias("start"), "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc_of_ids(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
