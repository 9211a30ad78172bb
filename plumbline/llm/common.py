"""Shared plumbing of the pipeline operators: staged tables, components, byte views."""

from __future__ import annotations

import atexit
import gc
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.staging import shared_root


#: Bounds of an Arrow batch while a table is written.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


class Workspace:
    """Intermediate tables of one operator run, as Parquet in the shared folder.

    A written table cuts the lineage: an executor lost later costs a re-read and
    never a recomputation of what came before.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/plumbline/{name}-{uuid.uuid4().hex}"
        atexit.register(self._forget)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        with self._small_batches():
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @contextmanager
    def _small_batches(self):
        """Rows of whole texts or sets go to Python in small batches: a batch is held twice, by the JVM and by the worker."""
        conf, before = self.spark.conf, {}
        for key, value in BATCHES.items():
            before[key] = conf.get(key, None)
            conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                conf.unset(key) if value is None else conf.set(key, value)

    def drop(self, name: str = "") -> None:
        """Delete a table that no later step reads (all of them without a name)."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let executors delete shuffle files of plans that nobody holds any more.

        Spark deletes them when the driver's garbage collector finds the plans; it has no
        other call for it.  Left alone, the files of every step stay until a driver with
        a large heap happens to collect, and disks hold several times the input.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def _forget(self) -> None:
        try:
            self.drop()
        except Exception:  # the session may have ended before the interpreter
            pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to differ from every column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def remainder_of_crc(doc_id: str | Column, modulus: int = 3) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: null)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % modulus


#: DuckDB has no crc32: two common table expressions (of a recursive list) with the remainders of all byte values, from eight shifts.
CRC_TABLES = """
steps(b, k, c) AS (
  SELECT CAST(range AS UBIGINT), 0, CAST(range AS UBIGINT) FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END FROM steps WHERE k < 8),
crcs AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8)"""


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII string, with ``t`` of ``crcs`` in reach."""
    bytes_ = f"list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS UBIGINT)))"
    return f"xor(list_reduce({bytes_}, lambda a, x: xor(a >> 8, t[1 + CAST(xor(a, x) & 255 AS INTEGER)])), CAST(4294967295 AS UBIGINT))"


def connected_components(ws: Workspace, edges: DataFrame, name: str = "cc") -> DataFrame:
    """Smallest reachable id of every node that has an edge.

    ``edges(a, b)`` are undirected longs.  Each round hooks every node to its
    smallest neighbour, jumps the pointers twice, and contracts the edges, so the
    graph at least halves and chains shorten; every round works on written tables.
    Returns ``(node, component)``.
    """
    cur = ws.stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-e0")
    maps: list[DataFrame] = []
    while not cur.isEmpty():
        k = len(maps)
        both = cur.union(cur.select(F.col("b"), F.col("a")))
        hook = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        hook = ws.stage(hook, f"{name}-h{k}")
        top = hook.select(F.col("node").alias("up"), F.col("up").alias("up2"))
        jump = ws.stage(hook.join(top, "up").select("node", F.col("up2").alias("up")), f"{name}-p{k}")
        maps.append(jump)
        left = jump.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        right = jump.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        moved = cur.join(left, "a").join(right, "b").where("ua <> ub")
        cur = ws.stage(moved.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), f"{name}-e{k + 1}")
    if not maps:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = maps[0]
    for later in maps[1:]:
        out = out.join(later.select(F.col("node").alias("up"), F.col("up").alias("next")), "up", "left").select("node", F.coalesce("next", "up").alias("up"))
    return ws.stage(out.select("node", F.col("up").alias("component")), f"{name}-out")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column laid end to end, and n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]] if len(column) else whole[:0], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20, rows: int = 4096):
    """Cut a batch so that each slice holds about ``most`` bytes of ``column``, one row at least and ``rows`` at most."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if i > start and (held + n > most or i - start >= rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < len(lengths):
        yield batch.slice(start, len(lengths) - start)


#: Odd multiplier of the polynomial hashes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown on demand and kept by the worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            have = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]), dtype=np.uint64)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    if salt:
        x += np.uint64(salt * BASE & (2**64 - 1))
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(mult)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Hash of any slice of a sequence from prefix sums: equal slices, equal hashes."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        n = len(values)
        self.inverse = powers(pow(base, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(base, n), out=self.sums[1:], dtype=np.uint64)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64), 3)


def spread(data: np.ndarray) -> np.ndarray:
    """Each byte as a fixed random 64-bit value, so that sums of them hash well."""
    return _BYTE_VALUES[data]


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)
