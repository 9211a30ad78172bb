"""The operators by name in SQL: table functions that stream over partitions.

    register(spark)
    spark.sql("SELECT * FROM chunks(TABLE(texts) PARTITION BY (doc_id), 512)")
    spark.sql("SELECT grp, sum(num), sum(total) / sum(num) FROM moments(TABLE(scores) PARTITION BY (grp, share)) GROUP BY grp")

A table function sees the rows of a partition one by one, so a partition is never held, which an
aggregate function in Python would do.  A group that may hold most rows is partitioned by a share as
well; the moments of its shares add up.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType


class Chunks:
    """Windows of ``size`` words of each text of the partition, the next one ``size`` words on; the last may be shorter.

    Input rows have ``doc_id`` and ``text``.  A text without words has no chunk.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, size: AnalyzeArgument) -> AnalyzeResult:
        if size.value is None or size.value < 1:
            raise ValueError("chunks: a size of at least one word")
        names = {f.name for f in rows.dataType.fields}
        if not {"doc_id", "text"} <= names:
            raise ValueError("chunks: a table with doc_id and text")
        return AnalyzeResult(StructType().add("doc_id", LongType()).add("chunk", IntegerType()).add("n_words", IntegerType()).add("chunk_text", StringType()))

    def eval(self, row, size: int):
        words = [w for w in _split(row["text"] or "") if w]
        for k in range(0, len(words), size):
            part = words[k : k + size]
            yield row["doc_id"], k // size, len(part), " ".join(part)


class Deduplicated:
    """Rows of a partition that come first for their text, in the order of the partition: what a scorer sees once.

    State is a digest a different text of the partition.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(StructType().add("doc_id", LongType()).add("text", StringType()))

    def __init__(self):
        self.seen: set[bytes] = set()

    def eval(self, row):
        import hashlib

        digest = hashlib.sha256((row["text"] or "").encode()).digest()[:16]
        if digest not in self.seen:
            self.seen.add(digest)
            yield row["doc_id"], row["text"]


def _split(text: str) -> list[str]:
    import re

    return re.split(r"[ \t-\r]+", text)


class Moments:
    """Number, extremes, sum and sum of squares of the ``score`` of a partition, under its ``grp``; missing scores are left out."""

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        names = {f.name: f.dataType for f in rows.dataType.fields}
        if "grp" not in names or "score" not in names:
            raise ValueError("moments: a table with grp and score")
        numbers = [("num", LongType()), ("max", DoubleType()), ("min", DoubleType()), ("total", DoubleType()), ("squares", DoubleType())]
        out = StructType().add("grp", names["grp"])
        for name, kind in numbers:
            out = out.add(name, kind)
        return AnalyzeResult(out)

    def __init__(self):
        self.grp, self.num, self.max, self.min, self.total, self.squares = None, 0, None, None, 0.0, 0.0

    def eval(self, row):
        self.grp, x = row["grp"], row["score"]
        if x is None:
            return
        self.num, self.total, self.squares = self.num + 1, self.total + x, self.squares + x * x
        self.max, self.min = (x, x) if self.max is None else (max(self.max, x), min(self.min, x))

    def terminate(self):
        yield self.grp, self.num, self.max, self.min, self.total, self.squares


def register(spark: SparkSession) -> None:
    """Registers ``chunks``, ``deduplicated`` and ``moments`` in a session."""
    from pyspark.sql.functions import udtf

    for name, function in {"chunks": Chunks, "deduplicated": Deduplicated, "moments": Moments}.items():
        spark.udtf.register(name, udtf(function))
