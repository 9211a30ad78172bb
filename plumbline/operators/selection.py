"""Projections, filters, splits and the joins that skip or keep rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.plans.indexing import with_position


def keep_labelled(df: DataFrame, labels: DataFrame, key: str, label: Column) -> DataFrame:
    """Rows whose label equals 1."""
    return df.join(labels.where(label == 1).select(key).distinct(), key, "left_semi")


def flag_dropped(df: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """``dropped``, ``dropped_by`` (first reason that holds) and one flag a reason."""
    by = F.coalesce(*[F.when(c, F.lit(k)) for k, c in reasons.items()])
    flags = {f"is_dropped_by_{k}": F.coalesce(c, F.lit(False)) for k, c in reasons.items()}
    return df.withColumns({**flags, "dropped_by": by}).withColumn("dropped", F.col("dropped_by").isNotNull())


def in_range(score: Column, low: float | None = None, high: float | None = None) -> Column:
    out = score.isNotNull()
    if low is not None:
        out = out & (score >= low)
    return out & (score <= high) if high is not None else out


def all_in_range(scores: Column, low: float, high: float, how: str = "any") -> Column:
    """Over an array: some element (``any``) or every one (``all``) in the range."""
    test = F.exists if how == "any" else F.forall
    return test(scores, lambda x: x.between(low, high))


def not_done(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Inputs without an output."""
    return inputs.join(outputs.select(key).distinct(), key, "left_anti")


def present(inputs: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Inputs that exist."""
    return inputs.join(existing.select(key).distinct(), key, "left_semi")


def slice_rows(df: DataFrame, order: str, start: int = 0, stop: int | None = None, step: int = 1) -> DataFrame:
    """Every ``step``-th row from ``start`` to ``stop`` in the order of a column."""
    rows = with_position(df, order)
    cond = (F.col("pos") >= start) & ((F.col("pos") - start) % step == 0)
    return rows.where(cond if stop is None else cond & (F.col("pos") < stop))


def round_robin(df: DataFrame, order: str, n: int) -> DataFrame:
    """Split number of each row: position modulo ``n``."""
    return with_position(df, order).withColumn("split", (F.col("pos") % n).cast("long"))


def equal_splits(df: DataFrame, order: str, n: int) -> DataFrame:
    """Contiguous splits of size N // n; the remainder is left out."""
    rows = with_position(df, order)
    size = df.count() // n
    return rows.where(F.col("pos") < size * n).withColumn("split", F.floor(F.col("pos") / max(size, 1)).cast("long"))


def sample_by_hash(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows, the same at every run: least md5 of seed and key."""
    return df.withColumn("__h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))).orderBy("__h", key).limit(n).drop("__h")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of tables with different columns; missing values are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def reshape_name(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(renames)


def longest_first(df: DataFrame, text: str) -> DataFrame:
    """Distinct texts by number of words, most first: digest, words and position."""
    from plumbline.functions.text import words

    unique = df.where(F.col(text).isNotNull()).select(F.col(text).alias("__t")).distinct()
    sized = unique.select(F.md5("__t").alias("digest"), F.size(words(F.col("__t"))).cast("long").alias("words"))
    return with_position(sized, F.desc("words"), "digest")


class Rules:
    """Filters and rewrites by name; each is a function from a column getter to an expression."""

    def __init__(self):
        self.filters: dict = {}
        self.rewrites: dict = {}

    def filter(self, name: str, rule) -> None:
        self.filters[name] = rule

    def rewrite(self, name: str, rule) -> None:
        self.rewrites[name] = rule

    def apply(self, df: DataFrame, drop: list[str] = (), content: str | None = None) -> DataFrame:
        """Rows that no filter drops, with ``content`` rewritten."""
        for name in drop:
            df = df.where(~F.coalesce(self.filters[name](F.col), F.lit(False)))
        return df if content is None else df.withColumn("content", self.rewrites[content](F.col))
