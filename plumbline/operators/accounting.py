"""Counts by sub-path, ratios, token estimates, weights and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.plans.indexing import with_running


def roll_up(df: DataFrame, group: str, sums: dict[str, Column]) -> DataFrame:
    """Sums by group, and over all as group ``_``."""
    rolled = df.rollup(group).agg(F.grouping(group).alias("__all"), *[F.sum(c).alias(k) for k, c in sums.items()])
    return rolled.withColumn(group, F.when(F.col("__all") == 1, F.lit("_")).otherwise(F.col(group))).drop("__all")


def quality_gate(df: DataFrame, group: str, error: Column, dropped: Column, threshold: float) -> DataFrame:
    """Errors over all rows, written and dropped, and whether the ratio stays within the threshold."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(dropped.cast("long")).alias("n_dropped"), F.sum(error.cast("long")).alias("errors"))
    return counts.withColumn("ratio", F.col("errors") / F.col("n")).withColumn("passes", F.col("ratio") <= threshold)


def token_estimate(df: DataFrame, group: str, text: str, order: str, every: int, kept: Column) -> DataFrame:
    """Tokens of each group from every ``every``-th row that survives, the first one always."""
    tokens = F.size(F.filter(F.split(text, r"\s+"), lambda t: t != ""))
    slim = df.select(group, order, F.coalesce(kept, F.lit(False)).alias("__kept"), F.octet_length(text).alias("__size"), tokens.alias("__tokens"))
    live = with_running(slim.where("__kept"), group, [order], pos="__n")
    probe = F.col("__n") % every == 0
    sampled = live.groupBy(group).agg(F.sum(F.when(probe, F.col("__tokens"))).alias("tokens"), F.sum(F.when(probe, F.col("__size"))).alias("bytes"), F.count(F.lit(1)).alias("live"))
    lines = df.groupBy(group).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length(text)).alias("total_bytes"))
    out = lines.join(sampled, group, "left").withColumn("token_per_byte", F.try_divide("tokens", "bytes"))
    out = out.withColumn("remained", F.coalesce(F.col("live"), F.lit(0)) / F.col("lines"))
    return out.withColumn("estimate", F.floor(F.col("total_bytes") * F.col("token_per_byte") * F.col("remained")).cast("long"))


def weights(df: DataFrame, group: str, amount: Column) -> DataFrame:
    """Each group's share of the total; the total is one row."""
    sums = df.groupBy(group).agg(F.sum(amount).alias("amount"))
    return sums.crossJoin(F.broadcast(sums.agg(F.sum("amount").alias("__all")))).select(group, "amount", (F.col("amount") / F.col("__all")).alias("weight"))


def profile(df: DataFrame, key: str, text: str, first: int = 10_000) -> DataFrame:
    """Rows, size in MB and a digest of the first rows in key order."""
    whole = df.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(F.octet_length(text)) / 1e6, 2).alias("size_mb"))
    head = df.orderBy(key).limit(first).select(key, F.sha2(F.concat_ws("|", F.col(key).cast("string"), text), 256).alias("h"))
    digest = head.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, "h"))), lambda r: r["h"]), ""), 256).alias("digest"))
    return whole.crossJoin(digest)


def statistics(df: DataFrame, score: str, by: list[str] | None = None, nan: str = "ignore") -> DataFrame:
    """num, max, min, mean and population variance; ``nan='propagate'`` lets a missing score spoil all."""
    c = F.col(score)
    aggs = {"num": F.count(F.lit(1)), "max": F.max(c), "min": F.min(c), "mean": F.avg(c), "variance": F.var_pop(c)}
    if nan == "propagate":
        bad = F.max((c.isNull() | F.isnan(c)).cast("int")) == 1
        aggs = {k: v if k == "num" else F.when(bad, F.lit(float("nan"))).otherwise(v) for k, v in aggs.items()}
    return df.groupBy(*(by or [])).agg(*[v.alias(k) for k, v in aggs.items()])


def early_stop(df: DataFrame, group: str, order: str, most: int) -> DataFrame:
    """The first ``most`` rows of each file."""
    return with_running(df, group, [order], pos="__n").where(F.col("__n") < most).drop("__n")


def without_errors(df: DataFrame, error: str = "error") -> DataFrame:
    """Rows that carry no error."""
    return df.where(F.col(error).isNull()).drop(error)
