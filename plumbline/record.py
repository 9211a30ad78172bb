"""The score record: long table of scores, JSON of the agreed shape, files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import significant


def long_scores(df: DataFrame, key: str, scorer: str, metrics: dict[str, str]) -> DataFrame:
    """A row for each item and metric: ``item, scorer, metric, score``, 4 significant figures."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("score")) for m, c in metrics.items()])
    flat = df.select(F.col(key).alias("item"), F.lit(scorer).alias("scorer"), F.explode(pairs).alias("p"))
    return flat.select("item", "scorer", "p.metric", significant(F.col("p.score")).alias("score"))


def item_json(scores: DataFrame) -> DataFrame:
    """One JSON object an item: scorer -> metric -> score."""
    per = scores.groupBy("item", "scorer").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "score")))).alias("m"))
    by_name = lambda a, b: F.when(a["scorer"] < b["scorer"], -1).when(a["scorer"] > b["scorer"], 1).otherwise(0)  # noqa: E731  maps have no order
    return per.groupBy("item").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("scorer", "m")), by_name))).alias("json"))


def write(scores: DataFrame, meta: DataFrame | None, path: str, add: bool = False) -> None:
    """``items`` and ``meta`` as JSON lines under ``path``; the committer publishes all or nothing.

    ``add`` keeps the items that are there and adds the new ones.
    """
    item_json(scores).write.mode("append" if add else "overwrite").json(f"{path}/items")
    if meta is not None:
        meta.write.mode("overwrite").json(f"{path}/meta")
