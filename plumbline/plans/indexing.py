"""Row positions and running sums without a task that holds a whole table or group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.staging import staged

PART, AT = "__part", "__at"


def dealt_by_ranges(df: DataFrame, order: list[str | Column], partitions: int | None) -> DataFrame:
    """Rows dealt by ranges of an order and sorted inside them, written once with part and place.

    Range bounds are sampled anew by every execution, so parts and places of two
    executions differ; what is counted and what is numbered must be one written table.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(AT, F.monotonically_increasing_id())
    rows = rows.withColumn(PART, F.shiftright(AT, 33).cast("int")).withColumn(AT, F.col(AT).bitwiseAND((1 << 33) - 1))
    return staged(rows, "dealt")


def with_position(df: DataFrame, *order: str | Column, name: str = "pos", partitions: int | None = None) -> DataFrame:
    """Adds the 0-based position of each row in the given order.

    A row's position is its place in the part plus the rows of the parts before.  Only
    one count a part reaches the driver.
    """
    dealt = dealt_by_ranges(df, list(order), partitions)
    base, rows = 0, []
    for r in sorted(dealt.groupBy(PART).count().collect()):
        rows.append((r[0], base))
        base += r[1]
    starts = df.sparkSession.createDataFrame(rows, f"{PART} int, __base long")
    return dealt.join(F.broadcast(starts), PART).withColumn(name, F.col("__base") + F.col(AT)).drop(AT, PART, "__base")


def with_running(
    df: DataFrame, group: str | list[str], order: list[str], *, pos: str | None = None, sums: dict[str, Column] | None = None, size: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Adds, within each group, the position of a row, sums over the rows before it, and with ``size`` the group's number of rows.

    A group that holds a third of all rows spans many parts: each part numbers and sums
    its own rows, and what the group's earlier parts add comes from a row a part and group.
    Null groups count as one group.
    """
    keys = [group] if isinstance(group, str) else list(group)
    values = {**({pos: F.lit(1).cast("long")} if pos else {}), **(sums or {})}
    raw = {f"__v{i}": c for i, c in enumerate(values.values())}
    dealt = dealt_by_ranges(df.withColumns(raw), [*keys, *order], partitions)
    before = Window.partitionBy(PART, *keys).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumns({f"__s{i}": F.coalesce(F.sum(v).over(before), F.lit(0)) for i, v in enumerate(raw)})
    totals = dealt.groupBy(PART, *keys).agg(F.count(F.lit(1)).alias("__n"), *[F.sum(v).alias(f"__t{i}") for i, v in enumerate(raw)])
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(F.col(PART).alias("__p"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.sum("__n").over(Window.partitionBy(*keys)).alias("__size"), *[F.coalesce(F.sum(f"__t{i}").over(earlier), F.lit(0)).alias(f"__b{i}") for i in range(len(raw))])
    # the two sides go by name: a column of the caller may be called as one of these
    same = F.col(f"l.{PART}") == F.col("r.__p")
    for i, k in enumerate(keys):
        same &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.__k{i}"))
    out = local.alias("l").join(base.alias("r"), same)
    new = [(F.col(f"l.__s{i}") + F.col(f"r.__b{i}")).alias(name) for i, name in enumerate(values)]
    return out.select(*[F.col(f"l.{c}") for c in df.columns if c not in values], *new, *([F.col("r.__size").alias(size)] if size else []))
