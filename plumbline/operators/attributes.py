"""Attribute side tables: positional joins, ragged layouts, offsets, weighted chunks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.plans.indexing import with_running


def positional_join(content: DataFrame, attribute: DataFrame, file: str, order_left: str, order_right: str) -> DataFrame:
    """Rows of a file meet by position; the longer side's tail is left out."""
    a = with_running(content, file, [order_left], pos="pos")
    b = with_running(attribute, file, [order_right], pos="pos")
    return a.join(b.drop(order_right) if order_right != order_left else b.withColumnRenamed(order_right, f"{order_right}_r"), [file, "pos"])


def match_by_name(contents: DataFrame, attributes: DataFrame, key: str) -> DataFrame:
    """Attribute files of each content file: its name as a prefix, ``-attr-<key>`` behind it.

    The join key is cut out of the attribute's name, so it is an equi-join.
    """
    named = attributes.withColumn("stem", F.regexp_extract("attribute_file", rf"^(.*)-attr-{key}\b", 1)).where("stem <> ''")
    return contents.withColumn("stem", F.regexp_replace("content_file", r"(\.jsonl)?(\.gz)?$", "")).join(named, "stem")


def flat_layout(df: DataFrame, group: str, order: str, values: Column) -> DataFrame:
    """Length and exclusive offset of each row's array in the flat array of its group."""
    sized = df.withColumn("len", F.size(values).cast("long"))
    return with_running(sized, group, [order], sums={"off": F.col("len")})


def _packed(batches, span: int):
    """Elements ``(group, i, value)`` as runs of neighbours that cross no border of a span: ``g, part, at, run``."""
    import pyarrow as pa

    for batch in batches:
        i = batch.column(1).to_numpy()
        g = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
        order = np.lexsort((i, g))
        i, g = i[order], g[order]
        starts = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (i[1:] != i[:-1] + 1) | (i[1:] // span != i[:-1] // span)])) if len(i) else i[:0]
        runs = pa.ListArray.from_arrays(pa.array(np.append(starts, len(i)), pa.int32()), batch.column(2).take(pa.array(order)))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(order[starts])), pa.array(i[starts] // span, pa.int64()), pa.array(i[starts], pa.int64()), runs], names=["g", "part", "at", "run"])


def _owned(span: int):
    """From the rows and the runs of a span: what each row has of it, ``g, off, lo, piece``."""

    def work(rows, runs):
        import pyarrow as pa

        if not (rows.num_rows and runs.num_rows):
            return pa.table({"g": rows.column("g").slice(0, 0), "off": pa.array([], pa.int64()), "lo": pa.array([], pa.int64()), "piece": runs.column("run").slice(0, 0)})
        runs = runs.sort_by("at").combine_chunks()
        lists = runs.column("run").combine_chunks()
        size = lists.value_lengths().to_numpy()
        place = np.repeat(runs.column("at").to_numpy() - (np.cumsum(size) - size), size) + np.arange(size.sum())
        off, n, part = (rows.column(c).to_numpy() for c in ("off", "len", "part"))
        lo, hi = np.maximum(off, part * span), np.minimum(off + n, (part + 1) * span)
        a = np.searchsorted(place, lo)
        k = np.searchsorted(place, hi) - a
        ends = np.cumsum(k)
        taken = lists.flatten().take(pa.array(np.repeat(a - (ends - k), k) + np.arange(ends[-1])))
        return pa.table({"g": rows.column("g"), "off": rows.column("off"), "lo": pa.array(lo, pa.int64()), "piece": pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), taken)})

    return work


def read_ragged(layout: DataFrame, flat: DataFrame, group: str, value: str = "value", span: int = 1 << 16) -> DataFrame:
    """Arrays back from ``layout(group, off, len)`` and ``flat(group, i, value)``.

    Neighbouring elements travel as one run.  A group's flat array is cut into spans of ``span`` places; the rows
    that reach into a span meet its runs there, and what a row has of several spans is put together, so a group
    of any size is dealt over many tasks.  Null groups are one group.
    """
    g, v = flat.schema[group].dataType.simpleString(), flat.schema[value].dataType.simpleString()
    runs = flat.select(group, F.col("i").cast("long"), value).mapInArrow(lambda batches: _packed(batches, span), f"g {g}, part long, at long, run array<{v}>")
    parts = F.sequence(F.floor(F.col("off") / span), F.floor((F.col("off") + F.col("len") - 1) / span))
    rows = layout.where("len > 0").select(F.col(group).alias("g"), F.col("off").cast("long").alias("off"), F.col("len").cast("long").alias("len"), F.explode(parts).alias("part"))
    pieces = rows.groupBy("g", "part").cogroup(runs.groupBy("g", "part")).applyInArrow(_owned(span), f"g {g}, off long, lo long, piece array<{v}>")
    in_order = F.array_sort(F.collect_list(F.struct("lo", "piece")))  # the pieces of one row
    arrays = pieces.groupBy("g", "off").agg(F.flatten(F.transform(in_order, lambda s: s["piece"])).alias("values"))
    same = F.col(f"l.{group}").eqNullSafe(F.col("r.g")) & (F.col("l.off") == F.col("r.off")) & (F.col("l.len") > 0)
    found = layout.alias("l").join(arrays.alias("r"), same, "left")
    return found.select("l.*", F.when(F.col("l.len") == 0, F.array().cast(f"array<{v}>")).otherwise(F.col("r.values")).alias("values"))


def record_offsets(df: DataFrame, file: str, order: str, line: Column) -> DataFrame:
    """Byte offset and length of each record when a file's lines are written in order, and its address."""
    sized = df.select(file, order, (F.octet_length(line) + 1).cast("long").alias("n_bytes"))
    sized = with_running(sized, file, [order], sums={"offset": F.col("n_bytes")})
    return sized.withColumn("loc", F.concat(F.col(file), F.lit("?bytes="), F.col("offset").cast("string"), F.lit(","), F.col("n_bytes").cast("string")))


def track(previous: Column, loc: Column, new: Column) -> tuple[Column, Column]:
    """Address and history of a document that moves: the address it had joins the history."""
    history = F.coalesce(previous, F.array().cast("array<string>"))
    return new, F.when(loc.isNull(), history).otherwise(F.array_append(history, loc))


def weighted_mean(df: DataFrame, key: str, value: Column, weight: Column) -> DataFrame:
    """Weighted mean by key; null where the weights sum to zero."""
    return df.groupBy(key).agg(F.try_divide(F.sum(value * weight), F.sum(weight).cast("double")).alias("weighted_mean"))
