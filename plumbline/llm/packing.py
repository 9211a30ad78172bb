"""Operator 5: pack documents into sequences by bin completion.

Lengths are whole numbers up to the capacity, so any corpus has at most ``capacity``
different item sizes.  The search for a packing therefore runs over the histogram of
lengths (at most ``capacity`` rows on the driver, whatever the corpus) and returns
patterns with multiplicities; every pattern uses up a length, so there are no more
patterns than lengths.  Pieces find their place from their rank among pieces of the
same length; the rank is a running number within an input partition plus the count of
that length in the partitions before it, so no task ever sees all pieces of a length.

Edge cases: null or empty text is one piece of the end id; repeated rows are packed
each; null ids stay null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm import fast_tokenizer
from plumbline.llm.common import Workspace, table

PIECES = "doc_id long, piece int, start long, length long, shard int, rank_in_shard long, ids binary"


# ---------------------------------------------------------------- the search

def fillings(counts: list[int], gap: int, patience: int | None = None) -> Iterator[tuple[int, ...] | None]:
    """All undominated fillings of ``gap`` from the lengths at hand, least waste first.

    Lazily: for each waste in turn the multisets of exactly that sum, larger items first,
    led by the sums that smaller lengths can reach (sets of sums are bits of a number).
    A filling is dominated, and left out, if another item fits besides, or could take the
    place of one or several of its items that sum to no more.  A part in which an item at
    hand equals the sum of several stays dominated however it goes on, and is not pursued.
    With ``patience``, None comes after every so many parts, so that a caller can count effort.
    """
    sizes = [s for s in range(1, gap + 1) if counts[s]]
    free = sum(1 << s for s in sizes)
    looked = 0
    reach = [1]
    for s in sizes:
        sums, copies, k = reach[-1], min(counts[s], gap // s), 1
        while copies:
            k = min(k, copies)
            sums |= sums << (s * k)
            copies, k = copies - k, 2 * k
        reach.append(sums & ((2 << gap) - 1))

    def exact(j: int, target: int, chosen: tuple[int, ...], sums: int, several: int) -> Iterator[tuple[int, ...] | None]:
        nonlocal looked
        if not target:
            yield chosen
            return
        while j >= 0 and reach[j + 1] >> target & 1:
            s = sizes[j]
            parts = [(chosen, sums, several)]
            for _ in range(min(counts[s], target // s)):
                had, all_, two = parts[-1]
                two, all_, had = two | (all_ & ~1) << s, all_ | all_ << s, (*had, s)
                if _replaceable(had, counts, two & free):
                    break
                parts.append((had, all_, two))
            for c in range(len(parts) - 1, 0, -1):
                if reach[j] >> (target - c * s) & 1:
                    looked += 1
                    if patience and looked % patience == 0:
                        yield None
                    yield from exact(j - 1, target - c * s, *parts[c])
            j -= 1

    for waste in range(gap + 1):
        if reach[-1] >> (gap - waste) & 1:
            for f in exact(len(sizes) - 1, gap - waste, (), 1, 0):
                if f is None or not _dominated(f, counts, free, waste):
                    yield f


def _replaceable(filling: tuple[int, ...], counts: list[int], could: int) -> bool:
    """Whether one of the lengths in the bits of ``could`` is at hand besides the filling."""
    for x in set(filling):
        if counts[x] <= filling.count(x):
            could &= ~(1 << x)
    return could != 0


def _dominated(filling: tuple[int, ...], counts: list[int], free: int, waste: int) -> bool:
    """``free``: bits of the lengths at hand."""
    one, several, sums = 0, 0, 1
    for x in filling:
        several |= (sums & ~1) << x
        one |= 1 << x
        sums |= sums << x
    could = several
    for k in range(1, waste + 1):
        could |= several << k | (one | 1) << k
    return _replaceable(filling, counts, could & free)


def greedy(counts: list[int], gap: int) -> tuple[int, ...]:
    """The largest item that fits, again and again."""
    out: list[int] = []
    for x in range(gap, 0, -1):
        n = min(counts[x], gap // x) if x <= gap else 0
        out += [x] * n
        gap -= x * n
    return tuple(out)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Volume bound, and items over half of the capacity that exclude each other, at every split."""
    sizes, half = np.arange(len(counts)), capacity // 2
    number, volume = np.cumsum(counts), np.cumsum(sizes * counts)
    k = np.arange(1, half + 1)
    big, mid = number[-1] - number[capacity - k], number[capacity - k] - number[half]
    free = mid * capacity - (volume[capacity - k] - volume[half])
    small = volume[half] - volume[k - 1]
    return int(max(-(-volume[-1] // capacity), (big + mid + np.maximum(0, -(-(small - free) // capacity))).max(initial=0)))


#: Parts of fillings that count as one node of the search, and levels that keep what they enumerate at hand.
PATIENCE, LEVELS = 100, 32


def bin_completion(counts, capacity: int, *, nodes: int | None = 4000) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, how many sequences) that hold all items.

    Depth first: the largest item left is completed by every undominated filling in turn,
    as often as the counts allow and then less often.  The first descent takes the best
    fit each time and is the first incumbent; better packings replace it.  A branch ends
    when its waste, or the bound of what is left, leaves no way to beat the incumbent.

    The problem is NP-hard, so effort is limited and items never are: the search ends at
    the lower bound, when all branches are done, or, once there is an incumbent, after
    ``nodes`` nodes; a level that looks at ``PATIENCE`` parts without an undominated
    filling tries the greedy one first.  With ``nodes=None`` the result is optimal.
    """
    left = np.array(counts, np.int64)
    total = int((np.arange(len(left)) * left).sum())
    target, best, best_bins = lower_bound(left, capacity), [], None
    path: list[tuple[tuple[int, ...], int, bool]] = []
    bins = waste = visited = 0

    def order(pattern: tuple[int, ...]) -> tuple:
        return capacity - sum(pattern), tuple(-x for x in pattern)

    def options() -> Iterator[tuple[tuple[int, ...], int, bool] | None]:
        """Sequences for the largest item; those of one largest item come in order, each set of them once."""
        have = left.tolist()
        big = max(x for x, n in enumerate(have) if n)
        last = order(path[-1][0]) if path and path[-1][2] and path[-1][0][0] == big else None
        have[big] -= 1

        def often(pattern: tuple[int, ...], ordered: bool):
            for m in range(min(int(left[x]) // pattern.count(x) for x in set(pattern)), 0, -1):
                yield pattern, m, ordered

        silent = True
        for f in fillings(have, capacity - big, None if nodes is None else PATIENCE):
            if f is None:
                if silent:
                    silent = False
                    yield from often((big, *greedy(have, capacity - big)), False)
                yield None
                continue
            pattern = (big, *f)
            if last is None or order(pattern) > last:
                silent = False
                yield from often(pattern, True)

    # levels of the descent: their options, and how many were taken; those far up are made anew when the search returns
    stack: list[list] = [[options(), 0]] if total else []

    def advance():
        level = stack[-1]
        if level[0] is None:
            level[0] = options()
            for _ in range(level[1]):
                next(level[0], None)
        level[1] += 1
        return next(level[0], False)

    while stack and not (best_bins is not None and (best_bins <= target or (nodes is not None and visited >= nodes))):
        chosen = advance()
        if chosen is False:
            stack.pop()
            if path:
                pattern, m, _ = path.pop()
                bins, waste = bins - m, waste - m * (capacity - sum(pattern))
                np.add.at(left, list(pattern), m)
            continue
        visited += 1
        if chosen is None:
            continue
        pattern, m, _ = chosen
        np.subtract.at(left, list(pattern), m)
        path.append(chosen)
        bins, waste = bins + m, waste + m * (capacity - sum(pattern))
        hopeless = best_bins is not None and (waste > (best_bins - 1) * capacity - total or bins + lower_bound(left, capacity) >= best_bins)
        if not hopeless and not left.any():
            best, best_bins = [(p, n) for p, n, _ in path], bins
        stack.append([iter(()) if hopeless or not left.any() else options(), 0])
        if len(stack) > LEVELS:
            stack[-1 - LEVELS][0] = None
    return best


# ---------------------------------------------------------------- the tables

def cut(docs: DataFrame, *, capacity: int, end_id: int, id_col: str, text_col: str, tokenizer: str | None) -> DataFrame:
    """Pieces of at most ``capacity`` ids; only longer documents are cut."""
    spec = docs.sparkSession.sparkContext.broadcast(fast_tokenizer.load_json(tokenizer))
    end = int(end_id).to_bytes(4, "little")
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in PIECES.split(", ")]

    def pieces(batches):
        from pyspark import TaskContext

        tok, shard = fast_tokenizer.engine(spec.value), TaskContext.get().partitionId()
        seen = array("q", [0]) * (capacity + 1)
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            held = 0
            for name, text in zip(batch.column(0), batch.column(1)):
                ids = tok.encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    n = len(part) // 4
                    for col, v in zip(cols, (name.as_py(), k, at // 4, n, shard, seen[n], part)):
                        col.append(v)
                    seen[n] += 1
                held += len(ids)
                if held > 8 << 20:
                    yield pa.record_batch([pa.array(v, t) for v, t in zip(cols, types)], names=names)
                    cols, held = [[] for _ in names], 0
            if cols[0]:
                yield pa.record_batch([pa.array(v, t) for v, t in zip(cols, types)], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(pieces, PIECES)


def place(patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first sequence, copies a sequence and offset of its patterns."""
    out: dict[int, list] = {}
    first = 0
    for pattern, m in patterns:
        ordered, at = sorted(pattern, reverse=True), 0
        runs: dict[int, tuple[int, int]] = {}
        for x in ordered:
            offset, n = runs.get(x, (at, 0))
            runs[x] = (offset, n + 1)
            at += x
        for x, (offset, n) in runs.items():
            out.setdefault(x, []).append((m * n, first, n, offset))
        first += m
    done = {}
    for x, rows in out.items():
        taken, seq, copies, offset = (np.array(c, np.int64) for c in zip(*rows))
        done[x] = (np.cumsum(taken) - taken, seq, copies, offset)
    return done


def pack(docs: DataFrame, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, payload: dict[str, Column] | None = None, ws: Workspace | None = None) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, and whatever ``payload`` makes of ``ids``.

    ``payload=None`` carries ``ids`` itself (32-bit little-endian).
    """
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "packing")
    pieces = ws.stage(cut(docs, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col, tokenizer=tokenizer), "pieces")
    per_shard = ws.stage(pieces.groupBy("shard", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_shard.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    where = place(bin_completion(counts, capacity), capacity)
    before = per_shard.select("shard", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("shard")) - F.col("n")).alias("before"))
    extra = {"ids": F.col("ids")} if payload is None else payload
    rows = pieces.select("doc_id", "piece", "start", "length", "shard", "rank_in_shard", *[c.alias(k) for k, c in extra.items()])
    ranked = rows.join(before.hint("merge"), ["shard", "length"]).withColumn("rank", F.col("rank_in_shard") + F.col("before")).drop("shard", "rank_in_shard", "before")
    kept = [c for c in ranked.columns if c != "rank"]

    def assign(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            seq, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                rows = np.nonzero(length == x)[0]
                first, sequence, copies, at = where[int(x)]
                k = np.searchsorted(first, rank[rows], side="right") - 1
                inner = rank[rows] - first[k]
                seq[rows] = sequence[k] + inner // copies[k]
                offset[rows] = at[k] + (inner % copies[k]) * x
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(seq), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    out = ranked.mapInArrow(assign, f"{schema}, sequence_id long, offset long")
    return out.select("doc_id", "piece", "start", "length", "sequence_id", "offset", *extra)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all of ``documents`` into sequences of at most 2048 ids."""
    out = pack(table(spark, sf_dir, "documents"), payload={"ids_crc32": F.crc32("ids")})
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
