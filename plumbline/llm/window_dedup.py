"""Operator 10: bytes covered by a long string that also starts elsewhere.

A depth-limited most-significant-digit radix sort of all suffixes, through ``length``
bytes: equal groups at that depth are exactly the repeated windows.  Two things keep it
far from one row a byte.  Windows with the same *anchor* (the leftmost least digit of
``DIGIT`` bytes inside, by hash, a function of the window's bytes alone) move through
the passes as one run.  And a pass keeps only groups that still hold two.

Pass 1 sorts by the anchor's digit.  Pass 2 compares whole runs: bytes and bounds equal
means all windows of the run repeat.  Runs that are alone in a group of several are cut
into sub-runs of ``CUT`` windows; pass 3 drops a sub-run whose common core is alone and
settles one whose whole extent is not.  Pass 4 sorts what is left window by window.
In each pass equal members go on as one member with a count, so thousands of copies
cost what one costs, and groups are met by aggregation and by joins that can be split.

Groups are told apart by two 64-bit hashes of different bytes in each pass (the digit and
the run, core, extent or window).  Texts are read again where their bytes are needed and
never travel with a row a window.

Edge cases: null and empty texts have no bytes and keep none; texts shorter than
``length`` keep all; windows never cross texts; repeats inside one text count, overlapping
ones too; a row that repeats id and text is another text; null ids are kept apart by
their text; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Rolling, Workspace, mix, signed, slices, spread, table, utf8
from plumbline.llm.words import sliding_min

LENGTH, DIGIT, CUT = 400, 128, 16
#: Bytes of text that a task looks at together.
SLICE = 3 << 19


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, digit: int = DIGIT):
    """Anchors of all windows of the texts.

    The anchor of a window is the leftmost least digit (``digit`` bytes, by hash) inside
    it.  Returns for each anchor: text, place of the digit, first and last window start
    (places in ``data``), and the rolling hash of ``data``.
    """
    roll = Rolling(spread(data))
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), roll
    at = np.arange(len(data) - digit + 1)
    short = mix(roll(at, at + min(16, digit)), 9)
    key = (short & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    least = (sliding_min(key, length - digit + 1)[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ok = text[:n] == text[length - 1 : length - 1 + n]
    start = np.nonzero(ok)[0]
    if not len(start):
        return start, start, start, start, roll
    anchor = least[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(start)) - 1
    return text[start[first]], anchor[first], start[first], start[last], roll


def _same(left: str, right: str) -> Column:
    """Equal texts of equal ids; the text's hash cannot be null and carries the join."""
    return (F.col(f"{left}.th") == F.col(f"{right}.th")) & F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))


def _runs(texts: DataFrame, length: int, digit: int) -> DataFrame:
    """Pass 0: a row an anchor, with the digit's hash ``h`` and the run's hash ``u``."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, offsets = utf8(part.column("text"))
                t, a, lo, hi, roll = anchors(data, offsets, length, digit)
                if not len(t):
                    continue
                bounds = (a - lo).astype(np.uint64) * np.uint64(1 << 20) + (hi - lo).astype(np.uint64)
                h = mix(roll(a, a + digit), 3)
                u = mix(mix(roll(lo, hi + length), 4) + mix(bounds, 5), 6)
                at = offsets[t]
                cols = [part.column("doc_id").take(pa.array(t)), part.column("th").take(pa.array(t)), pa.array((a - at).astype(np.int64)), pa.array((a - hi).astype(np.int32)), pa.array((a - lo).astype(np.int32)), pa.array(signed(h)), pa.array(signed(u))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "th", "a", "d0", "d1", "h", "u"])

    return texts.mapInArrow(run, "doc_id long, th long, a long, d0 int, d1 int, h long, u long")


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """Pass 3 keys: core and extent of each sub-run of the listed runs of a text."""

    def run(batches):
        for batch in batches:
            for text, runs in zip(batch.column("text"), batch.column("runs").to_pylist()):
                roll = Rolling(spread(np.frombuffer(text.as_py().encode(), np.uint8)))
                r = np.array([[x["a"], x["d0"], x["d1"], x["h"], x["u"], x["w"]] for x in runs], np.int64)
                first, last = r[:, 1] // CUT, r[:, 2] // CUT
                k = np.repeat(np.arange(len(r)), last - first + 1)
                j = np.arange(len(k)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[k]
                a = r[k, 0]
                core = mix(roll(a - CUT * j, a - CUT * j - CUT + 1 + length), 20)
                full = (r[k, 1] <= CUT * j) & (r[k, 2] >= CUT * j + CUT - 1)
                start = np.where(full, a - CUT * j - CUT + 1, 0)
                whole = mix(roll(start, np.where(full, a - CUT * j + length, 0)), 21)
                cols = [pa.array(r[k, 3]), pa.array(r[k, 4]), pa.array(j.astype(np.int32)), pa.array(signed(core)), pa.array(signed(whole), mask=~full), pa.array(r[k, 5])]
                yield pa.RecordBatch.from_arrays(cols, names=["h", "u", "j", "core", "whole", "w"])

    return rows.mapInArrow(run, "h long, u long, j int, core long, whole long, w long")


def _single(rows: DataFrame, length: int) -> DataFrame:
    """Pass 4 keys: every window of the listed sub-runs of a text."""

    def run(batches):
        for batch in batches:
            for text, runs in zip(batch.column("text"), batch.column("runs").to_pylist()):
                roll = Rolling(spread(np.frombuffer(text.as_py().encode(), np.uint8)))
                r = np.array([[x["a"], max(x["d0"], CUT * x["j"]), min(x["d1"], CUT * x["j"] + CUT - 1), x["h"], x["u"], x["w"]] for x in runs], np.int64)
                n = r[:, 2] - r[:, 1] + 1
                k = np.repeat(np.arange(len(r)), n)
                d = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n) + r[k, 1]
                start = r[k, 0] - d
                cols = [pa.array(r[k, 3]), pa.array(r[k, 4]), pa.array(d.astype(np.int32)), pa.array(signed(mix(roll(start, start + length), 22))), pa.array(r[k, 5])]
                yield pa.RecordBatch.from_arrays(cols, names=["h", "u", "d", "key", "w"])

    return rows.mapInArrow(run, "h long, u long, d int, key long, w long")


def covered(starts_ends: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    out: list[list[int]] = []
    for s, e in sorted(starts_ends):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def repeated_windows(docs: DataFrame, ws: Workspace, *, length: int = LENGTH, digit: int = DIGIT) -> DataFrame:
    """Spans ``(doc_id, th, s, e)`` whose windows of ``length`` bytes all start elsewhere too; ``docs(doc_id, th, text)``."""
    long_enough = docs.where(F.octet_length("text") >= length)
    runs = ws.stage(_runs(long_enough, length, digit), "runs")
    groups = runs.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("u0"), F.max("u").alias("u1")).where("n > 1")
    groups = ws.stage(groups.select("h", (F.col("u0") != F.col("u1")).alias("mixed")), "groups")  # so that the join can split a hot group
    held = ws.stage(runs.join(groups.hint("merge"), "h"), "held")
    ws.release()
    ws.drop("runs")
    alike = held.where("not mixed")

    place = F.min(F.struct("doc_id", "th", "a", "d0", "d1")).alias("m")
    classes = held.where("mixed").groupBy("h", "u").agg(F.count(F.lit(1)).alias("w"), place)
    classes = ws.stage(classes.select("h", "u", "w", "m.*"), "classes")
    many = held.where("mixed").join(classes.where("w > 1").select("h", "u").hint("merge"), ["h", "u"])
    settled = alike.select("doc_id", "th", "a", "d0", "d1").union(many.select("doc_id", "th", "a", "d0", "d1"))

    names = classes.select("doc_id", "th").distinct().hint("merge")
    texts = docs.alias("l").join(names.alias("r"), _same("l", "r"), "left_semi").dropDuplicates(["doc_id", "th"])
    texts = ws.stage(texts, "texts")
    ws.release()
    per_text = classes.groupBy("doc_id", "th").agg(F.collect_list(F.struct("a", "d0", "d1", "h", "u", "w")).alias("runs"))  # a text's own runs
    cut = ws.stage(_cut(texts.alias("l").join(per_text.hint("merge").alias("r"), _same("l", "r")).select("l.text", "r.runs"), length), "cut")
    whole = cut.where("whole is not null").groupBy("h", "j", "whole").agg(F.sum("w").alias("n")).where("n > 1").select("h", "j", "whole", F.lit(True).alias("found"))
    cut = cut.join(whole.hint("merge"), ["h", "j", "whole"], "left").select("h", "u", "j", "core", "w", (F.coalesce("found", F.lit(False))).alias("found"))
    cut = ws.stage(cut, "cut2")
    by_extent = cut.where("found and w = 1").select("h", "u", "j")
    open_ = (F.col("w") == 1) & ~F.col("found")
    cores = cut.groupBy("h", "j", "core").agg(F.sum("w").alias("n"), F.max(open_).alias("open")).where("n > 1 and open").select("h", "j", "core")
    left = ws.stage(cut.join(cores.hint("merge"), ["h", "j", "core"]).select("h", "u", "j"), "left")
    lists = left.join(classes.hint("merge"), ["h", "u"]).groupBy("doc_id", "th").agg(F.collect_list(F.struct("a", "d0", "d1", "h", "u", "w", "j")).alias("runs"))
    single = ws.stage(_single(texts.alias("l").join(lists.hint("merge").alias("r"), _same("l", "r")).select("l.text", "r.runs"), length), "single")
    keys = single.groupBy("h", "d", "key").agg(F.sum("w").alias("n"), F.max(F.col("w") == 1).alias("open")).where("n > 1 and open").select("h", "d", "key")
    windows = single.where("w = 1").join(keys.hint("merge"), ["h", "d", "key"]).select("h", "u", F.col("d").alias("d0"), F.col("d").alias("d1"))
    extents = by_extent.select("h", "u", (F.col("j") * CUT).alias("d0"), (F.col("j") * CUT + CUT - 1).alias("d1"))
    found = windows.union(extents).join(classes.select("h", "u", "doc_id", "th", "a").hint("merge"), ["h", "u"]).select("doc_id", "th", "a", "d0", "d1")
    return settled.union(found).select("doc_id", "th", (F.col("a") - F.col("d1")).alias("s"), (F.col("a") - F.col("d0") + length).alias("e"))


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, digit: int = DIGIT, id_col: str = "doc_id", text_col: str = "text", ws: Workspace | None = None) -> DataFrame:
    """``doc_id, n_bytes, spans`` (removed runs of bytes) and ``kept``, the bytes that stay."""
    ws = ws or Workspace(docs.sparkSession, "window-dedup")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    spans = repeated_windows(base, ws, length=length, digit=digit)
    lists = ws.stage(spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "e")).alias("found")), "spans")
    ws.release()
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, found in zip(batch.column("text"), batch.column("found").to_pylist()):
                data = text.as_py().encode()
                gone = covered([(x["s"], x["e"]) for x in found or ()])
                edges = [0, *(x for s in gone for x in s), len(data)]
                sizes.append(len(data))
                spans.append([{"start": s, "end": e} for s, e in gone])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pairs), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    rows = base.alias("l").join(lists.hint("merge").alias("r"), _same("l", "r"), "left").select("l.doc_id", "l.text", "r.found")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op10_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
