"""Operator 4: repeated runs of lines, with DataFrame functions only.

Lines become 128-bit ids, and prefix doubling orders the suffixes of the id sequences
into intervals: all suffixes that agree on their first ``d`` lines, ranked by the place of
the first of them.  The intervals at ``2 d`` come from the pairs of intervals of two
suffixes ``d`` lines apart.  An interval of one suffix leaves the race at once, so later
rounds see only what still repeats, and doubling ends when nothing does: after as many
rounds as the longest repeated run has binary digits.

An interval at depth ``d`` says that the suffixes in it have a common prefix of ``d``
lines at least; a suffix that is not the first of its interval starts a later copy.  Its
prefixes of all depths that it reaches, united with those of its neighbours, are the
maximal repeated runs: a run of any length ends where the run's last ``min_lines`` lines
do, and these are an interval of their own.  Lines of runs go, with blank lines between
them; the copy that comes first by (document id, line) stays.  Blank lines do not count.

With ``long_words`` a single line of so many words (between white space) is a run too,
settled from the intervals of depth one.

Edge cases: null text stays null; empty text and blank lines stay; rows that repeat
both id and text are one document and get the same result; null ids come first; copies
of one run inside one document count (the first stays); an empty table gives no rows;
other columns are carried along and never read, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import once
from plumbline.llm.common import Workspace, free_name, table

MIN_LINES = 2
#: Words from which the pipeline takes a single line for a run.
LONG_WORDS = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("__h1"), F.xxhash64(F.lit(1), text).alias("__h2")]


KEY = ["__id", "__h1", "__h2"]


def _long(line: Column, words: int | None) -> Column:
    """Whether a line has ``words`` words or more; lines too short for them aren't split."""
    if words is None:
        return F.lit(False)
    return F.when(F.length(line) >= 2 * words - 1, F.size(F.split(F.btrim(line, F.lit(" \t\r\f\v")), "[ \\t\\r\\f\\x0b]+")) >= words).otherwise(F.lit(False))


def suffixes(docs: DataFrame, long_words: int | None = None) -> DataFrame:
    """A row a line that is not blank: document, running number, line number, id, whether it is a run alone."""
    marked = F.transform(_lines(F.col("__text")), lambda x, i: F.struct(i.alias("line"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (F.length(F.btrim(x, F.lit(" \t\r\f\v"))) > 0).alias("full"), _long(x, long_words).alias("long")))
    ids = docs.select("__id", *_key(F.col("__text")), F.filter(marked, lambda s: s["full"]).alias("ids")).dropDuplicates(KEY)
    rows = ids.select(*KEY, F.posexplode("ids").alias("pos", "s"))
    return rows.select(*KEY, "pos", F.col("s.line").alias("line"), F.col("s.line").alias("last"), F.col("s.a").alias("a"), F.col("s.b").alias("b"), F.col("s.long").alias("long"))


def intervals(rows: DataFrame, ws: Workspace, depth: int) -> DataFrame:
    """Suffixes that share their first ``depth`` lines with another, each with the rank of its interval.

    The rank is the place of the interval's first suffix, in the order of documents and
    lines.  Intervals are written first: a join of two shuffles can split a hot one.
    """
    place = F.struct("__id", "pos", "__h1", "__h2")
    groups = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("rank")).where("copies > 1").drop("copies")
    groups = ws.stage(groups, f"intervals{depth}")
    return ws.stage(rows.join(groups.hint("merge"), ["a", "b"]), f"depth{depth}")  # one plan at every size


def later_copies(docs: DataFrame, ws: Workspace, *, min_lines: int = MIN_LINES, long_words: int | None = None) -> list[DataFrame]:
    """Spans of lines of which an earlier copy exists, a table for each depth that any suffix reaches."""
    later = ~F.struct("__id", "pos", "__h1", "__h2").eqNullSafe(F.col("rank"))
    current = intervals(suffixes(docs, long_words), ws, 1)
    found = [] if long_words is None or min_lines == 1 else [current.where(F.col("long") & later)]
    depth = 1
    while True:
        if depth >= min_lines:
            found.append(current.where(later))
        if min_lines == 1:  # every repeated line is a run of its own, and blank lines stay
            break
        step = depth if depth >= min_lines else min(depth, min_lines - depth)  # the last step up to min_lines may overlap
        right = current.select(*KEY, (F.col("pos") - step).alias("pos"), F.col("last").alias("last2"), F.col("a").alias("a2"), F.col("b").alias("b2"))
        pairs = current.alias("l").join(right.hint("merge").alias("r"), _same("l", "r") & (F.col("l.pos") == F.col("r.pos")))
        depth += step
        named = pairs.select(*[f"l.{c}" for c in KEY], "l.pos", "l.line", F.col("r.last2").alias("last"), F.xxhash64("l.a", "r.a2", "l.b").alias("a"), F.xxhash64("l.b", "r.b2", "r.a2").alias("b"), "l.long")
        current = intervals(ws.stage(named, f"named{depth}"), ws, depth)
        ws.drop(f"named{depth}")
        if current.isEmpty():
            break
    return [f.select(*KEY, "line", "last") for f in found]


def _same(left: str, right: str) -> Column:
    """Equal documents; ids can be null, hashes cannot, and so they carry the join."""
    return (F.col(f"{left}.__h1") == F.col(f"{right}.__h1")) & (F.col(f"{left}.__h2") == F.col(f"{right}.__h2")) & F.col(f"{left}.__id").eqNullSafe(F.col(f"{right}.__id"))


def _no_spans(base: DataFrame) -> DataFrame:
    return base.where(F.lit(False)).select("__id", *_key(F.col("__text")), F.lit(0).alias("line"), F.lit(0).alias("last"))


def dedup_lines(docs: DataFrame, *, min_lines: int = MIN_LINES, long_words: int | None = None, id_col: str = "doc_id", text_col: str = "text", ws: Workspace | None = None) -> DataFrame:
    """``docs`` with later copies deleted from the text, ``n_lines`` and the deleted ``runs`` (line numbers, end included).

    Columns of ``docs`` that have these two names are replaced.
    """
    ws = ws or Workspace(docs.sparkSession, "line-dedup")
    base = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    spans = reduce(DataFrame.union, later_copies(base, ws, min_lines=min_lines, long_words=long_words), _no_spans(base))
    runs = spans.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("line", "last"))).alias("w"))  # bounded by the lines of one document
    start = F.array().cast("array<struct<line:int,last:int>>")

    def merge(acc, w):
        end = F.get(acc, F.size(acc) - 1)
        joined = F.array_append(F.slice(acc, 1, F.size(acc) - 1), F.struct(end["line"].alias("line"), F.greatest(end["last"], w["last"]).alias("last")))
        return F.when((F.size(acc) > 0) & (w["line"] <= end["last"] + 1), joined).otherwise(F.array_append(acc, F.struct(w["line"].alias("line"), w["last"].alias("last"))))

    runs = ws.stage(runs.select(*KEY, F.aggregate("w", start, merge).alias("__runs")), "runs")
    ws.release()
    names = [free_name(docs, f"__{c}") for c in ("id", "h1", "h2", "found")]
    id_, h1, h2, found = names
    keyed = docs.select("*", F.col(id_col).alias(id_), *[c.alias(n) for c, n in zip(_key(F.col(text_col)), (h1, h2))]).alias("l")
    same = (F.col(f"l.{h1}") == F.col("r.__h1")) & (F.col(f"l.{h2}") == F.col("r.__h2")) & F.col(f"l.{id_}").eqNullSafe(F.col("r.__id"))
    out = keyed.join(runs.hint("merge").alias("r"), same, "left").select("l.*", F.col("r.__runs").alias(found))

    def between(lines: Column, k: Column) -> Column:
        """Lines after run ``k - 1`` and before run ``k``."""
        first = F.coalesce(F.get(F.col(found), k - 1)["last"] + 1, F.lit(0))
        return F.slice(lines, first + 1, F.greatest(F.lit(0), F.coalesce(F.get(F.col(found), k)["line"], F.size(lines)) - first))

    kept = once(_lines(F.col(text_col)), lambda lines: F.flatten(F.transform(F.sequence(F.lit(0), F.size(found)), lambda k: between(lines, k))))
    others = [c for c in docs.columns if c not in (text_col, "n_lines", "runs")]
    return out.select(*others, F.size(_lines(F.col(text_col))).alias("n_lines"), F.coalesce(found, start).alias("runs"), F.when(F.col(found).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")).alias(text_col))


def deleted_lines() -> Column:
    return F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + (r["last"] - r["line"] + 1))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    shown = F.array_join(F.transform("runs", lambda r: F.concat_ws("-", r["line"], r["last"])), ",")
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), deleted_lines().alias("n_deleted"), shown.alias("runs"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
e AS (SELECT doc_id, unnest(range(0, len(l))) AS line, unnest(l) AS s FROM d),
f AS (SELECT doc_id, line, s, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos FROM e WHERE trim(s, chr(32) || chr(9) || chr(13) || chr(12) || chr(11)) <> ''),
w AS (SELECT a.doc_id, a.pos, a.line, b.line AS last, a.s AS s1, b.s AS s2 FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1),
g AS (SELECT *, row_number() OVER (PARTITION BY s1, s2 ORDER BY doc_id, pos) AS n FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(line, last + 1)) AS line FROM g WHERE n > 1),
runs AS (
  SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS runs, CAST(sum(b - a + 1) AS BIGINT) AS n FROM (
    SELECT doc_id, min(line) AS a, max(line) AS b FROM (SELECT doc_id, line, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS k FROM gone) GROUP BY doc_id, k)
  GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(s, chr(10) ORDER BY line) AS t FROM e ANTI JOIN gone USING (doc_id, line) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(l) AS BIGINT) AS n_lines, coalesce(n, 0) AS n_deleted, coalesce(runs, '') AS runs, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
