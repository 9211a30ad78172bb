"""Operator 2: secrets in texts, with DataFrame functions only.

Base kinds are leftmost non-overlapping matches of fixed patterns.  The method adds
``entropy`` spans: candidate strings are maximal runs of token characters; a window
slides over each with the count of every character in it; a step adjusts the counts of
the one that leaves and the one that enters, and the Shannon entropy by their change.  Entropies are whole numbers (a
table of c*log2(c)), so nothing drifts.  Candidates fall in character classes with
thresholds of their own; an allow-list and spans already found suppress them.

Spark has no function for the places of matches, so they follow from the lengths of
the matches and of the pieces between them, as running sums.

Edge cases: null text counts as empty and has no spans; repeated rows give equal rows;
a null id stays null; an empty table gives no rows; other columns are not read.
Texts and candidates of any length are read whole, in time that grows with their length.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import once
from plumbline.llm.common import table

#: kind -> (pattern, group whose length decides, least length)
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
}
#: Maximal runs of characters that keys are written in.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}"
WINDOW = 24
#: class -> (pattern of the whole candidate, least entropy of a window in bits); first that fits.
CLASSES = {"hex": (r"^[0-9A-Fa-f]+$", 3.1), "alphanumeric": (r"^[0-9A-Za-z]+$", 3.9), "base64": (r"^[A-Za-z0-9+/_=-]+$", 4.0)}
#: A candidate that fits one of these is no secret: no digit or no letter, a UUID, placeholders.
ALLOW = (r"^[^0-9]*$", r"^[^A-Za-z]*$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"(?i)example|placeholder|xxxx|0123456789|abcdefgh")

#: Windows of a candidate that one fold looks at.
BLOCK = 104
_BLOCKS = rf"(?s)(?=(.{{1,{BLOCK + WINDOW - 1}}})).{{1,{BLOCK}}}"
#: Counts are kept as five bits a character, twelve to a number; codes start at "+".
_FIRST, _BITS, _PER_WORD = ord("+"), 5, 12
_WORDS = (ord("z") - _FIRST) // _PER_WORD + 1

_SCALE = 1_000_000
_TABLE = [0] + [round(_SCALE * c * math.log2(c)) for c in range(1, WINDOW + 1)]


def most_sum(bits: float) -> int:
    """Largest sum of c*log2(c) of a window whose entropy is at least ``bits``."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * _SCALE)


def _fold(values: Column, base: Column) -> Column:
    start = F.struct(F.array().cast("array<long>").alias("a"), base.cast("long").alias("t"))
    return F.aggregate(values, start, lambda s, v: F.struct(F.array_append(s["a"], s["t"]).alias("a"), (s["t"] + v).alias("t")), lambda s: s["a"])


def running_sums(values: Column, chunk: int = 128) -> Column:
    """Sum of the elements before each; by chunks, as growing an array copies it."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / chunk).cast("int")), lambda c: F.slice(values, c * chunk + 1, chunk))
    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, v: a + v))
    return F.when(F.size(values) > 0, F.flatten(F.zip_with(chunks, _fold(totals, F.lit(0)), _fold))).otherwise(F.array().cast("array<long>"))


def locate(df: DataFrame, text: str, pattern: str, out: str, group: int = 0) -> DataFrame:
    """Adds ``out``: array of (start, end, value) of the matches; null where there is none."""
    p = F.lit(pattern)
    has = F.col(text).rlike(pattern)
    df = df.withColumns({f"{out}_m": F.when(has, F.regexp_extract_all(text, p, F.lit(0))), f"{out}_g": F.when(has, F.split(text, pattern, -1))})
    if group:
        df = df.withColumn(f"{out}_v", F.when(F.size(f"{out}_m") > 0, F.regexp_extract_all(text, p, F.lit(group))))
    steps = F.transform(F.col(f"{out}_m"), lambda m, i: (F.length(m) + F.length(F.get(F.col(f"{out}_g"), i))).cast("long"))
    df = df.withColumn(f"{out}_s", steps).withColumn(f"{out}_b", running_sums(F.col(f"{out}_s")))
    value = F.col(f"{out}_v" if group else f"{out}_m")

    def one(m, i):
        start = F.get(F.col(f"{out}_b"), i) + F.length(F.get(F.col(f"{out}_g"), i))
        return F.struct(start.cast("long").alias("start"), (start + F.length(m)).cast("long").alias("end"), F.get(value, i).alias("value"))

    found = F.when(F.size(f"{out}_m") > 0, F.transform(F.col(f"{out}_m"), one))
    kept = [c for c in df.columns if not c.startswith(f"{out}_")]
    return df.select(*kept, found.alias(out))


def _f(c: Column) -> Column:
    return F.get(F.array(*[F.lit(v).cast("long") for v in _TABLE]), c)


def _codes(s: Column) -> Column:
    """Characters of a candidate as small whole numbers."""
    return F.transform(F.filter(F.split(s, ""), lambda c: c != ""), lambda c: F.ascii(c) - _FIRST)


def _word(code: Column) -> Column:
    return (code / _PER_WORD).cast("int")


def _bit(code: Column) -> Column:
    return code % _PER_WORD * _BITS


def _slide(codes: Column, limit: Column) -> Column:
    """(first, last) window of a block whose sum is at most ``limit``, by one fold over its characters.

    The state holds the count of every character in the window, five bits each, and the
    sum of c*log2(c); a step adjusts the counts of the character that leaves and of the
    one that enters, and the sum by their change.
    """
    zero, none = F.lit(0).cast("long"), F.lit(-1).cast("long")
    start = F.struct(F.array_repeat(zero, _WORDS).alias("counts"), zero.alias("sum"), none.alias("first"), none.alias("last"))

    def count(counts: Column, code: Column) -> Column:
        return F.call_function("shiftright", F.get(counts, _word(code)), _bit(code)).bitwiseAND(31).cast("int")

    def one(code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), _bit(code))

    def step(st: Column, i: Column) -> Column:
        come, gone = F.get(codes, i), F.get(codes, i - WINDOW)  # nothing leaves the first windows
        was, now = count(st["counts"], gone), count(st["counts"], come)
        counts = F.transform(st["counts"], lambda w, k: w + F.when(_word(come) == k, one(come)).otherwise(zero) - F.when(_word(gone) == k, one(gone)).otherwise(zero))
        less = F.coalesce(_f(was - 1) - _f(was), zero)
        total = st["sum"] + F.when(gone.eqNullSafe(come), zero).otherwise(less + _f(now + 1) - _f(now))
        at = (i - (WINDOW - 1)).cast("long")
        hot = (at >= 0) & (total <= limit)
        return F.struct(counts.alias("counts"), total.alias("sum"), F.when(hot & (st["first"] < 0), at).otherwise(st["first"]).alias("first"), F.when(hot, at).otherwise(st["last"]).alias("last"))

    return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, lambda st: F.struct(st["first"].alias("first"), st["last"].alias("last")))


def hot_windows(s: Column, limit: Column) -> Column:
    """(first, last) window of ``s`` whose sum of c*log2(c) is at most ``limit``; null without any.

    A candidate is cut once into blocks of ``BLOCK`` windows, which overlap by a window
    less one character, so the work grows with its length and a block's state is small.
    """
    blocks = F.regexp_extract_all(s, F.lit(_BLOCKS), F.lit(1))
    found = F.transform(blocks, lambda b, k: once(_codes(b), lambda codes: once(_slide(codes, limit), lambda h: F.when(h["first"] >= 0, F.struct((h["first"] + k * BLOCK).alias("first"), (h["last"] + k * BLOCK).alias("last"))))))
    return once(F.array_compact(found), lambda h: F.when(F.size(h) > 0, F.struct(F.get(h, 0)["first"].alias("first"), F.element_at(h, -1)["last"].alias("last"))))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``: array of (start, kind number, end, kind) in order."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for kind, (pattern, group, _) in KINDS.items():
        df = locate(df, "text", pattern, kind, group)
    df = locate(df, "text", CANDIDATE, "candidate")

    def spans(kind: str, number: int, column: Column) -> Column:
        made = F.transform(column, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("n"), m["end"].alias("end"), F.lit(kind).alias("kind")))
        return F.coalesce(made, F.array().cast("array<struct<start:bigint,n:int,end:bigint,kind:string>>"))

    def long_enough(kind: str, least: int) -> Column:
        return F.filter(F.col(kind), lambda m: F.length(m["value"]) >= least)

    base = F.concat(*[spans(k, i, long_enough(k, least)) for i, (k, (_, _, least)) in enumerate(KINDS.items())])
    df = df.withColumn("base", base)
    wanted = F.filter("candidate", lambda m: ~F.exists("base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])) & ~_any(m["value"]))
    df = df.withColumn("wanted", F.when(F.size("candidate") > 0, wanted))
    hot = F.transform("wanted", lambda m: F.struct(m["start"].alias("start"), once(_by_class(m["value"]), lambda limit: hot_windows(m["value"], limit)).alias("hot")))
    df = df.withColumn("hot", F.when(F.size("wanted") > 0, hot))
    more = F.transform(F.filter("hot", lambda h: h["hot"].isNotNull()), lambda h: F.struct((h["start"] + h["hot"]["first"]).alias("start"), (h["start"] + h["hot"]["last"] + WINDOW).cast("long").alias("end")))
    return df.select("doc_id", F.array_sort(F.concat("base", spans("entropy", len(KINDS), more))).alias("spans"))


def _any(value: Column) -> Column:
    out = F.lit(False)
    for p in ALLOW:
        out = out | value.rlike(p)
    return out


def _by_class(value: Column) -> Column:
    out = F.lit(-1).cast("long")
    for pattern, bits in reversed(CLASSES.values()):
        out = F.when(value.rlike(pattern), F.lit(most_sum(bits)).cast("long")).otherwise(out)
    return out


def _shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["n"] < len(KINDS))
    return found.select("doc_id", *[n(k).alias(f"n_{k}") for k in KINDS], n("entropy").alias("n_entropy"), F.sha2(_shown(base), 256).alias("base_sha256"), _shown(F.col("spans")).alias("spans"))


def _case_free(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _oracle() -> str:
    q = lambda s: s.replace("'", "''")
    words = "|".join(_case_free(w) for w in ("password", "passwd", "secret", "token", "api")).replace("[Aa][Pp][Ii]", "[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
    patterns = {
        "assign": rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "access": "AKIA[A-Z0-9]+",
        "hex": "[0-9a-f]{32,}",
        "candidate": "[A-Za-z0-9+/_=-]{24,}",
    }
    parts = []
    for i, (kind, p) in enumerate(patterns.items()):
        _, group, least = KINDS.get(kind, ("", 0, 0))
        parts.append(f"""
  SELECT doc_id, {i} AS n, '{kind}' AS kind,
    regexp_extract_all(t, '{q(p)}') AS m, regexp_extract_all(t, '{q(p)}', {group}) AS v, string_split_regex(t, '{q(p)}') AS g, {least} AS least FROM d""")
    rows = " UNION ALL ".join(parts)
    classes = " ".join(f"WHEN regexp_matches(v, '{p}') THEN {most_sum(b)}" for p, b in CLASSES.values())
    allow = " OR ".join(f"regexp_matches(v, '{p}')" for p in ALLOW)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({rows}),
placed AS (SELECT doc_id, n, kind, m, v, g, least, unnest(range(1, len(m) + 1)) AS i FROM raw WHERE len(m) > 0),
found AS (
  SELECT doc_id, n, kind, least, v[i] AS v,
    CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s, length(m[i]) AS l
  FROM placed),
base AS (SELECT doc_id, n, kind, s, s + l AS e FROM found WHERE n < {len(KINDS)} AND length(v) >= least),
cand AS (
  SELECT doc_id, s, v, CASE {classes} ELSE -1 END AS most FROM found f
  WHERE n = {len(KINDS)} AND NOT ({allow}) AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = f.doc_id AND b.s <= f.s AND f.s + f.l <= b.e)),
win AS (SELECT doc_id, s, v, most, unnest(range(0, length(v) - {WINDOW} + 1)) AS i FROM cand),
sums AS (
  SELECT doc_id, s, i, most, list_sum(list_transform(list_distinct(string_split(substring(v, i + 1, {WINDOW}), '')),
    lambda c: {_TABLE}[1 + {WINDOW} - length(replace(substring(v, i + 1, {WINDOW}), c, ''))])) AS total FROM win),
hot AS (SELECT doc_id, {len(KINDS)} AS n, 'entropy' AS kind, s + min(i) AS s, s + max(i) + {WINDOW} AS e FROM sums WHERE total <= most GROUP BY doc_id, sums.s),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM hot),
out AS (
  SELECT doc_id, count(*) FILTER (WHERE n = 0) AS n_assign, count(*) FILTER (WHERE n = 1) AS n_access, count(*) FILTER (WHERE n = 2) AS n_hex, count(*) FILTER (WHERE n = 3) AS n_entropy,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, n) FILTER (WHERE n < 3) AS b, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, n) AS a
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_entropy, 0) AS n_entropy,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN out USING (doc_id)
"""


ORACLE_SQL = _oracle()
