"""Operator 11: personal data in texts, with DataFrame functions only.

Base kinds are leftmost non-overlapping matches of fixed patterns, tested afterwards.  The
method adds spans by bootstrapping.  Base spans are seeds.  Identifier-like strings beside
them are candidates: numbers of six digits or more in groups, and strings that mix letters with
digits or ``@``.  Every occurrence has two lexical patterns: the two words before it, and the
word before it with the word after it.  Patterns and distinct values make a graph, which is scored
in rounds: a pattern's confidence in a kind is the sum of its values' scores over their number
plus one, and a candidate's score is the mean confidence of its patterns; seeds keep one for their kind.
A pattern with a confidence of at least 0.65 that enough different seeds of the kind support
extracts: candidates in it that fit the kind (numbers for ip, card and phone, strings with letters
for email) become spans ``<kind>_like``.  Scores are whole millionths, so their sums do not
depend on the order of rows.

Copies of a text add nothing: the graph has one edge for a pattern and a value.  A pattern or a value
may have most edges; where edges meet scores, either is split into shares.

The patterns below match what the stated ones match, in time that grows with the text: a
possessive run that starts where none can be under way, and a lazy run that ends where the
repeated group would.  The text is read whole, and only spans and their neighbours are kept.

Edge cases: null text counts as empty and has no spans; repeated rows give equal rows; a null id
stays null; an empty table gives no rows; other columns are not read.  A pattern's words are of the
64 characters before and after, up to the neighbouring match of the same family.  Offsets count code
points, ends are exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.text import once
from plumbline.llm.common import Workspace, table
from plumbline.llm.secret_scan import running_sums

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns as stated, for the SQL; the last two are the candidate families.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"[0-9]([\x20.-]?[0-9])+",
    "mixed": r"[A-Za-z0-9@._%+/#-]+",
}
#: The same matches in linear time; ``mixed`` leaves out strings that ``_fits`` would drop.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-][A-Za-z0-9.-]*?(?=\.(?![A-Za-z0-9-])|[^A-Za-z0-9.-]|\z)",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][\x20-]?[0-9][0-9\x20-]*?(?=[\x20-](?![0-9])|[^0-9\x20-]|\z)",
    "phone": STATED["phone"],
    "number": r"[0-9][\x20.-]?[0-9][0-9\x20.-]*?(?=[\x20.-](?![0-9])|[^0-9\x20.-]|\z)",
    "mixed": r"(?<![A-Za-z0-9@._%+/#-])(?=[A-Za-z._%+/#-]*+[0-9@])(?=[0-9@._%+/#-]*+[A-Za-z])[A-Za-z0-9@._%+/#-]++",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"
#: Families that a kind's patterns may extract.
FITS = {"email": "mixed", "ip": "number", "card": "number", "phone": "number"}
NUMBER_DIGITS = 6
MIXED_LENGTH = 5
#: Characters that a word of a text may hold beside a number; a number next to one is part of a string.
_JOINED = r"[A-Za-z0-9@_%+/#-]"

UNIT = 1_000_000
CONFIDENCE = 650_000
SEEDS = 3
ROUNDS = 3
NEAR = 64
#: Shares of a pattern or value where edges meet scores.
SHARES = 16

_WORDS = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOUND = "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum of at most nineteen digits holds."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda a, i: a + once(digits.substr(F.length(digits) - i + 1, F.lit(1)).cast("int"), lambda d: F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)),
    )
    return total % 10 == 0


def _fits(family: str, m: Column) -> Column:
    value = m["value"]
    if family == "email":
        return F.lit(True)
    if family == "ip":
        return value.rlike(IP)
    if family == "mixed":
        return F.length(value) >= MIXED_LENGTH
    count = F.length(_digits(value))
    if family == "card":
        # the checksum reads the digits of one in the right range only
        return F.when(count.between(14, 19), once(_digits(value), luhn)).otherwise(F.lit(False))
    if family == "phone":
        return count.between(10, 15)
    return (count >= NUMBER_DIGITS) & ~m["before"].rlike(rf"{_JOINED}\z") & ~m["after"].rlike(rf"^{_JOINED}")


def _locate(df: DataFrame, family: str) -> DataFrame:
    """Adds the matches of a family that pass its test: place, value, and what stands before and after, up to the next match."""
    pattern = PATTERNS[family]
    has = F.col("text").rlike(pattern)
    m, g, s = F.col(f"{family}_m"), F.col(f"{family}_g"), F.col(f"{family}_s")
    df = df.withColumns({f"{family}_m": F.when(has, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))), f"{family}_g": F.when(has, F.split("text", pattern, -1))})
    steps = F.transform(m, lambda x, i: (F.length(x) + F.length(F.get(g, i))).cast("long"))
    df = df.withColumn(f"{family}_b", steps).withColumn(f"{family}_s", running_sums(F.col(f"{family}_b")))

    def one(x: Column, i: Column) -> Column:
        start = F.get(s, i) + F.length(F.get(g, i))
        before, after = F.get(g, i), F.get(g, i + 1)
        return F.struct(start.cast("long").alias("start"), (start + F.length(x)).cast("long").alias("end"), x.alias("value"), before.substr(F.lit(-NEAR), F.lit(NEAR)).alias("before"), after.substr(F.lit(1), F.lit(NEAR)).alias("after"))

    found = F.when(F.size(m) > 0, F.filter(F.transform(m, one), lambda x: _fits(family, x)))
    kept = [c for c in df.columns if not c.startswith(f"{family}_")]
    return df.select(*kept, F.coalesce(found, F.array().cast(_FOUND)).alias(family))


def marks(docs: DataFrame, ws: Workspace, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id`` and the matches of every family, written once; ``row`` numbers the rows of that table."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for family in PATTERNS:
        df = _locate(df, family)
    return ws.stage(df.drop("text").withColumn("row", F.monotonically_increasing_id()), "marks")


def _words(c: Column) -> Column:
    """Lower-cased words; digits are all zeros."""
    return F.regexp_extract_all(F.regexp_replace(F.translate(c, _UPPER, _LOWER), "[0-9]", "0"), F.lit(_WORDS), F.lit(0))


def _patterns(before: Column, after: Column) -> Column:
    """The two patterns of an occurrence; null where there are no words for one."""

    def both(b: Column, a: Column) -> Column:
        last = F.get(b, F.size(b) - 1)  # null where there is none, and then so is the pattern
        two = F.concat(F.lit("b "), F.get(b, F.size(b) - 2), F.lit(" "), last)
        around = F.concat(F.lit("a "), last, F.lit(" "), F.get(a, F.lit(0)))
        return F.array_compact(F.array(two, around))

    return once(_words(before), lambda b: once(_words(after), lambda a: both(b, a)))


def occurrences(found: DataFrame, ws: Workspace) -> DataFrame:
    """``row, start, end, kind, family, value, patterns``: base spans with their kind, candidates that meet none without."""
    one = lambda f: F.transform(F.col(f), lambda m: F.struct(F.lit(f).alias("family"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), m["before"].alias("before"), m["after"].alias("after")))
    all_ = F.concat(*[one(f) for f in PATTERNS])
    rows = found.where(F.size(all_) > 0).select("row", F.inline(all_))
    # the base spans around a place: those that begin before its end have the largest end, and one may begin inside it
    base = F.col("family").isin(*KINDS)
    in_order = Window.partitionBy("row").orderBy("start", "end", "family")
    earlier = F.max(F.when(base, F.col("end"))).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    # the same frame in reverse, as one that grows to the left is computed anew for every row
    reverse = Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("end").desc(), F.col("family").desc())
    later = F.min(F.when(base, F.col("start"))).over(reverse.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"__e": earlier, "__l": later})
    clear = base | (F.coalesce(F.col("__e") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("__l") >= F.col("end"), F.lit(True)))
    kind = F.when(base, F.col("family"))
    family = F.when(base, F.create_map(*[F.lit(x) for k, f in FITS.items() for x in (k, f)])[F.col("family")]).otherwise(F.col("family"))
    rows = rows.where(clear).select("row", "start", "end", kind.alias("kind"), family.alias("family"), F.translate("value", _UPPER, _LOWER).alias("value"), _patterns(F.col("before"), F.col("after")).alias("patterns"))
    return ws.stage(rows, "occurrences")


def _quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _score(prefix: str) -> list[str]:
    return [f"{prefix}{k}" for k in KINDS]


def _meet(edges: DataFrame, scores: DataFrame, key: str, other: str) -> DataFrame:
    """Joins edges with the scores of one side, each key in shares that the other side's values decide."""
    split = edges.withColumn("__share", F.pmod(F.xxhash64(other), F.lit(SHARES)))
    spread = scores.withColumn("__share", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SHARES)])))
    return split.join(spread, [key, "__share"]).drop("__share")


def confident(occ: DataFrame, ws: Workspace, rounds: int = ROUNDS) -> DataFrame:
    """``pattern, kind, confidence`` of the patterns that may extract."""
    edges = occ.select(F.explode("patterns").alias("pattern"), "value", "kind")
    held = [F.max(F.when(F.col("kind") == k, UNIT).otherwise(0)).cast("long").alias(f"s_{k}") for k in KINDS]
    edges = edges.groupBy("pattern", "value").agg(*held, F.max(F.col("kind").isNotNull()).alias("seed"))
    # a pattern that no seed has will never be confident, nor bring a candidate anything
    live = edges.groupBy("pattern").agg(F.count(F.when(F.col("seed"), 1)).alias("seeds")).where("seeds > 0").drop("seeds")
    edges = ws.stage(_meet(edges, live, "pattern", "value"), "edges")
    # a value that is a seed anywhere counts as one everywhere
    values = edges.groupBy("value").agg(*[F.max(c).alias(f"v{c}") for c in _score("s_")], F.max("seed").alias("is_seed"))
    edges = ws.stage(_meet(edges.select("pattern", "value"), values, "value", "pattern"), "graph")
    current = edges
    for r in range(rounds):
        sums = [_quotient(F.sum(f"vs_{k}"), F.count(F.lit(1)) + 1).alias(f"p_{k}") for k in KINDS]
        seeds = [F.count(F.when(F.col("is_seed") & (F.col(f"vs_{k}") == UNIT), 1)).alias(f"n_{k}") for k in KINDS]
        patterns = ws.stage(current.groupBy("pattern").agg(*sums, *seeds), f"patterns{r}")
        if r == rounds - 1:
            break
        joined = _meet(edges.where("NOT is_seed").select("pattern", "value"), patterns.select("pattern", *_score("p_")), "pattern", "value")
        fresh = joined.groupBy("value").agg(*[_quotient(F.sum(f"p_{k}"), F.count(F.lit(1))).alias(f"vs_{k}") for k in KINDS], F.lit(False).alias("is_seed"))
        known = edges.where("is_seed")
        current = known.unionByName(_meet(edges.where("NOT is_seed").select("pattern", "value"), fresh, "value", "pattern"))
    sure = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"p_{k}").alias("confidence"), F.col(f"n_{k}").alias("seeds")) for k in KINDS])
    return patterns.select("pattern", F.inline(F.filter(sure, lambda x: (x["confidence"] >= CONFIDENCE) & (x["seeds"] >= SEEDS)))).select("pattern", "kind", "confidence")


def extract(occ: DataFrame, patterns: DataFrame) -> DataFrame:
    """``row, start, end, kind`` of candidates in confident patterns: the most confident kind that fits."""
    cand = occ.where("kind IS NULL").select("row", "start", "end", "family", F.explode("patterns").alias("pattern"))
    # the place in the text splits a pattern as well as the value does
    split = cand.withColumn("__at", F.concat_ws(":", "row", "start"))
    met = _meet(split, patterns, "pattern", "__at")
    fits = reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("family") == f) for k, f in FITS.items()])
    number = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])[F.col("kind")]
    best = F.min(F.struct((-F.col("confidence")).alias("c"), number.alias("n"), F.col("kind").alias("kind")))
    out = met.where(fits).groupBy("row", "start", "end").agg(best.alias("best"))
    # a number and a string that share characters: the one that begins first, the longer of two
    w = Window.partitionBy("row").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn("__e", F.max("end").over(w)).where("__e IS NULL OR __e <= start").select("row", "start", "end", F.col("best.n").alias("n"), F.concat("best.kind", F.lit("_like")).alias("kind"))


def _base(kind: str, number: int) -> Column:
    return F.transform(F.col(kind), lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("n"), m["end"].alias("end"), F.lit(kind).alias("kind")))


_SPANS = "array<struct<start:bigint,n:int,end:bigint,kind:string>>"


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``: array of (start, kind number, end, kind) in order."""
    ws = Workspace(docs.sparkSession, "pii")
    found = marks(docs, ws, id_col=id_col, text_col=text_col)
    occ = occurrences(found, ws)
    more = extract(occ, confident(occ, ws))
    more = more.groupBy("row").agg(F.collect_list(F.struct("start", (F.col("n") + len(KINDS)).cast("int").alias("n"), "end", "kind")).alias("more"))
    base = F.concat(*[_base(k, i) for i, k in enumerate(KINDS)])
    out = found.select("row", "doc_id", base.alias("base")).join(more, "row", "left")
    return out.select("doc_id", F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(_SPANS)))).alias("spans"))


def _shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op11_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["n"] < len(KINDS))
    more = F.size(F.filter("spans", lambda s: s["n"] >= len(KINDS))).cast("long")
    return found.select("doc_id", *[n(k).alias(f"n_{k}") for k in KINDS], more.alias("n_like"), F.sha2(_shown(base), 256).alias("base_sha256"), _shown(F.col("spans")).alias("spans"))


def _oracle() -> str:
    q = lambda s: s.replace("'", "''")
    digits = "regexp_replace(v, '[^0-9]', '', 'g')"
    checksum = "list_sum(list_transform(range(1, len(ds) + 1), lambda i: CASE WHEN i % 2 = 1 THEN ds[len(ds) - i + 1] WHEN ds[len(ds) - i + 1] > 4 THEN 2 * ds[len(ds) - i + 1] - 9 ELSE 2 * ds[len(ds) - i + 1] END))"
    tests = {
        "email": "true",
        "ip": f"regexp_full_match(v, '{IP[1:-1]}')",
        "card": f"len(ds) BETWEEN 14 AND 19 AND {checksum} % 10 = 0",
        "phone": "len(ds) BETWEEN 10 AND 15",
        "number": f"len(ds) >= {NUMBER_DIGITS} AND NOT regexp_matches(b, '{_JOINED}\\z') AND NOT regexp_matches(a, '^{_JOINED}')",
        "mixed": f"length(v) >= {MIXED_LENGTH} AND regexp_matches(v, '[0-9@]') AND regexp_matches(v, '[A-Za-z]')",
    }
    # a mixed string that is no candidate does not bound the neighbours of the next one
    mixed = r"[A-Za-z0-9@._%+/#-]+"
    raw = " UNION ALL ".join(
        f"SELECT r, {i} AS n, '{k}' AS family, regexp_extract_all(t, '{q(p)}') AS m, string_split_regex(t, '{q(p)}') AS g FROM d" for i, (k, p) in enumerate(STATED.items()) if k != "mixed"
    )
    words = lambda c: f"regexp_extract_all(regexp_replace(translate({c}, '{_UPPER}', '{_LOWER}'), '[0-9]', '0', 'g'), '{_WORDS}')"
    cases = " OR ".join(f"(family = '{k}' AND {t})" for k, t in tests.items())
    fits = " ".join(f"WHEN '{k}' THEN '{f}'" for k, f in FITS.items())
    sums = ", ".join(f"sum(s_{k}) // (count(*) + 1) AS p_{k}, count(*) FILTER (WHERE seed AND s_{k} = {UNIT}) AS n_{k}" for k in KINDS)
    steps = []
    for r in range(ROUNDS):
        steps.append(f"p{r} AS MATERIALIZED (SELECT pattern, {sums} FROM e{r} GROUP BY pattern)")
        if r < ROUNDS - 1:
            means = ", ".join(f"CAST(sum(p_{k}) // count(*) AS BIGINT) AS s_{k}" for k in KINDS)
            steps.append(f"f{r} AS MATERIALIZED (SELECT value, {means} FROM e0 JOIN p{r} USING (pattern) WHERE NOT seed GROUP BY value)")
            keep = ", ".join(f"coalesce(f.s_{k}, e.s_{k}) AS s_{k}" for k in KINDS)
            steps.append(f"e{r + 1} AS MATERIALIZED (SELECT pattern, e.value, seed, {keep} FROM e0 e LEFT JOIN f{r} f ON f.value = e.value)")
    sure = " UNION ALL ".join(f"SELECT pattern, {i} AS k, '{k}' AS kind, p_{k} AS c FROM p{ROUNDS - 1} WHERE p_{k} >= {CONFIDENCE} AND n_{k} >= {SEEDS}" for i, k in enumerate(KINDS))
    fit = " OR ".join(f"(s.kind = '{k}' AND family = '{f}')" for k, f in FITS.items())
    held = ", ".join(f"max(CASE WHEN kind = '{k}' THEN {UNIT} ELSE 0 END) AS s_{k}" for k in KINDS)
    everywhere = ", ".join(f"max(max(s_{k})) OVER (PARTITION BY value) AS s_{k}" for k in KINDS)
    counts = ", ".join(f"count(*) FILTER (WHERE n = {i}) AS n_{k}" for i, k in enumerate(KINDS))
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
strings AS (
  SELECT r, regexp_extract_all(t, '{q(mixed)}') AS m, string_split_regex(t, '{q(mixed)}') AS g FROM d),
parts AS (
  SELECT r, i, m[i] AS v, g[i] AS gap, regexp_matches(m[i], '[0-9@]') AND regexp_matches(m[i], '[A-Za-z]') AS ok,
    CAST(sum(length(g[i]) + length(m[i])) OVER (PARTITION BY r ORDER BY i) - length(m[i]) AS BIGINT) AS s
  FROM (SELECT r, m, g, unnest(range(1, len(m) + 1)) AS i FROM strings WHERE len(m) > 0)),
near AS (
  SELECT p.r, p.v, p.s, t, coalesce(lag(p.s + length(p.v)) OVER w, 0) AS low, coalesce(lead(p.s) OVER w, length(t)) AS high
  FROM parts p JOIN d USING (r) WHERE ok WINDOW w AS (PARTITION BY p.r ORDER BY p.s)),
raw AS ({raw}),
placed AS (SELECT r, n, family, m, g, unnest(range(1, len(m) + 1)) AS i FROM raw WHERE len(m) > 0),
matches AS (
  SELECT r, n, family, m[i] AS v,
    CAST(sum(length(g[i]) + length(m[i])) OVER (PARTITION BY r, n ORDER BY i) - length(m[i]) AS BIGINT) AS s,
    right(g[i], {NEAR}) AS b, left(g[i + 1], {NEAR}) AS a
  FROM placed
  UNION ALL
  SELECT r, 5, 'mixed', v, s, substring(t, greatest(low, s - {NEAR}) + 1, s - greatest(low, s - {NEAR})), substring(t, s + length(v) + 1, least(high - s - length(v), {NEAR})) FROM near),
tested AS (SELECT *, list_transform(string_split({digits}, ''), lambda c: TRY_CAST(c AS INTEGER)) AS ds FROM matches),
found AS MATERIALIZED (SELECT r, n, family, v, s, s + length(v) AS e, b, a FROM tested WHERE {cases}),
base AS MATERIALIZED (SELECT * FROM found WHERE n < 4),
occ0 AS (
  SELECT r, s, e, CASE WHEN n < 4 THEN family END AS kind, CASE family {fits} ELSE family END AS family, translate(v, '{_UPPER}', '{_LOWER}') AS value, {words("b")} AS wb, {words("a")} AS wa
  FROM found f WHERE n < 4 OR NOT EXISTS (SELECT 1 FROM base x WHERE x.r = f.r AND x.s < f.e AND f.s < x.e)),
occ AS MATERIALIZED (
  SELECT r, s, e, kind, family, value, list_filter([CASE WHEN len(wb) >= 2 THEN 'b ' || wb[-2] || ' ' || wb[-1] END, CASE WHEN len(wb) >= 1 AND len(wa) >= 1 THEN 'a ' || wb[-1] || ' ' || wa[1] END], lambda x: x IS NOT NULL) AS ps FROM occ0),
edges AS (SELECT pattern, value, {held}, bool_or(kind IS NOT NULL) AS seed FROM (SELECT unnest(ps) AS pattern, value, kind FROM occ) GROUP BY pattern, value),
live AS (SELECT *, bool_or(seed) OVER (PARTITION BY pattern) AS alive FROM edges),
e0 AS MATERIALIZED (SELECT pattern, value, bool_or(bool_or(seed)) OVER (PARTITION BY value) AS seed, {everywhere} FROM live WHERE alive GROUP BY pattern, value),
{", ".join(steps)},
sure AS MATERIALIZED ({sure}),
hits AS (
  SELECT r, o.s, o.e, s.k, s.kind, row_number() OVER (PARTITION BY r, o.s, o.e ORDER BY s.c DESC, s.k) AS best
  FROM (SELECT r, s, e, family, unnest(ps) AS pattern FROM occ WHERE kind IS NULL) o JOIN sure s USING (pattern) WHERE {fit}),
added AS (SELECT r, s, e, k, kind, max(e) OVER (PARTITION BY r ORDER BY s, e DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM hits WHERE best = 1),
spans AS (SELECT r, n, family AS kind, s, e FROM base UNION ALL SELECT r, k + 4, kind || '_like', s, e FROM added WHERE reach IS NULL OR reach <= s),
out AS (
  SELECT r, {counts}, count(*) FILTER (WHERE n >= 4) AS n_like,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, n) FILTER (WHERE n < 4) AS b, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, n) AS a
  FROM spans GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, coalesce(n_like, 0) AS n_like, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN out USING (r)
"""


ORACLE_SQL = _oracle()
