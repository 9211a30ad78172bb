"""Operator 12: repair the structure of conversations with the cheapest edits.

Every turn is one of twelve symbols: what its role begins with (``s``, ``u``, ``a`` or
another) and its fault (none, truncated, or one that requires deletion).  The grammar
``(s?(ua)+)?`` has four states: nothing yet, after ``s``, after ``u``, after ``a``.  The
cost-to-go of a turn and state is found backward; a forward walk then takes, among
the edits whose cost plus what they leave equals the cost-to-go, the one whose initial is
least in ASCII (Delete, Insert, Keep, Rerole).  An edit and a state give the next state,
so that walk yields the ASCII-least of all cheapest edit strings.

A conversation of any length is cut into blocks of turns, and a group is a block.
Each block has a table of the least cost from every state at its start to every state at
its end; a stream over the blocks of a conversation, last one first, turns these into the
cost-to-go at every block's end, each block is walked from the states that it may start in,
and a stream in order picks the walk that is real.  Edits go back to turns by their unique
place.  Only the digest of a repaired conversation is one sequence by its nature: its
turns pass through one task, in order, and none is held.  The edit string has a letter a
turn and is one value of one row, as the result asks.

Turns are ordered by number (null first); turns with one number by role and text, a
repetition after its original.  Repeated rows are turns like any other.  Null roles and texts
are one space, null numbers are one space in the damage key; a null conversation id is
one conversation.  A conversation without turns has zeros and the digest of nothing; an empty table
gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import CRC_TABLES, Workspace, crc32_sql, table
from plumbline.plans.indexing import with_running

#: Turns of a conversation that are walked as one piece.
BLOCK = 8192
#: Shares of the turns with one text.
SHARES = 16

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FINAL = (START, AFTER_A)
_NEXT = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
#: The only turn that Insert and Rerole can make in a state.
_MADE = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
_FAR = 1 << 60

_SPACE = r"\x20\x09-\x0D"
SYMBOLS = "suao"  # + 4 for truncated, + 8 for a turn that must go


def _edits(symbol: int | None, state: int) -> list[tuple[str, int, int, bool]]:
    """(initial, cost, next state, whether the turn is consumed) in ASCII order; without a turn only Insert."""
    made = _NEXT[_MADE[state]][state]
    if symbol is None:
        return [("I", INSERT, made, False)]
    first, fault = SYMBOLS[symbol % 4], symbol // 4
    out = [("D", DELETE, state, True), ("I", INSERT, made, False)]
    if fault < 2:
        if state in _NEXT.get(first, {}):
            out.append(("K", KEEP + TRUNCATED * fault, _NEXT[first][state], True))
        out.append(("R", REROLE + TRUNCATED * fault, made, True))
    return out


def before(symbol: int | None, after: tuple) -> tuple:
    """Cost-to-go of the four states before a turn, from that after it; without a turn, with insertions alone."""
    cost = list(after) if symbol is None else [min((c + after[n] for _, c, n, used in _edits(symbol, q) if used), default=_FAR) for q in range(4)]
    for _ in range(3):  # insertions lead through at most three other states
        cost = [min(cost[q], INSERT + cost[_edits(symbol, q)[-1 if symbol is None else 1][2]]) for q in range(4)]
    return tuple(cost)


#: Cost-to-go when no turn is left.
END = before(None, tuple(0 if q in FINAL else _FAR for q in range(4)))


class Costs:
    """Cost-to-go by symbol, remembered up to a constant: few differences between states occur."""

    def __init__(self):
        self.known: dict[tuple, tuple] = {}

    def __call__(self, symbol: int, after: tuple) -> tuple:
        least = min(after)
        key = (symbol, *[min(a - least, _FAR) for a in after])
        if key not in self.known:
            self.known[key] = before(symbol, key[1:])
        return tuple(min(c + least, _FAR) for c in self.known[key])

    def backward(self, symbols: bytes, end: tuple) -> list[tuple]:
        """Cost-to-go at every place from the first turn to the end."""
        out = [end]
        for s in reversed(symbols):
            out.append(self(s, out[-1]))
        return out[::-1]


def walk(symbols: bytes, costs: list[tuple], state: int, last: bool) -> tuple[list[str], list[int], int]:
    """Edits of each turn (insertions before it included), the state before them, and the state at the end.

    ``last``: insertions after the final turn are an entry of their own.
    """
    edits, states = [], []
    for i, s in enumerate(symbols):
        made, begin = "", state
        while True:
            initial, state, used = next((e, n, u) for e, c, n, u in _edits(s, state) if c + costs[i + u][n] == costs[i][state])
            made += initial
            if used:
                break
        edits.append(made)
        states.append(begin)
    if last:
        made, begin = "", state
        while costs[-1][state] > 0:
            made, state = made + "I", _edits(None, state)[0][2]
        edits.append(made)
        states.append(begin)
    return edits, states, state


_BLOCKS = "key string, block long, last boolean, symbols binary, first string, final string, illegal long, table array<long>"


def _tables(batches):
    """Adds to each block its least costs between states and its illegal neighbours."""
    costs = Costs()
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            named = "".join(SYMBOLS[s % 4] for s in r["symbols"])
            r["first"], r["final"] = named[:1], named[-1:]
            r["illegal"] = sum(a + b not in LEGAL for a, b in zip(named, named[1:], strict=False))
            r["table"] = []
            for target in range(4):  # least cost from each state at the start to one state at the end
                r["table"] += costs.backward(r["symbols"], tuple(0 if q == target else _FAR for q in range(4)))[0] if not (r["last"] and r["block"] == 0) else []
        yield pa.RecordBatch.from_pylist(rows, schema=_BLOCK_SCHEMA)


LEGAL = ("su", "ua", "au")
_BLOCK_SCHEMA = pa.schema(
    [
        ("key", pa.string()),
        ("block", pa.int64()),
        ("last", pa.bool_()),
        ("symbols", pa.binary()),
        ("first", pa.string()),
        ("final", pa.string()),
        ("illegal", pa.int64()),
        ("table", pa.list_(pa.int64())),
    ]
)

def _ends(batches):
    """Blocks of a conversation, last one first: the cost-to-go at the end of each, from the tables of those behind it."""
    schema = pa.schema([("key", pa.string()), ("block", pa.int64()), ("to_go", pa.list_(pa.int64()))])
    end = END
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["last"]:
                end = END
            out.append({"key": r["key"], "block": r["block"], "to_go": end})
            if r["block"]:
                end = tuple(min(min(r["table"][4 * t + q] + end[t] for t in range(4)), _FAR) for q in range(4))
        yield pa.RecordBatch.from_pylist(out, schema=schema)


_WALKS = "key string, block long, first string, final string, illegal long, cost long, walks array<struct<state:int,end:int,edits:array<string>,states:array<int>>>"
_WALK_SCHEMA = pa.schema(
    [
        ("key", pa.string()),
        ("block", pa.int64()),
        ("first", pa.string()),
        ("final", pa.string()),
        ("illegal", pa.int64()),
        ("cost", pa.int64()),
        ("walks", pa.list_(pa.struct([("state", pa.int32()), ("end", pa.int32()), ("edits", pa.list_(pa.string())), ("states", pa.list_(pa.int32()))]))),
    ]
)


def _walks(batches):
    """Walks each block from every state that it may start in."""
    costs = Costs()
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            to_go = costs.backward(r["symbols"], tuple(r["to_go"]))
            found = []
            for q in range(4) if r["block"] else (START,):
                edits, states, state = walk(r["symbols"], to_go, q, r["last"])
                found.append({"state": q, "end": state, "edits": edits, "states": states})
            out.append({k: r[k] for k in ("key", "block", "first", "final", "illegal")} | {"cost": 0 if r["block"] else to_go[0][START], "walks": found})
        yield pa.RecordBatch.from_pylist(out, schema=_WALK_SCHEMA)


def _starts(batches):
    """Blocks in order: the state that each starts in, and illegal neighbours across blocks."""
    schema = pa.schema([("key", pa.string()), ("block", pa.int64()), ("start", pa.int32()), ("across", pa.int64())])
    state, final = START, ""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["block"] == 0:
                state, final = START, ""
            out.append({"key": r["key"], "block": r["block"], "start": state, "across": int(bool(final) and final + r["first"] not in LEGAL)})
            state, final = next(end for begin, end in zip(r["state"], r["end"], strict=True) if begin == state), r["final"]
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _digests(batches):
    """Turns in order, one conversation after another: its edit string and the digest of its repaired text."""
    schema = pa.schema([("key", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    key, digest, audit, lines = None, None, [], 0
    done: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if r["key"] != key:
                if key is not None:
                    done.append({"key": key, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
                key, digest, audit, lines = r["key"], hashlib.sha256(), [], 0
            audit.append(r["edits"])
            if r["lines"] is not None:
                digest.update((("\n" if lines else "") + r["lines"]).encode())
                lines += 1
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"key": key, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema=schema)


def repair(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", order_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The repaired turns and a row a conversation.

    First table: ``key, pos, edits, roles, texts`` of every turn as it stands after its
    edits (none for a deleted one, several with insertions).  Second: ``key, conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.
    """
    ws = Workspace(turns.sparkSession, "repair")
    conv = F.col(conv_col)
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("-")).alias("key"), conv.alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        *[F.col(c).alias(f"order{i}") for i, c in enumerate(order_cols or [])],
    )
    order = ["turn", *([f"order{i}" for i in range(len(order_cols))] if order_cols else ["role", "text"])]
    rows = ws.stage(with_running(rows, "key", order, pos="pos", size="size").select("key", "conv_id", "turn", "role", "text", "pos", "size"), "turns")
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\v\f\r")), -1, 1)
    same = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    facts = rows.select("key", "conv_id", "turn", "pos", "size", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(rf"[^{_SPACE}]")).alias("blank"), (~last.isin(".", "!", "?")).alias("cut"), same.alias("same"))
    # one text may be most turns of a conversation: its first place goes to several shares of it
    share = F.pmod("pos", F.lit(SHARES)).cast("int").alias("share")
    earliest = facts.groupBy("key", "same").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    earliest = earliest.select("key", "same", "first", F.explode(F.array(*[F.lit(i) for i in range(SHARES)])).alias("share"))
    marked = facts.withColumn("share", share).join(earliest, ["key", "same", "share"], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first") < F.col("pos"), "duplicate").when(F.col("cut"), "truncated")
    first = F.when(F.col("initial").isin("s", "u", "a"), F.instr(F.lit(SYMBOLS), F.col("initial")) - 1).otherwise(3)
    symbol = first + F.when(F.col("fault").isin("blank", "duplicate"), 8).when(F.col("fault") == "truncated", 4).otherwise(0)
    marked = ws.stage(marked.withColumn("fault", fault).select("key", "conv_id", "turn", "pos", "size", "fault", symbol.cast("int").alias("symbol")), "facts")

    block = F.floor(F.col("pos") / BLOCK)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))), lambda x: F.lpad(F.hex(x["symbol"]), 2, "0"))
    blocks = marked.groupBy("key", block.alias("block")).agg(F.unhex(F.array_join(in_order, "")).alias("symbols"), F.max(F.col("pos") + 1 == F.col("size")).alias("last"))
    tables = ws.stage(blocks.select("key", "block", "last", "symbols").mapInArrow(_tables, _BLOCKS), "blocks")
    ends = tables.select("key", "block", "last", "table").repartition("key").sortWithinPartitions("key", F.col("block").desc())
    ends = ends.mapInArrow(_ends, "key string, block long, to_go array<long>")
    walked = ws.stage(tables.drop("table").join(ends, ["key", "block"]).mapInArrow(_walks, _WALKS), "walks")
    starts = walked.select("key", "block", "first", "final", "walks.state", "walks.end").repartition("key").sortWithinPartitions("key", "block")
    starts = starts.mapInArrow(_starts, "key string, block long, start int, across long")
    real = F.filter("walks", lambda w: w["state"] == F.col("start"))[0]
    chosen = walked.join(starts, ["key", "block"]).select("key", "block", (F.col("illegal") + F.col("across")).alias("illegal"), "cost", real["edits"].alias("edits"), real["states"].alias("states"))
    chosen = ws.stage(chosen, "chosen")

    # an entry beyond the last turn holds what is inserted after it
    entries = chosen.select("key", "block", F.arrays_zip("edits", "states").alias("e")).select("key", "block", F.posexplode("e").alias("at", "e"))
    entries = entries.select("key", (F.col("block") * BLOCK + F.col("at")).alias("pos"), "e.edits", F.col("e.states").alias("state"))
    repaired = ws.stage(entries.join(rows.select("key", "pos", "role", "text"), ["key", "pos"], "left").select("key", "pos", "edits", *_made()), "repaired")
    lines = F.when(F.size("roles") > 0, F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n"))
    digests = repaired.select("key", "pos", "edits", lines.alias("lines")).repartition("key").sortWithinPartitions("key", "pos").select("key", "edits", "lines")
    digests = digests.mapInArrow(_digests, "key string, audit string, repaired_sha256 string")

    n = lambda f: F.count(F.when(F.col("fault") == f, 1)).alias(f)
    # distinct turns are those that differ from the one before, as turns are in order
    spans = marked.groupBy("key", "turn").agg(F.first("conv_id").alias("conv_id"), n("blank"), n("duplicate"), n("truncated"))
    spans = spans.groupBy("key").agg(F.first("conv_id").alias("conv_id"), F.coalesce(_gaps(), F.lit(0)).cast("long").alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    costs = chosen.groupBy("key").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    return repaired, spans.join(costs, "key").join(digests, "key")


def _gaps() -> Column:
    """Missing numbers between the least and the largest; computed as decimals, as the span of longs is wider than a long."""
    wide = "decimal(20,0)"
    return (F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count("turn").cast(wide)).try_cast("long")


def _made() -> list[Column]:
    """Roles and texts of the turns that a turn's edits make; the state before says what Insert and Rerole make."""
    letters = F.filter(F.split("edits", ""), lambda c: c != "")
    start = F.struct(F.col("state").alias("q"), F.array().cast("array<string>").alias("roles"), F.array().cast("array<string>").alias("texts"))

    def step(st: Column, e: Column) -> Column:
        made = F.when(st["q"] == AFTER_U, F.lit("assistant")).otherwise(F.lit("user"))
        role = F.when(e == "K", F.col("role")).otherwise(made)
        text = F.when(e == "I", F.lit("")).otherwise(F.col("text"))
        first = F.substring(role, 1, 1)
        q = F.when(first == "s", AFTER_S).when(first == "u", AFTER_U).otherwise(AFTER_A)
        gone = e == "D"
        return F.struct(F.when(gone, st["q"]).otherwise(q).cast("int").alias("q"), F.when(gone, st["roles"]).otherwise(F.array_append(st["roles"], role)).alias("roles"), F.when(gone, st["texts"]).otherwise(F.array_append(st["texts"], text)).alias("texts"))

    made = F.aggregate(letters, start, step)
    return [made["roles"].alias("roles"), made["texts"].alias("texts")]


def damage(turns: DataFrame) -> DataFrame:
    """The stated damage of conversations, by a number of each turn; a repetition follows its original."""
    number = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", role.alias("role0"), text.alias("text0"), number.alias("kind"))
    rows = rows.where("kind <> 0").withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text0", ".!?", "")).otherwise(F.col("text0"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role0")).alias("role"), text.alias("text"), "role0", F.sha2("text0", 256).alias("text0"), "copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    _, found = repair(damage(given), order_cols=["role0", "text0", "copy"])
    found = found.drop("conv_id")
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    out = given.select("conv_id").distinct().withColumn("key", key).join(found, "key", "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _oracle() -> str:
    """Costs backward by one recursion over places, edits forward by another, for all conversations at once."""
    far = 1_000_000

    def consumed(state: str, keeps: dict[str, str], made: str) -> str:
        """Least cost of the edits that take a turn: ``keeps`` has the state after each initial that may stay."""
        kept = "".join(f" WHEN '{f}' THEN t + b.{q}" for f, q in keeps.items())
        return f"least(3 + b.{state}, CASE WHEN gone THEN {far} ELSE least(CASE f{kept} ELSE {far} END, 2 + t + b.{made}) END)"

    begin, after_s = consumed("v0", {"s": "v1", "u": "v2"}, "v2"), consumed("v1", {"u": "v2"}, "v2")
    after_u, after_a = consumed("v2", {"a": "v3"}, "v3"), consumed("v3", {"u": "v2"}, "v2")
    made = "CASE WHEN q = 2 THEN 3 ELSE 2 END"
    role = "CASE WHEN q = 2 THEN 'assistant' ELSE 'user' END"
    keep = "CASE WHEN f = 's' AND q = 0 THEN 1 WHEN f = 'u' AND q <> 2 THEN 2 WHEN f = 'a' AND q = 2 THEN 3 END"
    number = crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE{CRC_TABLES},
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, CAST({number} % 20 AS INTEGER) AS kind FROM conversations, crcs),
damaged AS (
  SELECT coalesce('=' || conv_id, '-') AS key, turn, role AS role0, text AS text0, copy, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM given WHERE kind <> 0)),
placed AS MATERIALIZED (SELECT key, turn, role, text, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role0, sha256(text0), copy) - 1 AS i FROM damaged),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_SPACE}]') THEN 'blank' WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(rtrim(text, {space}), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
turns AS MATERIALIZED (SELECT key, i, turn, role, text, left(role, 1) AS f, fault, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS t FROM faults),
back(key, i, v0, v1, v2, v3) AS (
  SELECT key, count(*), {END[0]}, {END[1]}, {END[2]}, {END[3]} FROM turns GROUP BY key
  UNION ALL
  SELECT key, i, least(c0, 2 + c2, 4 + c3), least(c1, 2 + c2, 4 + c3), least(c2, 2 + c3), least(c3, 2 + c2)
  FROM (SELECT b.key, s.i, {begin} AS c0, {after_s} AS c1, {after_u} AS c2, {after_a} AS c3 FROM back b JOIN turns s ON s.key = b.key AND s.i = b.i - 1)),
costs AS MATERIALIZED (SELECT key, i, [v0, v1, v2, v3] AS v FROM back),
walk(key, i, q, audit, made) AS (
  SELECT key, CAST(0 AS BIGINT), 0, '', CAST([] AS VARCHAR[]) FROM costs WHERE i = 0
  UNION ALL
  SELECT key, CASE WHEN e = 'I' THEN i ELSE i + 1 END, CASE e WHEN 'D' THEN q WHEN 'K' THEN k ELSE m END, audit || e,
    CASE e WHEN 'D' THEN made WHEN 'I' THEN list_append(made, {role} || ':') WHEN 'K' THEN list_append(made, role || ':' || text) ELSE list_append(made, {role} || ':' || text) END
  FROM (
    SELECT w.key, w.i, w.q, w.audit, w.made, s.role, s.text, {keep} AS k, {made} AS m,
      CASE WHEN s.i IS NOT NULL AND 3 + n.v[q + 1] = c.v[q + 1] THEN 'D' WHEN 2 + c.v[{made} + 1] = c.v[q + 1] THEN 'I'
        WHEN NOT s.gone AND coalesce(s.t + n.v[{keep} + 1] = c.v[q + 1], false) THEN 'K' ELSE 'R' END AS e
    FROM walk w JOIN costs c ON c.key = w.key AND c.i = w.i LEFT JOIN costs n ON n.key = w.key AND n.i = w.i + 1 LEFT JOIN turns s ON s.key = w.key AND s.i = w.i
    WHERE s.i IS NOT NULL OR c.v[q + 1] > 0)),
ended AS (SELECT w.key, audit, made FROM walk w JOIN costs c ON c.key = w.key AND c.i = w.i WHERE c.v[q + 1] = 0 AND w.i = (SELECT max(i) FROM costs x WHERE x.key = w.key)),
counts AS (
  SELECT key, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE i > 0 AND b4 || f NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(f) OVER (PARTITION BY key ORDER BY i) AS b4 FROM turns) GROUP BY key)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(c.v[1], 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '-') AS key FROM conversations) o LEFT JOIN counts USING (key) LEFT JOIN ended USING (key) LEFT JOIN costs c ON c.key = o.key AND c.i = 0
"""


ORACLE_SQL = _oracle()
