"""Operator 13: a Merkle manifest of a table, with a proof for every row.

Rows are leaves, grouped and ordered; every 16 consecutive nodes of a group become one
node until one remains, and the groups' tops become the leaves of a last tree.

Nodes are combined by key as events: a task keeps, for each parent, the children seen so
far under their places (the partial parent).  How many children a parent awaits follows
from the group's size and the level alone, so the child that completes it also emits it, and
the parent becomes an event of the level above in the same task.  Rows arrive in ranges of
the order, so nearly all parents complete where their leaves lie.  What is unresolved at a
task's end (a few partial parents for each level and range) is shuffled by parent, merged,
and combined again, until nothing is unresolved.

Every parent keeps its ordered children, which are the links back: trails of
siblings go from the root down, one join a level of nodes with their parents, and the
leaves lie in their parents' rows, so the widest rows are never shuffled.

Edge cases: null values hash as ``-``; rows that share an id are ordered by leaf digest; null ids
and the null group come first; equal rows are separate leaves; an empty table gives no rows;
other columns, whatever their names, are not read; a text of any length is hashed whole.  One
group may hold most rows: its leaves lie in many ranges.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import CRC_TABLES, Workspace, crc32_sql, table
from plumbline.plans.indexing import with_running

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_CHILD = "struct<place:int,digest:string,doc_id:bigint,altered:string>"
#: ``kind``: 0 a parent with all its children, 1 the top of a group, 2 an unresolved parent.
_NODE = f"kind int, grp string, size long, level int, idx long, digest string, kids array<{_CHILD}>"


def sha(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf(columns: list[Column]) -> Column:
    """Digest of a row: each value as its UTF-8 length, a colon and itself; null as a dash."""
    parts = []
    for c in columns:
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return sha(F.concat(*parts))


def level_size(size: int, level: int) -> int:
    """Nodes of a level above ``size`` leaves."""
    for _ in range(level):
        size = -(-size // ARITY)
    return size


def _combine(batches):
    """Leaves (``kind`` null, one child) and unresolved parents in; parents, tops and what is still unresolved out."""
    partial: dict[tuple, tuple[int, dict]] = {}
    out: list[tuple] = []

    def node(kind, grp, size, level, idx, digest, kids):
        out.append((kind, grp, size, level, idx, digest, [{"place": p, "digest": k[0], "doc_id": k[1], "altered": k[2]} for p, k in sorted(kids.items())]))

    def event(grp, size, level, idx, child):
        """A node of a level has come to be; emit every ancestor that it completes."""
        while (width := level_size(size, level)) > 1:
            parent, key = idx // ARITY, (grp, level + 1, idx // ARITY)
            kids = partial.setdefault(key, (size, {}))[1]
            kids[idx % ARITY] = child
            if len(kids) < min(ARITY, width - parent * ARITY):
                return
            del partial[key]
            digest = hashlib.sha256("".join(kids[p][0] for p in sorted(kids)).encode()).hexdigest()
            node(0, grp, size, level + 1, parent, digest, kids)
            level, idx, child = level + 1, parent, (digest, None, None)
        node(1, grp, size, level, idx, child[0], {0: child})

    def flush():
        names = [f.split()[0] for f in _NODE.split(", ")]
        columns = dict(zip(names, zip(*out, strict=True), strict=True))
        batch = pa.RecordBatch.from_arrays([pa.array(columns[n], _ARROW.field(n).type) for n in names], schema=_ARROW)
        out.clear()
        return batch

    for batch in batches:
        for row in batch.to_pylist():
            for k in row["kids"]:
                event(row["grp"], row["size"], row["level"] - 1, row["idx"] * ARITY + k["place"], (k["digest"], k["doc_id"], k["altered"]))
            if len(out) >= 2000:
                yield flush()
    for (grp, level, idx), (size, kids) in partial.items():
        node(2, grp, size, level, idx, None, kids)
        if len(out) >= 2000:
            yield flush()
    if out:
        yield flush()


_ARROW = pa.schema(
    [
        ("kind", pa.int32()),
        ("grp", pa.string()),
        ("size", pa.int64()),
        ("level", pa.int32()),
        ("idx", pa.int64()),
        ("digest", pa.string()),
        ("kids", pa.list_(pa.struct([("place", pa.int32()), ("digest", pa.string()), ("doc_id", pa.int64()), ("altered", pa.string())]))),
    ]
)


def build(ws: Workspace, leaves: DataFrame, name: str) -> DataFrame:
    """All parents and tops above ``leaves(grp, size, idx, digest, doc_id, altered)``, as a written table."""
    child = F.struct((F.col("idx") % ARITY).cast("int").alias("place"), "digest", "doc_id", "altered")
    start = leaves.select("grp", "size", F.lit(1).alias("level"), F.floor(F.col("idx") / ARITY).alias("idx"), F.array(child).alias("kids"))
    rounds = [ws.stage(start.mapInArrow(_combine, _NODE), f"{name}-0")]
    while not (open_ := rounds[-1].where("kind = 2")).isEmpty():
        merged = open_.select("grp", "size", "level", "idx", "kids").repartition("grp", "level", "idx")
        rounds.append(ws.stage(merged.mapInArrow(_combine, _NODE), f"{name}-{len(rounds)}"))
    out = rounds[0]
    for r in rounds[1:]:
        out = out.union(r)
    return out.where("kind < 2")


def trails(ws: Workspace, nodes: DataFrame, tops: DataFrame, name: str) -> DataFrame:
    """Rows ``(grp, size, digest, doc_id, altered, subroot, root, trail)`` of all leaves.

    ``tops(grp, subroot, root, trail)`` says what lies above each group's top; a trail is
    an array of (siblings, place) from a node's own level to the root.
    """
    height = nodes.agg(F.max("level")).first()[0] or 0
    heads = nodes.where("kind = 1").select("grp", "level", "kids").join(tops, "grp")
    single = heads.where("level = 0").select("grp", F.inline("kids").alias("place", "digest", "doc_id", "altered"), "subroot", "root", "trail")
    parents = nodes.where("kind = 0")
    heads = heads.select("grp", "level", F.lit(0).cast("long").alias("idx"), "subroot", "root", "trail")
    below = heads.where(F.col("level") == height).drop("level")
    for level in range(height, 0, -1):
        here = parents.where(F.col("level") == level).select("grp", "idx", "kids").join(below, ["grp", "idx"])
        kid = here.select("*", F.explode("kids").alias("kid"))
        others = F.array_join(F.transform(F.filter("kids", lambda k: k["place"] != F.col("kid.place")), lambda k: k["digest"]), "")
        trail = F.concat(F.array(F.struct(others.alias("sib"), F.col("kid.place").alias("place"))), F.col("trail"))
        if level == 1:
            leaves = kid.select("grp", "kid.place", "kid.digest", "kid.doc_id", "kid.altered", "subroot", "root", trail.alias("trail"))
            return leaves.union(single)
        below = kid.select("grp", (F.col("idx") * ARITY + F.col("kid.place")).alias("idx"), "subroot", "root", trail.alias("trail"))
        below = ws.stage(below.unionByName(heads.where(F.col("level") == level - 1).drop("level")), f"{name}-trail{level}")
    return single


def fold(digest: Column, trail: Column) -> Column:
    """The root that a leaf digest gives with its siblings."""
    wide = 64 * ARITY

    def up(below: Column, step: Column) -> Column:
        at = step["place"] * 64
        return sha(F.concat(step["sib"].substr(F.lit(1), at), below, step["sib"].substr(at + 1, F.lit(wide))))

    return F.aggregate(trail, digest, up)


def manifest(docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "source", leaf_of: Column | None = None, altered: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, trail, altered`` of every row; a trail proves its leaf."""
    ws = Workspace(docs.sparkSession, "merkle")
    digest = leaf([F.col(c) for c in FIELDS]) if leaf_of is None else leaf_of
    changed = F.lit(None).cast("string") if altered is None else altered
    # groups as non-null text whose order is that of the group: null first, then UTF-8
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))
    rows = docs.select(group.alias("grp"), F.col(id_col).cast("long").alias("doc_id"), digest.alias("digest"), changed.alias("altered"))
    rows = ws.stage(rows, "leaves")
    leaves = with_running(rows, "grp", ["doc_id", "digest"], pos="idx", size="size")
    nodes = build(ws, leaves, "rows")
    heads = nodes.where("kind = 1").select(F.lit("").alias("all"), "grp", "digest")
    order = with_running(heads, "all", ["grp"], pos="idx", size="size")
    order = ws.stage(order.select(F.col("all").alias("grp"), "size", "idx", "digest", F.lit(None).cast("long").alias("doc_id"), F.col("grp").alias("altered")), "groups")
    above = build(ws, order, "groups")
    none = F.array().cast("array<struct<sib:string,place:int>>")
    top = above.where("kind = 1").select("grp", F.col("digest").alias("subroot"), F.col("digest").alias("root"), none.alias("trail"))
    # a group's name travels as the payload of its leaf in the last tree
    tops = ws.stage(trails(ws, above, top, "groups").select(F.col("altered").alias("grp"), F.col("digest").alias("subroot"), "root", "trail"), "tops")
    found = trails(ws, nodes, tops, "rows")
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "trail", "altered")


def proof_digest(trail: Column) -> Column:
    return sha(F.array_join(F.transform(trail, lambda s: s["sib"]), ""))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    changed = F.when(hit & (lowered != F.col("text")), leaf([lowered if c == "text" else F.col(c) for c in FIELDS]))
    found = manifest(docs, altered=changed)
    folded = fold(F.coalesce("altered", "leaf"), F.col("trail"))
    out = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("trail")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(depth: int = 6) -> str:
    """The levels unrolled; ``depth`` levels hold 16 ** depth rows of a group."""

    def field(c: str) -> str:
        return f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def row(text: str) -> str:
        return f"sha256({' || '.join(field(text if c == 'text' else c) for c in FIELDS)})"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        "\nWITH RECURSIVE" + CRC_TABLES,
        f"""
ids AS (SELECT doc_id, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS crc FROM (SELECT DISTINCT doc_id FROM documents), crcs)""",
        f"""
leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '-') AS g, {row("text")} AS leaf, CASE WHEN crc % 5 = 0 THEN {row(low)} ELSE {row("text")} END AS altered
  FROM documents LEFT JOIN ids USING (doc_id))""",
        """
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves)""",
        """
rows0 AS (SELECT g, i, leaf AS d FROM placed)""",
    ]

    def tree(n: str) -> None:
        for k in range(depth):
            steps.append(f"""
{n}kids{k} AS MATERIALIZED (
  SELECT g, i // {ARITY} AS p, list(d ORDER BY i) AS ds, any_value(c) AS c FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM {n}{k}) GROUP BY g, i // {ARITY})""")
            steps.append(f"""
{n}{k + 1} AS (SELECT g, p AS i, CASE WHEN c = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d FROM {n}kids{k})""")

    def climb(n: str, last: str) -> str:
        """Siblings of every level that has more than one node, and the digest folded with them."""
        for k in range(depth):
            sides = f"ds[1:x.i % {ARITY}]", f"ds[x.i % {ARITY} + 2:]"
            steps.append(f"""
{n}up{k} AS (
  SELECT x.* EXCLUDE (i, sib, fold), x.i // {ARITY} AS i, CASE WHEN c = 1 THEN sib ELSE sib || array_to_string({sides[0]} || {sides[1]}, '') END AS sib,
    CASE WHEN c = 1 THEN fold ELSE sha256(array_to_string({sides[0]} || [fold] || {sides[1]}, '')) END AS fold
  FROM {last} x JOIN {n}kids{k} k ON k.g = x.g AND k.p = x.i // {ARITY})""")
            last = f"{n}up{k}"
        return last

    tree("rows")
    steps.append(f"""
tops AS MATERIALIZED (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, d, g AS grp FROM rows{depth})""")
    steps.append("""
tops0 AS (SELECT g, i, d FROM tops)""")
    tree("tops")
    steps.append("""
below AS (SELECT doc_id, leaf, g, i, '' AS sib, altered AS fold FROM placed)""")
    low_end = climb("rows", "below")
    steps.append(f"""
above AS (SELECT doc_id, leaf, t.d AS subroot, t.g, t.i, sib, fold FROM {low_end} u JOIN tops t ON t.grp = u.g)""")
    top_end = climb("tops", "above")
    return ",".join(steps) + f"""
SELECT doc_id, leaf, subroot, r.d AS root, sha256(sib) AS proof_sha256, fold AS folded_root, fold = r.d AS verified
FROM {top_end}, (SELECT d FROM tops{depth}) r"""


ORACLE_SQL = _oracle()
