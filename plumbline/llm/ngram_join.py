"""Operator 7: Jaccard join of word n-gram sets by parity sketches.

A set's sketch has P cells; every element belongs to one cell by its hash, and a cell is
the XOR of the hashes of its elements.  An element in one set only changes one cell, so
the number of cells that differ is at most the symmetric difference.  Documents fall in
size bands; a band's P exceeds the largest symmetric difference that two linked sets in
it can have, plus a reserve e, so linked sets agree in more than e cells (pigeonhole).
A document near the top of its band also takes part in the next one.

Every cell is shuffled once, by (band, cell, value); a window over equal cells keeps those
that two different sets share.  A document brings a cell at most once and a task sends the
cells of equal sets once, so the cells of one group of copies are no more than its share of
documents.  Cells that many share (blank cells, a passage common to many documents) are met by the reserve: of its cells,
a document need not use the e most frequent ones, as among the more than e that it
shares with a partner the rarest is never one of them, on either side.

Sets are verified on all their elements.  In each group of equal cells first everybody is
compared with the least member; groups that then still hold different components are
compared in pairs of blocks by bit sketches (each element flips one bit), across
components only; pairs whose Hamming distance is no larger than the symmetric difference
of linked sets can be are verified, first each member's nearest, then all that remain.  So every link between
components is found, and no group is ever expanded into all its pairs.  Equal sets are one node
throughout.  The sets in a node are told apart by 64-bit hashes of their elements.

Edge cases: null and empty texts and texts without words have no elements and link with
nothing; texts of fewer words than n are one element; equal texts link; repeated ids are
separate documents that share a name; null ids link like others, and a null id never
names a component that has another; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Workspace, connected_components, mix, signed, slices, table, utf8
from plumbline.llm.words import BLANK_SEPARATED, Words

#: Members of a block in the comparison of what is left of a group.
BLOCK = 2048
#: Pairs, times cells of a sketch, that are compared in one go.
PAIRS = 1 << 22


class Bands:
    """Size bands for links with ``num * intersection >= den * union`` (85 of 100)."""

    def __init__(self, share: int):
        self.share = share  # percent
        self.tops = [1]
        while self.cells_for(self.tops[0] + 1)[0] == 0:
            self.tops[0] += 1
        while self.tops[-1] < 1 << 40:
            self.tops.append(self.tops[-1] * 3 // 2 + 1)

    def cells_for(self, top: int) -> tuple[int, int, int]:
        """Largest symmetric difference of two linked sets of at most ``top``; reserve; cells."""
        most = 2 * top * (100 - self.share) // (100 + self.share)
        reserve = -(-most // 8)
        return most, reserve, most + 1 + reserve

    def of(self, n: int) -> list[int]:
        """Bands that a set of ``n`` takes part in: its own, and the next if a partner may be there."""
        b = int(np.searchsorted(self.tops, n))
        out = [b] if b else []
        if 100 * n // self.share > self.tops[b]:
            out.append(b + 1)
        return out


@lru_cache(maxsize=256)
def _salt(band: int, cells: int) -> np.ndarray:
    return mix(np.arange(cells, dtype=np.uint64) + np.uint64(band << 40), 5)


def sketch(elements: np.ndarray, band: int, cells: int) -> np.ndarray:
    """Keys of the cells of a sorted set of 64-bit elements."""
    cell = ((elements >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)
    edge = np.searchsorted(cell, np.arange(cells, dtype=np.uint64))
    full = np.append(edge, len(elements))
    value = np.zeros(cells, np.uint64)
    some = full[1:] > full[:-1]
    if some.any():
        value[some] = np.bitwise_xor.reduceat(mix(elements, 2), edge[some])
    return mix(value + _salt(band, cells), 6)


def parity(elements: np.ndarray, cells: int) -> bytes:
    """A 32-bit word a cell: every element of a sorted set flips one bit of its cell's word.

    The Hamming distance of two sets' words never exceeds their symmetric difference, and
    falls short of it only where two elements of one cell share a bit.
    """
    cell = ((elements >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)
    edge = np.searchsorted(cell, np.arange(cells, dtype=np.uint64))
    full = np.append(edge, len(elements))
    words = np.zeros(cells, np.uint32)
    some = full[1:] > full[:-1]
    if some.any():
        bit = np.uint32(1) << (elements & np.uint64(31)).astype(np.uint32)
        words[some] = np.bitwise_xor.reduceat(bit, edge[some])
    return words.astype("<u4").tobytes()


def element_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    w = Words(*utf8(column), BLANK_SEPARATED)
    h, ok = w.grams(n)
    out = []
    for t in range(len(column)):
        a, b = int(w.first[t]), int(w.first[t + 1])
        if b - a >= n:
            out.append(np.unique(h[a : b - n + 1]))
        elif b > a:
            out.append(mix(w._rolling(np.array([a]), np.array([b])), 100 + b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


#: Bytes of text that a task looks at together.
SLICE = 1 << 18
#: Sets that a task remembers, so as to send the cells of equal sets once; the store starts anew when full.
SEEN = 200_000


def _sets_and_sketches(docs: DataFrame, n: int, bands: Bands) -> DataFrame:
    def run(batches):
        seen: set[int] = set()
        longs = pa.list_(pa.int64())
        none = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sizes, nodes, first, second = [], [], [], []
                for s in element_sets(part.column("text"), n):
                    node = node_of(s) if len(s) else None
                    keys = []
                    if node is not None and node not in seen:
                        keys = [signed(sketch(s, b, bands.cells_for(bands.tops[b])[2])) for b in bands.of(len(s))]
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(node)
                    sizes.append(len(s))
                    nodes.append(node)
                    first.append(keys[0] if keys else none)
                    second.append(keys[1] if len(keys) > 1 else none)
                cols = [part.column("doc_id"), part.column("th"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(first, longs), pa.array(second, longs)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "th", "n", "node", "keys1", "keys2"])

    return docs.mapInArrow(run, "doc_id long, th long, n long, node long, keys1 array<long>, keys2 array<long>")


def node_of(elements: np.ndarray) -> int:
    """64-bit hash of a set."""
    return int(signed(mix(np.array([mix(elements, 11).sum(dtype=np.uint64) + np.uint64(len(elements))]), 12))[0])


def _sets_of(docs: DataFrame, n: int, bands: Bands) -> DataFrame:
    """Elements of each text whose set is the row's node, and its bit sketch of each band (hash collisions of texts fall out)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                kept, held, bits = [], [], []
                for node, s in zip(part.column("node").to_pylist(), element_sets(part.column("text"), n)):
                    if len(s) and node_of(s) == node:
                        kept.append(node)
                        held.append(s.astype("<u8").tobytes())
                        bits.append([parity(s, bands.cells_for(bands.tops[b])[2]) for b in bands.of(len(s))])
                cols = [pa.array(kept, pa.int64()), pa.array(held, pa.binary()), pa.array(bits, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(cols, names=["node", "elements", "bits"])

    return docs.select("node", "text").mapInArrow(run, "node long, elements binary, bits array<binary>")


def linked(a: bytes, b: bytes, share: int) -> bool:
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    if 100 * min(len(x), len(y)) < share * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= share * (len(x) + len(y) - both)


def near_documents(docs: DataFrame, *, n: int = 4, share: int = 85, id_col: str = "doc_id", text_col: str = "text", ws: Workspace | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    Also ``text_hash`` (xxhash64 of the text) and ``is_first``: whether the row is its
    component's first by id and text hash (null ids last); documents without words are.
    """
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "ngram-join")
    bands = Bands(share)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    sk = ws.stage(_sets_and_sketches(base, n, bands), "sketches")
    light = sk.select("doc_id", "th", "n", "node")
    place = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th"))
    nodes = ws.stage(light.where("node is not null").groupBy("node").agg(place.alias("first"), F.first("n").alias("n")), "nodes")

    # every cell travels once: a document has a cell at most once, so no key outweighs a partition
    cells = sk.select("node", F.explode("keys1").alias("key"), F.lit(1).alias("side")).union(sk.select("node", F.explode("keys2"), F.lit(2)))
    same = Window.partitionBy("key")
    held = cells.withColumns({"a": F.min("node").over(same), "b": F.max("node").over(same), "members": F.count(F.lit(1)).over(same)}).where("a <> b")
    held = ws.stage(held.groupBy("key", "node", "side").agg(F.first("a").alias("a"), F.first("members").alias("members")), "shared")
    light = ws.stage(light, "light")
    ws.release()
    ws.drop("sketches")

    # without each member's most frequent cells: the reserve of its band
    held = held.join(nodes.select("node", "n").hint("merge"), "node")
    order = Window.partitionBy("node", "side").orderBy(F.desc("members"), F.desc("key"))
    held = held.withColumn("frequent", F.row_number().over(order)).where(F.col("frequent") > _reserve(bands, F.col("n"), F.col("side"))).select("key", "node", "n", "side")
    held = ws.stage(held, "held")
    ws.drop("shared")
    least = ws.stage(held.groupBy("key").agg(F.min("node").alias("a")), "least")  # so that the join can split a hot group
    pairs = ws.stage(held.join(least.hint("merge"), "key").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "pairs")

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    reps = wanted.join(nodes, "node").select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.th").alias("th"))
    texts = base.alias("l").join(reps.hint("merge").alias("r"), (F.col("l.th") == F.col("r.th")) & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")))
    elements = _sets_of(texts.select("r.node", "l.text"), n, bands)
    elements = ws.stage(elements.dropDuplicates(["node"]), "elements")
    ws.release()

    left, right = elements.select(F.col("node").alias("a"), F.col("elements").alias("x")), elements.select(F.col("node").alias("b"), F.col("elements").alias("y"))

    def verify(batches):
        for batch in batches:
            ok = [linked(x.as_py(), y.as_py(), share) for x, y in zip(batch.column("x"), batch.column("y"))]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in (batch.column("a"), batch.column("b"))], names=["a", "b"])

    def verified(candidates: DataFrame, name: str) -> DataFrame:
        both = candidates.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "x", "y")
        return ws.stage(both.mapInArrow(verify, "a long, b long"), name)

    links = verified(pairs, "links")
    ws.release()
    cc = connected_components(ws, links)

    # what is left: groups that hold several components.  First every member names its nearest
    # candidate only, which joins clusters at a row a member; then all candidates that remain.
    compared = pairs
    for step, nearest in enumerate((True, False)):
        at = held.join(cc.hint("merge"), "node", "left").select("key", "node", "n", "side", F.coalesce("component", "node").alias("component"))
        near = ws.stage(_across(ws, at, elements, share, nearest, step), f"near{step}")
        if near.isEmpty():
            break
        fresh = ws.stage(near.join(compared.hint("merge"), ["a", "b"], "left_anti"), f"fresh{step}")
        if fresh.isEmpty():
            continue
        compared = compared.union(fresh)
        links = links.union(verified(fresh, f"links{step}"))
        cc = connected_components(ws, links, f"cc{step}")

    named = nodes.join(cc.hint("merge"), "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    first = ws.stage(named.groupBy("component").agg(F.min("first").alias("first")), "first")
    named = named.select("node", "component").join(first.hint("merge"), "component").select("node", "first")
    named = ws.stage(named, "named")
    for name in ("elements", "held", "least", "pairs", "nodes", "first"):
        ws.drop(name)
    ws.release()
    here = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th")
    out = light.join(named.hint("merge"), "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("first.doc_id", "doc_id").alias("component_id"), F.col("th").alias("text_hash"), (F.col("first").isNull() | here.eqNullSafe(F.col("first"))).alias("is_first"))


def _reserve(bands: Bands, n: Column, side: Column) -> Column:
    """Reserve of the band that a set of ``n`` elements takes part in on a side (see ``Bands.of``)."""
    own = F.size(F.filter(F.array(*[F.lit(t) for t in bands.tops]), lambda t: t < n))
    reserves = F.array(*[F.lit(bands.cells_for(t)[1]) for t in bands.tops])
    return F.get(reserves, F.when(own == 0, F.lit(1)).otherwise(own + side - 1))


def _across(ws: Workspace, at: DataFrame, elements: DataFrame, share: int, nearest: bool, step: int) -> DataFrame:
    """Pairs of a group in different components whose bit sketches are near enough for a link.

    ``nearest`` keeps for each member of a block the nearest of them.  Groups of two are
    left out: their members were compared with each other.  A task takes many small
    groups, or one pair of blocks of a large one, at a time.
    """
    mixed = at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi and size > 2")
    mixed = ws.stage(mixed.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"), "size"), f"mixed{step}")
    total = mixed.agg(F.coalesce(F.sum(F.col("size") * F.col("blocks")), F.lit(0)).alias("n")).first()["n"]
    place = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    rows = ws.stage(at.join(mixed.drop("size").hint("merge"), "key"), f"rows{step}")
    rows = rows.join(elements.select("node", "bits").hint("merge"), "node")
    rows = rows.withColumn("sketch", F.get("bits", F.least(F.col("side"), F.size("bits")) - 1)).withColumn("block", place)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    rows = rows.select(F.pmod(F.xxhash64("key", "i", "j"), F.lit(max(1, total // BLOCK))).alias("lot"), "key", "i", "j", "block", "node", "n", "component", "sketch")

    def across(t: pa.Table) -> pa.Table:
        found = [np.zeros((2, 0), np.int64)]
        cells = pc.binary_length(t.column("sketch")).to_numpy()
        for length in np.unique(cells):  # all members of a group have sketches of one length
            part = t.filter(pa.array(cells == length))
            found += _near_pairs(part, int(length) // 4, share, nearest)
        a, b = np.concatenate(found, 1)
        one = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        return pa.table({"a": one[:, 0], "b": one[:, 1]})

    return rows.groupBy("lot").applyInArrow(across, "a long, b long").distinct()


def _near_pairs(t: pa.Table, cells: int, share: int, nearest: bool) -> list[np.ndarray]:
    """Pairs of rows with one key and pair of blocks, by whole arrays; ``PAIRS`` pairs at a time."""
    key, i, j = (t.column(c).to_numpy() for c in ("key", "i", "j"))
    order = np.lexsort((j, i, key))
    key, i, j = key[order], i[order], j[order]
    node, comp, size, block = (t.column(c).to_numpy()[order] for c in ("node", "component", "n", "block"))
    sketches = np.frombuffer(b"".join(t.column("sketch").to_pylist()), "<u4").reshape(-1, cells)[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    start = np.flatnonzero(new)
    ends = np.append(start[1:], len(key))
    group = np.cumsum(new) - 1
    partners = ends[group] - np.arange(len(key)) - 1  # rows of the group behind each row
    out: list[np.ndarray] = []
    best_at, best_apart = np.full(len(key), -1), np.full(len(key), np.iinfo(np.int64).max)
    most = max(1, PAIRS // max(1, cells))
    first, bounds = 0, np.cumsum(partners)
    while first < len(key):
        done = bounds[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(bounds, done + most, side="right")))
        x = np.repeat(np.arange(first, last), partners[first:last])
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(partners[first:last]) - partners[first:last], partners[first:last])
        ok = (comp[x] != comp[y]) & ((i[x] == j[x]) | (block[x] != block[y])) & (100 * np.minimum(size[x], size[y]) >= share * np.maximum(size[x], size[y]))
        x, y = x[ok], y[ok]
        both = size[x] + size[y]
        apart = np.bitwise_count(sketches[x] ^ sketches[y]).sum(1, dtype=np.int64)
        ok = apart <= both - 2 * -(-share * both // (100 + share))
        x, y, apart = x[ok], y[ok], apart[ok]
        if nearest:
            for one, other in ((x, y), (y, x)):
                rank = np.lexsort((node[other], apart, one))
                lead = rank[np.append(True, one[rank][1:] != one[rank][:-1])] if len(rank) else rank
                better = apart[lead] < best_apart[one[lead]]
                best_at[one[lead][better]], best_apart[one[lead][better]] = other[lead][better], apart[lead][better]
        else:
            out.append(np.stack([node[x], node[y]]))
        first = last
    if nearest:
        have = np.flatnonzero(best_at >= 0)
        out.append(np.stack([node[have], node[best_at[have]]]))
    return out


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
p AS (SELECT a, b FROM c WHERE 100 * k >= 85 * (na + nb - k)),
sym AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS node, doc_id AS seen FROM s UNION SELECT r.node, sym.b FROM r JOIN sym ON sym.a = r.seen)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(seen) AS component_id FROM s JOIN r ON r.node = s.doc_id GROUP BY s.doc_id, len(g)
"""
