"""Operator 8: near-duplicate vectors by a pivot-permutation index.

Angles to reference points (pivots) build inverted lists; all pairs of a list are
compared by the exact cosine in double precision.  Every vector is indexed.  Equal
vectors of a label are one class with a count, so copies are never paired.

A vector with a pivot within ``reach`` lies in the cell of the nearest one, and every
vector joins the list of each pivot whose cell is no wider than their angle less the
link angle.  By the triangle inequality whatever links with a vector of a cell is in
the list of that cell: these links are exact, however dense the group.  A vector
outside all cells joins the lists of its ``k`` nearest pivots too; two such vectors
are compared when they share one of them, which can miss a link.

A list is cut into blocks of about ``BLOCK`` vectors and every pair of blocks is one
group of rows: a matrix product counts shared pivots, another gives the cosines.  A pair
that meets in several lists counts in the first of them.  A group returns for each
vector its number of links and an edge to the root of its part of the group, so linked
pairs are counted and never listed.

Reference points: unit vectors of a bounded sample by hash of the id, a power of two
near the root of the number of classes, 64 at least and ``most_pivots`` at most.  None
lies within ``reach`` of another, so a dense group has few of them; ``reach`` is twice
the link angle, or less (the link angle at least) where vectors would join more than
``k`` lists on average.

Edge cases: null labels, ids or vectors, null or non-finite components and zero vectors
link with nothing and stay; vectors of different lengths are never compared; repeated
ids are separate vectors of one name; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Workspace, connected_components, table

BLOCK = 768
NEAREST = 8
#: Angles that bounds are widened by, far above rounding errors.
SLACK = 1e-6


def unit_rows(values: pa.ListArray) -> list[bytes | None]:
    """Unit vectors as little-endian doubles; None where a vector can't be compared."""
    out: list[bytes | None] = []
    for v in values:
        if not v.is_valid or v.values.null_count or len(v.values) == 0:
            out.append(None)
            continue
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.abs(x).max()
        if not np.isfinite(top) or top == 0:
            out.append(None)
            continue
        x = x / top
        out.append((x / np.sqrt(x @ x)).astype("<f8").tobytes())
    return out


def angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1, 1))


def spread_pivots(sample: np.ndarray, m: int, link: float, k: int) -> tuple[np.ndarray, float]:
    """At most ``m`` vectors of the sample, none within ``reach`` of another, and ``reach``."""
    for reach in (2 * link, 1.5 * link, link):
        have = np.zeros((m, sample.shape[1]))
        n = 0
        for x in sample:
            if n < m and (angles(x[None], have[:n]) > reach).all():
                have[n] = x
                n += 1
        if reach == link or (angles(sample, have[:n]) <= reach + link).sum(1).mean() <= k:
            return have[:n], reach


def _roots(mask: np.ndarray) -> np.ndarray:
    """Least index of each row's part under a symmetric boolean matrix."""
    lab = np.arange(len(mask))
    while True:
        new = np.minimum(lab, np.where(mask, lab[None, :], len(mask)).min(1))
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def verify(n, side, pivots, vectors, pivot: int, pair: bool, m: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (weighted by class size) of each row, and the row of its root, for one pair of blocks."""
    marks = np.zeros((len(n), m), np.float32)
    marks[np.repeat(np.arange(len(n)), [len(p) for p in pivots]), np.concatenate(pivots)] = 1
    ok = (marks[:, :pivot] @ marks[:, :pivot].T == 0) & (vectors @ vectors.T >= least)
    np.fill_diagonal(ok, False)
    if pair:
        ok &= side[:, None] != side[None, :]
    return ok.astype(np.int64) @ n, _roots(ok)


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.93, k: int = NEAREST, most_pivots: int = 4096, ws: Workspace | None = None) -> DataFrame:
    """``vec_id, n_links, component_id`` of every vector."""
    spark = vectors.sparkSession
    ws = ws or Workspace(spark, "embedding-dedup")

    def units(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(unit_rows(b.column(2)), pa.binary())], names=["vec_id", "label", "unit"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.mapInArrow(units, "vec_id long, label string, unit binary")
    rows = ws.stage(rows.withColumns({"h1": F.xxhash64("unit"), "h2": F.xxhash64(F.lit(1), "unit")}), "units")
    usable = rows.where("unit is not null and label is not null and vec_id is not null")
    classes = ws.stage(usable.groupBy("label", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("rep"), F.first("unit").alias("unit")).withColumn("node", F.xxhash64("label", "h1", "h2")), "classes")
    total = classes.count()
    m = int(min(most_pivots, max(64, 1 << round(np.log2(max(total, 1)) / 2))))
    grain = 1 << 20
    share = min(grain, -(-2 * m * grain // max(total, 1)))
    sample = classes.where(F.pmod(F.xxhash64("node"), F.lit(grain)) < share).select("node", "unit").collect()  # about 2 m rows
    sample.sort(key=lambda r: ((r["node"] * 0x9E3779B97F4A7C15) & (2**64 - 1), r["node"]))
    by_size: dict[int, list[np.ndarray]] = {}
    for r in sample:
        x = np.frombuffer(bytes(r["unit"]), "<f8")
        by_size.setdefault(len(x), []).append(x)
    link = float(np.arccos(np.clip(least, -1, 1)))
    shipped = spark.sparkContext.broadcast((m, {d: spread_pivots(np.array(v), m, link, k) for d, v in by_size.items()}))

    def reference(d: int) -> tuple[np.ndarray, float]:
        m, known = shipped.value
        have, reach = known.get(d, (np.zeros((0, d)), link))
        if len(have) < m:  # too few vectors of this length were drawn: fixed random directions
            rest = np.random.default_rng(d).standard_normal((m - len(have), d))
            have = np.concatenate([have, rest / np.linalg.norm(rest, axis=1, keepdims=True)])
        return have, reach

    def by_length(batch, kept):
        """Rows of each length in a batch: their places, angles to the pivots, and the reach."""
        units = [np.frombuffer(x.as_py(), "<f8") for x in batch.column("unit")]
        sizes = np.array([len(u) for u in units], np.int32)
        for d in map(int, np.unique(sizes)):
            at = np.nonzero(sizes == d)[0]
            if d not in kept:
                kept[d] = reference(d)
            yield d, at, angles(np.array([units[i] for i in at]), kept[d][0]), kept[d][1]

    def homes(batches):
        kept: dict = {}
        for b in batches:
            for d, _, angle, reach in by_length(b, kept):
                home, width = angle.argmin(1), angle.min(1)
                inside = width <= reach
                cells = np.unique(home[inside])
                most = [width[inside & (home == c)].max() for c in cells]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), d, np.int32)), pa.array(cells.astype(np.int32)), pa.array(most, pa.float64())], names=["size", "pivot", "width"])

    widths = classes.select("unit").mapInArrow(homes, "size int, pivot int, width double").groupBy("size", "pivot").agg(F.max("width").alias("width"))
    cells: dict[int, np.ndarray] = {}
    for r in widths.collect():  # at most m rows a length
        cells.setdefault(r["size"], np.full(m, -np.inf))[r["pivot"]] = r["width"]
    wide = spark.sparkContext.broadcast(cells)

    def describe(batches):
        kept: dict = {}
        for b in batches:
            sizes, out = np.zeros(b.num_rows, np.int32), [None] * b.num_rows
            for d, at, angle, reach in by_length(b, kept):
                joins = angle <= wide.value.get(d, np.full(m, -np.inf)) + link + SLACK
                outside = np.nonzero(angle.min(1) > reach)[0]
                joins[outside[:, None], np.argsort(angle[outside], axis=1, kind="stable")[:, :k]] = True
                sizes[at] = d
                for i, row in zip(at, joins):
                    out[i] = np.nonzero(row)[0].astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("label"), b.column("n"), pa.array(sizes), pa.array(out, pa.list_(pa.int32())), b.column("unit")], names=["node", "label", "n", "size", "pivots", "unit"])

    index = ws.stage(classes.select("node", "label", "n", "unit").mapInArrow(describe, "node long, label string, n long, size int, pivots array<int>, unit binary"), "index")
    postings = index.withColumn("pivot", F.explode("pivots"))
    key = ["label", "size", "pivot"]
    lists = index.select("label", "size", F.explode("pivots").alias("pivot")).groupBy(*key).agg(F.count(F.lit(1)).alias("entries")).where("entries > 1")
    lists = lists.select(*key, F.ceil(F.col("entries") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node", "pivot"), F.col("blocks")).cast("int")
    spread = postings.join(lists, key).withColumn("side", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")}).select(*key, "i", "j", "side", "node", "n", "pivots", "unit")

    def group(t: pa.Table) -> pa.Table:
        pivots = t.column("pivots").to_pylist()
        units = np.array([np.frombuffer(x, "<f8") for x in t.column("unit").to_pylist()])
        node, n, side = (t.column(c).to_numpy() for c in ("node", "n", "side"))
        links, root = verify(n, side, pivots, units, t.column("pivot")[0].as_py(), t.column("i")[0].as_py() != t.column("j")[0].as_py(), m, least)
        hit = links > 0
        return pa.table({"node": node[hit], "links": links[hit], "peer": node[root[hit]]})

    found = ws.stage(spread.groupBy(*key, "i", "j").applyInArrow(group, "node long, links long, peer long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    cc = connected_components(ws, found.select(F.col("node").alias("a"), F.col("peer").alias("b")))
    out = classes.select("label", "h1", "h2", "n", "rep", "node").join(links, "node", "left").join(cc, "node", "left")
    out = ws.stage(out.select("label", "h1", "h2", "rep", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component")), "named")
    least = ws.stage(out.groupBy("component").agg(F.min("rep").alias("component_id")), "least")  # so that the join can split a hot component
    out = out.join(least.hint("merge"), "component").select("label", "h1", "h2", "n_links", "component_id")
    return (
        rows.withColumn("ok", F.col("unit").isNotNull() & F.col("vec_id").isNotNull())
        .withColumn("label", F.when(F.col("ok"), F.col("label")))
        .drop("unit")
        .join(out, ["label", "h1", "h2"], "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_vectors(table(spark, sf_dir, "embeddings"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


ORACLE_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
r AS (SELECT a AS node, a AS seen FROM p UNION SELECT r.node, p.b FROM r JOIN p ON p.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN c ON c.node = vec_id LEFT JOIN n ON n.a = vec_id
"""
