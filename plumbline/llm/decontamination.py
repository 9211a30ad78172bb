"""Operator 9: benchmark passages in documents, by winnowing.

Both sides keep the least hash of every ``window - k + 1`` neighbouring k-grams, which
guarantees a common fingerprint wherever ``window`` words running are shared.  Where a
document's fingerprint occurs in the benchmark, the windows around it are compared
word by word, so hits are exact.  Items shorter than a window are one window of their
own length; for each such length all grams of that length are looked up.

The benchmark's fingerprints reach the tasks by broadcast, in blocks of items of a
checked size; a benchmark beyond one block takes one pass for each block, and the
results of the passes are merged.  Documents are never shuffled in either case.  A worker
process builds the index of a pass once: arrays of hashes and places over the words of the block.

Edge cases: null or empty text has no words and no hits; null items or items without
words have no windows; equal windows of several items count for each of them; a null
item id marks words as hit but is not listed; repeated rows are judged alike; an empty
benchmark leaves all documents clean; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Workspace, slices, table, utf8
from plumbline.llm.words import ALPHANUMERIC, HashSet, Words, winnow

#: UTF-8 bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 16 << 20

FOUND = "doc_id long, n_words long, spans array<array<int>>, items array<string>"


class Index:
    """Windows of benchmark items and their fingerprints, as sorted arrays over the words of all items.

    A window is its hash and its first word, twelve bytes; its text stays where it is and is compared when a hash is met.
    """

    def __init__(self, items: list[tuple[str | None, str]], window: int, k: int):
        self.window, self.k = window, min(k, window)
        self.names = [name for name, _ in items]
        parts: dict[str, list[np.ndarray]] = {c: [np.zeros(0, t)] for c, t in (("data", np.uint8), ("start", np.int64), ("end", np.int64), ("text", np.int32), ("prints", np.uint64))}
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        at_byte = at_word = at_item = 0
        batch = pa.RecordBatch.from_arrays([pa.array([text for _, text in items], pa.string())], names=["text"])
        for part in slices(batch, "text"):  # what hashing takes beside its results is in proportion to a slice
            w = Words(*utf8(part.column("text")), ALPHANUMERIC)
            sizes = np.diff(w.first)
            h, ok = w.grams(self.k)
            kept = {"data": w.data, "start": w.start + at_byte, "end": w.end + at_byte, "text": (w.text + at_item).astype(np.int32), "prints": h[winnow(h, ok, w.text, window - self.k + 1)]}
            for c, x in kept.items():
                parts[c].append(x)
            for n in np.unique(np.minimum(sizes[sizes > 0], window)).tolist():
                h, ok = w.grams(n)
                # an item as long as a window has all of them, a shorter one is one itself
                at = np.nonzero(ok)[0] if n == window else w.first[:-1][sizes == n]
                found[n].append((h[at], (at + at_word).astype(np.int32)))
            at_byte, at_word, at_item = at_byte + len(w.data), at_word + len(w.start), at_item + len(sizes)
        self.data, self.start, self.end, self.text = (np.concatenate(parts[c]) for c in ("data", "start", "end", "text"))
        self.prints = HashSet(np.concatenate(parts["prints"]))
        self.starts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n, pairs in found.items():
            h, at = (np.concatenate(x) for x in zip(*pairs, strict=True))
            order = np.argsort(h, kind="stable")
            self.starts[n] = h[order], at[order]
        self.sets = {n: HashSet(h) for n, (h, _) in self.starts.items()}
        self._met: dict[tuple[int, int], list[tuple[bytes, set]]] = {}

    def shown(self, i: int, j: int) -> bytes:
        return b" ".join([self.data[a:b].tobytes() for a, b in zip(self.start[i:j], self.end[i:j], strict=True)])

    def candidates(self, words: Words):
        """(first word, number of words, hash) of every window whose hash is that of an item's."""
        for n, known in self.sets.items():
            h, ok = words.grams(n)
            if n == self.window:
                spread = self.window - self.k
                g, whole = words.grams(self.k)
                at = winnow(g, whole, words.text, spread + 1)
                hits = at[self.prints(g[at])]
                if not len(hits):
                    continue
                starts = np.unique((hits[:, None] - np.arange(spread + 1)[None, :]).ravel())
                starts = starts[(starts >= 0) & (starts < len(h))]
            else:
                starts = np.arange(len(h))
            starts = starts[ok[starts]]
            starts = starts[known(h[starts])]
            yield from ((int(i), n, x) for i, x in zip(starts, h[starts], strict=True))

    def owners(self, words: Words, i: int, n: int, x: np.uint64) -> set:
        """Items with the very words of a window."""
        hashes, starts = self.starts[n]
        low = int(np.searchsorted(hashes, x))
        met = self._met.get((n, low))
        if met is None:  # texts of one hash, nearly always one, and who has them
            texts: dict[bytes, set] = defaultdict(set)
            for s in starts[low : int(np.searchsorted(hashes, x, side="right"))].tolist():
                texts[self.shown(s, s + n)].add(self.names[self.text[s]])
            if len(self._met) > 100_000:
                self._met.clear()
            met = self._met[n, low] = list(texts.items())
        shown = words.shown(i, i + n)
        return next((names for t, names in met if t == shown), set())

    def search(self, words: Words, texts: int) -> list[tuple[list[list[int]], list[str]]]:
        """Of each text: hit runs of words (end exclusive), and the items found."""
        hit = np.zeros(len(words.start) + 1, bool)
        items: list[set] = [set() for _ in range(texts)]
        any_hit = set()
        for i, n, x in self.candidates(words):
            owners = self.owners(words, i, n, x)
            if owners:
                hit[i : i + n] = True
                t = int(words.text[i])
                any_hit.add(t)
                items[t] |= owners
        out = []
        for t in range(texts):
            spans: list[list[int]] = []
            if t in any_hit:
                a, b = words.first[t], words.first[t + 1]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]])))
                spans = edges.reshape(-1, 2).tolist()
            out.append((spans, sorted(x for x in items[t] if x is not None)))
        return out


_built: dict[str, Index] = {}


def index_of(key: str, shipped, window: int, k: int) -> Index:
    """The index of a pass, built once in each worker process, whatever the number of its tasks; an earlier one goes."""
    if key not in _built:
        _built.clear()
        _built[key] = Index(shipped.value, window, k)
    return _built[key]


def merge(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def find(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, k: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None, keep_prefix: str = "", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document's number of words, hit runs of words and items; ``keep`` carries columns along, named with ``keep_prefix``."""
    spark = docs.sparkSession
    ws = Workspace(spark, "decontamination")
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_bytes))
    keep = keep or []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"), *[F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)])
    rows = rows.withColumn("n_words", F.lit(0).cast("long")).withColumn("spans", F.lit(None).cast("array<array<int>>")).withColumn("items", F.lit(None).cast("array<string>"))
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        shipped = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in part.collect()])  # about BLOCK_BYTES
        key = f"{ws.path}-{b}"

        def one_pass(batches, shipped=shipped, key=key):
            index = index_of(key, shipped, window, k)
            for batch in batches:
                for part in slices(batch, "__text"):
                    words = Words(*utf8(part.column("__text")), ALPHANUMERIC)
                    found = index.search(words, len(part))
                    old = zip(part.column("spans").to_pylist(), part.column("items").to_pylist())
                    both = [(merge((s0 or []) + s), sorted({*(i0 or []), *i})) for (s0, i0), (s, i) in zip(old, found)]
                    new = {"n_words": pa.array(np.diff(words.first), pa.int64()), "spans": pa.array([s for s, _ in both], pa.list_(pa.list_(pa.int32()))), "items": pa.array([i for _, i in both], pa.list_(pa.string()))}
                    yield pa.RecordBatch.from_arrays([new.get(c, part.column(c)) for c in part.schema.names], names=part.schema.names)

        schema = rows.schema
        rows = rows.mapInArrow(one_pass, schema)
        if b + 1 < blocks:
            rows = ws.stage(rows, f"pass{b}")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s[1] - s[0]))
    return rows.select("doc_id", *[F.col(f"__keep{i}").alias(keep_prefix + c) for i, c in enumerate(keep)], "n_words", n_hit.alias("n_hit"), "spans", "items")


def contaminated(share: int = 20):
    """At least one hit, and hits on one word in ``share``."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


ORACLE_SQL = """
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
bl AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""
