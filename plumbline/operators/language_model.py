"""An n-gram language model counted, smoothed and applied by grouping and joining.

Interpolated modified Kneser-Ney smoothing of orders one to three.  Counts below the highest
order are numbers of distinct words before an n-gram (n-grams at the start of a sentence keep
plain counts), three discounts an order come from the counts of counts, and what a
context's discounts free is given to the next lower order.  Unknown words share what the
unigrams leave to an even distribution.

Words go by their 64-bit hashes: of ten million different words, two share one with a chance of some 3 in a
million, and would then count as one word.  No table is ever on one task or the driver: a dozen numbers (discounts and
totals) reach it.  Distinct n-grams are scored level by level, so a join key has at most as many rows as there are
different words, however often an n-gram occurs; the last join, from texts to their scored
trigrams, is left to adaptive execution, which splits the side of the texts.

``perplexity_under`` keeps no model: trigrams travel packed to the bucket of their middle word, where
all counts but those of single words are complete, and a bucket returns only what is asked.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.heads import perplexity
from plumbline.operators.spectra import _bytes, _numbers, _runs
from plumbline.staging import remove_staged, staged

BEGIN, END = "<s>", "</s>"
#: Discounts where a corpus is too small for its counts of counts to give any.
FALLBACK = (0.5, 1.0, 1.5)


def sentence_words(text: Column) -> Column:
    """Lines of a text as arrays of words: A-Z lower-cased, split at white space; an empty text is one line."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.transform(F.split(low, "\n"), lambda line: F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def _words(df: DataFrame, keys: list[str], sentences: str) -> DataFrame:
    """``keys, t``: a sentence a row, with its beginning and its end."""
    lines = df.select(*keys, F.explode(sentences).alias("__line"))
    return lines.select(*keys, F.concat(F.array(F.lit(BEGIN)), "__line", F.array(F.lit(END))).alias("t"))


def _trigrams(df: DataFrame, keys: list[str], sentences: str) -> DataFrame:
    """``keys, u, v, w`` of every word and sentence end, by the words' hashes; ``u`` is null after the beginning of a sentence.

    The three words are one array and its shifts, so a sentence costs what it is long.
    """
    t = F.col("t")
    shifts = F.arrays_zip(F.concat(F.array(F.lit(None).cast("string")), t).alias("u"), t.alias("v"), F.slice(t, F.lit(2), F.size(t)).alias("w"))
    grams = _words(df, keys, sentences).select(*keys, F.inline(shifts).alias("u", "v", "w")).where("w IS NOT NULL")
    return grams.select(*keys, F.when(F.col("u").isNotNull(), F.xxhash64("u")).alias("u"), F.xxhash64("v").alias("v"), F.xxhash64("w").alias("w"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts of an order from how many n-grams were counted once to four times."""
    return _discounts({r["c"]: r["n"] for r in counts.where("c <= 4").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()})


def _discounts(t: dict[int, int]) -> tuple[float, float, float]:
    if any(t.get(k, 0) == 0 for k in (1, 2, 3, 4)):
        return FALLBACK
    y = t[1] / (t[1] + 2 * t[2])
    found = tuple(k - (k + 1) * y * t[k + 1] / t[k] for k in (1, 2, 3))
    return found if all(0 <= d <= k for k, d in zip((1, 2, 3), found, strict=True)) else FALLBACK


def _discount(d: tuple[float, float, float], c: str = "c") -> Column:
    """Null without a count."""
    c = F.col(c)
    return F.when(c == 1, d[0]).when(c == 2, d[1]).when(c > 2, d[2])


def _contexts(counts: DataFrame, by: list[str], d: tuple[float, float, float]) -> DataFrame:
    """Total of each context, and the share that its discounts free."""
    return counts.groupBy(*by).agg(F.sum("c").alias("total"), (F.sum(_discount(d)) / F.sum("c")).alias("free"))


@dataclass
class LanguageModel:
    """Counts by the words' hashes, ``counts3(u, v, w, c)``, ``counts2(v, w, c)`` and ``counts1(w, c)``, their discounts, and ``names(h, word)``.

    ``unigrams(w, p)``, ``bigrams(v, w, p)``, ``free1(v, free)`` and ``free2(u, v, free)`` give the words themselves.
    """

    counts3: DataFrame
    counts2: DataFrame
    counts1: DataFrame
    names: DataFrame
    discounts: tuple[tuple[float, float, float], ...]
    total: int
    unknown: float

    TABLES = ("counts3", "counts2", "counts1", "names")

    def write(self, path: str) -> None:
        for name in self.TABLES:
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        row = ([list(d) for d in self.discounts], self.total, self.unknown)
        self.counts1.sparkSession.createDataFrame([row], "discounts array<array<double>>, total long, unknown double").coalesce(1).write.mode("overwrite").parquet(f"{path}/numbers")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> LanguageModel:
        n = spark.read.parquet(f"{path}/numbers").first()
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in cls.TABLES], tuple(tuple(d) for d in n.discounts), n.total, n.unknown)

    def _named(self, df: DataFrame, *keys: str) -> DataFrame:
        for k in keys:
            df = df.join(self.names.select(F.col("h").alias(k), F.col("word").alias(f"__{k}")), k)
        return df.select(*[F.col(f"__{c}").alias(c) if c in keys else c for c in df.columns if not c.startswith("__")])

    def _p1(self) -> DataFrame:
        return self.counts1.select("w", ((F.col("c") - _discount(self.discounts[0])) / self.total + self.unknown).alias("p1"))

    def _p2(self, counts: DataFrame, free1: DataFrame) -> DataFrame:
        p = (F.col("c") - _discount(self.discounts[1])) / F.col("total") + F.col("free") * F.col("p1")
        return counts.join(free1, "v").join(self._p1(), "w").select("v", "w", p.alias("p"))

    def _free1(self) -> DataFrame:
        return _contexts(self.counts2, ["v"], self.discounts[1])

    @property
    def unigrams(self) -> DataFrame:
        return self._named(self._p1(), "w").withColumnRenamed("p1", "p")

    @property
    def bigrams(self) -> DataFrame:
        return self._named(self._p2(self.counts2, self._free1()), "v", "w")

    @property
    def free1(self) -> DataFrame:
        return self._named(self._free1(), "v").drop("total")

    @property
    def free2(self) -> DataFrame:
        return self._named(_contexts(self.counts3.where("u IS NOT NULL"), ["u", "v"], self.discounts[2]), "u", "v").drop("total")

    def score(self, df: DataFrame, keys: list[str], sentences: str) -> DataFrame:
        """``keys, log10, length`` of each row: the log probability of its words and sentence ends, and their number.

        What is asked for is written first and meets the counts once an order, so only contexts that occur in it are smoothed.
        """
        asked = staged(_trigrams(df, keys, sentences).groupBy(*keys, "u", "v", "w").agg(F.count(F.lit(1)).alias("n")), "asked")
        triples = staged(asked.select("u", "v", "w").distinct(), "triples")
        pairs = staged(triples.select("v", "w").distinct(), "pairs")
        free1 = staged(self._free1(), "free1")
        known = staged(self._p2(self.counts2.join(pairs, ["v", "w"]), free1), "known")
        lower = F.coalesce(F.col("free"), F.lit(1.0)) * F.coalesce(F.col("p1"), F.lit(self.unknown))
        pairs = pairs.join(known, ["v", "w"], "left").join(self._p1(), "w", "left").join(free1, "v", "left")
        pairs = staged(pairs.select("v", "w", F.coalesce("p", lower).alias("p2")), "p2")
        contexts = staged(triples.where("u IS NOT NULL").select("u", "v").distinct(), "contexts")
        near = staged(self.counts3.where("u IS NOT NULL").join(contexts, ["u", "v"], "left_semi"), "near")
        free2 = _contexts(near, ["u", "v"], self.discounts[2])
        # no context: all of the lower order; a context without the word: what it frees
        upper = F.coalesce((F.coalesce("c", F.lit(0)) - F.coalesce(_discount(self.discounts[2]), F.lit(0.0))) / F.col("total") + F.col("free") * F.col("p2"), F.col("p2"))
        each = triples.join(pairs, ["v", "w"]).join(near, ["u", "v", "w"], "left").join(free2, ["u", "v"], "left")
        each = each.select(F.col("u").alias("__u"), F.col("v").alias("__v"), F.col("w").alias("__w"), F.log10(upper).alias("__l"))
        same = F.col("u").eqNullSafe(F.col("__u")) & (F.col("v") == F.col("__v")) & (F.col("w") == F.col("__w"))
        return asked.join(each, same).groupBy(*keys).agg(F.sum(F.col("n") * F.col("__l")).alias("log10"), F.sum("n").alias("length"))

    def perplexity(self, df: DataFrame, keys: list[str], sentences: str) -> DataFrame:
        scored = self.score(df, keys, sentences)
        return scored.select(*keys, "length", perplexity(F.col("log10"), F.col("length")).alias("perplexity"))


def train(df: DataFrame, sentences: str) -> LanguageModel:
    """A model of the sentences (arrays of words) in an array column."""
    raw = staged(_trigrams(df, [], sentences).groupBy("u", "v", "w").agg(F.count(F.lit(1)).alias("c")), "trigrams")
    c3 = raw.where("u IS NOT NULL")
    starts = raw.where("u IS NULL").select("v", "w", "c")
    c2 = staged(c3.groupBy("v", "w").agg(F.count(F.lit(1)).alias("c")).unionByName(starts), "bigrams")
    c1 = staged(c2.groupBy("w").agg(F.count(F.lit(1)).alias("c")), "unigrams")
    d1, d2, d3 = discounts(c1), discounts(c2), discounts(c3)
    total, freed, words = c1.agg(F.sum("c"), F.sum(_discount(d1)), F.count(F.lit(1))).first()
    if not words:
        raise ValueError("no sentence to learn from")
    names = _words(df, [], sentences).select(F.explode("t").alias("word")).distinct().select(F.xxhash64("word").alias("h"), "word")
    return LanguageModel(raw, c2, c1, names, (d1, d2, d3), total, freed / total / (words + 1))


# ------------------------------------------------------------------ without a model

#: Words that are packed at a time, trigrams of a bucket, trigrams that a task unpacks at a time, and buckets up to which those stay small.
_CHUNK, _BUCKET, _UNPACKED, _BUCKETS = 2_000_000, 2_000_000, 2_000_000, 128
_PACKED = "bucket int, asked boolean, size long, names binary, v binary, w binary, u binary, c binary"
_FOUND = "kind int, u long, v long, w long, c long, c2 long, t2 long, a2 long, b2 long, m2 long, t3 long, a3 long, b3 long, m3 long"
_COLUMNS = [x.split()[0] for x in _FOUND.split(", ")[1:]]


def _sentences(batches, begin: int, end: int):
    """``t, first``: words of some sentences with their beginnings and ends, and whether a word is a beginning."""
    held, size = [], 0

    def made():
        lengths, values = (np.concatenate(x) for x in zip(*held, strict=True))
        at = np.cumsum(lengths + 2)
        t, first, last = np.empty(int(at[-1]), np.uint64), np.zeros(int(at[-1]), bool), np.zeros(int(at[-1]), bool)
        first[at - lengths - 2], last[at - 1] = True, True
        t[first], t[last], t[~(first | last)] = begin, end, values
        return t, first

    for batch in batches:
        lines = batch.column(0).flatten()
        lengths, values = np.diff(lines.offsets.to_numpy()), lines.flatten().to_numpy().view(np.uint64)
        ends, i = np.cumsum(lengths + 2), 0
        while i < len(lengths):
            began = ends[i] - lengths[i] - 2
            j = max(i + 1, int(np.searchsorted(ends, began + _CHUNK - size, "right")))
            at = began - 2 * i
            held.append((lengths[i:j], values[at : ends[j - 1] - 2 * j].copy()))
            size, i = size + int(ends[j - 1] - began), j
            if size >= _CHUNK or i < len(lengths):
                yield made()
                held, size = [], 0
    if held:
        yield made()


def _pack(df: DataFrame, sentences: str, buckets: int, asked: bool, begin: int, end: int) -> DataFrame:
    """Different trigrams of a chunk by the bucket of their middle word: names in order, places in them of v, w and u (one more; 0 is none), and counts."""

    def run(batches):
        import pyarrow as pa

        for t, first in _sentences(batches, begin, end):
            here = ~first[1:]
            v, w = t[:-1][here], t[1:][here]
            u, start = np.concatenate([np.zeros(1, np.uint64), t[:-2]])[here], first[:-1][here]
            into = (v >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            at = np.argsort(into, kind="stable")
            bounds = np.searchsorted(into[at], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(bounds)):
                k = at[bounds[b] : bounds[b + 1]]
                names, place = np.unique(np.concatenate([v[k], w[k], u[k]]), return_inverse=True)
                x, y, z = place.reshape(3, -1)
                found = _triples(x, y, np.where(start[k], 0, z + 1), np.ones(len(k), np.int64))
                arrays = [np.diff(names, prepend=np.uint64(0)), *(x.astype(np.int32) for x in (np.diff(found[0], prepend=0), *found[1:3])), found[3]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([asked]), pa.array([len(found[0])], pa.int64())] + [pa.array([_bytes(x)], pa.binary()) for x in arrays], names=["bucket", "asked", "size", "names", "v", "w", "u", "c"]
                )

    hashes = F.transform(sentences, lambda s: F.transform(s, lambda w: F.xxhash64(w)))
    return df.select(F.coalesce(hashes, F.array().cast("array<array<long>>")).alias("h")).mapInArrow(run, _PACKED)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where the values of ordered columns change."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _triples(v: np.ndarray, w: np.ndarray, u: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different places ``v, w, u`` in order, and the sums of their counts."""
    bits = [max(1, int(x.max(initial=0)).bit_length()) for x in (v, w, u)]
    if sum(bits) <= 63:
        at = np.argsort((v.astype(np.int64) << bits[1] | w) << bits[2] | u)
    else:
        at = np.lexsort((u, w, v))
    v, w, u, c = v[at], w[at], u[at], c[at]
    s = _starts(v, w, u)
    return v[s], w[s], u[s], np.add.reduceat(c, s) if len(s) else c


def _numbered(key: np.ndarray, c: np.ndarray, into: np.ndarray) -> np.ndarray:
    """For each place of ``into`` in the list of keys asked, the total of ``c`` and how many are 1, 2 and more."""
    at = np.minimum(np.searchsorted(into, key), max(len(into) - 1, 0))
    ok = into[at] == key if len(into) else np.zeros(len(key), bool)
    at, c = at[ok], c[ok]
    return np.stack([np.bincount(at, x, len(into)) for x in (c, c == 1, c == 2, c > 2)]).astype(np.int64)


def _bucket(blobs: list[tuple]):
    """Rows ``_FOUND`` of a bucket: ``0`` words with the number of pairs they end, ``2`` and ``3`` counts of counts, ``1`` what is asked."""
    none = np.zeros(0, np.int64)
    named = [np.cumsum(_numbers(x[2], np.uint64), dtype=np.uint64) for x in blobs]
    names = np.unique(np.concatenate(named))
    total = sum(size for asked, size, *_ in blobs if not asked)
    parts = max(1, -(-total // _UNPACKED))

    def unpacked(kind: bool, part: int | None):
        held = []
        for (asked, _, _, v, w, u, c), own in zip(blobs, named, strict=True):
            if asked != kind:
                continue
            to = np.searchsorted(names, own)
            v, w, u, c = np.cumsum(_numbers(v, np.int32), dtype=np.int64), _numbers(w, np.int32), _numbers(u, np.int32), _numbers(c, np.int64)
            keep = slice(None) if part is None or parts == 1 else to[w] % parts == part
            held.append((to[v][keep], to[w][keep], np.where(u == 0, 0, to[u - 1] + 1)[keep], c[keep]))
        return _triples(*(np.concatenate(x) for x in zip(*held, strict=True))) if held else (none,) * 4

    av, aw, au, _ = unpacked(True, None)
    size = np.int64(len(names) + 1)  # keys of two places
    contexts, firsts, pairs, triples = np.unique(av * size + au), np.unique(av), np.unique(av * size + aw), av * size + aw
    of3, of2 = np.zeros((4, len(contexts)), np.int64), np.zeros((4, len(firsts)), np.int64)
    c3, before, starting = np.zeros(len(av), np.int64), np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    ends, hist = np.zeros(len(names), np.int64), np.zeros((2, 5), np.int64)
    asked_at = np.searchsorted(pairs, triples)
    asked_key = asked_at * size + au  # in order, as triples are
    for part in range(parts):
        v, w, u, c = unpacked(False, part)
        inner = u > 0
        hist[1] += np.bincount(np.minimum(c[inner], 5), minlength=6)[:5]
        of3 += _numbered(v[inner] * size + u[inner], c[inner], contexts)
        key = v * size + w
        # those with a word before count the words before, those at a beginning their occurrences
        s = _starts(key[inner])
        k2 = key[inner][s]
        n2 = np.diff(np.append(s, int(inner.sum())))
        for k, n, into in ((k2, n2, before), (key[~inner], c[~inner], starting)):
            hist[0] += np.bincount(np.minimum(n, 5), minlength=6)[:5]
            of2 += _numbered(k // size, n, firsts)
            ends += np.bincount(k % size, minlength=len(names))
            into += _numbered(k, n, pairs)[0]
        at = np.minimum(np.searchsorted(pairs, key), max(len(pairs) - 1, 0))
        ok = inner & (pairs[at] == key) if len(pairs) else np.zeros(len(key), bool)
        c3 += _numbered(at[ok] * size + u[ok], c[ok], asked_key)[0]
    empty = dict.fromkeys(_COLUMNS)
    signed = names.view(np.int64)
    some = np.flatnonzero(ends)
    yield 0, empty | {"w": signed[some], "c": ends[some]}
    for k in (2, 3):
        yield k, empty | {"w": np.arange(1, 5), "c": hist[k - 2, 1:]}
    if not len(av):
        return
    f, x = np.searchsorted(firsts, av), np.searchsorted(contexts, av * size + au)
    both = np.stack([before[asked_at], starting[asked_at]])
    # a pair with counts of both kinds (a text with the word of a beginning) has both
    for count, rows in ((both[0], (both[0] > 0) | (both[1] == 0)), (both[1], both[1] > 0)):
        if rows.any():
            got = {"v": signed[av], "w": signed[aw], "c": c3, "c2": count, "t2": of2[0][f], "a2": of2[1][f], "b2": of2[2][f], "m2": of2[3][f], "t3": of3[0][x], "a3": of3[1][x], "b3": of3[2][x], "m3": of3[3][x]}
            got = {k: y[rows] for k, y in got.items()}
            yield 1, got | {"u": np.ma.masked_array(signed[np.maximum(au - 1, 0)], au == 0)[rows]}


def perplexity_under(corpus: DataFrame, df: DataFrame, keys: list[str], sentences: str) -> DataFrame:
    """``keys, length, perplexity`` of each row under a model of the corpus, as ``train(corpus, sentences).perplexity(df, keys, sentences)``."""
    spark = corpus.sparkSession
    begin, end = (x % (1 << 64) for x in spark.range(1).select(F.xxhash64(F.lit(BEGIN)), F.xxhash64(F.lit(END))).first())
    size = corpus.agg(F.sum(F.aggregate(sentences, F.lit(0), lambda n, s: n + F.size(s) + 1))).first()[0]
    if not size:
        raise ValueError("no sentence to learn from")
    least = spark.sparkContext.defaultParallelism if size > _BUCKET else 1
    buckets = max(least, min(-(-size // _BUCKET), max(_BUCKETS, -(-size // (8 * _BUCKET)))))

    def counted(batches):
        import pyarrow as pa

        held: dict[int, list] = {}
        for batch in batches:
            for b, *x in zip(*[batch.column(c).to_pylist() for c in ("bucket", "asked", "size", "names", "v", "w", "u", "c")], strict=True):
                held.setdefault(b, []).append(tuple(x))
        for b in sorted(held):
            for kind, got in _bucket(held.pop(b)):
                n = len(got["w"])
                for i in range(0, n, 1 << 16):
                    cut = lambda x, i=i: pa.nulls(min(n - i, 1 << 16), pa.int64()) if x is None else pa.array(np.ma.getdata(x[i : i + (1 << 16)]), pa.int64(), mask=np.ma.getmaskarray(x[i : i + (1 << 16)]))  # noqa: E731, B023
                    columns = {c: cut(got[c]) for c in _COLUMNS}
                    yield pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(columns["w"]), kind), pa.int32()), **columns})

    packed = _pack(corpus, sentences, buckets, False, begin, end).unionByName(_pack(df, sentences, buckets, True, begin, end))
    found = staged(packed.repartitionById(buckets, F.col("bucket")).mapInArrow(counted, _FOUND), "found")
    c1 = staged(found.where("kind = 0").groupBy("w").agg(F.sum("c").alias("c")), "unigrams")
    d1 = discounts(c1)
    total, freed, words = c1.agg(F.sum("c"), F.sum(_discount(d1)), F.count(F.lit(1))).first()
    unknown = freed / total / (words + 1)
    hist: dict[int, dict[int, int]] = {2: {}, 3: {}}
    for r in found.where("kind > 1").groupBy("kind", "w").agg(F.sum("c").alias("c")).collect():
        hist[r.kind][r.w] = r.c
    d2, d3 = (_discounts(hist[k]) for k in (2, 3))

    def order(c: str, k: int, d: tuple[float, float, float]) -> tuple[Column, Column]:
        """What an order's own counts give, and the share of the order below; all of it without the context."""
        t, own = F.col(f"t{k}"), (F.col(c) - F.coalesce(_discount(d, c), F.lit(0.0)))
        free = F.col(f"a{k}") * d[0] + F.col(f"b{k}") * d[1] + F.col(f"m{k}") * d[2]
        return F.when(t > 0, own / t).otherwise(0.0), F.when(t > 0, free / t).otherwise(1.0)

    (own3, free3), (own2, free2) = order("c", 3, d3), order("c2", 2, d2)
    rest = found.where("kind = 1").select("u", "v", "w", (own3 + free3 * own2).alias("__own"), (free3 * free2).alias("__share"))
    p1 = F.coalesce((F.col("c") - _discount(d1)) / total + unknown, F.lit(unknown))
    each = rest.join(c1, "w", "left").select(F.col("u").alias("__u"), F.col("v").alias("__v"), F.col("w").alias("__w"), F.log10(F.col("__own") + F.col("__share") * p1).alias("__l"))
    each = staged(each, "each")
    for table in (found, c1):
        remove_staged(table)
    same = F.col("u").eqNullSafe(F.col("__u")) & (F.col("v") == F.col("__v")) & (F.col("w") == F.col("__w"))
    scored = _trigrams(df, keys, sentences).join(each, same).groupBy(*keys).agg(F.sum("__l").alias("log10"), F.count(F.lit(1)).alias("length"))
    return scored.select(*keys, "length", perplexity(F.col("log10"), F.col("length")).alias("perplexity"))
