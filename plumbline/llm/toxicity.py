"""Operator 6: toxicity by compression distance.

The zstandard trainer learns two dictionaries: one from ordinary texts, one from toxic
texts.  Words that both classes use cost nothing to tell apart, so the toxic samples are
the stretches of toxic texts made of strings (``GRAM`` bytes) that are significantly more
frequent there, and ordinary strings that the trainer leaves between them are blanked.
Each class has a dictionary of its own: the ordinary stock, and the same stock followed
by what was learned from toxic texts.  A window of a text is compressed with either; the
difference of the lengths is the distance.  The windows give four numbers a text (largest
difference, sum, count of windows above a threshold, number of windows) and a logistic
curve, calibrated on texts that the dictionaries have not seen, turns them into a score.

Training reads about ``per_class`` toxic and twice as many ordinary labelled texts (a
bounded sample by hash of the id, a documented parameter), each whole, in one process on
the driver; scoring reads every whole text.

Edge cases: null and empty texts are one empty window and get the low score of a text
without savings; without labelled rows, or with one class only, scores are 0; null
labels are not learned; several labels of one id count as toxic if one is; repeated
rows get equal scores; a null id is not held out; other columns are not read, and
``score`` carries them along (a column named like its output is replaced).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import remainder_of_crc, slices, table

WINDOW, STRIDE, GRAM = 40, 28, 6
#: Bytes of the dictionaries.
ORDINARY_BYTES, TOXIC_BYTES = 16384, 4096
#: Bytes saved from which a window counts.
SAVED = 2
#: Predicted toxic from this score on.
THRESHOLD = 0.7
#: A toxic row weighs as much as this many ordinary ones when the curve is fitted.
TOXIC_WEIGHT = 2.0

_BETWEEN = re.compile(rb"[^a-z0-9\x80-\xff]+")


def plain(text: str | None) -> bytes:
    """Lower-case words between single blanks."""
    return b" " + b" ".join(_BETWEEN.split((text or "").lower().encode("utf-8", "replace"))) + b" "


def windows(t: bytes) -> list[bytes]:
    return [t[i : i + WINDOW] for i in range(0, max(1, len(t) - WINDOW + STRIDE), STRIDE)]


class Model:
    """Both dictionaries (``toxic`` without the common stock) and the weights of the curve."""

    def __init__(self, ordinary: bytes, toxic: bytes, weights: list[float]):
        self.ordinary, self.toxic, self.weights = ordinary, toxic, weights
        params = zstandard.ZstdCompressionParameters.from_level(3, source_size=WINDOW, dict_size=len(ordinary) + len(toxic), min_match=GRAM, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        self.tools = []
        for content in (ordinary, ordinary + toxic):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.tools.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress)

    def features(self, text: str | None) -> tuple[float, ...]:
        a, b = self.tools
        most = total = count = n = 0
        for w in windows(plain(text)):
            n += 1
            saved = len(a(w)) - len(b(w))
            if saved >= SAVED:
                total += saved
                count += 1
                most = max(most, saved)
        return 1.0, float(most), float(np.log1p(total)), float(np.log1p(count)), float(np.log1p(n))

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        z = sum(w * x for w, x in zip(self.weights, self.features(text)))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def grams(t: bytes) -> list[bytes]:
    return [t[i : i + GRAM] for i in range(len(t) - GRAM + 1)]


def marks(toxic: list[bytes], ordinary: list[bytes], *, sigmas: float = 5.0, least_ratio: float = 50.0) -> set[bytes]:
    """Strings of toxic texts that hardly occur in ordinary ones: more texts hold them than chance explains."""
    here = Counter(g for t in toxic for g in set(grams(t)))
    least = max(3, round(0.004 * len(toxic)))
    here = {g: n for g, n in here.items() if n >= least}
    there: Counter = Counter()
    for t in ordinary:
        there.update(here.keys() & set(grams(t)))
    ratio = len(toxic) / max(1, len(ordinary))
    out = set()
    for g, n in here.items():
        expected = ratio * (there[g] + 1)
        if n - expected > sigmas * (expected + 1) ** 0.5 and there[g] * ratio * least_ratio <= n:
            out.add(g)
    return out or {g for g, n in here.items() if not there[g]}  # too few texts for significance


def stretches(t: bytes, known: set[bytes]) -> list[bytes]:
    """Maximal runs of bytes that lie in a known string."""
    on = np.zeros(len(t) + 2, np.int8)
    for i, g in enumerate(grams(t)):
        if g in known:
            on[i + 1 : i + 1 + GRAM] = 1
    edges = np.flatnonzero(np.diff(on)).reshape(-1, 2)
    return [t[a:b] for a, b in edges]


def train(samples: list[bytes], size: int, **more: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, **more).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        return b"".join(samples)[-size:]


def dictionaries(pairs: list[tuple[str, int]]) -> Model:
    toxic = [plain(t) for t, y in pairs if y]
    ordinary = [plain(t) for t, y in pairs if not y]
    stock = train([o[i : i + 512] for o in ordinary for i in range(0, len(o), 512)], ORDINARY_BYTES)
    known = marks(toxic, ordinary)
    samples = [b"\x00".join(s) for s in (stretches(t, known) for t in toxic) if s]
    learned = train(samples, TOXIC_BYTES, k=16, d=GRAM)
    return Model(stock, b"\x00".join([b"", *stretches(learned, known), b""]) + b"\x00" * 8, [])


def learn(texts: list[str], labels: list[int], toxic_share: float | None = None) -> Model:
    """Dictionaries from all distinct texts; the curve from texts scored by the other half's dictionaries.

    ``toxic_share`` is the share of toxic rows among all labelled ones; the curve weighs
    the sample back to it.
    """
    pairs = sorted(set(zip(texts, labels)), key=lambda p: (zlib.crc32(p[0].encode("utf-8", "replace")), p))
    if min(Counter(y for _, y in pairs).values(), default=0) < 2 or len({y for _, y in pairs}) < 2:
        return Model(b" " * 8, b" " * 8, [])
    one = [p for y in (0, 1) for p in [q for q in pairs if q[1] == y][::2]]
    two = [p for y in (0, 1) for p in [q for q in pairs if q[1] == y][1::2]]
    rows = [(m.features(t), y) for m, part in ((dictionaries(one), two), (dictionaries(two), one)) for t, y in part]
    x, y = np.array([f for f, _ in rows]), np.array([float(v) for _, v in rows])
    share = y.mean() if toxic_share is None else toxic_share
    weight = np.where(y == 1, TOXIC_WEIGHT * share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    whole = dictionaries(pairs)
    return Model(whole.ordinary, whole.toxic, [float(v) for v in w])


def training_rows(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, per_class: int) -> tuple[list[str], list[int], float | None]:
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y")).where("doc_id is not null and y is not null").where(remainder_of_crc("doc_id") != 1).groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a class
    grain = 1 << 20
    share = F.lit(0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, F.lit(min(grain, -(-per_class * (1 if y > 0 else 2) * grain // n)))).otherwise(share)
    some = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < share)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    ids = [r["doc_id"] for r in some.select("doc_id").collect()]  # about per_class a class
    wanted = docs.sparkSession.createDataFrame([(i,) for i in ids], "doc_id long") if ids else some.select("doc_id")
    rows = texts.join(F.broadcast(wanted), "doc_id", "left_semi").join(some, "doc_id").collect() if ids else []
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    toxic = sum(n for y, n in sizes.items() if y > 0)
    return [r["text"] for r in rows], [int(r["y"] > 0) for r in rows], toxic / sum(sizes.values()) if sizes else None


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 1000) -> Model:
    return learn(*training_rows(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, per_class=per_class))


def score(docs: DataFrame, model: Model, *, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score of each text; all other columns are carried along."""
    docs = docs.drop(out)
    shipped = docs.sparkSession.sparkContext.broadcast((model.ordinary, model.toxic, model.weights))
    schema = docs.select("*", F.lit(0.0).alias(out)).schema
    at = docs.columns.index(text_col)

    def run(batches):
        m = Model(*shipped.value)
        for batch in batches:
            for part in slices(batch, text_col):
                scores = [m.score(t.as_py()) for t in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, out])

    return docs.mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", F.coalesce(remainder_of_crc("doc_id") == 1, F.lit(False)).alias("held_out"), "text")
    return score(rows, model).select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
