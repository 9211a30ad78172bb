"""Operator 3: language identification with string kernels.

The kernel of two texts counts the character n-grams (n = 1, 2, 3; blended spectrum)
present in both, over the geometric mean of how many each has.  Presence is a bit per
n-gram class (letters lower-cased, everything else one blank; classes by hash).
Nystrom landmarks turn the kernel into features; kernel ridge regression learns one
column a language against the rest.  As the kernel is linear in presence bits, the
landmark matrix and the weights are multiplied once, and a batch is scored by one
matrix product of its presence matrix.

Training reads at most ``per_language`` labelled texts of each language (a bounded
sample by hash of the id, a documented parameter); scoring reads every whole text.

Letters are those of any script and plane; marks, digits and symbols are none.

Edge cases: null, empty or letterless text gives ``und`` with score 0; null languages
are not learned; a single learned language is always predicted; without labelled rows
all predictions are ``und``; repeated rows get equal predictions; a null id is not held
out; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import mix, remainder_of_crc, slices, table

BITS = 13
CLASSES = 1 << BITS
#: Prediction of texts without letters.
UNDETERMINED = "und"

_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def presence(texts: list[str | None]) -> np.ndarray:
    """One row a text, one column an n-gram class; rows of letterless texts are zero."""
    out = np.zeros((len(texts), CLASSES), np.uint8)
    joined = " ".join("" if t is None else t.lower() for t in texts) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = [len(t.lower()) + 1 if t is not None else 1 for t in texts]
    row = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    letters = _letter[codes]
    codes = np.where(letters, codes, 32).astype(np.uint64)
    lettered = np.zeros(len(texts), bool)
    lettered[row[letters]] = True
    flat, base = out.reshape(-1), row << BITS
    key = codes
    for n in (1, 2, 3):
        if n > 1:
            key = key[:-1] * np.uint64(0x110000) + codes[n - 1 :] if len(key) > 1 else key[:0]
        if not len(key):
            break
        bucket = ((key + np.uint64(n << 61)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)
        same = row[: len(key)] == row[n - 1 :]
        flat[(base[: len(key)] + bucket)[same]] = 1
    out[~lettered] = 0
    return out


class Model:
    """Languages and the folded weights: presence bits -> one score a language."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray):
        self.languages, self.weights, self.bias = languages, weights, bias

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        bits = presence(texts)
        size = bits.sum(1, dtype=np.int64)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        margin = (bits.astype(np.float32) @ self.weights) / np.sqrt(np.maximum(size, 1))[:, None] + self.bias
        shown = np.exp(4.0 * (margin - margin.max(1, keepdims=True)))
        score = shown.max(1) / shown.sum(1)
        best = margin.argmax(1)
        none = size == 0
        return [UNDETERMINED if e else self.languages[b] for b, e in zip(best, none)], np.where(none, 0.0, np.clip(score, 0, 1)).astype(np.float64)


def learn(bits: np.ndarray, labels: list[str], *, landmarks: int = 256, ridge: float = 1e-3) -> Model:
    """Nystrom features of the training rows, then one-versus-rest ridge regression."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((CLASSES, 0), np.float32), np.zeros(0))
    of = np.array([languages.index(x) for x in labels])
    per = max(1, landmarks // len(languages))
    marks = np.concatenate([np.flatnonzero(of == c)[:per] for c in range(len(languages))])
    norm = np.sqrt(np.maximum(bits.sum(1, dtype=np.int64), 1)).astype(np.float32)
    z = bits[marks].astype(np.float32) / norm[marks][:, None]
    k_zz = (z @ z.T).astype(np.float64)
    values, vectors = np.linalg.eigh(k_zz)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    k_xz = np.concatenate([(bits[i : i + 512].astype(np.float32) / norm[i : i + 512, None]) @ z.T for i in range(0, len(bits), 512)]).astype(np.float64)
    phi = np.concatenate([k_xz @ root, np.ones((len(bits), 1))], 1)
    target = np.where(of[:, None] == np.arange(len(languages)), 1.0, -1.0)
    weight = 1.0 / np.bincount(of, minlength=len(languages))[of] * len(of) / len(languages)
    gram = (phi * weight[:, None]).T @ phi + ridge * len(bits) * np.eye(phi.shape[1])
    w = np.linalg.solve(gram, (phi * weight[:, None]).T @ target)
    return Model(languages, (z.T.astype(np.float64) @ (root @ w[:-1])).astype(np.float32), w[-1])


def training_rows(docs: DataFrame, *, id_col: str, text_col: str, label_col: str, per_language: int) -> tuple[np.ndarray, list[str]]:
    """Presence rows of a bounded sample by hash of the id, spread over all rows of a language."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(label_col).alias("label"))
    base = base.where("label is not null and text is not null").where(remainder_of_crc("doc_id") != 1)
    sizes = {r["label"]: r["n"] for r in base.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language
    grain = 1 << 20
    share = F.lit(0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, F.lit(min(grain, -(-per_language * grain // n)))).otherwise(share)
    some = base.where(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < share).select("doc_id", "text", "label")

    def bitmaps(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 20, 512):
                bits = np.packbits(presence(part.column("text").to_pylist()), axis=1)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array([r.tobytes() for r in bits], pa.binary())], names=["doc_id", "label", "bits"])

    rows = some.mapInArrow(bitmaps, "doc_id long, label string, bits binary").collect()
    rows.sort(key=lambda r: (mix(np.array([r["doc_id"]], np.int64).view(np.uint64), 7)[0], r["doc_id"], r["label"], bytes(r["bits"])))
    taken: dict[str, int] = {}
    kept = []
    for r in rows:
        if taken.get(r["label"], 0) < per_language and any(r["bits"]):
            taken[r["label"]] = taken.get(r["label"], 0) + 1
            kept.append(r)
    bits = np.array([np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8)) for r in kept], np.uint8).reshape(-1, CLASSES)
    return bits, [r["label"] for r in kept]


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = 800, landmarks: int = 256) -> Model:
    return learn(*training_rows(docs, id_col=id_col, text_col=text_col, label_col=label_col, per_language=per_language), landmarks=landmarks)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, from its text alone."""
    shipped = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.bias))

    def score(batches):
        m = Model(*shipped.value)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20, 512):
                names, scores = m(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(remainder_of_crc(id_col) == 1, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))
