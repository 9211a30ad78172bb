"""Scorers by name: plans over a table that yield item scores or one score for all."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import numbers, text
from plumbline.operators import lexical, models, spectra, vectors
from plumbline.record import long_scores
from plumbline.staging import staged


@dataclass
class Scorer:
    """``keys`` are the input columns; ``options`` come from a configuration."""

    name: str
    keys: list[str]
    options: dict = field(default_factory=dict)

    def plan(self, df: DataFrame, key: str) -> DataFrame:
        """``item, scorer, metric, score`` rows, or ``scorer, metric, score`` for scorers of a whole table."""
        if self.name in NATIVE:
            prepared = PREPARED.get(self.name, lambda c: c)(F.col(self.keys[0]))
            slim = df.select(F.col(key), prepared.alias("__in"))
            metrics = {m: c for m, c in NATIVE[self.name](F.col("__in"), self.options).items() if self.kept(m)}
            scored = slim.select(key, *[c.cast("double").alias(m) for m, c in metrics.items()])
            return long_scores(scored, key, self.name, {m: m for m in metrics})
        if self.name in WHOLE:
            return WHOLE[self.name](df, self.keys[0], self.options)
        backend = self.options.get("backend")
        load = models.load_backend(backend) if isinstance(backend, str) else backend
        metrics = [m for m in models.metrics_of(self.name, self.options) if self.kept(m)]
        out = models.score_with(df.select(key, *[k for k in self.keys if k != key]), self.name, load, self.keys, options=self.options)
        scored = long_scores(out, key, self.name, {m: m for m in metrics})
        return without_default(scored) if models.metrics_of(self.name, self.options) == ("Default",) else scored

    def kept(self, metric: str) -> bool:
        """Metrics not named in ``metrics_to_keep`` stay for counts and go for diversity scores."""
        wanted = self.options.get("metrics_to_keep")
        return True if wanted is None else bool(wanted.get(metric, self.name == "LangkitScorer"))


def _ngrams(column: Column, options: dict) -> dict[str, Column]:
    return {"NgramScore": text.ngram_repetition(column, options.get("ngrams", 5))}


def _diversity(column: Column, options: dict) -> dict[str, Column]:
    return {"LexicalDiversityMTLDScore": lexical.mtld(column), "LexicalDiversityHD-DScore": lexical.hdd_of(column)}


def _counts(column: Column, options: dict) -> dict[str, Column]:
    return {numbers.metric_name("Langkit", k): c for k, c in lexical.readability(column).items()}


def _personal(column: Column, options: dict) -> dict[str, Column]:
    counts = list(text.personal_counts(column).values())
    return {"PresidioScore": sum(counts[1:], counts[0])}


def without_default(scores: DataFrame) -> DataFrame:
    """``Default`` goes where it is missing for every item and another metric is there."""
    per = scores.groupBy("scorer").agg(F.max((F.col("metric") != "Default").cast("int")).alias("__named"), F.max(((F.col("metric") == "Default") & F.col("score").isNotNull()).cast("int")).alias("__has"))
    kept = (F.col("metric") != "Default") | (F.col("__named") == 0) | (F.col("__has") == 1)
    return scores.join(F.broadcast(per), "scorer").where(kept).drop("__named", "__has")  # a row a scorer


#: What is computed of the column before the metrics.
PREPARED: dict[str, Callable[[Column], Column]] = {"LangkitScorer": lexical.text_statistics}

#: Scorers that are expressions of one column.
NATIVE: dict[str, Callable[[Column, dict], dict[str, Column]]] = {"NgramScorer": _ngrams, "LexicalDiversityScorer": _diversity, "LangkitScorer": _counts, "PresidioScorer": _personal}


def _meta(df: DataFrame, scorer: str, values: dict[str, float]) -> DataFrame:
    rows = [(scorer, m, float(v)) for m, v in values.items()]
    return df.sparkSession.createDataFrame(rows, "scorer string, metric string, score double")


#: Texts up to which the eigenvalues of all similarities are computed.
EXACT_TEXTS = 1000


def _vendi(df: DataFrame, column: str, options: dict) -> DataFrame:
    """By the column's type: n-grams of texts, or embeddings."""
    if df.schema[column].dataType.typeName() == "string":
        keyed = staged(df.select(F.monotonically_increasing_id().alias("__row"), column), "vendi")
        tokens = text.words(F.col(column))
        # exact eigenvalues of a small set; a large one takes the quadrature, with its error
        if keyed.limit(EXACT_TEXTS + 1).count() <= EXACT_TEXTS:
            return _meta(df, "VendiScorer", {"N-grams_VendiScore": round(vectors.vendi_ngrams(keyed, "__row", tokens), 2)})
        value, error = spectra.vendi_of_texts(keyed, tokens, "__row")
        return _meta(df, "VendiScorer", {"N-grams_VendiScore": round(value, 2), "N-grams_VendiScoreError": round(error, 4)})
    name = options.get("metric", "BERT_VendiScore")
    return _meta(df, "VendiScorer", {name: round(vectors.vendi(df.select(F.col(column).alias("embedding"))), 2)})


def _task2vec(df: DataFrame, column: str, options: dict) -> DataFrame:
    """Samples of rows, each embedded by the backend (texts in, one vector out), and their distances."""
    backend = options.get("backend")
    if backend is None:
        raise models.BackendMissing("Task2VecScorer needs a backend")
    load = models.load_backend(backend) if isinstance(backend, str) else backend
    key = options.get("key", column)
    drawn = vectors.draw_samples(df.select(*dict.fromkeys([key, column])), key, options.get("sample_nums", 10), options.get("sample_size", 100), options.get("seed", 0))

    def embed(t):
        import pyarrow as pa

        return pa.table({"vec_id": t.column("sample").slice(0, 1).cast(pa.int64()), "embedding": pa.array([load()(t.column(column).to_pylist())], pa.list_(pa.float64()))})

    embedded = drawn.groupBy("sample").applyInArrow(embed, "vec_id long, embedding array<double>")
    row = vectors.diversity(embedded, options.get("method", "cosine")).first()
    return _meta(df, "Task2VecScorer", row.asDict())


def _generated(measure: Callable[[DataFrame, dict], dict[str, float]], scorer: str):
    """Scorers of generated vectors against a reference set, ``options['reference']``."""

    def run(df: DataFrame, column: str, options: dict) -> DataFrame:
        renamed = df.select(F.monotonically_increasing_id().alias("vec_id"), F.col(column).alias("embedding"))
        return _meta(df, scorer, measure(renamed, options))

    return run


def _reference(options: dict) -> DataFrame:
    ref = options["reference"]
    return ref.select(F.monotonically_increasing_id().alias("vec_id"), F.col(options.get("reference_column", "embedding")).alias("embedding"))


def _kid(df: DataFrame, options: dict) -> dict[str, float]:
    row = vectors.kernel_distance_subsets(df, _reference(options), options.get("subsets", 100), options.get("subset_size", 1000), options.get("seed", 0)).first()
    return {"mean": row["mean"], "std": row["std"]}


def _is(df: DataFrame, options: dict) -> dict[str, float]:
    row = vectors.inception_splits(df.withColumnRenamed("embedding", "p"), "p", "vec_id", options.get("splits", 10)).first()
    return {"mean": row["mean"], "std": row["std"]}


#: Scorers of a whole table: a column of texts or vectors.
WHOLE = {
    "VendiScorer": _vendi,
    "Task2VecScorer": _task2vec,
    "FIDScorer": _generated(lambda df, o: {"Default": vectors.frechet(df, _reference(o))}, "FIDScorer"),
    "KIDScorer": _generated(_kid, "KIDScorer"),
    "ISScorer": _generated(_is, "ISScorer"),
}


def evaluate(df: DataFrame, key: str, scorers: list[Scorer]) -> tuple[DataFrame | None, DataFrame | None]:
    """Item scores and table scores of several scorers."""
    items, whole = None, None
    for s in scorers:
        out = s.plan(df, key)
        if "item" in out.columns:
            items = out if items is None else items.unionByName(out)
        else:
            whole = out if whole is None else whole.unionByName(out)
    return items, whole
