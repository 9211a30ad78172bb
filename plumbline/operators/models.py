"""Scorers that need a model or a service: a protocol, a registry, and no invented scores.

An adapter loads a backend once a worker and scores batches.  Without a configured
backend a scorer raises; nothing here makes numbers up.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class BackendMissing(RuntimeError):
    """The scorer has no model or service to call."""


@dataclass(frozen=True)
class ScorerSpec:
    name: str
    kind: str  # text, instruction, image, image_text, generated_image, video, video_text
    metrics: tuple[str, ...]
    needs_backend: bool = True
    dataset_level: bool = False
    options: dict = field(default_factory=dict)


class Registry:
    """Names to entries; a name is registered once."""

    def __init__(self, what: str):
        self.what, self._entries = what, {}

    def register(self, name: str, entry):
        if name in self._entries:
            raise ValueError(f"{self.what} {name} is registered already")
        self._entries[name] = entry
        return entry

    def get(self, name: str):
        if name not in self._entries:
            raise KeyError(f"no {self.what} named {name}")
        return self._entries[name]

    def __contains__(self, name: str) -> bool:
        return name in self._entries

    def __iter__(self):
        return iter(sorted(self._entries))


SCORERS = Registry("scorer")


def _add(kind: str, names: str, metrics: tuple[str, ...] = ("Default",), **more) -> None:
    for name in names.split():
        SCORERS.register(name, ScorerSpec(name, kind, metrics, **more))


_add("text", "NgramScorer", ("NgramScore",), needs_backend=False)
_add("text", "LexicalDiversityScorer", ("LexicalDiversityMTLDScore", "LexicalDiversityHD-DScore"), needs_backend=False)
_add("text", "LangkitScorer", tuple(f"Langkit{x}Score" for x in "FleschReadingEase AutomatedReadabilityIndex AggregateReadingLevel SyllableCount LexiconCount SentenceCount CharacterCount LetterCount PolysyllableCount MonosyllableCount DifficultWords".split()), needs_backend=False)
_add("text", "PresidioScorer", ("PresidioScore",), needs_backend=False)
_add("text", "PerplexityScorer", ("PerplexityScore",))
_add("text", "FineWebEduScorer", ("FineWebEduScore",))
_add("text", "DebertaV3Scorer", ("DebertaV3Score",))
_add("text", "TextbookScorer", ("TextbookScore",))
_add("text", "QuratingScorer", tuple(f"Qurating{x}Score" for x in ("WritingStyle", "RequiredExpertise", "FactsAndTrivia", "EducationalValue")))
_add("text", "UnievalScorer", tuple(f"UniEval{x}Score" for x in ("Fluency", "Naturalness", "Understandability")))
_add("text", "PerspectiveScorer", ("PerspectiveScore",))
_add("instruction", "SuperfilteringScorer", ("SuperfilteringScore",))
_add("instruction", "DeitaQualityScorer", ("DeitaQualityScore",))
_add("instruction", "DeitaComplexityScorer", ("DeitaComplexityScore",))
_add("instruction", "InstagScorer", ("InstagScore",))
_add("instruction", "RMScorer", ("RewardModelScore",))
_add("instruction", "AlpagasusScorer", ("AlpagasusScore",))
_add("instruction", "TreeinstructScorer", ("TreeinstructScore",))
_add("text", "VendiScorer", ("N-grams_VendiScore", "BERT_VendiScore", "SimCSE_VendiScore"), needs_backend=False, dataset_level=True)
_add("text", "Task2VecScorer", ("Task2VecDiversityScore", "ConfidenceInterval"), dataset_level=True)
_add("image", "QalignScorer LiqeScorer ArniqaScorer TopiqScorer ClipiqaScorer ManiqaScorer MusiqScorer DbcnnScorer Pqa2piqScorer HyperiqaScorer NimaScorer WadiqamScorer CnniqaScorer NrqmScorer PiScorer BrisqueScorer IlniqeScorer NiqeScorer PiqeScorer")
_add("image_text", "ClipScorer LongClipScorer ClipT5Scorer FleurScorer VisualDialogScorer")
_add("generated_image", "FIDScorer", needs_backend=False, dataset_level=True)
_add("generated_image", "KIDScorer ISScorer", ("mean", "std"), needs_backend=False, dataset_level=True)
_add("video", "VideoMotionScorer VideoResolutionScorer VideoAestheticScorer FastVQAScorer FasterVQAScorer DOVERScorer")
_add("video_text", "EMScorer PACScorer", ("figr_P", "figr_R", "figr_F", "cogr", "full_P", "full_R", "full_F"))


def list_scorers(kind: str | None = None) -> list[str]:
    return [n for n in SCORERS if kind is None or SCORERS.get(n).kind == kind]


def load_backend(path: str) -> Callable:
    """A factory by dotted path, ``package.module.name``."""
    module, _, name = path.rpartition(".")
    return getattr(importlib.import_module(module), name)


def metrics_of(name: str, options: dict | None = None) -> tuple[str, ...]:
    """Output columns of a scorer; an image metric with a ``type`` carries it in its name."""
    spec = SCORERS.get(name)
    kind = (options or {}).get("type")
    if spec.kind == "image" and spec.metrics == ("Default",) and kind:
        return (f"{name.removesuffix('Scorer').lower()}{(options or {}).get('separator', '_')}{kind}",)
    return spec.metrics


def score_with(df: DataFrame, name: str, backend: Callable[[], Callable[[dict[str, list]], object]] | None, inputs: list[str], type_: str = "double", options: dict | None = None) -> DataFrame:
    """Adds a column a metric: ``backend()`` once a task, then lists of columns in, and out a list of scores,
    or a list for each metric by name.

    A row that the backend returns None for stays null, and so do all rows of a batch for
    which it returns None altogether.  Rows are never dropped.
    """
    if backend is None:
        raise BackendMissing(f"{name} needs a backend")
    metrics = metrics_of(name, options)
    types = {"double": pa.float64(), "string": pa.string(), "array<double>": pa.list_(pa.float64())}[type_]
    schema = df.drop(*metrics).select("*", *[F.lit(None).cast(type_).alias(m) for m in metrics]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = backend()
        for b in batches:
            scores = call({c: b.column(c).to_pylist() for c in inputs})
            by = scores if isinstance(scores, dict) else {metrics[0]: scores}
            new = [pa.array(by.get(m) or [None] * b.num_rows, types) for m in metrics]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *metrics])

    return df.drop(*metrics).mapInArrow(run, schema)


def length_batches(lengths: list[int], budget: int) -> list[tuple[int, int]]:
    """Runs of rows, longest first, that stay within ``budget`` tokens when padded to their longest; one row at least."""
    out, start = [], 0
    for i in range(1, len(lengths) + 1):
        if i == len(lengths) or (i + 1 - start) * max(lengths[start], 1) > budget:
            out.append((start, i))
            start = i
    return out


def score_by_length(df: DataFrame, name: str, backend, inputs: list[str], length: str, budget: int, type_: str = "double", options: dict | None = None) -> DataFrame:
    """``score_with`` in batches of similar length: rows are sorted inside partitions, longest first, and called in runs of ``budget`` padded tokens.

    A null length counts as nothing.  Scores stay with their rows.
    """
    if backend is None:
        raise BackendMissing(f"{name} needs a backend")

    def load():
        call = backend()

        def batched(columns: dict[str, list]):
            lengths = [n or 0 for n in columns[length]]
            parts = [call({c: columns[c][a:b] for c in inputs}) for a, b in length_batches(lengths, budget)]
            names = metrics_of(name, options)
            fill = lambda p, m, a, b: (p if not isinstance(p, dict) and m == names[0] else p.get(m) if isinstance(p, dict) else None) or [None] * (b - a)
            return {m: [x for p, (a, b) in zip(parts, length_batches(lengths, budget), strict=True) for x in fill(p, m, a, b)] for m in names}

        return batched

    return score_with(df.sortWithinPartitions(F.col(length).desc_nulls_last()), name, load, list(dict.fromkeys([*inputs, length])), type_, options)


def padding(df: DataFrame, length: str, order: list[str], size: int, by_length: bool) -> DataFrame:
    """Tokens, and tokens padded to the longest of their batch, of batches of ``size`` rows in an order, or by length first."""
    from plumbline.plans.indexing import with_position

    keys = [length, *order] if by_length else order
    placed = with_position(df.select(*dict.fromkeys(keys), F.col(length).alias("__l")), *keys, name="__pos")
    each = placed.groupBy(F.floor(F.col("__pos") / size).alias("batch")).agg(F.sum("__l").alias("tokens"), (F.max("__l") * F.count(F.lit(1))).alias("padded"))
    return each.agg(F.count(F.lit(1)).alias("batches"), F.sum("tokens").alias("tokens"), F.sum("padded").alias("padded"))


def output_columns(df: DataFrame, model: str, fields: list[str], info: list[str] = ("track_id", "id", "language"), prefix: str | None = None, postfix: str | None = None) -> DataFrame:
    """Fields of a batch model under ``<prefix or model>_<field>[_postfix]``, with the row's own names kept."""
    tail = f"_{postfix}" if postfix else ""
    return df.select(*[c for c in info if c in df.columns], *[F.col(f).alias(f"{prefix or model}_{f}{tail}") for f in fields])


def with_retry(call: Callable[[dict], object], attempts: int = 5, wait: Callable[[int], None] = lambda n: None, busy: type[Exception] = ConnectionError) -> Callable[[dict], object]:
    """A service call that is repeated while the service is busy; other errors pass on."""

    def run(row: dict):
        for n in range(attempts):
            try:
                return call(row)
            except busy:
                if n + 1 == attempts:
                    raise
                wait(n)
        return None

    return run
