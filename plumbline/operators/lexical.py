"""Lexical diversity: MTLD by an ordered fold, HD-D by counts of a text's words; readability from one pass over the tokens."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from plumbline.functions import text as t
from plumbline.functions.text import once, strip_ascii_punctuation, words


def _lexical_tokens(text: Column) -> Column:
    """White-space words without ASCII punctuation, in lower case; a word of marks alone counts as the empty word."""
    return F.transform(words(text), lambda w: F.lower(strip_ascii_punctuation(w)))


def _factors(tokens: list[str], threshold: float) -> float:
    """Words over the number of stretches whose type-token ratio falls to the threshold, the last one in part."""
    types: set[str] = set()
    n = full = 0
    for token in tokens:
        n += 1
        types.add(token)
        if len(types) / n <= threshold:
            full, n = full + 1, 0
            types.clear()
    count = full + (1.0 - (len(types) / n if n else 1.0)) / (1.0 - threshold)
    return len(tokens) / count if count else -1.0


@F.pandas_udf(DoubleType())
def _both_ways(tokens: pd.Series) -> pd.Series:
    def one(w):
        return None if w is None else (_factors(w, 0.72) + _factors(w[::-1], 0.72)) / 2

    return pd.Series([one(w) for w in tokens], dtype="float64").replace(np.nan, None)


def mtld(text: Column, more_than: int = 50) -> Column:
    """Mean of the forward and the backward pass; null for ``more_than`` words or fewer.

    Tokens are built by column functions.  The fold restarts at a threshold, so each step
    needs the one before; as an array fold it took some ten times as long as in a batch
    of token lists.
    """
    tokens = _lexical_tokens(F.col(text) if isinstance(text, str) else text)
    return _both_ways(once(tokens, lambda w: F.when(F.size(w) > more_than, w)))


def _drawn(counts: np.ndarray, n: int, draws: int) -> float:
    """Sum over types, by their numbers of words, of the chance to be among ``draws`` of ``n`` words."""
    sizes, times = np.unique(counts, return_counts=True)
    j = np.arange(draws)
    missed = (np.maximum(0.0, n - sizes[:, None] - j) / (n - j)).prod(1)
    return float(((1 - missed) / draws * times).sum())


def hdd_of(text: Column, draws: int = 42) -> Column:
    """HD-D of a column: mean over word types of the chance to be drawn among ``draws`` words; null outside 51 to 999 words.

    Words are cut and folded by column functions and counted in batches, a text at a time, so
    that no row a word is made.  Marks go after white space is one blank each, as a word of marks alone counts.
    """

    @F.pandas_udf(DoubleType())
    def score(lines: pd.Series) -> pd.Series:
        def one(line):
            n = 0 if not line else line.count(" ") + 1
            return _drawn(np.array(list(Counter(line.split(" ")).values())), n, draws) if 50 < n < 1000 else None

        return pd.Series([one(line) for line in lines], dtype="float64").replace(np.nan, None)

    blanks = F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\s+", " ")
    return score(F.lower(strip_ascii_punctuation(blanks)))


def hdd(df: DataFrame, key: str = "doc_id", text: str = "text", draws: int = 42) -> DataFrame:
    """``key`` and ``hdd_of`` of every row."""
    return df.select(key, hdd_of(F.col(text), draws).alias("hdd"))


def text_statistics(text: Column) -> Column:
    """All counts of a text as one struct: the words are cut, and the syllables counted, once."""

    def counts(w: Column) -> Column:
        return once(F.transform(w, t.syllables), lambda s: F.struct(
            t.characters(text).cast("long").alias("character_count"),
            t.letters(text).cast("long").alias("letter_count"),
            F.size(w).cast("long").alias("lexicon_count"),
            t.sentences(text).cast("long").alias("sentence_count"),
            F.aggregate(s, F.lit(0), lambda a, x: a + x).cast("long").alias("syllable_count"),
            F.size(F.filter(s, lambda x: x >= 3)).cast("long").alias("polysyllable_count"),
            F.size(F.filter(s, lambda x: x == 1)).cast("long").alias("monosyllable_count"),
            F.size(F.array_distinct(F.filter(w, lambda x, i: F.get(s, i) >= 3))).cast("long").alias("difficult_words"),
        ))

    return once(t.clean_words(text), counts)


COUNTS = ("character_count", "letter_count", "lexicon_count", "sentence_count", "syllable_count", "polysyllable_count", "monosyllable_count", "difficult_words")


def readability(stats: Column) -> dict[str, Column]:
    """Counts, and the readability formulas over them, from ``text_statistics``."""
    n = {k: stats[k].cast("double") for k in COUNTS}
    w, s = n["lexicon_count"], n["sentence_count"]
    per = F.try_divide
    ease = 206.835 - 1.015 * per(w, s) - 84.6 * per(n["syllable_count"], w)
    ari = 4.71 * per(n["character_count"], w) + 0.5 * per(w, s) - 21.43
    grades = [
        0.39 * per(w, s) + 11.8 * per(n["syllable_count"], w) - 15.59,
        1.043 * F.sqrt(30 * per(n["polysyllable_count"], s)) + 3.1291,
        5.88 * per(n["letter_count"], w) - 29.6 * per(s, w) - 15.8,
        ari,
        0.4 * (per(w, s) + 100 * per(n["polysyllable_count"], w)),
    ]
    return {**{k: stats[k] for k in COUNTS}, "flesch_reading_ease": ease, "automated_readability_index": ari, "aggregate_reading_level": _consensus(grades)}


def _consensus(grades: list[Column]) -> Column:
    """The grade that most formulas round down or up to; the lowest of equally frequent ones; null without words."""
    both = F.array(*[f(g).cast("long") for g in grades for f in (F.floor, F.ceil)])

    def mode(all_: Column) -> Column:
        ranked = F.array_sort(F.transform(F.array_distinct(all_), lambda x: F.struct((-F.size(F.filter(all_, lambda y: y == x))).alias("n"), x.alias("x"))))
        return F.get(ranked, 0)["x"].cast("double")

    known = grades[0].isNotNull()
    return F.when(known, once(both, mode))
