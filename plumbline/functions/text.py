"""Column builders over texts: tokens, counts, normalisation, prompts."""

from __future__ import annotations

import string

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Everything that is no letter, digit, underscore or white space, in any script.
NOT_WORD = r"[^\p{L}\p{N}_\s]"
ASCII_PUNCTUATION = string.punctuation


def once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def words(text: Column) -> Column:
    """Pieces between white space; no empty strings."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def clean_words(text: Column) -> Column:
    """Lower-case words without punctuation of any script."""
    return words(F.regexp_replace(F.lower(text), NOT_WORD, ""))


def strip_ascii_punctuation(token: Column) -> Column:
    return F.translate(token, ASCII_PUNCTUATION, "")


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` tokens, joined by one blank."""

    def runs(t: Column) -> Column:
        starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(t, i, n), " "))

    return once(tokens, runs)


def distinct_ratio(values: Column) -> Column:
    """Distinct share of an array; 0 for an empty one."""
    return once(values, lambda v: F.coalesce(F.try_divide(F.size(F.array_distinct(v)).cast("double"), F.size(v)), F.lit(0.0)))


def ngram_repetition(text: Column, n: int = 5) -> Column:
    """Distinct n-grams over all n-grams: the higher, the less repetition."""
    return distinct_ratio(ngrams(clean_words(text), n))


def chunks(values: Column, size: int) -> Column:
    """Consecutive pieces of ``size`` elements; the last may be shorter."""

    def pieces(v: Column) -> Column:
        starts = F.when(F.size(v) > 0, F.sequence(F.lit(1), F.size(v), F.lit(size))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(v, i, size))

    return once(values, pieces)


def letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]", ""))


def characters(text: Column) -> Column:
    """Characters other than white space."""
    return F.length(F.regexp_replace(text, r"\s", ""))


def sentences(text: Column) -> Column:
    """Runs that end in one or more of ``.!?``; one at least."""
    return F.greatest(F.lit(1), F.regexp_count(text, F.lit(r"[.!?]+")))


def syllables(word: Column) -> Column:
    """Groups of vowels in a lower-case word, one at least."""
    return F.greatest(F.lit(1), F.regexp_count(word, F.lit(VOWELS)))


VOWELS = "[aeiouyáéíóúàèùâêîôûäëïöü]+"


def collapse_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n+", " ")


def truncate_bytes(text: Column, limit: int) -> Column:
    """At most ``limit`` UTF-8 bytes, never half a character.

    Drops the continuation bytes of a character that the cut leaves incomplete.
    """
    cut = F.decode(F.substring(F.encode(text, "UTF-8"), 1, limit), "ISO-8859-1")
    begun = F.length(F.regexp_replace(cut, "[\\x80-\\xBF]", ""))  # bytes that open a character
    kept = F.substring(text, F.lit(1), begun)
    whole = F.when(F.octet_length(kept) <= limit, kept).otherwise(F.substring(text, F.lit(1), begun - 1))
    return F.when(F.octet_length(text) <= limit, text).otherwise(whole)


# Punctuation of other scripts and its ASCII form.
PUNCTUATION = {
    "，": ",", "。": ".", "、": ",", "„": '"', "”": '"', "“": '"', "«": '"', "»": '"', "１": '"', "」": '"', "「": '"',
    "《": '"', "》": '"', "´": "'", "∶": ":", "：": ":", "？": "?", "！": "!", "（": "(", "）": ")", "；": ";", "–": "-",
    "—": " - ", "．": ". ", "～": "~", "’": "'", "…": "...", "━": "-", "〈": "<", "〉": ">", "【": "[", "】": "]",
    "％": "%", "►": "-",
}


def normalise_line(line: Column, *, case: bool = False, accents: bool = False, numbers: bool = True, punctuation: int = 1) -> Column:
    """Trim, optional lower case and accent removal, digits to 0, punctuation map (1) or removal (2), no control characters."""
    out = F.regexp_replace(line, r"^\s+|\s+$", "")
    if case:
        out = F.lower(out)
    if accents:
        out = F.translate(out, ACCENTED, PLAIN)
    if numbers:
        out = F.regexp_replace(out, r"\p{Nd}", "0")
    if punctuation == 1:
        single = {k: v for k, v in PUNCTUATION.items() if len(v) == 1}
        for k, v in PUNCTUATION.items():
            if len(v) > 1:
                out = F.replace(out, F.lit(k), F.lit(v))
        out = F.translate(out, "".join(single), "".join(single.values()))
    elif punctuation == 2:
        out = F.translate(out, "".join(PUNCTUATION), "")
    return F.regexp_replace(out, r"[\x00-\x1F\x7F-\x9F]", "")


def _accent_table() -> tuple[str, str]:
    """Composed letters of one base letter and marks, from the Unicode decompositions."""
    import unicodedata

    pairs = []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base != chr(code):
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accent_table()

#: Personal data by rule: kind -> pattern.
PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "ip": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "url": r"https?://[^\s]+",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "phone": r"\+?[0-9]{1,3}[ -][0-9]{3}[ -][0-9]{3,4}[ -]?[0-9]{0,4}",
    "iban": r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b",
    "card": r"\b[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}\b",
}


def personal_counts(text: Column) -> dict[str, Column]:
    return {k: F.size(F.regexp_extract_all(text, F.lit(p), F.lit(0))).cast("long") for k, p in PERSONAL.items()}


def json_list_length(text: Column) -> Column:
    """Elements of a JSON array; 0 for anything else."""
    return F.coalesce(F.json_array_length(text), F.lit(0))


def leading_number(reply: Column) -> Column:
    """First white-space-separated token of the first line as a number; null if it is none."""
    line = F.element_at(F.split(F.btrim(reply), "\n"), 1)
    return F.element_at(F.split(line, r"\s+"), 1).try_cast("double")


def whole_number(reply: Column) -> Column:
    """The reply as a whole number; 0 if it is none."""
    return F.coalesce(F.btrim(reply).try_cast("int"), F.lit(0))


def dotted(text: Column, path: str, default: float = 0.0) -> Column:
    """Number at a dotted path of a JSON object; missing, null, false, empty and zero give the default."""
    found = F.get_json_object(text, "$." + path)
    number = F.when(found == "true", 1.0).otherwise(found.try_cast("double"))
    return F.when(number.isNull() | (number == 0), F.lit(default)).otherwise(number)


def safe_get(text: Column, path: str, default: str) -> Column:
    """Value at a path of a JSON object; the default for null or missing."""
    return F.coalesce(F.get_json_object(text, "$." + path), F.lit(default))


def without_surrogates(text: Column) -> Column:
    """Escapes of lone surrogates in JSON text replaced by the replacement character."""
    return F.regexp_replace(text, r"(?i)(?<!\\)((?:\\\\)*)\\ud[89a-f][0-9a-f]{2}", "$1\ufffd")


def lenient_json(text: Column) -> Column:
    """JSON as it is; a Python literal of the same shape (single quotes, None, True) as JSON; null for neither."""

    @F.pandas_udf(StringType())
    def literal(rows: pd.Series) -> pd.Series:
        import ast
        import json

        def one(x):
            try:
                return json.dumps(ast.literal_eval(x), ensure_ascii=False)
            except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
                return None

        return rows.map(one, na_action="ignore")

    valid = F.try_parse_json(text).isNotNull()
    return F.when(valid, text).otherwise(literal(F.when(~valid, text)))


def stamp(time: Column) -> tuple[Column, Column]:
    """A time as ``YYYY-MM-DD HH:MM:SS`` and as seconds since 1970."""
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss"), F.unix_timestamp(time)


def is_object_path(path: Column) -> Column:
    return path.rlike("^s3a?://")


def object_path(path: Column, scheme: str = "s3a") -> Column:
    """The same object under the scheme that the reader at hand takes."""
    return F.regexp_replace(path, "^s3a?://", f"{scheme}://")


def bucket_and_key(path: Column) -> tuple[Column, Column]:
    """Bucket and key; both empty for other paths."""
    pattern = "^s3a?://([^/]+)(?:/(.*))?$"
    return F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)
