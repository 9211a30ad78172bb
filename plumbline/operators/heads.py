"""Deterministic steps around model scorers: prompts before, arithmetic after."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions import numbers, text, vector


def template(pattern: str, **fields: Column) -> Column:
    """``{name}`` in the pattern replaced by columns; null counts as empty."""
    out = F.lit(pattern)
    for name, col in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(col, F.lit("")))
    return out


def expected_rating(logits: Column, low: int = 1) -> Column:
    """Expectation of ratings ``low, low + 1, ...`` under the softmax of their logits."""
    p = vector.softmax(logits)
    return vector.total(F.transform(p, lambda x, i: x * (i + low)))


def rated_when_given(logits: Column, *inputs: Column, low: int = 1) -> Column:
    """``expected_rating``, missing where any input is null or empty."""
    there = F.lit(True)
    for c in inputs:
        there &= F.coalesce(F.length(c), F.lit(0)) > 0
    return F.when(there, expected_rating(logits, low))


def service_request(text: Column, language: Column, languages: list[str], limit: int = 20480) -> Column:
    """What a scoring service is asked about a text: at most ``limit`` bytes of it; nothing for blank texts and languages that it lacks."""
    from plumbline.functions.text import truncate_bytes

    wanted = text.rlike(r"[^\x20\x09-\x0D]") & language.isin(*languages)
    return F.when(F.coalesce(wanted, F.lit(False)), truncate_bytes(text, limit))


def textbook(probabilities: Column, low: float = 0.0, mid: float = 1.0, high: float = 2.0) -> Column:
    """Score of class probabilities in the order low, mid, high."""
    return vector.dot(probabilities, F.array(F.lit(low), F.lit(mid), F.lit(high)))


def following_difficulty(conditional: Column, alone: Column, output: Column) -> Column:
    """Perplexity given the instruction over perplexity alone; null without output or number, 0 over 0."""
    ratio = F.when(alone == 0, 0.0).otherwise(F.try_divide(conditional, alone))
    return F.when(F.coalesce(F.length(output), F.lit(0)) == 0, F.lit(None)).when(F.isnan(ratio), F.lit(None)).otherwise(ratio).cast("double")


def perplexity(log10_sum: Column, length: Column) -> Column:
    return F.round(F.pow(F.lit(10.0), -log10_sum / length), 1)


def two_class(logits: Column, index: int, how: str = "softmax", low: float | None = None, high: float | None = None) -> Column:
    """One class by softmax, sigmoid or raw logit, clipped if asked, rounded to 6 places."""
    x = F.element_at(vector.softmax(logits) if how == "softmax" else logits, index + 1)
    if how == "sigmoid":
        x = vector.sigmoid(x)
    return F.round(numbers.clip(x, low, high) if low is not None else x, 6)


def clip_truncate(tokens: Column, head: int, tail: int) -> Column:
    """First ``head`` and last ``tail`` tokens of longer arrays."""
    cut = F.concat(F.slice(tokens, 1, head), F.slice(tokens, F.greatest(F.size(tokens) - tail + 1, F.lit(1)), tail)) if tail else F.slice(tokens, 1, head)
    return F.when(F.size(tokens) > head + tail, cut).otherwise(tokens)


def digit_rating(first: Column, second: Column) -> Column:
    """Ratings from digit probabilities: tenths from ``first``, hundredths from ``second`` (null: one decimal)."""
    hundredths = F.coalesce(vector.total(F.transform(second, lambda p, d: p * d * 0.01)), F.lit(0.0))
    return vector.total(F.transform(first, lambda p, d: p * d * 0.1)) + hundredths


def rated(stated: Column, first: Column, second: Column) -> Column:
    """Smoothed rating of a stated number: 0 outside 0 to 1, -1 where there is none, and for 1.0 from the chances of 0 and 1."""
    one = 0.9 * F.get(first, 0) + F.get(first, 1)
    return F.when(stated.isNull(), -1.0).when((stated < 0) | (stated > 1), 0.0).when(stated == 1, one).otherwise(digit_rating(first, second))


def answer_likelihood(losses: Column) -> Column:
    """exp of the mean loss, negated: the chance of an answer by the cross entropy of its tokens."""
    return F.exp(-vector.mean(losses))


def dialog_score(failed: Column, correct_log_prob: Column, has_incorrect: Column) -> Column:
    """Log chance of the word for yes; -1000 if only the word for no was found, -1 for neither, -2 after an error."""
    return F.when(failed, -2.0).when(correct_log_prob.isNotNull(), correct_log_prob).when(has_incorrect, -1000.0).otherwise(-1.0)


def clip_score(a: Column, b: Column) -> Column:
    """Cosine of two feature vectors, times 100."""
    return vector.cosine(a, b) * 100


# Mean and deviation of the raw scores of each video model.
VIDEO_SCALES = {
    "FasterVQA": (0.14759505, 0.03613452),
    "FasterVQA-MS": (0.15218826, 0.03230298),
    "FasterVQA-MT": (0.14699507, 0.036453716),
    "FAST-VQA": (-0.110198185, 0.04178565),
    "FAST-VQA-M": (0.023889644, 0.030781006),
}


def video_quality(raw: Column, model: str = "FasterVQA") -> Column:
    """A raw score of a video model on its own scale, through the sigmoid."""
    mean, deviation = VIDEO_SCALES[model]
    return vector.sigmoid((raw - mean) / deviation)


def reduced(frame_scores: Column, how: str = "avg", scale: float = 1.0) -> Column:
    """Mean, largest or (any other name) least score of a video's frames; 0 without frames."""
    value = {"avg": vector.mean(frame_scores), "max": F.array_max(frame_scores)}.get(how, F.array_min(frame_scores))
    return F.when(F.size(frame_scores) > 0, value / scale).otherwise(0.0)


def padded(tokens: Column, length: int, fill: int = 0) -> tuple[Column, Column]:
    """Token ids padded on the right to a length, and the mask of the real ones."""
    missing = F.greatest(F.lit(length) - F.size(tokens), F.lit(0))
    return F.concat(tokens, F.array_repeat(F.lit(fill), missing)), F.concat(F.array_repeat(F.lit(1), F.size(tokens)), F.array_repeat(F.lit(0), missing))


def judge_number(reply: Column) -> Column:
    return text.leading_number(reply)


def frame_indices(total: Column, clips: int, length: int, interval: int, start: int = 0) -> Column:
    """Even sampling: clips start in the middle of equal steps, all at 0 in videos shorter than a clip; frames wrap round."""
    span = length * interval
    step = (total - span + 1) / F.lit(float(clips))
    at = lambda c: F.when(total > span - 1, F.floor(c * step + step / 2)).otherwise(0)
    starts = F.transform(F.sequence(F.lit(0), F.lit(clips - 1)), at)
    return F.flatten(F.transform(starts, lambda s: F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: (F.pmod(s + i * interval, total) + start).cast("int"))))


def fragment_frames(total: Column, parts: int, length: int, interval: int = 1, fractions: Column | None = None) -> Column:
    """Runs of ``length`` frames, one in each of ``parts`` equal parts, shifted by a fraction (0 to 1, an array) of the room there is."""
    part = F.floor(total / parts).cast("int")
    room = F.greatest(part - length * interval, F.lit(0))

    def run(k: Column) -> Column:
        shift = F.lit(0) if fractions is None else F.floor(F.get(fractions, k) * room).cast("int")
        return F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.pmod(part * k + shift + i * interval, total).cast("int"))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), run))


def fragment_grid(height: Column, width: Column, rows: int, columns: int, size: int, fractions: Column | None = None) -> Column:
    """Top left corners of a grid of patches, row by row, each shifted by a fraction of its cell's room, inside the picture."""

    def corner(length: Column, n: int, k: Column, place: Column) -> Column:
        cell = F.floor(length / n)
        shift = F.lit(0) if fractions is None else F.floor(F.get(fractions, place) * F.greatest(cell - size, F.lit(0)))
        return (F.least(cell * k, length - size) + shift).cast("int")

    cells = F.sequence(F.lit(0), F.lit(rows * columns - 1))
    return F.transform(cells, lambda c: F.struct(corner(height, rows, F.floor(c / columns), c).alias("top"), corner(width, columns, c % columns, c).alias("left")))


def extraction_seconds(duration: Column, frames: Column, wanted: int) -> Column:
    """Times of ``wanted`` frames: the middle for one, otherwise both ends and even steps; no more than there are."""
    n = F.least(F.lit(wanted), frames)
    even = F.transform(F.sequence(F.lit(0), n - 1), lambda i: i * duration / (n - 1))
    return F.when(n == 1, F.array(duration / 2)).when(n > 1, even).otherwise(F.array().cast("array<double>"))


def motion_step(fps: Column, frames: Column, sampling_fps: float) -> Column:
    """Frames between two that are compared: at least one, and never past the last."""
    return F.greatest(F.least(F.bround(fps / F.least(F.lit(sampling_fps), fps)).cast("int"), frames - 1), F.lit(1))


def document_content(items: Column) -> Column:
    """Parts that are neither dropped nor rules, ``md`` before ``text``, with blank lines between; empty parts are left out."""
    kept = F.filter(items, lambda x: (F.coalesce(x["type"], F.lit("")) != "hr") & (F.size(F.coalesce(x["drop_it_list"], F.array().cast("array<string>"))) == 0))
    return F.array_join(F.filter(F.transform(kept, lambda x: F.coalesce(x["md"], x["text"], F.lit(""))), lambda t: t != ""), "\n\n")


def content_or_fallback(items: Column, *fields: Column) -> Column:
    """Content of the parts; without parts the first field that is not empty (content, text, string)."""
    other = F.coalesce(*[F.when(F.length(f) > 0, f) for f in fields], F.lit(""))
    return F.when(F.coalesce(F.size(items), F.lit(0)) > 0, document_content(items)).otherwise(other)


def truncated_content(content: Column, head: int, tail: int) -> Column:
    """First ``head`` and last ``tail`` characters of longer texts."""
    cut = F.concat(F.substring(content, 1, head), F.right(content, F.lit(tail)) if tail else F.lit(""))
    return F.when(F.length(content) <= head + tail, content).otherwise(cut)


def content_tokens(content: Column, lower: bool = False, n: int = 1) -> Column:
    """White-space tokens of a content, in lower case if asked, as n-grams for n above 1."""
    tokens = text.words(F.lower(content) if lower else content)
    return text.ngrams(tokens, n) if n > 1 else tokens
