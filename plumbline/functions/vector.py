"""Column builders over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import once


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2(a: Column, b: Column) -> Column:
    """Distance by the expansion of the square, cut at zero."""
    return F.sqrt(F.greatest(F.lit(0.0), dot(a, a) - 2 * dot(a, b) + dot(b, b)))


def normalise(a: Column) -> Column:
    return once(norm(a), lambda n: F.transform(a, lambda x: F.try_divide(x.cast("double"), n)))


def softmax(v: Column) -> Column:
    def shares(e: Column) -> Column:
        return once(total(e), lambda t: F.transform(e, lambda x: x / t))

    return once(v, lambda u: once(F.array_max(u), lambda top: once(F.transform(u, lambda x: F.exp(x - top)), shares)))


def expectation(probabilities: Column, values: Column) -> Column:
    return dot(probabilities, values)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def argmax_label(probabilities: Column, labels: Column) -> Column:
    return F.element_at(labels, F.array_position(probabilities, F.array_max(probabilities)).cast("int"))


def scaled(a: Column, b: Column) -> tuple[Column, Column]:
    """Each of two positive vectors over their sum."""
    one = F.zip_with(a, b, lambda x, y: x / (x + y + 1e-8))
    two = F.zip_with(a, b, lambda x, y: y / (x + y + 1e-8))
    return one, two


def kl(a: Column, b: Column, symmetric: bool = True) -> Column:
    """Divergence of diagonal normal distributions with these variances; the larger direction by dimension."""
    def one(x, y):
        return 0.5 * (x / y - 1 + F.ln(y) - F.ln(x))

    return total(F.zip_with(a, b, lambda x, y: F.greatest(one(x, y), one(y, x)) if symmetric else one(x, y)))


def jsd(a: Column, b: Column) -> Column:
    def one(x, m):
        return 0.5 * (x / m - 1 + F.ln(m) - F.ln(x))

    return total(F.zip_with(a, b, lambda x, y: 0.5 * (one(x, 0.5 * (x + y)) + one(y, 0.5 * (x + y))))) / F.size(a)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - cosine(a, b)


def mean(v: Column) -> Column:
    return total(v) / F.size(v)


def correlation_distance(a: Column, b: Column) -> Column:
    def centred(u: Column) -> Column:
        return once(mean(u), lambda m: F.transform(u, lambda x: x - m))

    return once(centred(a), lambda x: once(centred(b), lambda y: cosine_distance(x, y)))


def entropy_distance(a: Column, b: Column) -> Column:
    """ln 2 less the mean binary entropy of the first vector's share."""
    share = scaled(a, b)[0]
    bits = F.transform(share, lambda p: -F.when(p > 0, p * F.ln(p)).otherwise(0.0) - F.when(p < 1, (1 - p) * F.ln(1 - p)).otherwise(0.0))
    return F.ln(F.lit(2.0)) - mean(bits)


#: Distances by name over two positive vectors.
DISTANCES = {
    "kl": kl,
    "asymmetric_kl": lambda a, b: kl(a, b, symmetric=False),
    "jsd": jsd,
    "cosine": lambda a, b: cosine_distance(*scaled(a, b)),
    "normalized_cosine": cosine_distance,
    "correlation": correlation_distance,
    "entropy": entropy_distance,
}
