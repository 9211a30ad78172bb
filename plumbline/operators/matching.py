"""Token matching scores, document frequencies, ranks and rescaling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import vector as v
from plumbline.plans.indexing import AT, PART, dealt_by_ranges, with_position, with_running
from plumbline.staging import staged


def _matches(weighted: tuple[bool, bool]):
    """Batches ``k, a, b, wa, wb`` of two lists of vectors and their weights: ``k, precision, recall``."""
    import pyarrow as pa

    def vectors(column):
        """Each list as a matrix; a null vector is one of missing numbers."""
        inner = column.flatten()
        sizes = inner.value_lengths().fill_null(0).to_numpy()
        flat = inner.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends, n = np.cumsum(sizes), column.value_lengths().fill_null(0).to_numpy()
        for last, k in zip(np.cumsum(n), n):
            of = sizes[last - k : last]
            if not k or not of.any():
                yield np.full((k, 0), np.nan)
                continue
            out = np.full((k, of.max()), np.nan)
            begin = ends[last - k] - sizes[last - k]
            out[of > 0] = flat[begin : ends[last - 1]].reshape(-1, of.max())
            yield out

    def weights(column):
        flat, n = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), column.value_lengths().fill_null(0).to_numpy()
        return (flat[last - k : last] for last, k in zip(np.cumsum(n), n))

    def average(values, w, use):
        total = w.sum() if use else len(values)
        return (values @ w if use else values.sum()) / total if len(values) and total != 0 else np.nan

    def work(batches):
        for batch in batches:
            found = np.full((batch.num_rows, 2), np.nan)
            for i, (x, y, wx, wy) in enumerate(zip(vectors(batch.column(1)), vectors(batch.column(2)), weights(batch.column(3)), weights(batch.column(4)), strict=True)):
                if len(x) and len(y) and x.shape[1] == y.shape[1] > 0:
                    v = x @ y.T
                    found[i] = average(np.fmax.reduce(v, 1), wx, weighted[0]), average(np.fmax.reduce(v, 0), wy, weighted[1])
            p, r = (pa.array(c, mask=np.isnan(c)) for c in found.T)
            yield pa.RecordBatch.from_arrays([batch.column(0), p, r], names=["k", "precision", "recall"])

    return work


def greedy_match(pairs: DataFrame, key: str, hyp: str = "hyp", ref: str = "ref", hyp_weight: str | None = None, ref_weight: str | None = None) -> DataFrame:
    """Precision, recall and F of two arrays of unit vectors, each token with its best partner.

    Weights (document frequencies turned round) default to even ones, which makes both plain means.  The products
    of a pair are one product of matrices in a batch.  Null vectors are no partners; a side without any has no score.
    """
    given = [F.col(c).cast("array<array<double>>") for c in (hyp, ref)] + [F.col(c).cast("array<double>") if c else F.array().cast("array<double>") for c in (hyp_weight, ref_weight)]
    rows = pairs.select(F.col(key).alias("k"), *[c.alias(n) for c, n in zip(given, ("a", "b", "wa", "wb"), strict=True)])
    schema = rows.select("k", F.lit(0.0).alias("precision"), F.lit(0.0).alias("recall")).schema
    for f in schema.fields:
        f.nullable = True
    scored = rows.mapInArrow(_matches((hyp_weight is not None, ref_weight is not None)), schema)
    return scored.select(F.col("k").alias(key), "precision", "recall", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f"))


def full_match(fine: DataFrame, coarse: Column) -> DataFrame:
    """Fine scores, the cosine of the whole vectors (``cogr``), and the mean of both for P, R and F."""
    named = fine.withColumn("cogr", coarse)
    return named.select("*", *[((F.col(c) + F.col("cogr")) / 2).alias(f"full_{c}") for c in ("precision", "recall", "f")])


def combined(against_references: DataFrame, against_video: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """Scores against the references, against the video, and their mean."""
    a = against_references.select(key, *[F.col(m).alias(f"{m}_refs") for m in metrics])
    b = against_video.select(key, *[F.col(m).alias(f"{m}_video") for m in metrics])
    return a.join(b, key).select("*", *[((F.col(f"{m}_refs") + F.col(f"{m}_video")) / 2).alias(f"{m}_both") for m in metrics])


def expand_references(df: DataFrame, key: str, candidate: str, references: str) -> DataFrame:
    """A row for each reference of a candidate, with its number; candidates without any stay, with nulls."""
    return df.select(key, candidate, F.posexplode_outer(references).alias("reference_number", "reference"))


def best_reference(scores: DataFrame, key: str, score: str) -> DataFrame:
    """A candidate with several references keeps the largest score."""
    return scores.groupBy(key).agg(F.max(score).alias(score))


def inverse_frequencies(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """ln((N + 1) / (df + 1)) of every token; ``unseen_frequency`` is that of all others."""
    seen = df.select(key, F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return seen.crossJoin(F.broadcast(total)).select("token", "df", F.ln((F.col("n") + 1) / (F.col("df") + 1)).alias("idf"), F.ln(F.col("n") + 1.0).alias("unseen_idf"))


def token_features(df: DataFrame, keys: list[str], tokens: str, features: DataFrame, missing: dict[str, Column] | None = None) -> DataFrame:
    """Adds, for each column of ``features`` but ``token``, an array with its value for every token, in order.

    Features are joined to the distinct tokens of a row, so a row meets each of its words once.  ``missing`` says
    what tokens without a row in ``features`` have; null otherwise.  ``keys`` name a row.
    """
    names = [c for c in features.columns if c != "token"]
    found = df.select(*keys, F.explode(F.array_distinct(tokens)).alias("token")).join(features, "token", "left")
    entry = F.struct(*[F.coalesce(F.col(c), missing[c]).alias(c) if missing and c in missing else F.col(c) for c in names])
    known = found.groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("token", entry.alias("f")))).alias("__f"))  # the words of one text
    left, right = df.alias("l"), known.alias("r")
    same = F.lit(True)
    for k in keys:
        same &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    rows = left.join(right, same, "left").select("l.*", "r.__f")
    return rows.select(*df.columns, *[_feature(tokens, n) for n in names])


def _feature(tokens: str, name: str) -> Column:
    return F.transform(tokens, lambda t: F.col("__f")[t][name]).alias(f"{tokens}_{name}")


def weighted_tokens(df: DataFrame, keys: list[str], tokens: list[str], vectors: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Adds the vector (``<tokens>_vec``) and the inverse frequency (``<tokens>_idf``) of every token of the arrays named.

    ``vectors(token, vec)`` are unit vectors; ``frequencies`` is what ``inverse_frequencies`` returns, and tokens that the
    corpus lacks take its weight for unseen ones.
    """
    frequencies = staged(frequencies, "frequencies")
    seen = frequencies.agg(F.first("unseen_idf").alias("unseen")).first()["unseen"]
    features = vectors.join(frequencies.select("token", "idf"), "token", "full")
    for side in tokens:
        df = token_features(df, keys, side, features, {"idf": F.lit(seen)})
    return df


def weighted_scores(pairs: DataFrame, keys: list[str], candidate: str, reference: str, vectors: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Precision, recall and F of token arrays, each token weighted by its inverse frequency in a corpus (``weighted_tokens``).

    Where a text is in many pairs, take ``weighted_tokens`` of the texts and ``greedy_match`` of the pairs.
    """
    rows = weighted_tokens(pairs.select(*keys, candidate, reference), keys, [candidate, reference], vectors, frequencies)
    rows = rows.withColumn("__key", F.struct(*keys))
    scored = greedy_match(rows, "__key", f"{candidate}_vec", f"{reference}_vec", f"{candidate}_idf", f"{reference}_idf")
    return scored.select("__key.*", "precision", "recall", "f")


def average_ranks(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Rank of a value in its group; ties share their mean rank.

    Ranks come from the counts of distinct values, so a large group is numbered in parts.
    """
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("__n"))
    ranked = with_running(counts, group, [value], sums={"__before": F.col("__n")}).select(group, value, (F.col("__before") + (F.col("__n") + 1) / 2).alias(name))
    return df.join(ranked, [group, value])


def spearman(df: DataFrame, group: str, a: str, b: str) -> DataFrame:
    """Correlation of the mean ranks; pairs of values count as often as they occur."""
    pairs = df.select(group, F.col(a).alias("__a"), F.col(b).alias("__b"))
    ranked = average_ranks(average_ranks(pairs, group, "__a", "__ra"), group, "__b", "__rb")
    return ranked.groupBy(group).agg(F.corr("__ra", "__rb").alias("spearman"))


def mean_over_raters(scores: DataFrame, rater: str, metric: str) -> DataFrame:
    """Mean over raters of a correlation by rater, to four places."""
    return scores.agg(F.count(F.col(metric)).alias("raters"), F.round(F.avg(metric), 4).alias(metric))


def kendall(df: DataFrame, group: str, key: str, a: str, b: str) -> DataFrame:
    """tau-b of small rated groups: concordant less discordant pairs over the untied ones."""
    left = df.select(group, F.col(key).alias("k1"), F.col(a).alias("a1"), F.col(b).alias("b1"))
    right = df.select(group, F.col(key).alias("k2"), F.col(a).alias("a2"), F.col(b).alias("b2"))
    pairs = left.join(right, group).where("k1 < k2")
    x, y = F.signum(F.col("a1") - F.col("a2")), F.signum(F.col("b1") - F.col("b2"))
    return pairs.groupBy(group).agg(F.try_divide(F.sum(x * y), F.sqrt(F.sum(F.abs(x)) * F.sum(F.abs(y)))).alias("kendall"))


def _inversions(values: np.ndarray, weights: np.ndarray) -> float:
    """Sum of the products of weights of places i < j with values[i] > values[j]; the values are 0 to n - 1.

    Two values differ first in one bit: level by level, every one counts the zeros that
    follow it among those with the same higher bits.
    """
    total = 0.0
    for bit in range(int(len(values)).bit_length() - 1, -1, -1):
        prefix = values >> (bit + 1)
        at = np.argsort(prefix, kind="stable")
        one, w, group = (values[at] >> bit & 1).astype(bool), weights[at].astype(np.float64), prefix[at]
        before = np.concatenate([[0.0], np.cumsum(np.where(one, w, 0.0))])
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        base = np.repeat(before[starts], np.diff(np.concatenate([starts, [len(group)]])))
        total += float((w * (before[:-1] - base))[~one].sum())
    return total


def _inverted_within(keys: list[str], order: list[str], value: list[str]):
    """Weighted inversions of each group of a table: rows in an order, and the order of their values."""

    def count(t):
        import pyarrow as pa

        cols = [t.column(c).to_numpy() for c in [*order, *value]]
        first = np.lexsort(cols[: len(order)][::-1])
        ranks = np.empty(len(first), np.int64)
        ranks[np.lexsort(cols[len(order) :][::-1])] = np.arange(len(first))
        found = _inversions(ranks[first], t.column("n").to_numpy()[first])
        return pa.table({"group": t.column(keys[0]).slice(0, 1), "d": pa.array([found], pa.float64())})

    return count


def _inverted_across(t):
    """From the number of rows by part and block: pairs of an earlier part and a later block."""
    import pyarrow as pa

    part, block = (np.unique(t.column(c).to_numpy(), return_inverse=True)[1] for c in ("part", "block"))
    grid = np.zeros((part.max() + 1, block.max() + 1))
    np.add.at(grid, (part, block), t.column("n").to_numpy().astype(np.float64))
    later = np.zeros_like(grid)
    later[:, :-1] = grid[:, ::-1].cumsum(1)[:, ::-1][:, 1:]  # in later blocks of the same part
    earlier = np.zeros_like(grid)
    earlier[1:] = later.cumsum(0)[:-1]
    return pa.table({"group": t.column("__g").slice(0, 1), "d": pa.array([float((grid * earlier).sum())], pa.float64())})


def kendall_large(df: DataFrame, group: str, a: str, b: str, partitions: int | None = None) -> DataFrame:
    """tau-b of each group, of any size: ties from counts, discordant pairs as inversions, no pairs of rows.

    Different pairs of values, with their number, are dealt by ranges of (a, b) into parts and
    by ranges of (b, a) into blocks.  A pair of rows is discordant if the two orders differ on it: it
    lies in one part (counted there), in one block and two parts (counted in the block), or in two of both
    (counted from the numbers of rows by part and block, a row each).  Null values are left out; null
    groups are one group; a group whose values are all tied has no coefficient.
    """
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(group).alias("__g"), F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
    # -0.0 and 0.0 are one value
    rows = rows.select("__g", *[(F.col(c) + F.lit(0.0)).alias(c) for c in ("a", "b")]).groupBy("__g", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    parts = dealt_by_ranges(rows, ["__g", "a", "b"], partitions).withColumnRenamed(PART, "part").withColumnRenamed(AT, "i")
    blocks = dealt_by_ranges(parts, ["__g", "b", "a"], partitions).withColumnRenamed(PART, "block").withColumnRenamed(AT, "k")
    kind = df.schema[group].dataType.simpleString()
    schema = f"group {kind}, d double"
    inside = blocks.groupBy("__g", "part").applyInArrow(_inverted_within(["__g"], ["i"], ["block", "k"]), schema)
    between = blocks.groupBy("__g", "block").applyInArrow(_inverted_within(["__g"], ["part", "k"], ["k"]), schema)
    numbers = blocks.groupBy("__g", "part", "block").agg(F.sum("n").alias("n"))
    across = numbers.groupBy("__g").applyInArrow(_inverted_across, schema)
    discordant = inside.unionByName(between).unionByName(across).groupBy(F.col("group").alias("__h")).agg(F.sum("d").alias("d"))
    pairs = lambda c: F.col(c).cast("double") * (F.col(c) - 1) / 2
    tied = lambda c: rows_of.groupBy("__g", c).agg(F.sum("n").alias("t")).groupBy(F.col("__g").alias("__h")).agg(F.sum(pairs("t")).alias(f"t_{c}"))
    rows_of = blocks.select("__g", "a", "b", "n")
    totals = rows_of.groupBy("__g").agg(F.sum("n").alias("t"), F.sum(pairs("n")).alias("both"))
    out = totals
    for side in (tied("a"), tied("b"), discordant):
        out = out.join(side, F.col("__g").eqNullSafe(F.col("__h"))).drop("__h")
    untied_a, untied_b = pairs("t") - F.col("t_a"), pairs("t") - F.col("t_b")
    agreeing = pairs("t") - F.col("t_a") - F.col("t_b") + F.col("both") - 2 * F.col("d")
    return out.select(F.col("__g").alias(group), F.try_divide(agreeing, F.sqrt(untied_a) * F.sqrt(untied_b)).alias("kendall"))


def rescale(df: DataFrame, score: str) -> DataFrame:
    """z-score with the population deviation, and rank over count; moments and ranks come from joins, not from one task."""
    stats = df.agg(F.avg(score).alias("__m"), F.stddev_pop(score).alias("__s"), F.count(F.lit(1)).alias("__n"))
    rows = with_position(df, score, "doc_id").crossJoin(F.broadcast(stats))
    return rows.withColumn("gaussian", (F.col(score) - F.col("__m")) / F.col("__s")).withColumn("uniform", F.col("pos") / F.col("__n")).drop("__m", "__s", "__n", "pos")


def percentile_against(scores: DataFrame, stored: DataFrame, score: str) -> DataFrame:
    """z-score and share of stored scores below, of each score as if it joined the stored set."""
    stats = stored.agg(F.count(F.lit(1)).alias("__n"), F.sum(score).alias("__t"), F.sum(F.col(score) * F.col(score)).alias("__q"))
    asked = scores.select(F.col(score).alias("__x")).distinct().withColumn("__k", F.lit(0))  # sorts before equal stored scores
    line = asked.unionByName(stored.select(F.col(score).alias("__x"), F.lit(1).alias("__k"))).withColumn("__g", F.lit(0))
    below = with_running(line, "__g", ["__x", "__k"], sums={"__less": F.col("__k")}).where("__k = 0").select("__x", "__less")
    rows = scores.join(below, F.col(score) == F.col("__x")).crossJoin(F.broadcast(stats))
    n, x = F.col("__n") + 1, F.col(score)
    mean = (F.col("__t") + x) / n
    return rows.select(*scores.columns, ((x - mean) / F.sqrt((F.col("__q") + x * x) / n - mean * mean)).alias("gaussian"), (F.col("__less") / n).alias("uniform"))


# Mean, deviation and weight of the technical and of the aesthetic score.
FUSED = {"technical": (0.1107, 0.07355, 0.6104), "aesthetic": (-0.08285, 0.03774, 0.3896)}


def fuse(technical: Column, aesthetic: Column) -> Column:
    """Weighted sigmoid of two video scores."""
    scaled = [(c - mean) / deviation * weight for c, (mean, deviation, weight) in zip((technical, aesthetic), FUSED.values())]
    return v.sigmoid(scaled[0] + scaled[1])
