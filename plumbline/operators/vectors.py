"""Centroids, distances, moments and the distribution distances built on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import vector as v

#: Bytes of centroids that one pass sends to all tasks.
CENTROID_BYTES = 64 << 20


def whole(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and has no null component; the measures of sets leave out all others."""
    return rows.where(F.col(column).isNotNull() & ~F.exists(column, lambda x: x.isNull()))


def nearest_centroid(rows: DataFrame, centroids: DataFrame, metric: str = "l2_norm", block_bytes: int = CENTROID_BYTES) -> DataFrame:
    """Closest centroid of each row; ties go to the lower centroid id.

    Features are normalised.  ``l2_norm`` takes the least distance, ``dot_product`` and
    ``cosine`` the largest product (``cosine`` normalises the centroids).  A batch of rows
    meets a block of centroids in one matrix product.  Centroids beyond ``block_bytes``
    take one pass for each block by hash of their id, and rows carry the best so far.  A row
    without a vector, or with a null component, stays with a null centroid.
    """
    c = whole(centroids, "c_embs").select(F.col("cid").cast("long").alias("cid"), (v.normalise(F.col("c_embs")) if metric == "cosine" else F.col("c_embs").cast("array<double>")).alias("c"))
    size = c.agg(F.coalesce(F.sum(F.size("c") * 8), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_bytes))
    best = rows.select("vec_id", v.normalise(F.col("embedding")).alias("x"), F.lit(None).cast("double").alias("key"), F.lit(None).cast("long").alias("cid"))
    sign = 1.0 if metric == "l2_norm" else -1.0
    for b in range(blocks):
        part = c if blocks == 1 else c.where(F.pmod(F.xxhash64("cid"), F.lit(blocks)) == b)
        held = sorted((r["cid"], r["c"]) for r in part.collect())  # at most about block_bytes
        if not held:
            continue
        shipped = rows.sparkSession.sparkContext.broadcast((np.array([i for i, _ in held]), np.array([x for _, x in held], np.float64)))

        def one_pass(batches, shipped=shipped):
            import pyarrow as pa

            ids, known = shipped.value
            for batch in batches:
                given = batch.column("x").to_pylist()
                there = np.array([x is not None and None not in x for x in given], bool)
                x = np.array([g if ok else [0.0] * known.shape[1] for g, ok in zip(given, there, strict=True)], np.float64).reshape(-1, known.shape[1])
                score = x @ known.T
                if metric == "l2_norm":
                    score = np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] - 2 * score + (known * known).sum(1)[None, :]))
                key = np.round(sign * score, 9)
                at = key.argmin(1)  # ids are in order, so the first of equal scores has the lowest
                new, cid = key[np.arange(len(x)), at], ids[at]
                old = batch.column("key").to_numpy(zero_copy_only=False).astype(np.float64)
                other = batch.column("cid").fill_null(0).to_numpy(zero_copy_only=False)
                stays = ~np.isnan(old) & ((old < new) | ((old == new) & (other < cid)))
                best_key, best_cid = pa.array(np.where(stays, old, new), mask=~there), pa.array(np.where(stays, other, cid), mask=~there)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), best_key, best_cid], names=["vec_id", "x", "key", "cid"])

        best = best.mapInArrow(one_pass, best.schema)
    return best.select("vec_id", "cid", F.round(sign * F.col("key"), 6).alias("score"))


def pair_distances(rows: DataFrame, metric: str = "cosine") -> DataFrame:
    """Distance of every two vectors of a stated small set (a sample or a class)."""
    a = rows.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x"))
    b = rows.select(F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", v.DISTANCES[metric](F.col("x"), F.col("y")).alias("d"))


def cross_distances(left: DataFrame, right: DataFrame, metric: str = "cosine") -> DataFrame:
    """Distance of every vector of one stated small set to every one of another."""
    a = left.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x"))
    b = right.select(F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    return a.crossJoin(b).select("a", "b", v.DISTANCES[metric](F.col("x"), F.col("y")).alias("d"))


def cross_distance_statistics(left: DataFrame, right: DataFrame) -> DataFrame:
    """Number, mean, population deviation and sum of the cosine distances of every vector of one set to every one of another.

    Without pairs: with u and w the unit vectors, the sum of their cosines is (sum u).(sum w),
    and the sum of the squared cosines the product of sum u u^T and sum w w^T, place by place.
    Pairs with a vector that is null, zero or holds a null count in the number alone.
    """
    pairs = left.count() * right.count()
    unit = lambda rows: whole(rows).where(v.norm(F.col("embedding")) != 0).select(v.normalise(F.col("embedding")).alias("embedding"))
    (n, s, g), (m, t, h) = second_moments(unit(left)), second_moments(unit(right))
    found = None, None, None
    if n and m:
        cosines, squares = float(s @ t), float((g * h).sum())
        mean = cosines / n / m
        found = 1 - mean, float(np.sqrt(np.maximum(0.0, squares / n / m - mean * mean))), n * m - cosines
    return left.sparkSession.createDataFrame([(pairs, *found)], "n long, mean double, std double, sum double")


def distance_statistics(pairs: DataFrame, keep_zero: bool = False) -> DataFrame:
    """Number, mean, population deviation and sum; zeros count only for cross-set matrices."""
    rows = pairs if keep_zero else pairs.where("d <> 0")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg("d").alias("mean"), F.stddev_pop("d").alias("std"), F.sum("d").alias("sum"))


def class_distance_statistics(rows: DataFrame, group: str) -> DataFrame:
    """Number, mean and deviation of the cosine distances of all pairs of different vectors in a class.

    Without pairs: with u the unit vectors, the sum of cosines over all pairs follows from
    |sum u|^2 and the sum of their squares from the squared norm of sum u u^T.  Partitions
    add both up; the number of components squared travels for each class, never a pair.
    Equal vectors are at distance zero, which does not count, so each class of them
    enters with its multiplicity taken off again.
    """
    unit = whole(rows).select(group, v.normalise(F.col("embedding")).alias("u"), F.xxhash64("embedding").alias("h"))
    twins = unit.groupBy(group, "h").agg(F.count(F.lit(1)).alias("c")).groupBy(group).agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("twins"))
    schema = unit.select(F.col(group), F.lit(0).cast("long").alias("n"), F.array(F.lit(0.0)).alias("s")).schema

    def local(batches):
        import pyarrow as pa

        sums: dict = {}
        for b in batches:
            labels = b.column(0).to_pylist()
            x = np.array(b.column(1).to_pylist(), np.float64)
            for label in set(labels):
                u = x[[k for k, y in enumerate(labels) if y == label]]
                new = np.concatenate([u.sum(0), (u.T @ u).ravel()])
                n, old = sums.get(label, (0, 0.0))
                sums[label] = (n + len(u), old + new)
        if sums:
            out = [(k, n, s.tolist()) for k, (n, s) in sums.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out]).cast(b.schema.field(0).type), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.list_(pa.float64()))], names=[group, "n", "s"])

    parts = unit.select(group, "u").mapInArrow(local, schema)
    flat = parts.select(group, "n", F.posexplode("s").alias("i", "x")).groupBy(group, "i").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    d = F.floor((F.sqrt(1 + 4 * F.count(F.lit(1))) - 1) / 2 + 0.5)
    totals = flat.groupBy(group).agg(F.max("n").alias("n"), d.alias("d"), F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    squares = lambda a: F.aggregate(a, F.lit(0.0), lambda t, y: t + y["x"] * y["x"])
    t = totals.withColumns({"one": squares(F.slice("v", F.lit(1), F.col("d").cast("int"))), "two": squares(F.slice("v", F.col("d").cast("int") + 1, F.size("v")))}).join(twins, group)
    pairs = F.col("n") * (F.col("n") - 1) / 2
    cosines, cosine_squares = (F.col("one") - F.col("n")) / 2 - F.col("twins"), (F.col("two") - F.col("n")) / 2 - F.col("twins")
    t = t.select(group, (pairs - F.col("twins")).cast("long").alias("n"), cosines.alias("c"), cosine_squares.alias("q")).where("n > 0")
    mean = F.col("c") / F.col("n")
    return t.select(group, "n", (1 - mean).alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean)).alias("std"))


def normalised(rows: DataFrame) -> DataFrame:
    """Each component over the root of its mean square, over all rows."""
    flat = rows.select("vec_id", F.posexplode("embedding").alias("i", "x"))
    scale = flat.groupBy("i").agg(F.sqrt(F.avg(F.col("x").cast("double") * F.col("x"))).alias("__q"))
    return flat.join(F.broadcast(scale), "i").select("vec_id", "i", F.try_divide(F.col("x").cast("double"), F.col("__q")).alias("x"))  # a row a component


def diversity(samples: DataFrame, metric: str = "cosine") -> DataFrame:
    """Mean and deviation of the distances between embedded samples: the diversity and its interval."""
    return distance_statistics(pair_distances(samples, metric)).select(F.col("mean").alias("Task2VecDiversityScore"), F.col("std").alias("ConfidenceInterval"))


def draw_samples(rows: DataFrame, key: str, samples: int, size: int, seed: int = 0, replace: bool = False) -> DataFrame:
    """``sample`` numbers and rows: each sample the ``size`` rows of least hash of seed, number and key.

    With ``replace`` a sample draws ``size`` places, each the row whose running number is a
    hash modulo the number of rows, so a row can come up again.
    """
    from pyspark.sql import Window

    from plumbline.plans.indexing import with_position

    numbers = F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))
    if replace:
        total = rows.count()
        draws = rows.sparkSession.range(samples * size).select((F.col("id") % samples).alias("sample"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(total, 1))).alias("__pos"))
        return draws.join(with_position(rows, key, name="__pos"), "__pos").drop("__pos")
    total = max(rows.count(), 1)
    share = min(1.0, 1.5 * size / total + 8.0 / total)  # enough rows below it but for a vanishing chance, met by the rank below
    hashed = rows.withColumn("sample", numbers).withColumn("__h", F.xxhash64(F.lit(seed), "sample", key))
    near = hashed.where(F.pmod("__h", F.lit(1 << 32)) < int(share * (1 << 32))) if share < 1 else hashed
    rank = F.row_number().over(Window.partitionBy("sample").orderBy(F.pmod("__h", F.lit(1 << 32)), key))
    return near.withColumn("__r", rank).where(F.col("__r") <= size).drop("__r", "__h")


def mean_vector(rows: DataFrame, group: str | None = None) -> DataFrame:
    keys = [group] if group else []
    return rows.select(*keys, F.posexplode("embedding").alias("i", "x")).groupBy(*keys, "i").agg(F.avg(F.col("x").cast("double")).alias("mu"))


#: Side of the squares in which sums of outer products travel.
SQUARE = 256


def _added(batches):
    """Sums the arrays of each key of a partition; a key is one square or one sketch, so a task holds few of them."""
    import pyarrow as pa

    sums: dict[tuple, np.ndarray] = {}
    for b in batches:
        for i, j, x in zip(b.column("i").to_pylist(), b.column("j").to_pylist(), b.column("x"), strict=True):
            new = np.frombuffer(x.as_buffer(), np.float64)
            sums[i, j] = sums[i, j] + new if (i, j) in sums else new.copy()
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["i", "j", "x"])


_KEYED = "i int, j int, x binary"


def _add_up(parts: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Arrays ``(i, j, x)`` of all tasks summed by key in parallel; a row a key reaches the driver."""
    return {(r["i"], r["j"]): np.frombuffer(r["x"], np.float64) for r in parts.repartition("i", "j").mapInArrow(_added, _KEYED).toLocalIterator()}


def second_moments(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, sum and sum of outer products.

    Partitions add up locally and send the upper squares of their sum, which are added by
    place in parallel: no task holds more than its own d*d numbers, and d*d reach the driver.
    """
    import pyarrow as pa

    def local(batches):
        n, s, g = 0, None, None
        for b in batches:
            x = np.array(b.column(0).to_pylist(), np.float64)
            if len(x):
                s = x.sum(0) if s is None else s + x.sum(0)
                g = x.T @ x if g is None else g + x.T @ x
                n += len(x)
        if n:
            d = len(s)
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([0], pa.int32()), pa.array([np.concatenate([[float(n)], s]).tobytes()], pa.binary())], names=["i", "j", "x"])
            for i in range(0, d, SQUARE):
                for j in range(i, d, SQUARE):
                    square = np.ascontiguousarray(g[i : i + SQUARE, j : j + SQUARE]).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([square], pa.binary())], names=["i", "j", "x"])

    sums = _add_up(whole(rows).select(F.col("embedding").cast("array<double>")).mapInArrow(local, _KEYED))
    if not sums:
        return 0, np.zeros(0), np.zeros((0, 0))
    head = sums.pop((-1, 0))
    d = len(head) - 1
    g = np.zeros((d, d))
    for (i, j), x in sums.items():
        square = x.reshape(min(SQUARE, d - i), min(SQUARE, d - j))
        g[i : i + SQUARE, j : j + SQUARE] = square
        g[j : j + SQUARE, i : i + SQUARE] = square.T
    return int(head[0]), head[1:], g


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample covariance."""
    n, s, g = second_moments(rows)
    mu = s / n
    return mu, (g - n * np.outer(mu, mu)) / (n - 1)


def frechet(a: DataFrame, b: DataFrame, eps: float = 1e-6) -> float:
    """Squared distance of the means plus the trace term; the root by symmetric eigenvalues."""
    (m1, c1), (m2, c2) = moments(a), moments(b)
    w, q = np.linalg.eigh(c1)
    if w.min() < 0:
        w = np.clip(w, 0, None) + eps
    half = (q * np.sqrt(w)) @ q.T
    inner = np.clip(np.linalg.eigvalsh(half @ c2 @ half), 0, None)
    return float(((m1 - m2) ** 2).sum() + np.trace(c1) + np.trace(c2) - 2 * np.sqrt(inner).sum())


def cubic_discrepancy(x: np.ndarray, y: np.ndarray) -> float:
    """Unbiased squared mean discrepancy of two sets with the kernel (x.y/d + 1)^3, by matrix products."""
    d, m, n = x.shape[1], len(x), len(y)
    k = lambda a, b: (a @ b.T / d + 1) ** 3
    xx, yy, xy = k(x, x), k(y, y), k(x, y)
    return float((xx.sum() - np.trace(xx)) / (m * (m - 1)) + (yy.sum() - np.trace(yy)) / (n * (n - 1)) - 2 * xy.mean())


#: Components up to which third moments of whole sets are summed (their number cubed).
MOST_CUBIC = 128


def _power_sums(rows: DataFrame) -> tuple[int, float, list[np.ndarray]]:
    """Rows, sum of the kernel of each row with itself, and sums of x, x x and x x x over all rows."""
    import pyarrow as pa

    def local(batches):
        n, own, sums = 0, 0.0, None
        for b in batches:
            x = np.array(b.column(0).to_pylist(), np.float64)
            if len(x):
                d = x.shape[1]
                if d > MOST_CUBIC:
                    raise ValueError(f"{d} components: take kernel_distance_sketch or kernel_distance_subsets")
                new = [x.sum(0), x.T @ x, np.einsum("ni,nj,nk->ijk", x, x, x, optimize=True)]
                sums = new if sums is None else [a + c for a, c in zip(sums, new)]
                n, own = n + len(x), own + float(((np.einsum("ni,ni->n", x, x) / d + 1) ** 3).sum())
        if n:
            flat = np.concatenate([s.ravel() for s in sums])
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([own]), pa.array([flat.tolist()])], names=["n", "own", "s"])

    parts = whole(rows).select(F.col("embedding").cast("array<double>")).mapInArrow(local, "n long, own double, s array<double>")
    n, own, flat = 0, 0.0, None
    for r in parts.toLocalIterator():  # a row a partition, of the components cubed
        s = np.array(r["s"])
        n, own, flat = n + r["n"], own + r["own"], s if flat is None else flat + s
    if flat is None:
        return 0, 0.0, []
    d = next(k for k in range(1, MOST_CUBIC + 1) if k + k * k + k**3 == len(flat))
    return n, own, [flat[:d], flat[d : d + d * d].reshape(d, d), flat[d + d * d :].reshape(d, d, d)]


def kernel_distance(a: DataFrame, b: DataFrame) -> float:
    """Unbiased squared mean discrepancy over whole sets with the kernel (x.y/d + 1)^3, without pairs.

    The cube opens into powers of x.y, and the sum of a power over all pairs is the
    product of two moment tensors.
    """
    (m, own_a, p), (n, own_b, q) = _power_sums(a), _power_sums(b)
    d = len(p[0])

    def total(s: list[np.ndarray], t: list[np.ndarray], pairs: int) -> float:
        one, two, three = ((x * y).sum() for x, y in zip(s, t))
        return float(three / d**3 + 3 * two / d**2 + 3 * one / d + pairs)

    return (total(p, p, m * m) - own_a) / (m * (m - 1)) + (total(q, q, n * n) - own_b) / (n * (n - 1)) - 2 * total(p, q, m * n) / (m * n)


def _tensor_sketch(x: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Spectrum of the sketched third tensor power of each row, summed over the rows.

    Three count sketches with hashes of their own; the product of their spectra is the
    spectrum of the sketch of the tensor product.
    """
    rng = np.random.default_rng(seed)
    out = None
    for _ in range(3):
        place, sign = rng.integers(0, width, x.shape[1]), rng.choice([-1.0, 1.0], x.shape[1])
        counts = np.zeros((width, len(x)))
        np.add.at(counts, place, (x * sign).T)
        f = np.fft.rfft(counts, axis=0)
        out = f if out is None else out * f
    return out.sum(1)


def _sketch_sums(rows: DataFrame, width: int, repeats: int, seed: int) -> tuple[int, float, list[np.ndarray]]:
    """Rows, sum of the kernel of each row with itself, and the sketches of the summed features."""
    import pyarrow as pa

    def local(batches):
        n, own, sums = 0, 0.0, None
        for b in batches:
            for part in range(0, b.num_rows, 256):
                x = np.array(b.column(0).slice(part, 256).to_pylist(), np.float64)
                y = np.concatenate([x / np.sqrt(x.shape[1]), np.ones((len(x), 1))], 1)
                new = [_tensor_sketch(y, width, seed * 1000 + r) for r in range(repeats)]
                sums = new if sums is None else [a + c for a, c in zip(sums, new, strict=True)]
                n, own = n + len(x), own + float((np.einsum("ni,ni->n", y, y) ** 3).sum())
        if n:
            keys = [-1, *range(repeats)]
            values = [np.array([float(n), own]), *[s.view(np.float64) for s in sums]]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([0] * len(keys), pa.int32()), pa.array([x.tobytes() for x in values], pa.binary())], names=["i", "j", "x"])

    sums = _add_up(whole(rows).select(F.col("embedding").cast("array<double>")).mapInArrow(local, _KEYED))
    if not sums:
        return 0, 0.0, []
    n, own = sums[-1, 0]
    return int(n), float(own), [np.fft.irfft(np.ascontiguousarray(sums[r, 0]).view(np.complex128), width) for r in range(repeats)]


def kernel_distance_sketch(a: DataFrame, b: DataFrame, width: int = 8192, repeats: int = 8, seed: int = 0) -> tuple[float, float]:
    """Squared mean discrepancy of whole sets with the kernel (x.y/d + 1)^3, for any number of components: estimate and its standard error.

    The kernel is the product of third tensor powers of (x/sqrt(d), 1), which a tensor
    sketch of ``width`` numbers keeps in expectation; sketches are linear, so one pass sums them.  What
    a row has with itself is summed exactly and taken off.  ``repeats`` independent sketches
    give the error, which shrinks with the root of ``width * repeats`` and does not grow with rows.
    """
    (m, own_a, p), (n, own_b, q) = _sketch_sums(a, width, repeats, seed), _sketch_sums(b, width, repeats, seed)
    if m < 2 or n < 2:
        raise ValueError("two vectors a set at least")
    found = [(x @ x - own_a) / (m * (m - 1)) + (y @ y - own_b) / (n * (n - 1)) - 2 * (x @ y) / (m * n) for x, y in zip(p, q, strict=True)]
    return float(np.mean(found)), float(np.std(found, ddof=1) / np.sqrt(repeats)) if repeats > 1 else float("nan")


def kernel_distance_subsets(a: DataFrame, b: DataFrame, subsets: int = 100, size: int = 1000, seed: int = 0) -> DataFrame:
    """Mean and deviation of the discrepancy over subsets drawn with replacement; a subset is one small task."""
    left = draw_samples(a.select("vec_id", "embedding"), "vec_id", subsets, size, seed, replace=True).withColumn("side", F.lit(0))
    right = draw_samples(b.select("vec_id", "embedding"), "vec_id", subsets, size, seed + 1, replace=True).withColumn("side", F.lit(1))

    def one(t):
        import pyarrow as pa

        x, side = np.array(t.column("embedding").to_pylist(), np.float64), t.column("side").to_numpy()
        return pa.table({"sample": t.column("sample").slice(0, 1), "mmd2": [cubic_discrepancy(x[side == 0], x[side == 1])]})

    each = left.unionByName(right).groupBy("sample").applyInArrow(one, "sample long, mmd2 double")
    return each.agg(F.count(F.lit(1)).alias("subsets"), F.avg("mmd2").alias("mean"), F.stddev_pop("mmd2").alias("std"))


def inception(rows: DataFrame, probabilities: str, split: str) -> DataFrame:
    """exp of the mean divergence from the split's mean, by split."""
    flat = rows.select(split, "vec_id", F.posexplode(probabilities).alias("i", "p"))
    mean = flat.groupBy(split, "i").agg(F.avg("p").alias("q"))
    size = rows.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
    kl = flat.join(mean, [split, "i"]).groupBy(split).agg(F.sum(F.when(F.col("p") > 0, F.col("p") * F.ln(F.col("p") / F.col("q"))).otherwise(0.0)).alias("kl"))
    return kl.join(size, split).select(split, F.exp(F.col("kl") / F.col("n")).alias("score"))


def inception_splits(rows: DataFrame, probabilities: str, order: str, splits: int) -> DataFrame:
    """Mean and population deviation of the score over equal splits in an order; the remainder is left out."""
    from plumbline.operators.selection import equal_splits

    dealt = equal_splits(rows.select("vec_id", order, probabilities) if order != "vec_id" else rows.select("vec_id", probabilities), order, splits)
    each = inception(dealt, probabilities, "split")
    return each.agg(F.count(F.lit(1)).alias("splits"), F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))


def vendi_of_gram(gram: np.ndarray) -> float:
    """exp of the entropy of the eigenvalues of a matrix of trace one."""
    w = np.linalg.eigvalsh(gram)
    w = w[w > 1e-12]
    return float(np.exp(-(w * np.log(w)).sum()))


def vendi(rows: DataFrame) -> float:
    """Diversity of vectors by the d*d dual of the similarity matrix."""
    unit = rows.select(v.normalise(F.col("embedding")).alias("embedding"))
    n, _, g = second_moments(unit)
    return vendi_of_gram(g / n)


def ngram_gram(rows: DataFrame, key: str, tokens, ns: tuple[int, ...] = (1, 2, 3, 4)) -> DataFrame:
    """``i, j, k``: mean over n of the cosine of n-gram counts of every two texts of a stated set, i <= j, zeros left out.

    Texts meet through the n-grams that they share.
    """
    from plumbline.functions.text import ngrams

    def named(n: int):
        return F.transform(ngrams(tokens, n), lambda g: F.struct(F.lit(n).alias("n"), g.alias("g")))

    found = F.flatten(F.array(*[named(n) for n in ns]))
    counts = rows.select(F.col(key).alias("i"), F.explode(found).alias("x")).groupBy("i", "x.n", "x.g").agg(F.count(F.lit(1)).alias("c"))
    length = counts.groupBy("i", "n").agg(F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("len"))
    unit = counts.join(length, ["i", "n"]).select("i", "n", "g", (F.col("c") / F.col("len")).alias("w"))
    other = unit.select(F.col("i").alias("j"), "n", "g", F.col("w").alias("v"))
    return unit.join(other, ["n", "g"]).where("i <= j").groupBy("i", "j").agg((F.sum(F.col("w") * F.col("v")) / len(ns)).alias("k"))


def vendi_ngrams(rows: DataFrame, key: str, tokens, ns: tuple[int, ...] = (1, 2, 3, 4), most: int = 4096) -> float:
    """Diversity of a stated set of at most ``most`` texts by their n-grams; eigenvalues on the driver."""
    ids = [r[0] for r in rows.select(key).orderBy(key).limit(most + 1).collect()]
    if len(ids) > most:
        raise ValueError(f"more than {most} texts: draw a sample first (draw_samples)")
    at = {x: n for n, x in enumerate(ids)}
    gram = np.zeros((len(ids), len(ids)))
    for r in ngram_gram(rows, key, tokens, ns).toLocalIterator():
        gram[at[r["i"]], at[r["j"]]] = gram[at[r["j"]], at[r["i"]]] = r["k"]
    return vendi_of_gram(gram / max(len(ids), 1))
