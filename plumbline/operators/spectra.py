"""Diversity of the n-grams of whole tables: the spectrum of a sparse similarity matrix that nobody holds.

The similarity of two texts is the mean over n of the cosines of their n-gram counts, that is
Z Z' for a sparse matrix Z with a row a text and a column an n-gram.  The entropy of the
eigenvalues of Z Z' / N is the trace of f(Z Z' / N) with f(x) = -x ln x; stochastic Lanczos
quadrature finds it from products of the matrix with a few random vectors, after the leading
eigenvectors are taken off.  Z is counted once and lies in buckets of whole columns as a written table:
columns of at most ``_FEW`` texts add to a list of pairs of texts, so that what copies share is one
number, the others are kept with their counts.  A product hands each task the vectors and its buckets, and sums
what the tasks return; no product of a column leaves its task.
The driver holds the coefficients of the recurrences: steps times vectors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.vectors import _KEYED, _added
from plumbline.plans.indexing import with_position
from plumbline.staging import remove_staged, staged

#: Texts of a piece of a vector, and n-grams whose sums a task holds at a time.
ROWS, COLUMNS = 1024, 1 << 16
#: Entries that one product touches at a time: they stay in a core's cache.
_ENTRIES = 1 << 10
#: Texts up to which an n-gram counts as pairs of texts.
_FEW = 3
#: Words whose n-grams make a bucket, words and texts that are counted at a time, and passes over the words.
_BUCKET, _CHUNK, _TEXTS, _PASSES = 3_000_000, 1_000_000, 1 << 14, 4
_BLOCK = "part int, k int, n int, rb int, a binary, b binary, c binary"


def _bytes(x: np.ndarray) -> bytes:
    """Whole numbers of any size in compressed planes of bytes."""
    import pyarrow as pa

    x = np.ascontiguousarray(x)
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()
    return np.int64(len(planes)).tobytes() + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _numbers(buffer, kind) -> np.ndarray:
    import pyarrow as pa

    view = memoryview(buffer)
    planes = pa.Codec("zstd").decompress(view[8:], int(np.frombuffer(view[:8], np.int64)[0]), asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _chunks(batches):
    """``pos, text, words``: places of some texts, and of all their words the text's number in the chunk and the hash."""
    held, size, texts = [], 0, 0

    def made():
        at = np.concatenate([p for p, _, _ in held])
        lengths = np.concatenate([n for _, n, _ in held])
        return at, np.repeat(np.arange(len(at), dtype=np.uint64), lengths), np.concatenate([h for _, _, h in held])

    for batch in batches:
        pos, h = batch.column("pos").to_numpy(), batch.column("h")
        lengths, values = np.diff(h.offsets.to_numpy()), h.flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(lengths)
        i = 0
        while i < len(pos):
            began = ends[i] - lengths[i]
            j = max(i + 1, min(int(np.searchsorted(ends, began + _CHUNK - size, "right")), i + _TEXTS - texts))
            held.append((pos[i:j], lengths[i:j], values[began : ends[j - 1]].copy()))
            size, texts, i = size + int(ends[j - 1] - began), texts + j - i, j
            if size >= _CHUNK or texts >= _TEXTS or i < len(pos):
                yield made()
                held, size, texts = [], 0, 0
    if held:
        yield made()


def _grams(text: np.ndarray, h: np.ndarray, ns: tuple[int, ...]):
    """``n``, and the text and hash of each n-gram."""
    for n in ns:
        if len(h) < n:
            continue
        size = len(h) - n + 1
        g = np.full(size, n, np.uint64)
        for k in range(n):  # mixed after each word, so order counts
            g = (g ^ h[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
            g ^= g >> np.uint64(29)
            g *= np.uint64(0xBF58476D1CE4E5B9)
            g ^= g >> np.uint64(32)
        inside = text[:size] == text[n - 1 :]
        yield n, text[:size][inside], g[inside]


#: Bits of an n-gram's hash in a key beside its bucket; the others hold the text.
_LOW = np.uint64(64 - 14)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and how often each occurs."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.diff(np.append(starts, len(keys)))


def sparse_rows(rows: DataFrame, tokens: Column, ns: tuple[int, ...], order: str) -> tuple[DataFrame, DataFrame, int, float]:
    """Blocks of whole columns (``_BLOCK``), the scales of each row by n (``rb, s``), the number of texts, and the trace of Z Z'.

    An entry of Z is its count times its row's scale.  Words go by 64-bit hashes, n-grams by 50 bits and their bucket.
    """
    hashes = F.coalesce(F.transform(tokens, lambda w: F.xxhash64(w)), F.array().cast("array<long>"))
    dealt = with_position(rows.select(F.col(order).alias("__o"), hashes.alias("h")), "__o", name="pos")
    placed = dealt.select("pos", "h")
    n, size = placed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("h")), F.lit(0))).first()
    tasks = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    buckets = -(-max(1, -(-size // _BUCKET)) // tasks) * tasks if size > _CHUNK else 1
    parts = min(tasks, buckets)
    share, place = float(len(ns)) ** -0.5, {k: i for i, k in enumerate(ns)}

    def scaled(batches):
        import pyarrow as pa

        for pos, text, h in _chunks(batches):
            squares = np.zeros((len(ns), len(pos)))
            for k, of, g in _grams(text, h, ns):
                keys, c = _runs(of << _LOW | g >> np.uint64(14))
                squares[place[k]] = np.bincount((keys >> _LOW).astype(np.int64), c.astype(float) ** 2, len(pos))
            s = np.where(squares > 0, share / np.sqrt(np.maximum(squares, 1)), 0.0).T
            yield pa.RecordBatch.from_arrays([pa.array(pos), pa.array([x.tobytes() for x in s], pa.binary())], names=["pos", "s"])

    pieces = placed.mapInArrow(scaled, "pos long, s binary").groupBy(F.floor(F.col("pos") / ROWS).cast("int").alias("rb"))
    # bytes of the rows one after another
    joined = F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda x: F.hex(x["s"])), ""))
    scales = staged(pieces.agg(joined.alias("s")), "scales")

    def counted(low: int, high: int):
        def run(batches):
            import pyarrow as pa

            for pos, text, h in _chunks(batches):
                for k, of, g in _grams(text, h, ns):
                    into = (g >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                    for b in range(low, high):
                        mine = into == b
                        keys, c = _runs(g[mine] << np.uint64(14) | of[mine])
                        if len(keys):
                            made = [_bytes(pos), _bytes(np.diff(keys, prepend=np.uint64(0))), _bytes(c.astype(np.int64))]
                            yield pa.RecordBatch.from_pydict({"bucket": pa.array([b - low], pa.int32()), "n": pa.array([k], pa.int32()), **{x: pa.array([y], pa.binary()) for x, y in zip("abc", made, strict=True)}})

        return run

    def gathered(low: int):
        def run(batches):
            import pyarrow as pa

            held: dict[tuple[int, int], list] = {}
            for batch in batches:
                for b, k, *x in zip(batch.column("bucket").to_pylist(), batch.column("n").to_pylist(), *[batch.column(c).to_pylist() for c in "abc"], strict=True):
                    held.setdefault((b, k), []).append(x)
            for (b, k), blobs in sorted(held.items()):
                for kind, *arrays in _columns(blobs):
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) for x in ((b + low) % parts, kind, place[k], None)] + [pa.array([_bytes(x)], pa.binary()) for x in arrays], names=["part", "k", "n", "rb", "a", "b", "c"])

        return run

    made, step = None, max(parts, -(-buckets // _PASSES))
    for low in range(0, buckets, step):  # each pass shuffles its buckets only
        high = min(buckets, low + step)
        dealt_out = placed.mapInArrow(counted(low, high), "bucket int, n int, a binary, b binary, c binary").repartitionById(high - low, F.col("bucket"))
        one = staged(dealt_out.mapInArrow(gathered(low), _BLOCK), "blocks")
        made = one if made is None else made.unionByName(one)

    def traced(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float((np.frombuffer(x.as_buffer(), np.float64) > 0).sum()) for x in batch.column("s")])], names=["t"])

    trace = (scales.select("s").mapInArrow(traced, "t double").agg(F.sum("t")).first()[0] or 0.0) / len(ns)
    remove_staged(dealt)
    return made, scales, n, float(trace)


def _columns(blobs: list) -> list[tuple]:
    """Of the n-grams of a bucket: ``1``, the columns' lengths, their rows and counts; ``2``, pairs of rows and the sum of their products."""
    blobs = sorted(([_numbers(x, kind) for x, kind in zip(b, (np.int64, np.uint64, np.int64), strict=True)] for b in blobs), key=lambda x: x[0][0])
    keys = [np.cumsum(k, dtype=np.uint64) for _, k, _ in blobs]
    rows = np.concatenate([p[(k & np.uint64(_TEXTS - 1)).astype(np.int64)] for (p, _, _), k in zip(blobs, keys, strict=True)])
    grams, c = np.concatenate([k >> np.uint64(14) for k in keys]), np.concatenate([x for _, _, x in blobs])
    at = np.argsort(grams, kind="stable")
    grams, rows, c = grams[at], rows[at], c[at]
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    df = np.diff(np.append(starts, len(grams)))
    wide = np.repeat(df > _FEW, df)
    out = [(1, df[df > _FEW].astype(np.int32), rows[wide].astype(np.int32), c[wide].astype(np.int64))] if wide.any() else []
    pairs = [(rows[~wide], rows[~wide], c[~wide] ** 2)]
    for d in range(2, _FEW + 1):
        s = starts[df == d]
        pairs += [(np.minimum(rows[s + i], rows[s + j]), np.maximum(rows[s + i], rows[s + j]), c[s + i] * c[s + j]) for i in range(d) for j in range(i + 1, d)]
    a, b, x = (np.concatenate(y) for y in zip(*pairs, strict=True))
    if len(a):
        at = np.lexsort((b, a))
        a, b, x = a[at], b[at], x[at]
        starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        out.append((2, a[starts].astype(np.int32), b[starts].astype(np.int32), np.add.reduceat(x, starts).astype(np.int64)))
    return out


def _add(out: np.ndarray, into: np.ndarray, x: np.ndarray, frm: np.ndarray, w: np.ndarray) -> None:
    """Adds ``w`` times the rows ``frm`` of ``x`` to the rows ``into``, which are in order."""
    for s in range(0, len(into), _ENTRIES):
        i, c = into[s : s + _ENTRIES], w[s : s + _ENTRIES]
        part = np.take(x, frm[s : s + _ENTRIES], axis=0)
        if (c != 1).any():
            part *= c[:, None]
        new = i[1:] != i[:-1]
        if new.all():
            out[i] += part
        else:
            starts = np.flatnonzero(np.concatenate([[True], new]))
            out[i[starts]] += np.add.reduceat(part, starts, axis=0)


def _by(into: np.ndarray) -> np.ndarray:
    """The order by a column of places."""
    return (np.sort(into.astype(np.int64) << 32 | np.arange(len(into))) & 0xFFFFFFFF).astype(np.int64)


def _block_times(kind: int, a: np.ndarray, b: np.ndarray, c: np.ndarray, x: np.ndarray) -> np.ndarray:
    """What a block makes of vectors ``x``, without scales."""
    y, w = np.zeros_like(x), c.astype(np.float64)
    if kind == 2:
        _add(y, a, x, b, w)
        off = a != b
        a, b, w = a[off], b[off], w[off]
        at = _by(b)
        _add(y, b[at], x, a[at], w[at])
        return y
    ends = np.cumsum(a.astype(np.int64))
    for j in range(0, len(a), COLUMNS):
        s, e = int(ends[j] - a[j]), int(ends[min(j + COLUMNS, len(a)) - 1])
        column, row, count = np.repeat(np.arange(len(a[j : j + COLUMNS])), a[j : j + COLUMNS]), b[s:e], w[s:e]
        z = np.zeros((len(a[j : j + COLUMNS]), x.shape[1]))
        _add(z, column, x, row, count)
        at = _by(row)
        _add(y, row[at], z, column[at], count[at])
    return y


def _multiply(blocks: DataFrame, vectors: DataFrame, scales: DataFrame, n: int, m: int, k: int) -> DataFrame:
    """``rb, y``: Z Z' times vectors; each part gets all pieces ``rb, x`` first and then its blocks one by one."""
    parts = max(1, blocks.sparkSession.sparkContext.defaultParallelism)
    none = F.lit(None)

    def product(batches):
        import pyarrow as pa

        x, s, y = np.zeros((n, m)), np.zeros((n, k)), None
        for batch in batches:
            for r in range(batch.num_rows):
                kind, a, b = (batch.column(c)[r] for c in ("k", "a", "b"))
                if kind.as_py() == 0:
                    at = batch.column("rb")[r].as_py() * ROWS
                    new = np.frombuffer(a.as_buffer(), np.float64).reshape(-1, m)
                    x[at : at + len(new)], s[at : at + len(new)] = new, np.frombuffer(b.as_buffer(), np.float64).reshape(-1, k)
                    continue
                y = np.zeros((n, m)) if y is None else y
                scale = s[:, batch.column("n")[r].as_py(), None]
                arrays = (_numbers(v.as_buffer(), t) for v, t in zip((a, b, batch.column("c")[r]), (np.int32, np.int32, np.int64), strict=True))
                y += _block_times(kind.as_py(), *arrays, x * scale) * scale
        for i in range(0, n if y is not None else 0, ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([i // ROWS], pa.int32()), pa.array([y[i : i + ROWS].tobytes()], pa.binary())], names=["i", "x"])

    def added(batches):
        """Sums by piece; rows come in order of their piece, so a task holds one."""
        import pyarrow as pa

        def made():
            return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["i", "x"])

        i, total = None, None
        for batch in batches:
            for j, x in zip(batch.column("i").to_pylist(), batch.column("x"), strict=True):
                x = np.frombuffer(x.as_buffer(), np.float64)
                if j == i:
                    total += x
                    continue
                if total is not None:
                    yield made()
                i, total = j, x.copy()
        if total is not None:
            yield made()

    pieces = vectors.join(scales, "rb").select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("k"), none.cast("int").alias("n"), "rb", F.col("x").alias("a"), F.col("s").alias("b"), none.cast("binary").alias("c"))
    given = pieces.unionByName(blocks).repartitionById(parts, F.col("part")).sortWithinPartitions("k", "n")
    return given.mapInArrow(product, "i int, x binary").repartition("i").sortWithinPartitions("i").mapInArrow(added, "i int, x binary").select(F.col("i").alias("rb"), F.col("x").alias("y"))


def _pieces(df: DataFrame, columns: dict[str, int], work, out: list[str], name: str) -> DataFrame:
    """Rows ``rb`` and pieces of vectors: ``work`` gets the named columns as matrices of that many columns and returns new ones."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for r in range(batch.num_rows):
                given = {c: None if not batch.column(c)[r].is_valid else np.frombuffer(batch.column(c)[r].as_buffer(), np.float64).reshape(-1, w) for c, w in columns.items()}
                made = work(batch.column("rb")[r].as_py(), given)
                yield pa.RecordBatch.from_pydict({"rb": batch.column("rb").slice(r, 1), **{c: [np.ascontiguousarray(made[c]).tobytes()] for c in out}})

    return staged(df.mapInArrow(run, ", ".join(["rb int", *[f"{c} binary" for c in out]])), name)


def _summed(df: DataFrame, column: str) -> np.ndarray:
    """Sum of small arrays over all rows; a row a task reaches the driver."""
    parts = df.select(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col(column).alias("x")).mapInArrow(_added, _KEYED).select("x").collect()
    return np.sum([np.frombuffer(r["x"], np.float64) for r in parts], axis=0)


def _f(x: np.ndarray) -> np.ndarray:
    """-x ln x, zero at and below zero."""
    return np.where(x > 1e-14, -x * np.log(np.maximum(x, 1e-300)), 0.0)


def entropy(blocks: DataFrame, scales: DataFrame, n: int, trace: float, k: int, steps: int = 8, vectors: int = 32, top: int = 16, rounds: int = 3, seed: int = 0) -> tuple[float, float]:
    """Entropy of the eigenvalues of Z Z' / n, and the standard error of the estimate.

    The ``top`` leading eigenvectors are found by iterating a subspace and count exactly;
    the random vectors see only what is orthogonal to them, where no single eigenvalue weighs much.
    What a vector makes of the trace, which is known, corrects what it makes of the entropy.
    """
    top = min(top, max(n - 1, 0))
    m = vectors

    def times(current: DataFrame, width: int, name: str, extra: DataFrame, columns: dict[str, int], dots) -> DataFrame:
        """Adds ``w``, the matrix times ``x``, and ``dots`` of the pieces."""
        joined = current.join(_multiply(blocks, current.select("rb", "x"), scales, n, width, k), "rb", "left")
        joined = joined if extra is None else joined.join(extra, "rb")

        def work(_, g):
            w = np.zeros_like(g["x"]) if g["y"] is None else g["y"] / n
            return g | {"w": w, "dots": dots(g, w)}

        return _pieces(joined, columns | {"x": width, "y": width}, work, [*columns, "x", "w", "dots"], name)

    exact, left = 0.0, trace / n
    if top:
        q = _pieces(scales, {"s": k}, lambda rb, g: {"x": np.random.default_rng([seed, 1, rb]).standard_normal((len(g["s"]), top))}, ["x"], "basis")
        for r in range(rounds + 1):
            made = times(q, top, f"basis{r}", None, {}, lambda g, w: np.concatenate([(w.T @ w).ravel(), (g["x"].T @ w).ravel()]))
            both = _summed(made, "dots")
            if r == rounds:
                small = both[top * top :].reshape(top, top)
                exact, left = float(_f(np.linalg.eigvalsh((small + small.T) / 2)).sum()), left - float(np.trace(small))
                break
            values, turn = np.linalg.eigh(both[: top * top].reshape(top, top))
            scale = turn * np.where(values > values[-1] * 1e-20, 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
            before, q = q, _pieces(made.select("rb", "w"), {"w": top}, lambda _, g, scale=scale: {"x": g["w"] @ scale}, ["x"], f"basis{r}-next")
            # a second time, as the first loses what nearly parallel columns differ in
            again = _pieces(q, {"x": top}, lambda _, g: {"dots": g["x"].T @ g["x"]}, ["dots"], f"basis{r}-gram")
            values, turn = np.linalg.eigh(_summed(again, "dots").reshape(top, top))
            scale = turn * np.where(values > 1e-9, 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
            used = [before, made, q, again]
            q = _pieces(q, {"x": top}, lambda _, g, scale=scale: {"x": g["x"] @ scale}, ["x"], f"basis{r}-even")
            for state in used:
                remove_staged(state)
        basis = q.withColumnRenamed("x", "q")
    else:
        basis = _pieces(scales, {"s": k}, lambda _, g: {"q": np.zeros((len(g["s"]), 1))}, ["q"], "basis")
    wide = max(top, 1)

    def dots(g, w):
        return np.concatenate([(g["x"] * w).sum(0), (w * w).sum(0), (g["q"].T @ w).ravel()])

    # the state of a step: the vector before, the vector, the product of the matrix with it, and the basis
    probes = _pieces(basis, {"q": wide}, lambda rb, g: {"q": g["q"], "x": (v := np.random.default_rng([seed, 2, rb]).choice([-1.0, 1.0], (len(g["q"]), m))), "dots": g["q"].T @ v}, ["q", "x", "dots"], "probes")
    along = _summed(probes, "dots").reshape(wide, m)
    squared = n - (along**2).sum(0)  # of what is left of a vector of n signs
    alive = squared > 1e-9
    first = np.where(alive, 1 / np.sqrt(np.maximum(squared, 1e-300)), 0.0)
    current = _pieces(probes, {"q": wide, "x": m}, lambda _, g: {"p": np.zeros_like(g["x"]), "x": (g["x"] - g["q"] @ along) * first}, ["p", "x"], "vectors0")
    remove_staged(probes)
    alphas, betas = [], [np.zeros(m)]
    for step in range(steps):
        state = times(current, m, f"lanczos{step}", basis, {"p": m, "q": wide}, dots)
        remove_staged(current)
        found = _summed(state, "dots")
        alpha, beta, into = found[:m], betas[-1], found[2 * m :].reshape(wide, m)
        alphas.append(alpha)
        # the new vector is w - q q'w - alpha x - beta p, and q, x and p are orthonormal
        unit = np.sqrt(np.maximum(0.0, found[m : 2 * m] - (into**2).sum(0) - alpha**2 - beta**2))
        unit[unit < 1e-7 * np.abs(alphas[0])] = 0.0  # the space is exhausted
        betas.append(unit)
        if not unit.any() or step == steps - 1:
            break

        def advance(_, g, alpha=alpha, beta=beta, unit=unit, into=into):
            w = g["w"] - g["q"] @ into - alpha * g["x"] - beta * g["p"]
            return {"p": g["x"], "x": np.divide(w, unit, out=np.zeros_like(w), where=unit > 0)}

        current = _pieces(state, {"p": m, "x": m, "w": m, "q": wide}, advance, ["p", "x"], f"vectors{step + 1}")
        remove_staged(state)
    rest, traces = np.zeros(m), np.zeros(m)
    for c in np.flatnonzero(alive):
        size = next((k + 1 for k in range(len(alphas)) if betas[k + 1][c] == 0), len(alphas))
        off = [betas[k + 1][c] for k in range(size - 1)]
        values, ends = np.linalg.eigh(np.diag([a[c] for a in alphas[:size]]) + np.diag(off, 1) + np.diag(off, -1))
        rest[c], traces[c] = squared[c] * (ends[0] ** 2 @ np.array([_f(values), values]).T)
    spread = traces - traces.mean()
    slope = float(spread @ (rest - rest.mean()) / (spread @ spread)) if spread @ spread > 0 else 0.0
    corrected = rest - slope * (traces - left)
    return exact + float(corrected.mean()), float(np.std(corrected, ddof=1) / np.sqrt(m)) if m > 1 else float("nan")


def vendi_of_texts(rows: DataFrame, tokens: Column, order: str, ns: tuple[int, ...] = (1, 2, 3, 4), **options) -> tuple[float, float]:
    """Effective number of different texts of a whole table, and its relative standard error; a table without texts has none."""
    blocks, scales, n, trace = sparse_rows(rows, tokens, ns, order)
    if n == 0:
        return float("nan"), float("nan")
    h, error = entropy(blocks, scales, n, trace, len(ns), **options)
    remove_staged(blocks)
    remove_staged(scales)
    return float(np.exp(h)), error
