"""Operators against brute force at their production sizes, and at edges that several share."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from plumbline.llm import decontamination, embedding_dedup, fast_tokenizer, language_id, line_dedup, ngram_join, packing, secret_scan, toxicity, window_dedup
from tests.llm.test_ops import SCHEMA, brute_lines, edges, frame, rows, sentence

#: Columns that operators or stages use inside.
CLASHING = ["runs", "n_lines", "__runs", "__id", "__h1", "__text", "toxicity", "__toxicity", "score", "th", "text_hash", "id", "spans", "items", "n_words", "n_hit", "node", "length", "piece"]


def clashing(spark, texts, first=0):
    docs = spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return docs.withColumns({c: F.lit(c) for c in CLASHING})


# ------------------------------------------------------------------ 2


@pytest.mark.parametrize("length", [24, 127, 128, 231, 5000, 100_000])
def test_long_candidates_equal_a_plain_slide(spark, length):
    rng = random.Random(length)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    s = "".join(rng.choice("ab1") if rng.random() < 0.5 and i < length // 2 else rng.choice(letters) for i in range(length))
    w, counts, total, sums = secret_scan.WINDOW, Counter(), 0, []
    table = secret_scan._TABLE
    for i, c in enumerate(s):
        if i >= w:
            total += table[counts[s[i - w]] - 1] - table[counts[s[i - w]]]
            counts[s[i - w]] -= 1
        total += table[counts[c] + 1] - table[counts[c]]
        counts[c] += 1
        if i >= w - 1:
            sums.append(total)
    limit = secret_scan.most_sum(4.0)
    hot = [i for i, x in enumerate(sums) if x <= limit]
    got = spark.createDataFrame([(s,)], "s string").select(secret_scan.hot_windows(F.col("s"), F.lit(limit).cast("long")).alias("h")).first().h
    assert (None if got is None else (got["first"], got["last"])) == ((hot[0], hot[-1]) if hot else None)


# ------------------------------------------------------------------ 3


def test_only_letters_make_a_language():
    bits = language_id.presence(["😀😀", "𝟘𝟙 12", "𐐀𐐁", "a", "", None, "́"])
    assert [bool(r.any()) for r in bits] == [False, False, True, True, False, False, False]


def test_folded_weights_equal_the_kernel():
    rng = np.random.default_rng(0)
    texts = [sentence(rng, 20) if i % 2 else " ".join(rng.choice(["schung", "licht", "ein", "und"], 20)) for i in range(40)]
    labels = ["a" if i % 2 else "b" for i in range(40)]
    bits = language_id.presence(texts)
    model = language_id.learn(bits, labels, landmarks=8)
    of = np.array([model.languages.index(x) for x in labels])
    marks = np.concatenate([np.flatnonzero(of == c)[:4] for c in range(2)])

    def grams(t):
        kept = "".join(c if c.isalpha() else " " for c in t.lower())
        return {n: {kept[i : i + n] for i in range(len(kept) - n + 1)} for n in (1, 2, 3)}

    shared = lambda a, b: sum(len(a[n] & b[n]) for n in (1, 2, 3))  # noqa: E731  the kernel, without classes by hash
    g = [grams(t) for t in texts]
    exact = np.array([[shared(x, y) for y in g[:6]] for x in g[:6]])
    hashed = bits[:6].astype(int) @ bits[:6].T.astype(int)
    assert np.abs(exact - hashed).max() <= 0.02 * exact.max() + 2  # few classes collide
    norm = np.sqrt(bits.sum(1, dtype=np.int64))
    z = bits[marks] / norm[marks][:, None]
    values, vectors = np.linalg.eigh(z @ z.T)
    keep = values > 1e-6 * values.max()
    phi = np.concatenate([(bits / norm[:, None]) @ z.T @ (vectors[:, keep] / np.sqrt(values[keep])), np.ones((40, 1))], 1)
    weight = 1.0 / np.bincount(of)[of] * 40 / 2
    w = np.linalg.solve((phi * weight[:, None]).T @ phi + 1e-3 * 40 * np.eye(phi.shape[1]), (phi * weight[:, None]).T @ np.where(of[:, None] == np.arange(2), 1.0, -1.0))
    names, _ = model(texts)
    assert names == [model.languages[k] for k in (phi @ w).argmax(1)] == labels


def test_language_of_repeated_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(i % 3, "ein licht und schein" if i % 2 else "one of the many words", "de" if i % 2 else "en") for i in range(40)], "doc_id long, text string, lang string")
    out = language_id.predict(docs, language_id.fit(docs)).collect()
    assert len(out) == 40 and {r.held_out for r in out if r.doc_id == 0} == {zlib.crc32(b"0") % 3 == 1}
    assert language_id.predict(docs.limit(0), language_id.fit(docs.limit(0))).count() == 0


# ------------------------------------------------------------------ 4


@pytest.mark.parametrize("m", [2, 3])
def test_line_dedup_of_long_runs_and_clashing_names(spark, m):
    rng = np.random.default_rng(m)
    run = [f"line {i}" for i in range(70)]
    texts = ["\n".join(run), "\n".join(["own", *run[5:40], "", *run[41:], "end"]), "\n".join(run[:33]), "x\n" * 300, "y\n" * 3, None, ""]
    texts += ["\n".join(rng.choice(["a", "b", "c", "d"], 30)) for _ in range(10)]
    docs = clashing(spark, texts)
    out = line_dedup.dedup_lines(docs, min_lines=m)
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].text for i in range(len(texts))] == brute_lines(texts, m)
    assert got[0]["__runs"] == "__runs" and got[0]["__id"] == "__id" and set(out.columns) == set(docs.columns)


# ------------------------------------------------------------------ 5


def exhaustive(sizes, capacity):
    best = len(sizes)
    items = sorted(sizes, reverse=True)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for free in sorted({b for b in bins if b >= items[i]}):
            k = bins.index(free)
            bins[k] -= items[i]
            go(i + 1, bins)
            bins[k] += items[i]
        bins.append(capacity - items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(4))
def test_bin_completion_equals_exhaustive_search(seed, monkeypatch):
    monkeypatch.setattr(packing, "LEVELS", 1 + 31 * (seed % 2))  # levels made anew on the way back
    rng = random.Random(seed)
    for _ in range(150):
        capacity = rng.choice([7, 20, 50])
        sizes = [rng.randint(1, rng.choice([capacity, capacity // 2 + 1])) for _ in range(rng.randint(1, 11))]
        counts = np.bincount(sizes, minlength=capacity + 1)
        found = packing.bin_completion(counts, capacity, nodes=None)
        used = Counter()
        for pattern, times in found:
            assert sum(pattern) <= capacity
            used.update({x: times * n for x, n in Counter(pattern).items()})
        assert used == Counter(sizes)
        assert packing.lower_bound(counts, capacity) <= sum(times for _, times in found) == exhaustive(sizes, capacity)


def test_fillings_are_all_undominated_ones():
    counts = [0, 2, 1, 0, 1, 1, 0, 0, 1]
    every = set(packing.fillings(counts, 8))
    assert every == {(8,), (5, 2, 1), (4, 2, 1, 1)} or (8,) in every
    wastes = [8 - sum(f) for f in packing.fillings(counts, 8)]
    assert wastes == sorted(wastes) and list(packing.fillings([0, 0, 0], 2)) == [()]


def test_packed_pieces_hold_the_ids_of_the_library(spark):
    texts = edges() + [sentence(np.random.default_rng(i), 40) for i in range(20)]
    docs = frame(spark, texts).unionByName(frame(spark, ["same id"]))
    tok = fast_tokenizer.engine(fast_tokenizer.load_json()).tokenizer
    ids = lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, 0]
    want = sorted((i, k, at, zlib.crc32(np.array(x[at : at + 256], "<u4").tobytes())) for i, t in [*enumerate(texts), (0, "same id")] for x in [ids(t)] for k, at in enumerate(range(0, len(x), 256)))
    got = packing.pack(docs, capacity=256, payload={"crc": F.crc32("ids")}).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.crc) for r in got) == want


# ------------------------------------------------------------------ 6


def test_toxic_windows_are_plain_compressions():
    rng = np.random.default_rng(0)
    ordinary = [" ".join(rng.choice(["mild", "calm", "river", "stone", "green", "walk"], 60)) for _ in range(80)]
    toxic = [t + " vilewretch " + t + " scumbagge " for t in ordinary[:30]]
    model = toxicity.dictionaries([(t, 1) for t in toxic] + [(t, 0) for t in ordinary[30:]])
    assert b"vilewretch" in model.toxic and b"river" not in model.toxic and model.ordinary[:4] == zstandard.train_dictionary(16384, [b"x" * 40 + bytes([i]) * 40 for i in range(200)]).as_bytes()[:4]
    text = "the river and a vilewretch walk " * 3
    plain, lengths = toxicity.plain(text), []
    params = zstandard.ZstdCompressionParameters.from_level(3, source_size=toxicity.WINDOW, dict_size=len(model.ordinary) + len(model.toxic), min_match=toxicity.GRAM, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    for content in (model.ordinary, model.ordinary + model.toxic):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        c = zstandard.ZstdCompressor(dict_data=d, compression_params=params)
        lengths.append([len(c.compress(plain[i : i + toxicity.WINDOW])) for i in range(0, max(1, len(plain) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)])
    saved = [a - b for a, b in zip(*lengths) if a - b >= toxicity.SAVED]
    _, most, total, count, n = model.features(text)
    assert (most, total, count, n) == (max(saved), np.log1p(sum(saved)), np.log1p(len(saved)), np.log1p(len(lengths[0])))


def test_toxicity_of_no_rows_and_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert [r.score for r in out] == [0.0] * 3
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0))).count() == 0


# ------------------------------------------------------------------ 7


def test_a_third_of_all_rows_in_one_group(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = np.random.default_rng(2)
    base = sentence(rng, 120).split()
    texts = [" ".join(base)] * 60 + ["two words"] * 60
    for _ in range(60):
        t = list(base)
        t[int(rng.integers(120))] = f"e{rng.integers(10**6)}"
        texts.append(" ".join(t))
    texts += [sentence(rng, 30) for _ in range(40)]
    out = {r.doc_id: r for r in ngram_join.near_documents(frame(spark, texts).repartition(8)).collect()}
    assert {out[i].component_id for i in [*range(60), *range(120, 180)]} == {0} and {out[i].component_id for i in range(60, 120)} == {60}
    assert all(out[i].component_id == i for i in range(180, 220)) and sum(out[i].is_first for i in range(220)) == 42


def test_null_ids_link_like_others(spark):
    base = sentence(np.random.default_rng(0), 100).split()
    docs = spark.createDataFrame([(None, " ".join(base)), (None, " ".join([*base[:-1], "x"])), (5, " ".join([*base[:-2], "y", "x"]))], "doc_id long, text string")
    got = ngram_join.near_documents(docs).collect()
    assert {r.component_id for r in got} == {5} and sorted(r.is_first for r in got) == [False, False, True]


# ------------------------------------------------------------------ 8


@pytest.mark.parametrize("n", [2000, 8000])
def test_recall_of_far_apart_pairs(spark, n):
    """Pairs just above the threshold among random vectors, far from every pivot."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=(n // 2, 64))
    side -= (side * x[::2]).sum(1, keepdims=True) * x[::2]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x[1::2] = 0.94 * x[::2] + np.sqrt(1 - 0.94**2) * side
    docs = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(docs).collect()}
    want = (x @ x.T >= 0.93).sum(1) - 1
    have = np.array([got[i] for i in range(n)])
    assert (have <= want).all() and have.sum() >= 0.95 * want.sum()


def test_repeated_vector_ids(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0)], "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_vectors(docs).collect())
    assert got == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]


# ------------------------------------------------------------------ 9


def test_decontamination_of_repeated_ids_and_clashing_names(spark):
    item = sentence(np.random.default_rng(1), 30)
    docs = clashing(spark, [item, "clean words", item]).withColumn("doc_id", F.lit(4).cast("long"))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontamination.find(docs, bench, keep=docs.columns, keep_prefix="kept_").collect()
    assert sorted(r.n_hit for r in out) == [0, 30, 30] and {r.kept_spans for r in out} == {"spans"}


# ------------------------------------------------------------------ 10


def test_repeats_around_the_production_length(spark):
    """Passages of over 50 words: what is removed depends on their bytes, 400 or more, and not on their words."""
    rng = np.random.default_rng(0)
    passage = (sentence(rng, 200) + " " + "ü" * 40).encode()
    texts = []
    for n in (399, 400, 401, 640):
        cut = passage[:n].decode()
        for _ in range(2):
            texts.append(sentence(rng, 60) + "|" + f"{n}" + "".join(f"{n}{w}" for w in cut) + "|" + sentence(rng, 60))
    short = sentence(rng, 55)[:380]
    texts += [sentence(rng, 40) + short + sentence(rng, 40) for _ in range(3)]
    texts += ["ab" * 1000, "q" * 399, "q" * 400, "q" * 401, sentence(rng, 300), None, ""]
    big = sentence(rng, 90)
    texts += [f"{k} {big[:400 + k]} {k}" for k in range(-2, 3)] + [big] * 4
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + 400] for d in data for i in range(len(d) - 399))
    got = {r.doc_id: r for r in window_dedup.remove_repeats(frame(spark, texts)).collect()}
    for i, d in enumerate(data):
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - 399):
            if count[d[p : p + 400]] > 1:
                gone[p : p + 400] = True
        edges_ = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).reshape(-1, 2)
        assert [(s.start, s.end) for s in got[i].spans] == [tuple(e) for e in edges_.tolist()]
        assert bytes(got[i].kept) == bytes(np.frombuffer(d, np.uint8)[~gone]) and got[i].n_bytes == len(d)
    assert all(not got[i].spans for i in (8, 9, 10))


def test_query_on_planted_passages(spark, tmp_path):
    """Passages of over 50 words in two to four documents each, read by the columns of removal: all of 400 bytes or more are found, shorter ones and clean documents stay."""
    rng = random.Random(10)
    words = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 9))) for _ in range(n))
    texts, passages = [], []
    for k in range(120):
        passage = words(rng.randint(51, 90))
        for _ in range(2 + k % 3):
            texts.append(f"{words(rng.randint(0, 80))}<{passage}>{words(rng.randint(0, 80))}")
            passages.append(len(passage) + 2)
    texts += [words(rng.randint(60, 250)) for _ in range(200)]
    passages += [0] * 200
    assert 20 < sum(0 < n < 399 for n in passages) and 20 < sum(n >= 400 for n in passages)
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    data = [t.encode() for t in texts]
    count = Counter(d[i : i + 400] for d in data for i in range(len(d) - 399))
    got = {r.doc_id: r for r in window_dedup.op10_window_dedup(spark, f"{tmp_path}").collect()}
    assert len(got) == len(texts)
    for i, (d, n) in enumerate(zip(data, passages)):
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - 399):
            if count[d[p : p + 400]] > 1:
                gone[p : p + 400] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(d), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest())
        assert (got[i].n_removed >= n) if n >= 400 else (n > 390 or got[i].n_removed == 0)


def test_windows_of_repeated_ids(spark):
    text = sentence(np.random.default_rng(3), 120)
    docs = spark.createDataFrame(rows([text, text])[:1] * 2 + rows(["other"], 9), SCHEMA)
    got = window_dedup.remove_repeats(docs).collect()
    assert sorted(len(r.kept) for r in got) == [0, 0, 5]
