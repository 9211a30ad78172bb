"""The pipeline operators against brute force, and at the edges."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import decontamination, embedding_dedup, fast_tokenizer, language_id, line_dedup, ngram_join, packing, secret_scan, token_binary, toxicity, window_dedup
from plumbline.llm.common import Workspace, connected_components

#: Columns that carry names the operators use inside.
SCHEMA = "doc_id long, text string, n long, node string, key string, spans string, score double, lang string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def rows(texts, first=0):
    return [(first + i, t, 1, "x", "y", "z", 0.5, "en") for i, t in enumerate(texts)]


def frame(spark, texts):
    return spark.createDataFrame(rows(texts), SCHEMA)


def edges():
    """Null, empty, blank, one word, very long, repeated and tied texts."""
    return [None, "", " \n ", "word", "Word", "long " * 40_000, "same text of some words here", "same text of some words here", "ünïcode ﬁ １２ <|endoftext|> Straße\tİx", "\n\n\nline\n\n"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.integers(40)) for _ in range(n))


# ------------------------------------------------------------------ 1 and 5


def test_chunked_ids_equal_the_library():
    tok = fast_tokenizer.engine(fast_tokenizer.load_json())
    for t in [*edges(), "don't 'S  a\r\nb c \x1cd é é ΑΣ. ab,, x.y", "日本語 テスト ½ ²"]:
        assert np.frombuffer(tok.encode(t), "<u4").tolist() == tok.tokenizer.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000)
    data = token_binary.pack(ids, bits)
    assert len(data) == -(-1000 // 64) * bits * 8
    for a, b in ((0, 1000), (63, 65), (500, 500), (999, 1000), (128, 192)):
        assert token_binary.unpack(data, bits, a, b).tolist() == ids[a:b].tolist()


def test_token_files(spark):
    docs = frame(spark, edges()).union(frame(spark, ["word"])).union(spark.createDataFrame([(None, "no id", 1, "", "", "", 0.0, "")], SCHEMA))
    ws = Workspace(spark, "t")
    token_binary.write(docs, f"{ws.path}/ids", shards=3)
    base = token_binary.shard_starts(spark, f"{ws.path}/ids")
    got = token_binary.read(spark, f"{ws.path}/ids").join(base, "shard").collect()
    tok = fast_tokenizer.engine(fast_tokenizer.load_json()).tokenizer
    want, at = [], 0
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")):
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, at, ids))
        at += len(ids)
    assert sorted(((r.doc_id, r.base + r.start_in_shard, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=lambda x: x[1]) == want
    assert token_binary.token_of(spark, f"{ws.path}/ids", 3).tolist()[-1] == 2
    token_binary.write(docs.limit(0), f"{ws.path}/none")
    assert token_binary.read(spark, f"{ws.path}/none").count() == 0


def test_packing(spark):
    texts = edges() + [sentence(np.random.default_rng(i), 5 + i * 7 % 90) for i in range(60)]
    out = packing.pack(frame(spark, texts), capacity=256).collect()
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in out)
    assert len(bins) <= -(-total // 256) + 2
    long = sorted((r.piece, r.start, r.length) for r in out if r.doc_id == 5)
    assert all(p == i and s == 256 * i for i, (p, s, _) in enumerate(long)) and all(n == 256 for _, _, n in long[:-1])
    assert packing.pack(frame(spark, texts).limit(0)).count() == 0


def test_bin_completion_finds_optimal_packings():
    for seed in range(6):
        rng = np.random.default_rng(seed)
        sizes = rng.integers(1, 101, 120)
        counts = np.bincount(sizes, minlength=101)
        found = packing.bin_completion(counts, 100)
        used = Counter()
        for pattern, m in found:
            assert sum(pattern) <= 100 and m > 0
            used.update({x: m * n for x, n in Counter(pattern).items()})
        assert used == Counter(sizes.tolist())
        assert sum(m for _, m in found) <= packing.lower_bound(counts, 100) + 1
    assert packing.bin_completion(np.zeros(101, int), 100) == []
    assert sum(m for _, m in packing.bin_completion(np.bincount([60, 60, 40, 40, 50, 50], minlength=101), 100)) == 3


# ------------------------------------------------------------------ 2


def test_secret_spans(spark):
    key = "aB3dE5gH7jK9mN1pQ3sT5vW7xY9z"
    texts = edges() + [
        "password: secret: longvalue123 Token='abcdefgh' api_key = ABCDEFGH1",
        "é AKIAABCDEFGHIJKL AKIASHORT " + "deadbeef" * 4 + " " + "0123456789abcdef" * 3,
        f"here {key} and {'A' * 30}1 and 550e8400-e29b-41d4-a716-446655440000",
        f"token={key}",
        ("x" * 5000 + " password=hunter22aa ") * 300,
    ]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.scan(frame(spark, texts)).collect()}
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for i, t in enumerate(texts):
        t = t or ""
        want = [("assign", m.start(), m.end()) for m in assign.finditer(t) if len(m[2]) >= 8]
        want += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        want += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        assert sorted(s for s in got[i] if s[0] != "entropy") == sorted(want)
    n = len(edges())
    assert ("entropy", 5, 5 + len(key)) in got[n + 2] and len(got[n + 2]) == 1
    assert [k for k, _, _ in got[n + 3]] == ["assign"]  # the candidate lies inside
    assert secret_scan.scan(frame(spark, texts).limit(0)).count() == 0


def test_window_entropy_is_exact(spark):
    rng = np.random.default_rng(1)
    strings = ["".join(rng.choice(list("abcdefghijklmnop0123456789ABCDEF"), 60)) for _ in range(5)]
    table = secret_scan._TABLE
    for s in strings:
        sums = [sum(table[c] for c in Counter(s[i : i + 24]).values()) for i in range(len(s) - 23)]
        limit = sorted(sums)[len(sums) // 2]
        hot = [i for i, x in enumerate(sums) if x <= limit]
        r = spark.createDataFrame([(s,)], "s string").select(secret_scan.hot_windows(F.col("s"), F.lit(limit).cast("long")).alias("h")).first().h
        assert (r["first"], r["last"]) == (hot[0], hot[-1])


# ------------------------------------------------------------------ 3 and 6


def test_language_id(spark):
    syllables = {"aa": "ka to mi ne su".split(), "bb": "sch ung lich ter ein".split()}
    rng = np.random.default_rng(0)
    texts = [(i, " ".join("".join(rng.choice(syllables[l], 3)) for _ in range(20)), l) for i in range(200) for l in [("aa", "bb")[i % 2]]]
    texts += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !!", None), (None, "kato mine", "aa"), (1003, "kato " * 50_000, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = {r.doc_id: r for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    assert all(got[i].lang_pred == l for i, _, l in texts[:200])
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(200))
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred == "aa" and got[None].held_out is False
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.predict(docs, language_id.fit(none)).collect()} == {"und"}


def test_toxicity(spark):
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for i in range(500):
        words = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            for at in rng.integers(0, 60, 4):
                words[at] = rng.choice(["scumbagge", "vilewretch", "trashpile"])
        texts.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    texts += [(9000, None), (9001, ""), (9002, "alpha " * 50_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("labels", F.lit(1))
    model = toxicity.fit(docs, spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(got[i] >= 0.7) == (i % 4 == 0) for i in held]) > 0.9
    assert max(got[9000], got[9001], got[9002]) < 0.5
    assert toxicity.learn([], []).score("x") == 0.0 and toxicity.learn(["a", "b"], [1, 1]).score("a") == 0.0


# ------------------------------------------------------------------ 4


def brute_lines(texts, m):
    seen, gone = {}, {i: set() for i in range(len(texts))}
    for i, t in enumerate(texts):
        full = [(k, x) for k, x in enumerate((t or "").split("\n")) if x.strip(" \t\r\f\v")]
        for p in range(len(full) - m + 1):
            run = tuple(x for _, x in full[p : p + m])
            if run in seen:
                gone[i].update(range(full[p][0], full[p + m - 1][0] + 1))
            seen.setdefault(run, (i, p))
    return ["\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) if t is not None else None for i, t in enumerate(texts)]


@pytest.mark.parametrize("m", [1, 2, 3, 4])
def test_line_runs(spark, m):
    rng = np.random.default_rng(m)
    texts = edges()[:7] + ["\n".join(rng.choice(["a", "b", "c", "", " "], 12)) for _ in range(25)] + ["a\n\nb\na\n\nb\na\n\nb"]
    out = line_dedup.dedup_lines(frame(spark, texts), min_lines=m)
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].text for i in range(len(texts))] == brute_lines(texts, m)
    assert got[0].node == "x" and set(out.columns) == set(frame(spark, []).columns) | {"n_lines", "runs"}


def test_repeated_rows_of_lines_are_one_document(spark):
    docs = frame(spark, ["a\nb\nc"]).union(frame(spark, ["a\nb\nc"]))
    assert [r.text for r in line_dedup.dedup_lines(docs).collect()] == ["a\nb\nc"] * 2
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ 7


def brute_join(texts, n, share):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("n,share", [(4, 85), (5, 80)])
def test_ngram_join(spark, monkeypatch, n, share):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = np.random.default_rng(n)
    texts = edges()
    passage = sentence(rng, 60)
    for k in range(12):
        base = sentence(rng, int(rng.integers(5, 160))).split() + (passage.split() if k % 3 == 0 else [])
        texts.append(" ".join(base))
        for _ in range(8):  # a chain of edits, so that links are not all direct
            base = list(base)
            for _ in range(max(1, len(base) // 60)):
                base[int(rng.integers(len(base)))] = "edit" + str(rng.integers(1000))
            texts.append(" ".join(base))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_documents(frame(spark, texts), n=n, share=share).collect()}
    assert [got[i] for i in range(len(texts))] == brute_join(texts, n, share)


def test_ngram_join_edges(spark):
    docs = frame(spark, ["one two three four five", None]).union(frame(spark, ["one two three four five"])).union(spark.createDataFrame([(None, "one two three four five", 1, "", "", "", 0.0, "")], SCHEMA))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_documents(docs).collect()), key=str)
    assert got == sorted([(0, 2, 0), (1, 0, 1), (0, 2, 0), (None, 2, 0)], key=str)
    assert ngram_join.near_documents(docs.limit(0)).count() == 0


def test_sketch_distance_bounds_the_difference():
    rng = np.random.default_rng(0)
    bands = ngram_join.Bands(85)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[int(rng.integers(0, 30)) :], rng.integers(0, 2**63, 10).astype(np.uint64)]))
        band = max(bands.of(len(a)))
        cells = bands.cells_for(bands.tops[band])[2]
        differ = (ngram_join.sketch(a, band, cells) != ngram_join.sketch(b, band, cells)).sum()
        assert differ <= len(np.setxor1d(a, b))
    for s in range(1, 400):
        for t in range(s, 100 * s // 85 + 1):
            both = set(bands.of(s)) & set(bands.of(t))
            largest = s + t - 2 * -(-85 * (s + t) // 185)
            assert largest <= 0 or any(bands.cells_for(bands.tops[b])[0] >= largest for b in both)


def test_components_of_long_chains(spark):
    edges_ = [(i, i + 1) for i in range(24)] + [(100, 200), (200, 100), (7, 7)]
    out = connected_components(Workspace(spark, "cc"), spark.createDataFrame(edges_, "a long, b long"))
    assert {r.node: r.component for r in out.collect()} == {**{i: 0 for i in range(25)}, 100: 100, 200: 100}


# ------------------------------------------------------------------ 8


def test_vectors_near_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    rng = np.random.default_rng(0)
    x = []
    for _ in range(150):
        c = rng.normal(size=64)
        x.append(c)
        x += [c + rng.normal(size=64) * s for s in (0.1, 0.25, 0.36, 0.4, 0.6)]
    x += [x[0]] * 50
    label = [i % 2 for i in range(150) for _ in range(6)] + [0] * 50
    data = [(i, v.tolist(), l) for i, (v, l) in enumerate(zip(x, label))]
    data += [(5000, None, 0), (5001, [0.0] * 64, 0), (5002, x[0].tolist(), None), (5003, [float("nan")] * 64, 0), (5004, [1.0], 0), (5005, [None, 1.0], 0)]
    out = embedding_dedup.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("n", F.lit(0)))
    got = {r.vec_id: r for r in out.collect()}
    u = np.array(x) / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(near, False)
    want = near.sum(1)
    have = np.array([got[i].n_links for i in range(len(x))])
    assert (have <= want).all() and have.sum() >= 0.97 * want.sum()
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(5000, 5006))
    assert got[900].component_id == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert embedding_dedup.near_vectors(empty).count() == 0


@pytest.mark.parametrize("n", [3000, 12000])
def test_a_dense_group_of_a_third_of_the_vectors_keeps_its_links(spark, n):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 64))
    x[: n // 3] = rng.normal(size=64) + rng.normal(size=(n // 3, 64)) * 0.2
    docs = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").repartition(4)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.93).sum(1) - 1
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(docs).collect()}
    assert [got[i] for i in range(n)] == want.tolist()


# ------------------------------------------------------------------ 9


def brute_hits(text, items, window=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = low(text), set(), set()
    for name, t in items:
        b = low(t)
        size = min(len(b), window)
        grams = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)} if b else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(str(name))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1 << 24, 300])
def test_decontamination(spark, block):
    rng = np.random.default_rng(5)
    items = [(i, sentence(rng, n)) for i, n in enumerate((30, 13, 14, 50, 3, 1, 12))] + [(20, None), (21, ""), (22, sentence(np.random.default_rng(5), 30))]
    texts = edges()
    for k in range(30):
        words = sentence(rng, 80).split()
        donor = items[k % 7][1].split()
        a = int(rng.integers(0, len(donor)))
        part = donor[a : a + int(rng.integers(1, 25))]
        words[20:20] = [p.upper() + "," for p in part]
        texts.append(" ".join(words))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.find(frame(spark, texts), bench, block_bytes=block).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == brute_hits(t, items)
    assert decontamination.find(frame(spark, texts), bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.find(frame(spark, texts).limit(0), bench).count() == 0


# ------------------------------------------------------------------ 10


@pytest.mark.parametrize("length,digit", [(40, 16), (60, 20)])
def test_repeated_windows(spark, length, digit):
    rng = np.random.default_rng(length)
    shared = sentence(rng, 40)
    texts = edges()
    for k in range(30):
        own = sentence(rng, int(rng.integers(3, 40)))
        a, b = sorted(rng.integers(0, len(shared), 2))
        texts.append(own + "é" * (k % 3) + shared[a:b] + own[: int(rng.integers(0, 60))])
    texts += [shared, shared, "ab" * 300, "z" * 200]
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    got = {r.doc_id: r for r in window_dedup.remove_repeats(frame(spark, texts), length=length, digit=digit).collect()}
    for i, d in enumerate(data):
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if count[d[p : p + length]] > 1:
                gone[p : p + length] = True
        assert bytes(got[i].kept) == bytes(np.frombuffer(d, np.uint8)[~gone])
        assert sum(s.end - s.start for s in got[i].spans) == gone.sum()
        assert hashlib.sha256(bytes(got[i].kept)).hexdigest()
    assert window_dedup.remove_repeats(frame(spark, texts).limit(0)).count() == 0
