"""Language model, rank correlation, spectra, sketches, archives, streams and SQL functions against plain versions."""

import gzip
import json
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import sql, text
from plumbline.operators import language_model, matching, models, scorers, spectra, vectors
from plumbline.sources import archives, warc
from plumbline.streaming import scores

# ------------------------------------------------------------------ language model


def plain_model(texts):
    """Interpolated modified Kneser-Ney of orders 1 to 3 with dictionaries."""
    lines = [["<s>", *line.lower().split(), "</s>"] for t in texts for line in t.split("\n")]
    c3 = Counter(tuple(s[i - 2 : i + 1]) for s in lines for i in range(2, len(s)))
    c2 = Counter(g[1:] for g in c3)
    c2.update(tuple(s[:2]) for s in lines)
    c1 = Counter((g[1],) for g in c2)

    def discount(counts):
        t = Counter(counts.values())
        if min(t[k] for k in (1, 2, 3, 4)) == 0:
            return language_model.FALLBACK
        y = t[1] / (t[1] + 2 * t[2])
        d = tuple(k - (k + 1) * y * t[k + 1] / t[k] for k in (1, 2, 3))
        return d if all(0 <= x <= k for k, x in zip((1, 2, 3), d)) else language_model.FALLBACK

    ds = [discount(c) for c in (c1, c2, c3)]
    take = lambda d, c: d[min(c, 3) - 1]
    totals, frees = [defaultdict(float) for _ in range(3)], [defaultdict(float) for _ in range(3)]
    for k, counts in enumerate((c1, c2, c3)):
        for g, c in counts.items():
            totals[k][g[:-1]] += c
            frees[k][g[:-1]] += take(ds[k], c)

    def p(g):
        k = len(g) - 1
        below = 1 / (len(c1) + 1) if k == 0 else p(g[1:])
        h = g[:-1]
        if h not in totals[k]:
            return below
        c = (c1, c2, c3)[k].get(g, 0)
        return (c - take(ds[k], c) if c else 0.0) / totals[k][h] + frees[k][h] / totals[k][h] * below

    def log10(t):
        out, n = 0.0, 0
        for line in t.split("\n"):
            s = ["<s>", *line.lower().split(), "</s>"]
            for i in range(1, len(s)):
                out, n = out + math.log10(p(tuple(s[max(0, i - 2) : i + 1]))), n + 1
        return out, n

    return log10


def test_language_model_equals_a_plain_one(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    texts = ["\n".join(" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randint(0, 12))) for _ in range(rng.randint(1, 4))) for _ in range(200)]
    asked = [*texts[:40], "", "unknown w1 w2", "w1 unknown w2 w3\n\nw0", "w0 " * 50]
    log10 = plain_model(texts)
    model = language_model.train(spark.createDataFrame([(t,) for t in texts], "text string").select(language_model.sentence_words(F.col("text")).alias("s")), "s")
    rows = spark.createDataFrame(list(enumerate(asked)), "id long, text string").select("id", language_model.sentence_words(F.col("text")).alias("s"))
    got = {r.id: r for r in model.score(rows, ["id"], "s").collect()}
    for i, t in enumerate(asked):
        want, n = log10(t)
        assert got[i].length == n and got[i].log10 == pytest.approx(want, abs=1e-9)
    assert sum(r.p for r in model.unigrams.collect()) + model.unknown == pytest.approx(1)
    context = model.bigrams.where("v = '<s>'")
    free = model.free1.where("v = '<s>'").first().free
    rest = model.unigrams.join(context.select("w"), "w", "left_anti").agg(F.sum("p")).first()[0] or 0.0
    assert context.agg(F.sum("p")).first()[0] + free * (rest + model.unknown) == pytest.approx(1)


def test_perplexity_without_a_model_equals_a_plain_one(spark, monkeypatch):
    """Chunks, buckets and parts of a bucket smaller than the texts."""
    monkeypatch.setattr(language_model, "_BUCKET", 400)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    texts = ["\n".join(" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randint(0, 12))) for _ in range(rng.randint(1, 4))) for _ in range(200)]
    asked = [*texts[:40], "", "unknown w1 w2", "w1 unknown w2 w3\n\nw0", "w0 " * 50, None]
    log10 = plain_model(texts)
    sentences = language_model.sentence_words(F.col("text")).alias("s")
    corpus = spark.createDataFrame([(t,) for t in texts], "text string").select(sentences)
    rows = spark.createDataFrame(list(enumerate(asked)), "id long, text string").select("id", sentences)
    got = {r.id: r for r in language_model.perplexity_under(corpus, rows, ["id"], "s").collect()}
    for i, t in enumerate(asked):
        want, n = log10(t or "")
        assert got[i].length == n and got[i].perplexity == pytest.approx(10 ** (-want / n), abs=0.0501)  # given to one place
    with pytest.raises(ValueError):
        language_model.perplexity_under(corpus.limit(0), rows, ["id"], "s")


def test_trigrams_travel_packed(spark, monkeypatch):
    """Different trigrams of one chunk take a few bytes each, and parts of a bucket give what the whole gives."""
    rng = random.Random(3)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 5000}" for _ in range(400)) for _ in range(100)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(language_model.sentence_words(F.col("text")).alias("s")).coalesce(1)
    begin, end = (x % (1 << 64) for x in spark.range(1).select(F.xxhash64(F.lit("<s>")), F.xxhash64(F.lit("</s>"))).first())
    made = [tuple(r)[1:] for kind in (False, True) for r in language_model._pack(rows, "s", 1, kind, begin, end).collect()]
    assert sum(len(x) for r in made[:1] for x in r[2:]) < 7 * made[0][1]
    whole = [(k, {c: None if x is None else np.ma.getdata(x).tolist() for c, x in r.items()}) for k, r in language_model._bucket(made)]
    monkeypatch.setattr(language_model, "_UNPACKED", 5000)
    assert whole == [(k, {c: None if x is None else np.ma.getdata(x).tolist() for c, x in r.items()}) for k, r in language_model._bucket(made)]


def test_language_model_is_kept(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a b a c\nb a"), (2, None)], "id long, text string").select("id", language_model.sentence_words(F.col("text")).alias("s"))
    model = language_model.train(rows, "s")
    model.write(str(tmp_path))
    again = language_model.LanguageModel.read(spark, str(tmp_path))
    key = lambda m: sorted(m.perplexity(rows, ["id"], "s").collect())
    assert key(model) == key(again)
    with pytest.raises(ValueError):
        language_model.train(rows.limit(0), "s")


def test_trigrams_of_a_long_sentence(spark):
    """A sentence of 40 000 words: time in proportion (its shifts, not a copy of it a word)."""
    import time

    rows = spark.createDataFrame([("a b " * 20_000 + "\n\na",)], "text string").select(language_model.sentence_words(F.col("text")).alias("s"))
    began = time.time()
    got = language_model._trigrams(rows, [], "s").groupBy("u", "v", "w").count().collect()
    assert time.time() - began < 20
    a, b, begin, end = spark.range(1).select(*[F.xxhash64(F.lit(x)) for x in ("a", "b", "<s>", "</s>")]).first()
    want = {(None, begin, a): 2, (begin, a, b): 1, (a, b, a): 19_999, (b, a, b): 19_999, (a, b, end): 1, (None, begin, end): 1, (begin, a, end): 1}
    assert {tuple(r)[:3]: r[3] for r in got} == want


# ------------------------------------------------------------------ rank correlation


@pytest.mark.parametrize("n", [1, 2, 9, 700])
def test_weighted_inversions(n):
    rng = np.random.default_rng(n)
    values, weights = rng.permutation(n), rng.integers(1, 5, n)
    want = sum(int(weights[i] * weights[j]) for i in range(n) for j in range(i + 1, n) if values[i] > values[j])
    assert matching._inversions(values, weights) == want


def test_kendall_of_large_groups_equals_pairs(spark):
    rng = random.Random(4)
    rows = [(g, k, float(rng.randint(0, top)), rng.choice([0.0, -0.0, 1.5, rng.random()])) for g, top, n in (("a", 3, 300), ("b", 1000, 200), ("c", 5, 2)) for k in range(n)]
    rows += [("d", k, 1.0, float(k)) for k in range(5)] + [("a", 999, None, 1.0)] + [(None, k, float(k), -float(k)) for k in range(6)]
    t = spark.createDataFrame(rows, "g string, k long, a double, b double")
    got = {r.g: r.kendall for r in matching.kendall_large(t, "g", "a", "b", partitions=5).collect()}
    want = {r.g: r.kendall for r in matching.kendall(t.where("g IS NOT NULL AND a IS NOT NULL"), "g", "k", "a", "b").collect()}
    assert got.pop(None) == pytest.approx(-1)
    assert got.keys() == want.keys()
    assert all(got[g] is None if want[g] is None else got[g] == pytest.approx(want[g]) for g in want)


def test_match_with_frequencies_of_a_corpus(spark):
    """Weights are those of the corpus, unseen tokens take theirs, and repeated tokens count each time."""
    corpus = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "c"]), (3, ["a"])], "id long, w array<string>")
    idf = matching.inverse_frequencies(corpus, "id", F.col("w"))
    x = {"a": [1.0, 0.0], "b": [0.0, 1.0], "new": [0.6, 0.8]}
    vec = spark.createDataFrame(list(x.items()), "token string, vec array<double>")
    pairs = spark.createDataFrame([(1, ["a", "b", "b"], ["new", "a"]), (None, ["b"], ["b"])], "k long, h array<string>, r array<string>")
    got = {g.k: g for g in matching.weighted_scores(pairs, ["k"], "h", "r", vec, idf).collect()}
    w = {"a": math.log(4 / 4), "b": math.log(4 / 2), "new": math.log(4.0)}
    dot = lambda s, t: sum(p * q for p, q in zip(x[s], x[t]))
    side = lambda s, t: sum(w[u] * max(dot(u, v) for v in t) for u in s) / sum(w[u] for u in s)
    assert got[1].precision == pytest.approx(side(["a", "b", "b"], ["new", "a"]))
    assert got[1].recall == pytest.approx(side(["new", "a"], ["a", "b", "b"]))
    assert got[None].f == pytest.approx(1)


# ------------------------------------------------------------------ vectors


def some_vectors(spark, n, d, seed, shift=0.0):
    x = np.random.default_rng(seed).normal(shift, 1, (n, d))
    return x, spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")


def test_moments_in_squares(spark):
    x, df = some_vectors(spark, 40, 600, 0)
    n, s, g = vectors.second_moments(df.repartition(3))
    assert n == 40 and np.allclose(s, x.sum(0)) and np.allclose(g, x.T @ x)
    n, s, g = vectors.second_moments(df.limit(0))
    assert n == 0 and len(s) == 0


def test_sketched_kernel_distance(spark):
    (_, a), (_, b) = some_vectors(spark, 200, 64, 1), some_vectors(spark, 150, 64, 2, 0.3)
    want = vectors.kernel_distance(a, b)
    got, error = vectors.kernel_distance_sketch(a, b, width=2048, repeats=6)
    assert abs(got - want) < max(5 * error, 1e-9) and error < 0.1 * want
    # at 2048 components: against all pairs
    (x, a), (y, b) = some_vectors(spark, 60, 2048, 3), some_vectors(spark, 50, 2048, 4, 0.3)
    want = vectors.cubic_discrepancy(x, y)
    got, error = vectors.kernel_distance_sketch(a, b, width=8192, repeats=4)
    assert got == pytest.approx(want, rel=0.05)


def test_null_vectors_are_left_out(spark):
    """A null vector or one with a null component has no centroid and is no part of a set."""
    _, df = some_vectors(spark, 30, 4, 5)
    more = spark.createDataFrame([(100, None), (101, [1.0, None, 0.0, 0.0])], "vec_id long, embedding array<double>")
    both = df.unionByName(more)
    assert vectors.vendi(both) == pytest.approx(vectors.vendi(df))
    assert vectors.frechet(both, df) == pytest.approx(0, abs=1e-9)
    assert vectors.kernel_distance(both, df) == pytest.approx(vectors.kernel_distance(df, df))
    centroids = df.limit(3).select(F.col("vec_id").alias("cid"), F.col("embedding").alias("c_embs"))
    got = {r.vec_id: r.cid for r in vectors.nearest_centroid(both, centroids.unionByName(more.toDF("cid", "c_embs"))).collect()}
    assert len(got) == 32 and got[100] is None and got[101] is None and got[5] is not None


def test_matching_in_batches(spark):
    """Equal rows stand each other by, null vectors are no partners, and a text's words are looked up once for all its pairs."""
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.6, 0.8]), ("c", [0.0, 1.0])], "token string, vec array<double>")
    idf = spark.createDataFrame([("a", 1, 2.0, 5.0), ("b", 1, 1.0, 5.0)], "token string, df long, idf double, unseen_idf double")
    texts = spark.createDataFrame([(1, ["a", "b", "a"]), (1, ["a", "b", "a"]), (2, ["c", "x"]), (3, ["x"]), (4, [])], "k int, w array<string>")
    rows = matching.weighted_tokens(texts, ["k"], ["w"], vec, idf)
    assert sorted(r.k for r in rows.collect()) == [1, 1, 2, 3, 4]
    left = rows.where("k = 1").select(F.col("w_vec").alias("h"), F.col("w_idf").alias("hw"))
    pairs = left.crossJoin(rows.select("k", F.col("w_vec").alias("r"), F.col("w_idf").alias("rw")))
    got = matching.greedy_match(pairs, "k", "h", "r", "hw", "rw").collect()
    assert len(got) == 10
    for r in got:
        if r.k == 1:
            assert (r.precision, r.recall, r.f) == (pytest.approx(1), pytest.approx(1), pytest.approx(1))
        elif r.k == 2:  # a: 0, b: 0.8, a: 0; x has no vector, so no mean of the other side
            assert (r.precision, r.recall, r.f) == (pytest.approx(0.8 / 5), None, None)
        else:
            assert (r.precision, r.recall, r.f) == (None, None, None)


def test_spectrum_of_texts(spark, monkeypatch):
    monkeypatch.setattr(spectra, "ROWS", 100)
    monkeypatch.setattr(spectra, "COLUMNS", 500)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(80)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(80)], k=rng.randint(0, 40))) for _ in range(230)]
    texts += texts[:20] * 2  # copies
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    want = vectors.vendi_ngrams(df, "id", text.words(F.col("text")))
    got, error = spectra.vendi_of_texts(df, text.words(F.col("text")), "id")
    assert got == pytest.approx(want, rel=0.01) and error < 0.01
    assert math.isnan(spectra.vendi_of_texts(df.limit(0), text.words(F.col("text")), "id")[0])


def test_buckets_of_columns_hold_the_similarities(spark, monkeypatch):
    """Blocks of many buckets times all unit vectors are the similarities, and what copies share is one number a bucket."""
    monkeypatch.setattr(spectra, "ROWS", 10)
    monkeypatch.setattr(spectra, "_BUCKET", 100)
    monkeypatch.setattr(spectra, "_CHUNK", 50)
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 12))) for _ in range(40)] + [" ".join(f"w{i}" for i in range(300))] * 2 + [None, "a a a a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    blocks, scales, n, trace = spectra.sparse_rows(df, text.words(F.col("text")), (1, 2), "id")
    units = spark.createDataFrame([(i // 10, np.eye(n)[i : i + 10].tobytes()) for i in range(0, n, 10)], "rb int, x binary")
    made = {r.rb: r.y for r in spectra._multiply(blocks, units, scales, n, n, 2).collect()}
    got = np.concatenate([np.frombuffer(made[b], np.float64).reshape(-1, n) for b in sorted(made)])
    grams = [[Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for k in (1, 2)] for w in ((t or "").split() for t in texts)]
    cosine = lambda a, b: sum(c * b[g] for g, c in a.items()) / math.sqrt(sum(c * c for c in a.values()) * sum(c * c for c in b.values())) if a and b else 0.0
    assert np.allclose(got, [[sum(map(cosine, a, b)) / 2 for b in grams] for a in grams]) and trace == pytest.approx(np.trace(got))
    pairs = sum(int(((spectra._numbers(r.a, np.int32) == 40) & (spectra._numbers(r.b, np.int32) == 41)).sum()) for r in blocks.where("k = 2").collect())
    assert 0 < pairs <= 2 * blocks.where("k = 2").count() < 100


def test_chunks_of_texts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(spectra, "_CHUNK", 5)
    monkeypatch.setattr(spectra, "_TEXTS", 3)
    lists = [[1, 2], [], [3] * 12, [4], [], [], [5], [6, 7, 8, 9, 10]]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, b)), pa.array(lists[a:b], pa.list_(pa.int64()))], names=["pos", "h"]) for a, b in ((0, 5), (5, 8))]
    got = list(spectra._chunks(batches))
    assert [h[of == i].tolist() for pos, of, h in got for i in range(len(pos))] == lists
    assert np.concatenate([pos for pos, _, _ in got]).tolist() == list(range(8)) and max(len(pos) for pos, _, _ in got) <= 3


def test_large_sets_of_texts_take_the_quadrature(spark, monkeypatch):
    monkeypatch.setattr(scorers, "EXACT_TEXTS", 20)
    df = spark.createDataFrame([(i, f"a b c w{i % 7} d") for i in range(40)], "id long, text string")
    made = {r.metric: r.score for r in scorers.Scorer("VendiScorer", ["text"]).plan(df, "id").collect()}
    assert made["N-grams_VendiScore"] == pytest.approx(vectors.vendi_ngrams(df, "id", text.words(F.col("text"))), rel=0.02)
    assert made["N-grams_VendiScoreError"] < 0.02


# ------------------------------------------------------------------ archives and documents


def pages(n, big=0):
    rng = random.Random(9)
    return [(f"http://h{i % 5}.example/{i}", "<p>" + "".join(rng.choice("abcdef é\n") for _ in range(rng.randint(0, 3000))) + "x" * (big if i == 3 else 0), 200 if i % 4 else 404) for i in range(n)]


def test_archives_in_parts(spark, tmp_path):
    rows = pages(400, 300_000)
    archives.write_members(spark.createDataFrame(rows, "url string, html string, status int").coalesce(2), f"{tmp_path}/a", kind="warc")
    for split in (1000, 50_000, 128 << 20):
        found = archives.read_archives(spark, f"{tmp_path}/a", split=split)
        assert sorted((r.url, r.html, r.status) for r in found.collect()) == sorted(rows)
    good = archives.read_archives(spark, f"{tmp_path}/a", ["url", "kind", "status"]).where("status < 400 AND kind = 'response' AND url LIKE 'http://h1%'")
    assert sorted(r.url for r in good.collect()) == sorted(u for u, _, s in rows if s < 400 and u.startswith("http://h1"))
    whole = [r for f, _ in archives.listed(f"{tmp_path}/a") for r in warc.parse(open(f, "rb").read())]
    assert sorted((r[0], r[5]) for r in whole) == sorted((u, h) for u, h, _ in rows)


def test_conditions_reach_the_archive(spark, tmp_path):
    archives.write_members(spark.createDataFrame(pages(5), "url string, html string, status int"), f"{tmp_path}/a", kind="warc")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = archives.ArchiveReader(f"{tmp_path}/a", ["url", "status"], 1 << 20)
    from pyspark.sql.datasource import EqualTo, LessThan, Not

    left = list(reader.pushFilters([LessThan(("status",), 400), EqualTo(("html",), "x"), Not(EqualTo(("kind",), "request"))]))
    assert [f.attribute for f in left] == [("html",)] and len(reader.filters) == 2
    plan = archives.read_archives(spark, f"{tmp_path}/a", ["url", "status"]).where("status < 400")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]


def test_odd_archives(spark, tmp_path):
    """Several records in a member, archives without compression, members cut off, empty files."""
    raw = b"".join(archives.record({"url": f"http://x/{i}", "html": f"é{i}"}, "-") for i in range(5))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "plain.warc").write_bytes(raw)
    (tmp_path / "b" / "one.warc.gz").write_bytes(gzip.compress(raw))
    (tmp_path / "b" / "cut.warc.gz").write_bytes(gzip.compress(raw)[:-40] if len(gzip.compress(raw)) > 40 else b"")
    (tmp_path / "b" / "empty.warc.gz").write_bytes(b"")
    found = archives.read_archives(spark, f"{tmp_path}/b/plain.warc").unionByName(archives.read_archives(spark, f"{tmp_path}/b/one.warc.gz"))
    assert found.groupBy("url", "html").count().where("count = 2").count() == 5
    assert archives.read_archives(spark, f"{tmp_path}/b", split=64).where("url = 'http://x/0'").count() >= 2


def test_documents_hold_their_addresses(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab é\n\"") for _ in range(rng.choice([0, 1, 40, 900, 20_000]))), f"old?bytes={i},1" if i % 3 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, text string, doc_loc string")
    archives.write_members(df.repartition(3), f"{tmp_path}/d", roll=30_000)
    files = [f for f, _ in archives.listed(f"{tmp_path}/d")]
    assert len(files) > 3 and not list((tmp_path / "d").glob("_pending*"))
    written = spark.read.schema("id long, text string, doc_loc string, track_loc array<string>").json(f"{tmp_path}/d")
    assert sorted((r.id, r.text, r.track_loc[-1] if r.track_loc else None) for r in written.collect()) == sorted(rows, key=str) or {(r.id, r.text) for r in written.collect()} == {r[:2] for r in rows}
    back = archives.members_at(written, "doc_loc").collect()
    assert len(back) == 300 and all(json.loads(r.value)["doc_loc"] == r.loc for r in back)
    assert {json.loads(r.value)["id"]: json.loads(r.value)["text"] for r in back} == {r[0]: r[1] for r in rows}


def test_lengths_are_fixed_points():
    for n in range(1, 400):
        loc, data = archives.addressed(lambda at, n=n: (at * n).encode(), "/p/f.gz", 10**n if n < 12 else n)
        assert int(loc.rpartition(",")[2]) == len(data)
        assert gzip.decompress(data) == (loc * n).encode()


def test_routed_counts_equal_a_second_read(spark, tmp_path):
    rows = [(i, f"r{i % 70}" if i % 9 else None, i % 5 == 0, float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, route string, gone boolean, size double")
    archives.write_members(df.repartition(2), f"{tmp_path}/r", route="route", dropped="gone", sums="size", roll=2000)
    counts = archives.written_counts(f"{tmp_path}/r")
    read = spark.read.option("recursiveFileLookup", True).schema("id long, size double, doc_loc string").json(f"{tmp_path}/r")
    got = {r.route or "": (r.n, r.s) for r in read.join(df.select("id", "route"), "id").groupBy("route").agg(F.count("*").alias("n"), F.sum("size").alias("s")).collect()}
    assert {r: (c["rows"], c["size"]) for r, c in counts.items() if c["rows"]} == got
    assert sum(c["dropped"] for c in counts.values()) == 100
    assert read.where("doc_loc NOT LIKE '%/r/%'").count() == 0


# ------------------------------------------------------------------ batches, streams, SQL


def test_batches_by_length(spark):
    assert models.length_batches([9, 9, 4, 3, 1, 1], 18) == [(0, 2), (2, 6)]
    assert models.length_batches([50, 2], 10) == [(0, 1), (1, 2)] and models.length_batches([], 10) == []
    rows = [(i, "x" * (i * 7 % 13)) for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("n", F.length("text"))
    calls = lambda: lambda c: [float(len(t or "")) for t in c["text"]]
    name = "FineWebEduScorer"
    metric = models.metrics_of(name)[0]
    got = {r.id: r[metric] for r in models.score_by_length(df, name, calls, ["text"], "n", 30).collect()}
    assert got == {i: float(len(t or "")) for i, t in rows}


EVENTS = "event_id long, ts timestamp, value double, kind string"


def shuffled_files(spark, path, n=400, files=4, replays=2):
    """Events of a whole day dealt to files at random, and some of them again in other files."""
    rng = random.Random(6)
    rows = [(i, float(i % 17), "ab"[i % 2]) for i in range(n)]
    dealt = [(r, rng.randrange(files)) for r in rows]
    dealt += [(rows[k * 7], (dealt[k * 7][1] + 1) % files) for k in range(replays)]
    df = spark.createDataFrame([(*r, f) for r, f in dealt], "event_id long, value double, kind string, f int")
    df = df.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.col("event_id") * 7919, F.lit(86400)))).select("event_id", "ts", "value", "kind", "f")
    for f in range(files):
        df.where(f"f = {f}").drop("f").coalesce(1).write.mode("append").parquet(path)
    return df.drop("f").distinct()


def test_streams_of_several_files_lose_nothing(spark, tmp_path):
    events = shuffled_files(spark, f"{tmp_path}/e")
    plan = lambda late: lambda rows: scores.drop_replays(rows, "event_id", "ts", late).select("event_id", "value")
    late = scores.covering_delay(events, "ts")
    got = scores.drain(spark, f"{tmp_path}/e", EVENTS, plan(late), "t", per_batch=1)
    assert sorted(r.event_id for r in got.collect()) == list(range(400))
    got = scores.drain(spark, f"{tmp_path}/e", EVENTS, plan(None), "t", per_batch=1)
    assert sorted(r.event_id for r in got.collect()) == list(range(400))
    with pytest.raises(scores.LateRows):
        scores.drain(spark, f"{tmp_path}/e", EVENTS, plan("1 hour"), "t", per_batch=1)
    some = scores.drain(spark, f"{tmp_path}/e", EVENTS, plan("1 hour"), "t", per_batch=1, allow_late=True)
    assert 0 < some.count() < 400


def test_windows_over_several_batches(spark, tmp_path):
    events = shuffled_files(spark, f"{tmp_path}/e", replays=0)
    late = scores.covering_delay(events, "ts")
    plan = lambda rows: scores.windowed(rows, "ts", "value", ["kind"], late=late)
    got = scores.drain(spark, f"{tmp_path}/e", EVENTS, plan, "w", mode="update", per_batch=1, keys=["window_start", "kind"])
    want = scores.windowed(events, "ts", "value", ["kind"])
    key = lambda df: sorted((r.window_start, r.kind, r.num, round(r["mean"], 9), r.min, r.max) for r in df.collect())
    assert key(got) == key(want)


def test_commits_are_contiguous(spark, tmp_path):
    """Messages sent, sent again and acknowledged over several batches, late ones too, equal what one batch says."""
    from plumbline.streaming import queue

    rng = random.Random(8)
    rows = [(p, o, "sent") for p in (0, 1, 2) for o in range(60)]
    acked = [(p, o) for p, o, _ in rows if p == 2 or (o % 10 and (p, o) != (1, 3))]
    rows += [(p, o, "done") for p, o in acked] + rng.sample(rows, 20)
    rng.shuffle(rows)
    schema = "part int, off long, what string"
    for k in range(4):
        spark.createDataFrame(rows[k::4], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/q")
    plan = lambda e: queue.message_states(e, ["part", "off"], F.col("what") == "done")
    states = scores.drain(spark, f"{tmp_path}/q", schema, plan, "q", mode="update", per_batch=1, keys=["part", "off"])
    points = queue.commit_points(states, "part", "off")
    got = {r.part: (r.commit, r.waiting) for r in points.collect()}
    done = set(acked)
    for p in (0, 1, 2):
        first = next((o for o in range(60) if (p, o) not in done), 60)
        assert got[p] == (first, sum((p, o) in done for o in range(first, 60)))
    assert {r.part for r in queue.stalled(points, 15).collect()} == {0, 1} and queue.stalled(points, 100).count() == 0


def test_requests_and_ratings(spark):
    from plumbline.operators import heads

    df = spark.createDataFrame([(1, "a" * 30, "en"), (2, " \n", "en"), (3, None, "en"), (4, "x", "zz"), (5, "x", None), (6, "éé", "en")], "id int, t string, l string")
    got = {r.id: r.r for r in df.select("id", heads.service_request(F.col("t"), F.col("l"), ["en"], 3).alias("r")).collect()}
    assert got == {1: "aaa", 2: None, 3: None, 4: None, 5: None, 6: "é"}
    rated = df.select("id", heads.rated_when_given(F.array(F.lit(0.0), F.lit(0.0)), F.col("t"), F.col("l")).alias("r")).collect()
    assert {r.id: r.r for r in rated} == {1: 1.5, 2: 1.5, 3: None, 4: 1.5, 5: None, 6: 1.5}


def test_table_functions(spark):
    sql.register(spark)
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "f"), (2, ""), (3, None), (None, "x  y")], "doc_id long, text string")
    got = spark.sql("SELECT * FROM chunks(TABLE({d}) PARTITION BY (doc_id), 2)", d=docs).collect()
    assert sorted((r.doc_id or 0, r.chunk, r.n_words, r.chunk_text) for r in got) == [(0, 0, 2, "x y"), (1, 0, 1, "f"), (1, 0, 2, "a b"), (1, 1, 2, "c d"), (1, 2, 1, "e")]
    twice = docs.unionByName(docs)
    assert spark.sql("SELECT * FROM deduplicated(TABLE({d}) PARTITION BY (doc_id))", d=twice).count() == 5
    s = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 2.0)], "grp string, score double")
    got = {r.grp: (r.num, r.max, r.total, r.squares) for r in spark.sql("SELECT * FROM moments(TABLE({s}) PARTITION BY (grp))", s=s).collect()}
    assert got == {"a": (2, 3.0, 4.0, 10.0), "b": (0, None, 0.0, 0.0), None: (1, 2.0, 2.0, 4.0)}
    with pytest.raises(Exception, match="size of at least"):
        spark.sql("SELECT * FROM chunks(TABLE({d}) PARTITION BY (doc_id), 0)", d=docs).collect()
