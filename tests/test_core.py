"""Scorers and operators against plain Python on small rows."""

import json
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline import record
from plumbline.functions import numbers, text, vector
from plumbline.operators import accounting, attributes, heads, lexical, matching, models, selection, vectors
from plumbline.plans import catalog
from plumbline.plans.indexing import with_position
from plumbline.sources import files, warc
from plumbline.streaming import scores

SF = "/root/testdata/sf0.001"
TEXTS = ["", "   ", "one two three four", "one two three four five", "a " * 51, " ".join(f"w{i}" for i in range(60)), "Größe, ½ naïve; x_y!", "... !!! ---", "word " * 999, "w" * 30 + "é" * 300]


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def docs(spark):
    return table(spark, list(enumerate(TEXTS)), "doc_id long, text string")


def test_ngram_repetition(spark):
    def plain(t, n):
        w = re.sub(r"[^\w\s]", "", t.lower()).split()
        g = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]
        return len(set(g)) / len(g) if g else 0.0

    for n in (1, 5):
        got = {r[0]: r[1] for r in docs(spark).select("doc_id", text.ngram_repetition(F.col("text"), n)).collect()}
        assert got == pytest.approx({i: plain(t, n) for i, t in enumerate(TEXTS)})


def test_mtld_and_hdd(spark):
    got = {r[0]: r[1] for r in docs(spark).select("doc_id", lexical.mtld("text")).collect()}
    assert got[3] is None and got[5] == -1 and got[4] is not None
    hdd = {r[0]: r[1] for r in lexical.hdd(docs(spark)).collect()}
    assert hdd[8] is not None and hdd[3] is None
    assert hdd[5] == pytest.approx(60 * (1 - math.comb(60 - 42, 1) / math.comb(60, 1)) / 42)
    # marks alone are one type, white space of any kind cuts, and no row a word is dealt
    odd = table(spark, [(1, " \tA, a\n\n" + "-- !\x0b" * 30 + "b. "), (2, "x " * 49 + "."), (3, None), (4, "- " * 51), (4, "y " * 1000), (None, "z\n" * 51)], "doc_id long, text string")
    miss = lambda n, f: math.comb(n - f, 42) / math.comb(n, 42)
    got = lexical.hdd(odd)
    assert [(r[0], r[1] and round(r[1], 9)) for r in got.collect()] == [(1, round((3 - miss(63, 2) - miss(63, 60) - miss(63, 1)) / 42, 9)), (2, None), (3, None), (4, round(1 / 42, 9)), (4, None), (None, round(1 / 42, 9))]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_byte_truncation_keeps_whole_characters(spark):
    for limit in (29, 30, 31, 32, 33, 512):
        for r in docs(spark).select("text", text.truncate_bytes(F.col("text"), limit).alias("t")).collect():
            assert r.t == r.text.encode()[:limit].decode("utf-8", "ignore")


def test_normalise_line(spark):
    rows = table(spark, [("  ① “a”—b … 1٣ \x07é  ",)], "t string")
    assert rows.select(text.normalise_line(F.col("t"))).first()[0] == '① "a" - b ... 00 é'
    assert rows.select(text.normalise_line(F.col("t"), accents=True)).first()[0].endswith("e")


def test_replies_and_numbers(spark):
    rows = table(spark, [(" 4.5 because\nno",), ("none",), ("7",), ('[{"tag":"x"}]',), (None,)], "r string")
    assert [r[0] for r in rows.select(text.leading_number(F.col("r"))).collect()] == [4.5, None, 7.0, None, None]
    assert [r[0] for r in rows.select(text.whole_number(F.col("r"))).collect()] == [0, 0, 7, 0, 0]
    assert [r[0] for r in rows.select(text.json_list_length(F.col("r"))).collect()][3] == 1
    v = table(spark, [(0.0,), (123456.0,), (0.00012344,), (-9.9999,)], "x double")
    assert [r[0] for r in v.select(numbers.significant(F.col("x"))).collect()] == [0.0, 123500.0, 0.0001234, -10.0]
    odd = table(spark, [(float("nan"),), (float("inf"),), (float("-inf"),), (0.5,)], "x double")
    assert [r[0] for r in odd.select(numbers.finite(F.col("x"))).collect()] == [0.0, 1.0, 0.0, 0.5]
    assert numbers.metric_name("Langkit", "flesch_reading_ease") == "LangkitFleschReadingEaseScore"


def test_statistics_with_missing_scores(spark):
    rows = table(spark, [(1.0,), (None,), (3.0,)], "s double")
    r = accounting.statistics(rows, "s").first()
    assert (r["num"], r["mean"], r["variance"]) == (3, 2.0, 1.0)
    assert math.isnan(accounting.statistics(rows, "s", nan="propagate").first()["mean"])


def test_positions_and_splits(spark):
    rows = table(spark, [(i * 7 % 53,) for i in range(53)], "k long")
    assert sorted((r.k, r.pos) for r in with_position(rows, "k").collect()) == [(i, i) for i in range(53)]
    assert sorted(r.k for r in selection.slice_rows(rows, "k", 3, 20, 5).collect()) == list(range(53))[3:20:5]
    assert selection.equal_splits(rows, "k", 5).count() == 50
    assert sorted(r.k for r in selection.round_robin(rows, "k", 10).where("split = 3").collect()) == list(range(53))[3::10]


def test_attributes(spark):
    rows = table(spark, [("f", 1, [0]), ("f", 2, [1, 2]), ("f", 3, []), ("f", 4, [3, 4, 5])], "file string, k int, v array<int>")
    got = sorted((r.k, r.len, r.off) for r in attributes.flat_layout(rows, "file", "k", F.col("v")).collect())
    assert got == [(1, 1, 0), (2, 2, 1), (3, 0, 3), (4, 3, 3)]
    other = table(spark, [("f", 10, 0.5), ("f", 20, 0.25)], "file string, j int, score double")
    joined = attributes.positional_join(rows, other, "file", "k", "j")
    assert sorted((r.k, r.score) for r in joined.collect()) == [(1, 0.5), (2, 0.25)]
    names = attributes.match_by_name(table(spark, [("a/b.jsonl",)], "content_file string"), table(spark, [("a/b-attr-q.npy",), ("a/c-attr-q.npy",)], "attribute_file string"), "q")
    assert [r.attribute_file for r in names.collect()] == ["a/b-attr-q.npy"]


def test_vectors_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 6))
    rows = table(spark, [(i, x[i].tolist(), i % 2) for i in range(40)], "vec_id long, embedding array<double>, label int")
    mu, cov = vectors.moments(rows)
    assert np.allclose(mu, x.mean(0)) and np.allclose(cov, np.cov(x.T))
    assert vectors.frechet(rows, rows) == pytest.approx(0, abs=1e-6)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    w = np.linalg.eigvalsh(u @ u.T / 40)
    w = w[w > 1e-12]
    assert vectors.vendi(rows) == pytest.approx(np.exp(-(w * np.log(w)).sum()))
    c = table(spark, [(0, [1.0] * 6), (1, [1.0] * 6), (2, [-1.0] * 6)], "cid long, c_embs array<double>")
    got = {r.vec_id: r.cid for r in vectors.nearest_centroid(rows, c, "cosine").collect()}
    assert got == {i: 0 if x[i].sum() > 0 else 2 for i in range(40)}
    a, b = np.abs(x[0]) + 0.1, np.abs(x[1]) + 0.1
    pair = table(spark, [(a.tolist(), b.tolist())], "a array<double>, b array<double>")
    d = pair.select(*[f(F.col("a"), F.col("b")).alias(k) for k, f in vector.DISTANCES.items()]).first()
    assert d["asymmetric_kl"] == pytest.approx((0.5 * (a / b - 1 + np.log(b) - np.log(a))).sum())
    assert d["correlation"] == pytest.approx(1 - np.corrcoef(a, b)[0, 1])
    zero = table(spark, [([0.0, 0.0],)], "v array<double>")
    assert zero.select(vector.cosine(F.col("v"), F.col("v"))).first()[0] is None


def test_heads(spark):
    rows = table(spark, [([0.0, 0.0, 0.0, 0.0, 0.0, 0.0],)], "x array<double>")
    assert rows.select(heads.expected_rating(F.col("x"))).first()[0] == pytest.approx(3.5)
    one = table(spark, [(2.0, 0.0, "x"), (2.0, 4.0, ""), (2.0, 4.0, "x")], "c double, a double, o string")
    assert [r[0] for r in one.select(heads.following_difficulty(F.col("c"), F.col("a"), F.col("o"))).collect()] == [0.0, None, 0.5]
    n = table(spark, [(10,)], "n int")
    assert n.select(heads.frame_indices(F.col("n"), 2, 2, 3)).first()[0] == [1, 4, 3, 6]  # steps of (10 - 2 * 3 + 1) / 2
    assert n.select(heads.frame_indices(F.col("n"), 2, 4, 3)).first()[0] == [0, 3, 6, 9, 0, 3, 6, 9]  # shorter than a clip


def test_matching(spark):
    rows = table(spark, [(1, [[1.0, 0.0]], [[1.0, 0.0], [0.0, 1.0]])], "k int, hyp array<array<double>>, ref array<array<double>>")
    r = matching.greedy_match(rows, "k").first()
    assert (r.precision, r.recall) == (1.0, 0.5) and r.f == pytest.approx(2 / 3)
    t = table(spark, [("g", i, float(i), float(i * i)) for i in range(6)], "g string, k int, a double, b double")
    assert matching.spearman(t, "g", "a", "b").first()["spearman"] == pytest.approx(1)
    assert matching.kendall(t, "g", "k", "a", "b").first()["kendall"] == pytest.approx(1)


def test_models_never_invent_scores(spark):
    with pytest.raises(models.BackendMissing):
        models.score_with(docs(spark), "FineWebEduScorer", None, ["text"])
    out = models.score_with(docs(spark), "FineWebEduScorer", lambda: lambda c: [float(len(t)) if t else None for t in c["text"]], ["text"])
    got = {r.doc_id: r.FineWebEduScore for r in out.collect()}
    assert got[2] == 18.0 and got[0] is None
    with pytest.raises(KeyError):
        models.SCORERS.get("nothing")
    with pytest.raises(ValueError):
        models.SCORERS.register("ClipScorer", None)
    assert len(models.list_scorers("image")) == 19
    calls = []

    def flaky(row):
        calls.append(row)
        if len(calls) < 3:
            raise ConnectionError
        return 1

    assert models.with_retry(flaky)({}) == 1


def test_record_json(spark, tmp_path):
    rows = table(spark, [(0, 0.123456, None), (1, 12345.6, 0.0)], "item long, a double, b double")
    long = record.long_scores(rows, "item", "S", {"A": "a", "B": "b"})
    record.write(long, None, str(tmp_path / "r"))
    got = {r.item: json.loads(r.json) for r in spark.read.json(str(tmp_path / "r/items")).collect()}
    assert got[0]["S"]["A"] == 0.1235 and got[1]["S"] == {"A": 12350.0, "B": 0.0}


def test_sources(spark, tmp_path):
    (tmp_path / "list.json").write_text('{"metadata": {"x": 1}, "data": [{"a": 1}, {"a": 2}]}')
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "rows.jsonl").write_text('{"a": 3}\n{"a": 4, "b": "x"}\n')
    (tmp_path / "other.txt").write_text("ignored")
    (tmp_path / "m.lst").write_text("x.jsonl\n\n y.jsonl \n")
    assert sorted(r.a for r in files.read_rows(spark, str(tmp_path / "list.json")).collect()) == [1, 2]
    assert sorted(r.a for r in files.read_folder(spark, str(tmp_path)).collect()) == [3, 4]
    assert files.manifest(spark, str(tmp_path / "m.lst")) == ["x.jsonl", "y.jsonl"]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=gb2312\r\n\r\n" + "页".encode("gb18030")
    data = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    (tmp_path / "w.warc").write_bytes(data)
    row = warc.read_warc(spark, str(tmp_path / "w.warc")).first()
    assert (row.url, row.status, row.html) == ("http://x", 200, "页")
    assert warc.read_warc(spark, str(tmp_path / "w.warc")).where(warc.keep_pages(F.col("kind"), F.col("content_type"), F.col("status"))).count() == 1


def test_streams(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.union(e).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    once = scores.run_available(scores.drop_replays(stream, "event_id", "ts", "3650 days"), "once", "append", str(tmp_path / "c1"))
    assert once.count() == e.count()
    w = scores.run_available(scores.windowed(stream, "ts", "value", ["event_type"]), "win", "complete", str(tmp_path / "c2"))
    assert w.agg(F.sum("num")).first()[0] == 2 * e.count()
    scores.write_idempotent(stream, str(tmp_path / "out"), str(tmp_path / "c3")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2 * e.count()


def test_queries_have_stable_columns(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["doc_id", "score"]
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    for name in ("filter_by_label", "sub_path_totals", "json_fields"):
        assert catalog.queries()[name](spark, SF).count() > 0


def test_configured_run(spark, tmp_path):
    from plumbline import cli, sinks

    (tmp_path / "in.jsonl").write_text('{"id": 1, "text": "a b c d e f"}\n{"id": 2, "text": "mail x@y.org now"}\n')
    cfg = {"data": {"path": str(tmp_path / "in.jsonl"), "key": "id"}, "output": str(tmp_path / "out"), "scorers": {"NgramScorer": {"ngrams": 2}, "PresidioScorer": {}, "LangkitScorer": {"metrics_to_keep": {"LangkitLetterCountScore": False}}}}
    (tmp_path / "c.json").write_text(json.dumps(cfg))
    cli.run(spark, cli.Config.load(str(tmp_path / "c.json")))
    got = {r.item: json.loads(r.json) for r in spark.read.json(str(tmp_path / "out/items")).collect()}
    assert got[1]["NgramScorer"] == {"NgramScore": 1.0} and got[2]["PresidioScorer"] == {"PresidioScore": 1.0}
    assert "LangkitLetterCountScore" not in got[1]["LangkitScorer"] and got[1]["LangkitScorer"]["LangkitLexiconCountScore"] == 6.0
    assert sinks.is_published(spark, str(tmp_path / "out/items"))
    cfg["scorers"] = {"Unknown": {}}
    (tmp_path / "c.json").write_text(json.dumps(cfg))
    with pytest.raises(KeyError):
        cli.Config.load(str(tmp_path / "c.json"))


def test_sinks(spark, tmp_path):
    from plumbline import sinks

    rows = table(spark, [("a", 1, True, [1]), ("a", 2, False, []), ("b", 3, None, [2, 3])], "route string, k int, bad boolean, v array<int>")
    counts = {r.route: (r.rows, r.dropped) for r in sinks.write_routed(rows, str(tmp_path / "r"), "route", F.col("bad"), {"k": F.col("k")}).collect()}
    assert counts == {"a": (1, 1), "b": (1, 0), "_": (2, 1)}
    assert spark.read.json(str(tmp_path / "r")).count() == 2
    sinks.write_attribute(rows, str(tmp_path / "v"), "route", "k", "v")
    assert sorted((r.k, r.len, r.off) for r in spark.read.parquet(str(tmp_path / "v")).collect()) == [(1, 1, 0), (2, 0, 1), (3, 2, 0)]
    p = table(spark, [("x/y.jsonl.gz",)], "p string")
    assert p.select(sinks.output_name(F.col("p"))).first()[0] == "y_output.json"
