"""Plans that must hold beyond one task: positions, running sums, closed forms, blocks, addresses."""

import json

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline import sinks
from plumbline.functions import nested, text
from plumbline.operators import accounting, attributes, heads, lexical, matching, models, scorers, selection, vectors
from plumbline.plans.indexing import with_position, with_running
from plumbline.sources import files, objects
from plumbline.streaming import queue, scores

SF = "/root/testdata/sf0.001"


def test_positions_are_a_permutation_beyond_the_sampler(spark):
    n = 300_000
    rows = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(n)).alias("k"), "id")
    for _ in range(2):
        got = with_position(rows, "k", "id", partitions=7)
        r = got.agg(F.count_distinct("pos").alias("d"), F.min("pos").alias("a"), F.max("pos").alias("b")).first()
        assert (r.d, r.a, r.b) == (n, 0, n - 1)
        ordered = got.where("pos < 2000").orderBy("pos").collect()
        assert [(r.k, r.id) for r in ordered] == sorted((r.k, r.id) for r in ordered)
    sizes = [r[1] for r in selection.equal_splits(rows, "k", 7).groupBy("split").count().collect()]
    assert sizes == [n // 7] * 7


def test_running_sums_of_a_group_that_holds_most_rows(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, None).otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), "id", (F.col("id") % 13).alias("v"))
    got = with_running(rows, "g", ["id"], pos="pos", sums={"before": F.col("v")}, partitions=9)
    w = Window.partitionBy("g").orderBy("id")
    want = rows.withColumn("pos", F.row_number().over(w) - 1).withColumn("before", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    assert got.count() == 40_000 and got.select("g", "id", "pos", "before").exceptAll(want.select("g", "id", "pos", "before")).isEmpty()
    assert with_running(rows.limit(0), "g", ["id"], pos="pos").count() == 0


def test_running_sums_beside_columns_with_the_same_names(spark):
    from plumbline.operators import accounting

    rows = spark.range(100).select((F.col("id") % 3).alias("g"), "id", F.lit(7).alias("__size"), F.lit(8).alias("__b0"), F.lit(9).alias("__p"))
    got = with_running(rows, "g", ["id"], pos="pos", size="n").where("id = 99").first()
    assert (got["pos"], got["n"], got["__size"], got["__b0"], got["__p"]) == (33, 34, 7, 8, 9)
    texts = spark.createDataFrame([("a", i, "x " * (i + 1)) for i in range(12)] + [("b", 1, None), (None, 1, "x y")], "s string, id long, t string")
    got = {r.s: r for r in accounting.token_estimate(texts, "s", "t", "id", 5, F.col("id") % 2 == 0).collect()}
    # of the rows 0, 2, 4, 6, 8, 10 that survive, the first and the sixth are counted: 1 + 11 words, 2 + 22 bytes of 156
    assert (got["a"].lines, got["a"].tokens, got["a"].bytes, got["a"].estimate) == (12, 12, 24, 39)
    assert (got["b"].lines, got["b"].tokens, got["b"].remained, got["b"].estimate) == (1, None, 0.0, None) and got[None].lines == 1


def vectors_of(spark, x, labels):
    return spark.createDataFrame([(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(x, labels))], "vec_id long, embedding array<double>, label int").repartition(3)


def test_closed_forms_equal_all_pairs(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(90, 5))
    x[7] = x[4]  # equal vectors of a class are at distance zero and do not count
    rows = vectors_of(spark, x, np.arange(90) % 3)
    got = {r.label: r for r in vectors.class_distance_statistics(rows, "label").collect()}
    for label in range(3):
        u = x[label::3] / np.linalg.norm(x[label::3], axis=1, keepdims=True)
        d = (1 - u @ u.T)[np.triu_indices(30, 1)]
        d = d[d > 1e-12]
        assert got[label].n == len(d) and (got[label]["mean"], got[label]["std"]) == (pytest.approx(d.mean()), pytest.approx(d.std()))
    a, b = rows.where("vec_id < 40"), rows.where("vec_id >= 40")
    assert vectors.kernel_distance(a, b) == pytest.approx(vectors.cubic_discrepancy(x[:40], x[40:]))
    odd = spark.createDataFrame([(100, None, 0), (101, [0.0] * 5, 0), (102, [1.0, None, 0.0, 0.0, 0.0], 0)], rows.schema)
    d = 1 - (x[:40] / np.linalg.norm(x[:40], axis=1, keepdims=True)) @ (x[40:] / np.linalg.norm(x[40:], axis=1, keepdims=True)).T
    for left, right, n in ((a, b, 2000), (a.union(odd), b, 2150), (odd, b, 150), (a, b.limit(0), 0)):
        got = vectors.cross_distance_statistics(left, right).first()
        want = vectors.distance_statistics(vectors.cross_distances(left, right, "normalized_cosine"), keep_zero=True).first()
        assert got.n == want.n == n and tuple(got[1:]) == (pytest.approx(tuple(want[1:]), abs=1e-9) if want["mean"] is not None else (None, None, None))
    assert vectors.cross_distance_statistics(a, b).first()["std"] == pytest.approx(d.std())
    r = vectors.kernel_distance_subsets(a, b, 5, 30).first()
    assert r.subsets == 5 and abs(r["mean"] - vectors.kernel_distance(a, b)) < 4 * r["std"] + 1
    q = vectors.normalised(rows).groupBy("i").agg(F.avg(F.col("x") * F.col("x")).alias("q")).collect()
    assert all(x.q == pytest.approx(1) for x in q)


def test_centroids_in_blocks(spark):
    rng = np.random.default_rng(1)
    rows = vectors_of(spark, rng.normal(size=(50, 6)), np.zeros(50))
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.repeat(rng.normal(size=(8, 6)), 2, 0))], "cid long, c_embs array<double>")
    for metric in ("l2_norm", "dot_product", "cosine"):
        whole = vectors.nearest_centroid(rows, c, metric).collect()
        blocks = vectors.nearest_centroid(rows, c, metric, block_bytes=100).collect()
        assert sorted(whole) == sorted(blocks) and all(r.cid % 2 == 0 for r in whole)


def test_samples_with_and_without_replacement(spark):
    rows = spark.range(500).select(F.col("id").alias("k"))
    one = vectors.draw_samples(rows, "k", 4, 60, seed=3)
    assert [r[1] for r in one.groupBy("sample").agg(F.count_distinct("k")).collect()] == [60] * 4
    assert sorted(one.collect()) == sorted(vectors.draw_samples(rows.repartition(5), "k", 4, 60, seed=3).collect())
    again = vectors.draw_samples(rows, "k", 2, 500, replace=True)
    assert again.count() == 1000 and again.where("sample = 0").distinct().count() < 500


def test_lexical_scores_by_name(spark):
    words = [f"w{i % 37}" for i in range(200)]
    rows = spark.createDataFrame([(0, " ".join(words)), (1, "short"), (2, None)], "doc_id long, t string")
    got = {(r.item, r.metric): r.score for r in scorers.Scorer("LexicalDiversityScorer", ["t"]).plan(rows, "doc_id").collect()}
    assert got[0, "LexicalDiversityHD-DScore"] == pytest.approx(lexical.hdd(rows, text="t").where("doc_id = 0").first().hdd, rel=1e-3)
    assert got[1, "LexicalDiversityMTLDScore"] is None and got[2, "LexicalDiversityHD-DScore"] is None

    def passes(tokens):
        full, types, n = 0, set(), 0
        for t in tokens:
            types.add(t)
            n += 1
            if len(types) / n <= 0.72:
                full, types, n = full + 1, set(), 0
        return len(tokens) / (full + (1 - (len(types) / n if n else 1.0)) / 0.28)

    assert rows.select(lexical.mtld(F.col("t"))).first()[0] == pytest.approx((passes(words) + passes(words[::-1])) / 2)
    stats = rows.select(lexical.text_statistics(F.col("t")).alias("s")).select(*[c.alias(k) for k, c in lexical.readability(F.col("s")).items()]).collect()
    assert stats[0].lexicon_count == 200 and stats[0].aggregate_reading_level is not None and stats[2].lexicon_count is None or stats[2].lexicon_count == 0


def test_scorers_of_whole_tables_and_of_several_metrics(spark):
    rng = np.random.default_rng(2)
    rows = vectors_of(spark, rng.normal(size=(60, 4)), np.zeros(60))
    for name in ("FIDScorer", "KIDScorer"):
        out = scorers.Scorer(name, ["embedding"], {"reference": rows, "subsets": 3, "subset_size": 20}).plan(rows, "vec_id").collect()
        assert all(r.scorer == name for r in out) and len(out) == (1 if name == "FIDScorer" else 2)
    p = rows.withColumn("p", F.transform("embedding", lambda x: F.exp(x)))
    p = p.withColumn("p", F.transform("p", lambda x: x / F.aggregate("p", F.lit(0.0), lambda a, y: a + y)))
    assert {r.metric for r in scorers.Scorer("ISScorer", ["p"], {"splits": 3}).plan(p, "vec_id").collect()} == {"mean", "std"}
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c d e", "a b c d e", "x y z u v"])], "k long, t string")
    assert scorers.Scorer("VendiScorer", ["t"]).plan(texts, "k").first().score == pytest.approx(np.exp(-(2 / 3 * np.log(2 / 3) + 1 / 3 * np.log(1 / 3))), abs=0.01)
    task = scorers.Scorer("Task2VecScorer", ["t"], {"backend": lambda: lambda ts: [float(len(t)) + 1 for t in ts[:2]], "sample_nums": 3, "sample_size": 2, "key": "k"})
    assert {r.metric for r in task.plan(texts, "k").collect()} == {"Task2VecDiversityScore", "ConfidenceInterval"}
    with pytest.raises(models.BackendMissing):
        scorers.Scorer("Task2VecScorer", ["t"]).plan(texts, "k")
    several = scorers.Scorer("UnievalScorer", ["t"], {"backend": lambda: lambda c: {"UniEvalFluencyScore": [0.5] * len(c["t"])}, "metrics_to_keep": {"UniEvalFluencyScore": True}})
    assert {(r.metric, r.score) for r in several.plan(texts, "k").collect()} == {("UniEvalFluencyScore", 0.5)}
    typed = models.score_with(texts, "TopiqScorer", lambda: lambda c: [1.0] * len(c["t"]), ["t"], options={"type": "nr"})
    assert "topiq_nr" in typed.columns
    skipped = models.score_with(texts, "EMScorer", lambda: lambda c: {}, ["t"]).first()
    assert skipped.cogr is None
    named = models.output_columns(typed.withColumn("id", F.col("k")), "cls", ["topiq_nr"], postfix="v2")
    assert named.columns == ["id", "cls_topiq_nr_v2"]
    mixed = spark.createDataFrame([(0, "S", "Default", None), (0, "S", "named", 1.0), (0, "T", "Default", 2.0)], "item long, scorer string, metric string, score double")
    assert {(r.scorer, r.metric) for r in scorers.without_default(mixed).collect()} == {("S", "named"), ("T", "Default")}


def test_lines_by_address(spark, tmp_path):
    lines = [json.dumps({"i": i, "t": "ü" * (i % 7)}, ensure_ascii=False) for i in range(500)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (tmp_path / "a" / "y.jsonl").write_text("one\ntwo\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        ranges = objects.read_ranges(spark, str(tmp_path / "a"), "*.jsonl")
        got = {r.line: r for r in ranges.where(F.col("file").endswith("x.jsonl")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    data = (tmp_path / "a" / "x.jsonl").read_bytes()
    assert len(got) == 500
    for i, r in got.items():
        assert r.value == lines[i] and data[r.offset : r.offset + r.n_bytes].decode() == lines[i] + "\n"
    assert objects.read_row(spark, got[123].loc) == lines[123]
    wanted = spark.createDataFrame([(got[7].loc,), (got[8].loc,)], "loc string")
    assert {r.value for r in objects.rows_at(ranges, wanted).collect()} == {lines[7], lines[8]}
    assert objects.list_files(spark, str(tmp_path / "a")).count() == 2 and objects.list_files(spark, str(tmp_path / "a"), limit=1).count() == 1
    assert objects.read_records(spark, str(tmp_path / "a" / "y.jsonl")).count() == 2
    with pytest.raises(ValueError):
        objects.read_records(spark, "x.7z")


def test_storage_settings():
    buckets = {"[default]": {"access_key": "a", "secret_key": "b", "endpoint": "http://e"}, "other": {"access_key": "c", "secret_key": "b", "endpoint": "http://e"}}
    assert objects.spark_settings(buckets) == {"spark.hadoop.fs.s3a.access.key": "a", "spark.hadoop.fs.s3a.secret.key": "b", "spark.hadoop.fs.s3a.endpoint": "http://e", "spark.hadoop.fs.s3a.bucket.other.access.key": "c"}
    assert objects.profile_of("other", buckets)["access_key"] == "c" and objects.profile_of("p-1", buckets, {"p-": {"access_key": "d"}})["access_key"] == "d"
    assert objects.profile_of("none", buckets)["access_key"] == "a"


def test_media_by_path_and_pictures(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "1.jpg").write_bytes(b"\xff\xd8\xff" + folder.encode())
    meta = spark.createDataFrame([("a/1.jpg",), ("b/1.jpg",), (f"{tmp_path}/b/1.jpg",), ("c/1.jpg",)], "p string")
    got = {r.p: r.content for r in files.with_media(meta, str(tmp_path), "p").collect()}
    assert len(got) == 4 and bytes(got["a/1.jpg"])[-1:] == b"a" and bytes(got[f"{tmp_path}/b/1.jpg"])[-1:] == b"b" and got["c/1.jpg"] is None
    import base64

    rows = spark.createDataFrame([(base64.b64encode(b"\x89PNG\r\n\x1a\nx").decode(),), ("!!",), ("aGVsbG8=",), (None,)], "img string")
    assert [r.error for r in files.with_pictures(rows, encoded="img").collect()] == [None, "no picture", "no picture", "no picture"]
    (tmp_path / "hub").mkdir()
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "hub" / "train-00000.parquet"))
    with pytest.raises(FileNotFoundError):
        files.read_hub_folder(spark, str(tmp_path / "hub"), "test")


def test_documents_and_marks(spark, tmp_path):
    rows = spark.createDataFrame([("f", 2, "x", "old?bytes=0,5"), ("f", 1, "ü", None), ("g", 3, "z", None)], "file string, k int, t string, doc_loc string")
    where = {r.k: r for r in sinks.write_documents(rows, str(tmp_path / "d"), "file", "k").collect()}
    stored = [f for f in (tmp_path / "d" / "file=f").iterdir() if f.name.startswith("part-")]
    data = b"".join(f.read_bytes() for f in sorted(stored))
    first = json.loads(data[where[1].offset : where[1].offset + where[1].n_bytes])
    second = json.loads(data[where[2].offset : where[2].offset + where[2].n_bytes])
    assert first["t"] == "ü" and second["track_loc"] == ["old?bytes=0,5"] and where[1].offset == 0
    assert not sinks.all_published(spark, str(tmp_path / "nothing"))
    sinks.write_mark(spark, str(tmp_path / "m" / "a"), "_SUCCESS")
    assert sinks.all_published(spark, str(tmp_path / "m"))
    sinks.write_summary(spark, str(tmp_path / "m"), spark.createDataFrame([("a", 1)], "sub string, n int"))
    assert json.loads((tmp_path / "m" / "_SUMMARY").read_text()) == [{"sub": "a", "n": 1}]


def test_queues(spark):
    raw = spark.createDataFrame([(b'{"id": 1, "t": "x"}', 0), (b"broken", 1), (b'{"id": 2}', 2)], "value binary, offset long")
    got = {r.offset: r for r in queue.parse_messages(raw, "id int, t string").collect()}
    assert got[0].id == 1 and got[0].error is None and got[1].error == "broken" and got[2].id == 2
    out = queue.missing_work(spark.createDataFrame([("a",), ("b",)], "p string"), spark.createDataFrame([("a",)], "p string"), "p").collect()
    assert [(r.key, r.value) for r in out] == [("b", '{"p":"b"}')]
    assert queue.source_options("h:1", "t")["maxOffsetsPerTrigger"] == "100"


def test_stream_is_drained_and_errors_stay(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.union(e).repartition(4).write.parquet(str(tmp_path / "in"))
    out = scores.drain(spark, str(tmp_path / "in"), e.schema, lambda rows: scores.drop_replays(rows, "event_id", "ts", "3650 days"), "t")
    assert out.count() == e.count()
    rows = scores.guarded(spark.createDataFrame([("1",), ("x",)], "v string"), {"n": F.col("v").try_cast("int")}, F.col("v").rlike("^[0-9]+$"), "no number")
    assert [(r.n, r.error) for r in rows.collect()] == [(1, None), (None, "no number")]


def test_nested_scores(spark):
    rows = spark.createDataFrame([(([1.0, 2.0], (3.0,)),)], "s struct<a:array<double>,b:struct<c:double>>")
    kind = rows.schema["s"].dataType
    assert nested.leaves(kind) == ["a", "b.c"]
    r = rows.select(nested.map_leaves(F.col("s"), kind, lambda x: x + 1).alias("m"), nested.leaf_length(F.col("s"), kind).alias("n"), nested.leaf_item(F.col("s"), kind, 1).alias("i")).first()
    assert r.m == ([2.0, 3.0], (4.0,)) and r.n == 2 and r.i.a == 2.0 and r.i.b.c == 3.0


def test_texts_of_json_and_content(spark):
    rows = spark.createDataFrame([('{"a": 1}',), ("{'a': None, 'b': True}",), ("no", ), (None,)], "j string")
    assert [r[0] for r in rows.select(text.lenient_json(F.col("j"))).collect()] == ['{"a": 1}', '{"a": null, "b": true}', None, None]
    d = spark.createDataFrame([('{"a":{"b":0}}', 1), ('{"a":{"b":true}}', 2), ('{"a":{"b":2.5}}', 3), ("{}", 4)], "j string, k int")
    assert [r[0] for r in d.select(text.dotted(F.col("j"), "a.b", 7.0)).collect()] == [7.0, 1.0, 2.5, 7.0]
    c = spark.createDataFrame([([("text", "t1", None, None), ("hr", "x", None, None), ("text", "no", "m2", None), ("text", "gone", None, ["r"]), ("text", None, None, None)], "f"), ([], "f"), (None, "")], "items array<struct<type:string,text:string,md:string,drop_it_list:array<string>>>, string string")
    assert [r[0] for r in c.select(heads.content_or_fallback(F.col("items"), F.col("string"))).collect()] == ["t1\n\nm2", "f", ""]
    s = spark.createDataFrame([("a \\ud800 b",), ("plain",)], "j string")
    assert s.select(text.without_surrogates(F.col("j"))).first()[0] == "a � b"


def test_rules_and_limits(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", "bad"), (3, "a", None), (4, "b", None)], "k int, g string, error string")
    assert sorted(r.k for r in accounting.without_errors(rows).collect()) == [1, 3, 4]
    assert sorted(r.k for r in accounting.early_stop(rows, "g", "k", 2).collect()) == [1, 2, 4]
    rules = selection.Rules()
    rules.filter("late", lambda c: c("k") > 3)
    assert rules.apply(rows, ["late"]).count() == 3


def test_percentiles_and_weighted_match(spark):
    stored = spark.createDataFrame([(float(x),) for x in (1, 2, 2, 3, 5)], "s double")
    asked = spark.createDataFrame([(1, 2.0), (2, 0.0), (3, 9.0)], "k int, s double")
    got = {r.k: r for r in matching.percentile_against(asked, stored, "s").collect()}
    assert [got[k].uniform for k in (1, 2, 3)] == pytest.approx([1 / 6, 0, 5 / 6])
    joined = np.array([9.0, 1, 2, 2, 3, 5])
    assert got[3].gaussian == pytest.approx((9 - joined.mean()) / joined.std())
    layout = spark.createDataFrame([("f", 1, 0, 2), ("f", 2, 2, 0), ("f", 3, 2, 3)], "file string, k int, off long, len long")
    flat = spark.createDataFrame([("f", i, i * 10) for i in range(5)], "file string, i long, value int")
    assert {r.k: r["values"] for r in attributes.read_ragged(layout, flat, "file").collect()} == {1: [0, 10], 2: [], 3: [20, 30, 40]}


def test_datasets_by_kind_and_resumed_runs(spark, tmp_path):
    from plumbline import cli

    (tmp_path / "a.jsonl").write_text('{"id": 1, "text": "a b c d e f"}\n{"id": 2, "text": "g h i j k"}\n')
    (tmp_path / "b.jsonl").write_text('{"id": 3, "text": "x"}\n')
    (tmp_path / "list.txt").write_text(f"{tmp_path}/a.jsonl\n{tmp_path}/missing.jsonl\n{tmp_path}/b.jsonl\n")
    assert files.load_dataset(spark, manifest_path=str(tmp_path / "list.txt")).count() == 3
    assert files.load_dataset(spark, path=str(tmp_path / "a.jsonl")).count() == 2
    with pytest.raises(ValueError):
        files.load_dataset(spark)
    (tmp_path / "none.txt").write_text("nowhere.jsonl\n")
    with pytest.raises(FileNotFoundError):
        files.read_manifest(spark, str(tmp_path / "none.txt"))
    cfg = {"data": {"path": str(tmp_path / "a.jsonl"), "key": "id"}, "output": str(tmp_path / "out"), "resume": True, "scorers": {"NgramScorer": {"ngrams": 1}}}
    for data in ({"path": str(tmp_path / "a.jsonl"), "key": "id"}, {"manifest": str(tmp_path / "list.txt"), "key": "id"}, {"manifest": str(tmp_path / "list.txt"), "key": "id"}):
        (tmp_path / "c.json").write_text(json.dumps(cfg | {"data": data}))
        cli.run(spark, cli.Config.load(str(tmp_path / "c.json")))
    assert sorted(r.item for r in spark.read.json(str(tmp_path / "out/items")).collect()) == [1, 2, 3]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "1.jpg").write_bytes(b"x")
    (tmp_path / "meta.csv").write_text("name,text\n1.jpg,hello\n2.jpg,gone\n")
    got = {r.id: (r.content, r.caption) for r in files.read_media(spark, str(tmp_path / "meta.csv"), str(tmp_path / "m"), "name", caption="text").collect()}
    assert bytes(got["1.jpg"][0]) == b"x" and got["2.jpg"] == (None, "gone")


def test_ragged_arrays_of_hot_and_null_groups(spark):
    """Elements travel in runs: no row an element is shuffled, and a hot or a null group is dealt over spans."""
    from plumbline.operators import attributes

    rows = spark.range(600).select(F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, None).otherwise("x").alias("g"), "id")
    rows = rows.withColumn("w", F.when(F.col("id") == 7, F.lit(None)).when(F.col("id") % 6 == 5, F.array().cast("array<int>")).otherwise(F.transform(F.sequence(F.lit(0), F.col("id") % 50), lambda k: k.cast("int") * 3 - 1)))
    rows = rows.withColumn("w", F.when(F.col("id") == 20, F.array(F.lit(1), F.lit(None), F.lit(2))).otherwise(F.col("w")))
    layout = attributes.flat_layout(rows, "g", "id", F.col("w"))
    flat = layout.select("g", "off", F.posexplode("w").alias("k", "value")).select("g", (F.col("off") + F.col("k")).alias("i"), "value").repartition(3)
    want = {r.id: r.w for r in rows.collect()}
    for span in (4, 64, 1 << 16):
        back = attributes.read_ragged(layout.select("g", "id", "off", "len"), flat, "g", span=span)
        assert {r.id: r["values"] for r in back.collect()} == want
    none = attributes.read_ragged(layout.select("g", "id", "off", "len").limit(0), flat.limit(0), "g")
    assert none.count() == 0
