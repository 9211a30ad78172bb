"""The corpus pipeline on small tables: whole run, columns, planted cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm.common import Workspace

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_apply_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("node", F.lit("x"))
    ws = Workspace(spark, "t")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = ws.stage(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and 0.5 * docs.count() < out.count() <= docs.count()
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def test_near_duplicate_stage(spark):
    rng = np.random.default_rng(0)
    base = [f"w{x}" for x in rng.integers(0, 10_000, 200)]
    near = list(base)
    near[50] = "other"
    rows = [(7, " ".join(base)), (3, " ".join(near)), (9, "clean text that nobody else has at all"), (10, None), (11, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()) == [3, 9, 10, 11]


def test_one_of_repeated_rows_stays(spark):
    """Of rows with one id and text, one stays; rows without words, and repeats that are not the first of their group, are as before."""
    words = [f"w{x}" for x in np.random.default_rng(1).integers(0, 10_000, 60)]
    rows = [(5, " ".join(words), "a"), (5, " ".join(words), "b"), (5, " ".join(words), "a"), (8, " ".join([*words[:-1], "x"]), "a"), (8, " ".join([*words[:-1], "x"]), "a")]
    rows += [(None, "a text with a null id that is there twice", "a")] * 2 + [(9, "", "a"), (9, "", "a"), (9, "own words here", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string")
    got = sorted((r.doc_id or 0, (r.text or "")[:8]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect())
    assert got == [(0, "a text w"), (5, " ".join(words)[:8]), (9, ""), (9, ""), (9, "own word")]


def test_repeated_lines_stage(spark):
    rows = [(1, "a b\nc d\ne", 7), (2, "a b\nc d\nown line", 16), (3, "a b\nc d", 7), (4, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()}
    assert got == {1: ("a b\nc d\ne", 7), 2: ("own line", 8), 4: ("", 0)}


def test_long_single_lines_are_runs(spark):
    line = " ".join(f"w{i}" for i in range(50))
    short = " ".join(f"v{i}" for i in range(49))
    texts = [f"a\n{line}\nb\n{short}\nc", f"d\n{line}\ne\n{short}\nf", line, short, f"{line}\ng\n \n{line}"]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()}
    assert got == {0: texts[0], 1: f"d\ne\n{short}\nf", 3: short, 4: "g\n "}


def small_tables(spark, path, texts, toxic=()):
    spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "benchmark " + " ".join(f"b{i}" for i in range(40)))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_run_on_planted_cases(spark, tmp_path):
    rng = np.random.default_rng(0)
    words = [a + b for a in "ka to mi ne su ro".split() for b in "len dar pos tik wum".split()]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(240)]
    toxic = set(range(0, 240, 4))
    for i in toxic:
        w = texts[i].split()
        for at in rng.integers(0, 60, 5):
            w[at] = rng.choice(["scumbagge", "vilewretch", "trashpile"])
        texts[i] = " ".join(w)
    clean = texts[1]
    passage = "benchmark " + " ".join(f"b{i}" for i in range(20))
    lines = "shared line one of many\nshared line two of many\n"
    texts += [clean, clean.replace(clean.split()[30], "other", 1), passage, lines + texts[2], lines + texts[3] + " end", None, "", clean]
    small_tables(spark, f"{tmp_path}", texts, toxic)
    out = corpus_pipeline.run(spark, f"{tmp_path}").collect()
    left = {r.doc_id for r in out}
    assert len(left & toxic) <= 0.1 * len(toxic)
    assert 240 not in left and 241 not in left and 247 not in left and 242 not in left  # copies, near copy, benchmark passage
    assert {1, 245, 246} <= left and len(left - toxic) >= 0.95 * 182
    used = {}
    for r in out:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in v) <= 2048 and sorted(v)[0][0] == 0 for v in used.values())


CLASHING = ["toxicity", "__toxicity", "runs", "n_lines", "__runs", "__id", "text_hash", "id", "score", "spans", "items", "n_words"]


@pytest.mark.parametrize("k", range(4))
def test_every_stage_at_the_edges(spark, tmp_path, k):
    texts = [None, "", " ", "w", "long " * 30_000, "same line\nof text", "same line\nof text", "tie", "tie"]
    small_tables(spark, f"{tmp_path}", texts)
    _, stage = corpus_pipeline.STAGES[k]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumns({c: F.lit(c) for c in CLASHING})
    docs = docs.unionByName(docs.where("doc_id = 7")).unionByName(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    out = stage(spark, docs, f"{tmp_path}")
    assert out.columns == docs.columns and {0, 1, 2, 3, 4, 5, 7} <= {r.doc_id for r in out.collect()}
    assert {tuple(r[c] for c in CLASHING) for r in out.collect()} == {tuple(CLASHING)}
    assert stage(spark, docs.limit(0), f"{tmp_path}").count() == 0


@pytest.mark.parametrize("name", ["op1_token_binary", "op9_benchmark_decontamination"])
def test_queries_are_registered(name):
    import __spark_entry__

    assert name in __spark_entry__.queries() and "pipeline" in __spark_entry__.queries()
