"""A corpus pipeline: toxicity, line dedup, near duplicates, decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the
documents that it keeps, with the columns of ``docs``; the last returns packed pieces.
``run`` applies them to ``documents``, each result written as Parquet and read again.

Defined results at the edges: null and empty texts pass every filter and are packed as a
lone end id; a document that loses all its lines to earlier copies goes; of rows that share
both id and text the near-duplicate stage keeps one; an empty table stays
empty; extra columns, whatever their names, are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from plumbline.llm.common import Workspace, free_name, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model fitted on the labelled ones.

    Null and empty texts score like texts without any toxic string and stay; without
    labels nothing is learned and all stay; rows that repeat a text stand or fall together.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "toxicity")
    return toxicity.score(docs, model, out=name).where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of two or more lines, and of single lines of 50 words or more, are deleted from the texts.

    A document goes when nothing but white space is left of it.  Null, empty and blank
    texts stay; rows that repeat id and text keep the same lines; the first copy by id and
    line stays, null ids first.
    """
    aside = {c: free_name(docs, f"kept_{c}") for c in docs.columns if c in ("n_lines", "runs")}
    out = line_dedup.dedup_lines(docs.withColumnsRenamed(aside), long_words=line_dedup.LONG_WORDS)
    emptied = (F.size("runs") > 0) & (F.length(F.btrim("text", F.lit(" \t\r\n\f\v"))) == 0)
    out = out.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("runs") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id and text hash, of each group linked at a similarity of 0.8 on five words.

    Texts without words link with nothing and stay; null ids come last in a group; of rows
    that repeat both id and text one stays.
    """
    ws = Workspace(spark, "near")
    found = ngram_join.near_documents(docs, n=5, share=80).select("doc_id", "text_hash", "is_first", (F.col("n_shingles") > 0).alias("worded"))
    found = ws.stage(found, "found")
    gone = found.where("not is_first").select(F.col("doc_id").alias("id"), "text_hash").distinct()
    same = (F.xxhash64("l.text") == F.col("r.text_hash")) & F.col("l.doc_id").eqNullSafe(F.col("r.id"))
    rows = docs.alias("l").join(gone.hint("merge").alias("r"), same, "left_anti").select(*docs.columns)
    kept = found.where("is_first AND worded").groupBy(F.col("doc_id").alias("id"), "text_hash").agg(F.count(F.lit(1)).alias("n"))
    repeated = ws.stage(kept.where("n > 1").select("id", "text_hash"), "repeated")
    if repeated.isEmpty():  # as in every table whose ids are a key
        return rows
    aside = free_name(docs, "text_hash")
    once = rows.alias("l").join(repeated.alias("r"), same, "left_semi").select(*docs.columns).withColumn(aside, F.xxhash64("text"))
    once = once.dropDuplicates(["doc_id", aside]).drop(aside)
    return rows.alias("l").join(repeated.hint("merge").alias("r"), same, "left_anti").select(*docs.columns).unionByName(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark passage.

    Null and empty texts have no words and stay; an empty benchmark lets all stay.
    """
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"), keep=docs.columns, keep_prefix="__kept_")
    return found.where(~decontamination.contaminated()).select(*[F.col(f"__kept_{c}").alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids with their sequence and place.

    A null or empty text is one piece of the end id; every row is packed, repeated ones
    too; other columns end here.
    """
    return packing.pack(docs, payload={"ids": F.col("ids"), "ids_crc32": F.crc32("ids")})


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Model fitting, packing and component search have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = ws.stage(stage(spark, docs, sf_dir), name)
        if before:  # the next stage is written, so nothing reads the one before it again
            ws.drop(before)
        before = name
    return docs
