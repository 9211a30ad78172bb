"""Registered queries of the core engine and their DuckDB equivalents.

Every query runs over its whole tables.  Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline import record
from plumbline.functions import numbers, text, vector
from plumbline.operators import accounting, attributes, heads, lexical, matching, selection, vectors

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


_CLEAN = r"list_filter(string_split_regex(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+'), lambda x: x <> '')"
_GRAMS = "list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' '))"


def _repetition_sql(n: int) -> str:
    return f"""WITH t AS (SELECT doc_id, {_CLEAN} AS w FROM documents),
g AS (SELECT doc_id, {_GRAMS.format(n=n)} AS g FROM t)
SELECT doc_id, round(CASE WHEN len(g) = 0 THEN 0.0 ELSE CAST(len(list_distinct(g)) AS DOUBLE) / len(g) END, 6) AS score FROM g"""


def _repetition(n: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read(spark, sf_dir, "documents").select("doc_id", r6(text.ngram_repetition(F.col("text"), n)).alias("score"))

    return run


for _n in (1, 2, 3, 5):
    _name = "ngram_repetition" if _n == 5 else f"ngram_repetition_n{_n}"
    _QUERIES[_name], _SQL[_name] = _repetition(_n), _repetition_sql(_n)


@query(f"WITH s AS ({_repetition_sql(5)}) SELECT count(*) AS num, max(score) AS max, min(score) AS min, round(avg(score), 6) AS mean, round(var_pop(score), 6) AS variance FROM s")
def score_statistics(spark, sf_dir):
    s = accounting.statistics(_QUERIES["ngram_repetition"](spark, sf_dir), "score")
    return s.select("num", "max", "min", r6("mean").alias("mean"), r6("variance").alias("variance"))


@query(f"WITH s AS ({_repetition_sql(5)}) SELECT lang, count(*) AS num, max(score) AS max, min(score) AS min, round(avg(score), 6) AS mean, round(var_pop(score), 6) AS variance FROM s JOIN documents USING (doc_id) GROUP BY lang")
def score_statistics_by_lang(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("lang", r6(text.ngram_repetition(F.col("text"), 5)).alias("score"))
    return accounting.statistics(d, "score", ["lang"]).select("lang", "num", "max", "min", r6("mean").alias("mean"), r6("variance").alias("variance"))


_SYL = f"greatest(1, len(regexp_extract_all(x, '{text.VOWELS}')))"
_COUNTS = rf"""t AS (SELECT doc_id, text, {_CLEAN} AS w FROM documents),
c AS (SELECT doc_id, CAST(length(regexp_replace(text, '\s', '', 'g')) AS BIGINT) AS character_count, CAST(length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS BIGINT) AS letter_count,
  CAST(len(w) AS BIGINT) AS lexicon_count, CAST(greatest(1, len(regexp_extract_all(text, '[.!?]+'))) AS BIGINT) AS sentence_count, w,
  list_transform(w, lambda x: {_SYL}) AS s FROM t),
k AS (SELECT doc_id, character_count, letter_count, lexicon_count, sentence_count, CAST(coalesce(list_sum(s), 0) AS BIGINT) AS syllable_count,
  CAST(len(list_filter(s, lambda x: x >= 3)) AS BIGINT) AS polysyllable_count, CAST(len(list_filter(s, lambda x: x = 1)) AS BIGINT) AS monosyllable_count,
  CAST(len(list_distinct(list_filter(w, lambda x: {_SYL} >= 3))) AS BIGINT) AS difficult_words FROM c)"""


def _statistics(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", lexical.text_statistics(F.col("text")).alias("s"))


@query(f"WITH {_COUNTS} SELECT * FROM k")
def text_counts(spark, sf_dir):
    return _statistics(spark, sf_dir).select("doc_id", *[F.col(f"s.{k}") for k in lexical.COUNTS])


@query(f"""WITH {_COUNTS} SELECT doc_id, round(206.835 - 1.015 * (lexicon_count / nullif(CAST(sentence_count AS DOUBLE), 0)) - 84.6 * (syllable_count / nullif(CAST(lexicon_count AS DOUBLE), 0)), 6) AS flesch_reading_ease,
round(4.71 * (character_count / nullif(CAST(lexicon_count AS DOUBLE), 0)) + 0.5 * (lexicon_count / CAST(sentence_count AS DOUBLE)) - 21.43, 6) AS automated_readability_index FROM k""")
def readability(spark, sf_dir):
    cols = lexical.readability(F.col("s"))
    return _statistics(spark, sf_dir).select("doc_id", *[r6(cols[k]).alias(k) for k in ("flesch_reading_ease", "automated_readability_index")])


@query(f"""WITH {_COUNTS}, x AS (SELECT doc_id, CAST(lexicon_count AS DOUBLE) AS w, CAST(sentence_count AS DOUBLE) AS s, CAST(syllable_count AS DOUBLE) AS y, CAST(polysyllable_count AS DOUBLE) AS p, CAST(character_count AS DOUBLE) AS c, CAST(letter_count AS DOUBLE) AS l FROM k WHERE lexicon_count > 0),
g AS (SELECT doc_id, unnest([0.39 * (w / s) + 11.8 * (y / w) - 15.59, 1.043 * sqrt(30 * (p / s)) + 3.1291, 5.88 * (l / w) - 29.6 * (s / w) - 15.8, 4.71 * (c / w) + 0.5 * (w / s) - 21.43, 0.4 * (w / s + 100 * (p / w))]) AS g FROM x),
b AS (SELECT doc_id, floor(g) AS v FROM g UNION ALL SELECT doc_id, ceil(g) FROM g), n AS (SELECT doc_id, v, count(*) AS n FROM b GROUP BY doc_id, v),
m AS (SELECT doc_id, v FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, v) AS r FROM n) WHERE r = 1)
SELECT doc_id, CAST(v AS DOUBLE) AS aggregate_reading_level FROM documents LEFT JOIN m USING (doc_id)""")
def reading_level(spark, sf_dir):
    return _statistics(spark, sf_dir).select("doc_id", lexical.readability(F.col("s"))["aggregate_reading_level"].alias("aggregate_reading_level"))


_TOKENS = r"list_transform(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''), lambda x: lower(translate(x, '" + text.ASCII_PUNCTUATION.replace("'", "''") + r"', '')))"


_FOLD = """list_reduce({w}, lambda a, x: CASE WHEN CAST(len(CASE WHEN list_contains(a.t, x.t[1]) THEN a.t ELSE list_append(a.t, x.t[1]) END) AS DOUBLE) / (a.n + 1) <= 0.72
  THEN {{'t': CAST([] AS VARCHAR[]), 'n': 0, 'f': a.f + 1}} ELSE {{'t': CASE WHEN list_contains(a.t, x.t[1]) THEN a.t ELSE list_append(a.t, x.t[1]) END, 'n': a.n + 1, 'f': a.f}} END, {{'t': CAST([] AS VARCHAR[]), 'n': 0, 'f': 0}})"""


@query(f"""WITH t AS (SELECT doc_id, list_transform({_TOKENS}, lambda x: {{'t': [x], 'n': 0, 'f': 0}}) AS w FROM documents),
a AS (SELECT doc_id, len(w) AS n, {_FOLD.format(w="w")} AS u, {_FOLD.format(w="list_reverse(w)")} AS v FROM t WHERE len(w) > 50),
c AS (SELECT doc_id, n, u.f + (1 - CASE WHEN u.n = 0 THEN 1.0 ELSE CAST(len(u.t) AS DOUBLE) / u.n END) / 0.28 AS x, v.f + (1 - CASE WHEN v.n = 0 THEN 1.0 ELSE CAST(len(v.t) AS DOUBLE) / v.n END) / 0.28 AS y FROM a),
m AS (SELECT doc_id, (CASE WHEN x = 0 THEN -1.0 ELSE n / x END + CASE WHEN y = 0 THEN -1.0 ELSE n / y END) / 2 AS mtld FROM c)
SELECT doc_id, round(mtld, 6) AS mtld FROM documents LEFT JOIN m USING (doc_id)""")
def lexical_mtld(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", r6(lexical.mtld(F.col("text"))).alias("mtld"))


@query(f"""WITH t AS (SELECT doc_id, {_TOKENS} AS w FROM documents), s AS (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM t WHERE len(w) > 50 AND len(w) < 1000),
f AS (SELECT doc_id, n, t, count(*) AS f FROM s GROUP BY ALL),
p AS (SELECT doc_id, sum((1 - list_product(list_transform(range(0, 42), lambda j: greatest(0.0, CAST(n - f - j AS DOUBLE)) / (n - j)))) / 42) AS hdd FROM f GROUP BY doc_id)
SELECT doc_id, round(hdd, 6) AS hdd FROM documents LEFT JOIN p USING (doc_id)""")
def lexical_hdd(spark, sf_dir):
    return lexical.hdd(read(spark, sf_dir, "documents")).select("doc_id", r6("hdd").alias("hdd"))


def _translate_sql(expr: str) -> str:
    single = {k: v for k, v in text.PUNCTUATION.items() if len(v) == 1}
    for k, v in text.PUNCTUATION.items():
        if len(v) > 1:
            expr = f"replace({expr}, '{k}', '{v}')"
    q = lambda s: s.replace("'", "''")
    return f"translate({expr}, '{q(''.join(single))}', '{q(''.join(single.values()))}')"


@query(rf"""SELECT doc_id, md5(regexp_replace({_translate_sql(r"regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\p{Nd}', '0', 'g')")}, '[\x00-\x1F\x7F-\x9F]', '', 'g')) AS digest FROM documents""")
def line_normalise(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(text.normalise_line(F.col("text"))).alias("digest"))


@query(r"SELECT doc_id, md5(regexp_replace(text, '\n+', ' ', 'g')) AS digest FROM documents")
def newline_collapse(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(text.collapse_newlines(F.col("text"))).alias("digest"))


_CUT = 20480


@query(f"""WITH RECURSIVE s AS (SELECT doc_id, text, 0 AS lo, length(text) AS hi FROM documents
UNION ALL SELECT doc_id, text, CASE WHEN strlen(text[1:(lo + hi + 1) // 2]) <= {_CUT} THEN (lo + hi + 1) // 2 ELSE lo END, CASE WHEN strlen(text[1:(lo + hi + 1) // 2]) <= {_CUT} THEN hi ELSE (lo + hi + 1) // 2 - 1 END FROM s WHERE lo < hi)
SELECT doc_id, md5(text[1:lo]) AS digest, CAST(strlen(text[1:lo]) AS BIGINT) AS n_bytes FROM s WHERE lo = hi UNION ALL SELECT doc_id, NULL, NULL FROM documents WHERE text IS NULL""")
def byte_truncate(spark, sf_dir):
    cut = read(spark, sf_dir, "documents").select("doc_id", text.truncate_bytes(F.col("text"), _CUT).alias("t"))
    return cut.select("doc_id", F.md5("t").alias("digest"), F.octet_length("t").cast("long").alias("n_bytes"))


_TURNS = "SELECT a.conv_id, a.turn, a.text AS instruction, b.text AS output FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'"


def instructions(spark, sf_dir) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    a = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    b = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    return a.join(b, ["conv_id", "turn"])


@query(f"SELECT conv_id, turn, md5('Question: ' || coalesce(instruction, '') || chr(10) || 'Answer: ' || coalesce(output, '')) AS digest FROM ({_TURNS})")
def prompt_template(spark, sf_dir):
    p = heads.template("Question: {i}\nAnswer: {o}", i=F.col("instruction"), o=F.col("output"))
    return instructions(spark, sf_dir).select("conv_id", "turn", F.md5(p).alias("digest"))


@query("SELECT doc_id, " + ", ".join(f"CAST(len(regexp_extract_all(text, '{p}')) AS BIGINT) AS {k}" for k, p in text.PERSONAL.items()) + " FROM documents")
def personal_data_count(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", *[c.alias(k) for k, c in text.personal_counts(F.col("text")).items()])


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def filter_by_label(spark, sf_dir):
    return selection.keep_labelled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "doc_id", F.col("quality")).select("doc_id", "lang", "source")


@query("""SELECT source, count(*) AS n, count(*) FILTER (WHERE n_chars < 200 OR lang <> 'en') AS n_dropped, count(*) FILTER (WHERE n_chars < 200) AS n_short, count(*) FILTER (WHERE n_chars >= 200 AND lang <> 'en') AS n_language FROM documents GROUP BY source""")
def drop_flag_summary(spark, sf_dir):
    d = selection.flag_dropped(read(spark, sf_dir, "documents"), {"short": F.col("n_chars") < 200, "language": F.col("lang") != "en"})
    c = lambda x: F.sum(x.cast("long"))
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n"), c(F.col("dropped")).alias("n_dropped"), c(F.coalesce(F.col("dropped_by") == "short", F.lit(False))).alias("n_short"), c(F.coalesce(F.col("dropped_by") == "language", F.lit(False))).alias("n_language"))


@query("SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_size BETWEEN 10 AND 20 AND p_retailprice >= 300")
def range_filter(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    return p.where(selection.in_range(F.col("p_size"), 10, 20) & selection.in_range(F.col("p_retailprice"), 300)).select("p_partkey", "p_size", "p_retailprice")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_done(spark, sf_dir):
    return selection.not_done(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def exists_semi(spark, sf_dir):
    c = read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return selection.present(read(spark, sf_dir, "orders"), c, "o_custkey").select("o_orderkey", "o_totalprice")


@query("SELECT doc_id, pos FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents) WHERE pos >= 10 AND pos < 900 AND (pos - 10) % 7 = 0")
def slice_step(spark, sf_dir):
    return selection.slice_rows(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 10, 900, 7).select("doc_id", "pos")


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 10 AS split FROM documents")
def round_robin_split(spark, sf_dir):
    return selection.round_robin(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 10).select("doc_id", "split")


@query("WITH n AS (SELECT count(*) // 7 AS s FROM documents) SELECT doc_id, CAST(floor(pos / s) AS BIGINT) AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents), n WHERE pos < s * 7")
def equal_split(spark, sf_dir):
    return selection.equal_splits(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 7).select("doc_id", "split")


@query("SELECT doc_id FROM documents ORDER BY md5('0:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100")
def hash_sample(spark, sf_dir):
    return selection.sample_by_hash(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100)


@query("""WITH a AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents),
b AS (SELECT d.source, l.quality, row_number() OVER (PARTITION BY d.source ORDER BY l.doc_id) - 1 AS pos FROM labels l JOIN documents d USING (doc_id))
SELECT source, pos, doc_id, quality FROM a JOIN b USING (source, pos)""")
def positional_attributes(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("source", "doc_id")
    l = read(spark, sf_dir, "labels").join(d, "doc_id").select("source", F.col("doc_id").alias("label_doc"), "quality")
    return attributes.positional_join(d, l, "source", "doc_id", "label_doc").select("source", F.col("pos").cast("long").alias("pos"), "doc_id", "quality")


@query(rf"""WITH t AS (SELECT source, doc_id, CAST(len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS BIGINT) AS len FROM documents)
SELECT source, doc_id, len, CAST(coalesce(sum(len) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM t""")
def flat_offsets(spark, sf_dir):
    return attributes.flat_layout(read(spark, sf_dir, "documents"), "source", "doc_id", text.words(F.col("text"))).select("source", "doc_id", "len", "off")


@query("""WITH t AS (SELECT source, doc_id, CAST(strlen(text) + 1 AS BIGINT) AS n_bytes FROM documents),
o AS (SELECT *, CAST(coalesce(sum(n_bytes) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM t)
SELECT doc_id, n_bytes, "offset", source || '?bytes=' || "offset" || ',' || n_bytes AS loc FROM o""")
def document_offsets(spark, sf_dir):
    return attributes.record_offsets(read(spark, sf_dir, "documents"), "source", "doc_id", F.col("text")).select("doc_id", "n_bytes", "offset", "loc")


@query(r"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents),
c AS (SELECT doc_id, unnest(list_transform(range(1, len(w) + 1, 64), lambda i: w[i:i + 63])) AS c FROM t),
s AS (SELECT doc_id, len(c) AS n, CAST(len(list_distinct(c)) AS DOUBLE) / len(c) AS s FROM c)
SELECT doc_id, round(sum(s * n) / sum(n), 6) AS weighted_mean FROM s GROUP BY doc_id""")
def chunk_weighted_mean(spark, sf_dir):
    c = read(spark, sf_dir, "documents").select("doc_id", F.explode(text.chunks(text.words(F.col("text")), 64)).alias("c"))
    return attributes.weighted_mean(c, "doc_id", text.distinct_ratio(F.col("c")), F.size("c")).select("doc_id", r6("weighted_mean").alias("weighted_mean"))


@query("SELECT coalesce(source, '_') AS source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ROLLUP (source)")
def sub_path_totals(spark, sf_dir):
    return accounting.roll_up(read(spark, sf_dir, "documents"), "source", {"n": F.lit(1).cast("long"), "chars": F.col("n_chars")})


@query("""SELECT l_returnflag, count(*) AS n, CAST(sum(CASE WHEN l_quantity < 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped, CAST(sum(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END) AS BIGINT) AS errors,
round(sum(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END) / count(*), 6) AS ratio, sum(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END) / count(*) <= 0.2 AS passes FROM lineitem GROUP BY l_returnflag""")
def quality_gate(spark, sf_dir):
    out = accounting.quality_gate(read(spark, sf_dir, "lineitem"), "l_returnflag", F.col("l_discount") > 0.08, F.col("l_quantity") < 5, 0.2)
    return out.withColumn("ratio", r6("ratio"))


@query(r"""WITH d AS (SELECT source, doc_id, text, len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS k, strlen(text) AS b, n_chars >= 200 AS live FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS n FROM d WHERE live),
s AS (SELECT source, sum(k) FILTER (WHERE n % 5 = 0) AS tokens, sum(b) FILTER (WHERE n % 5 = 0) AS bytes, count(*) AS live FROM l GROUP BY source),
a AS (SELECT source, count(*) AS lines, CAST(sum(b) AS BIGINT) AS total_bytes FROM d GROUP BY source)
SELECT source, lines, total_bytes, round(CAST(tokens AS DOUBLE) / bytes, 6) AS token_per_byte, round(CAST(coalesce(live, 0) AS DOUBLE) / lines, 6) AS remained,
CAST(floor(total_bytes * (CAST(tokens AS DOUBLE) / bytes) * (CAST(coalesce(live, 0) AS DOUBLE) / lines)) AS BIGINT) AS estimate FROM a LEFT JOIN s USING (source)""")
def token_estimate(spark, sf_dir):
    out = accounting.token_estimate(read(spark, sf_dir, "documents"), "source", "text", "doc_id", 5, F.col("n_chars") >= 200)
    return out.select("source", "lines", "total_bytes", r6("token_per_byte").alias("token_per_byte"), r6("remained").alias("remained"), "estimate")


@query("SELECT source, CAST(sum(n_chars) AS BIGINT) AS amount, round(CAST(sum(n_chars) AS DOUBLE) / (SELECT sum(n_chars) FROM documents), 6) AS weight FROM documents GROUP BY source")
def dataset_weights(spark, sf_dir):
    return accounting.weights(read(spark, sf_dir, "documents"), "source", F.col("n_chars")).select("source", "amount", r6("weight").alias("weight"))


@query("""WITH h AS (SELECT doc_id, sha256(CAST(doc_id AS VARCHAR) || '|' || text) AS h FROM documents ORDER BY doc_id LIMIT 10000)
SELECT (SELECT count(*) FROM documents) AS n_rows, (SELECT round(sum(strlen(text)) / 1e6, 2) FROM documents) AS size_mb, sha256(string_agg(h, '' ORDER BY doc_id)) AS digest FROM h""")
def dataset_profile(spark, sf_dir):
    return accounting.profile(read(spark, sf_dir, "documents"), "doc_id", "text")


_E = "e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)"
_DOT = "list_dot_product({a}, {b})"


@query(f"WITH {_E} SELECT vec_id, round(sqrt(list_dot_product(v, v)), 6) AS norm, round(v[1] / sqrt(list_dot_product(v, v)), 6) AS first FROM e")
def vector_normalise(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return e.select("vec_id", r6(vector.norm(F.col("embedding"))).alias("norm"), r6(F.element_at(vector.normalise(F.col("embedding")), 1)).alias("first"))


_CENTROIDS = "c AS (SELECT label AS cid, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM e) GROUP BY label, i) GROUP BY label)"


def centroids(spark, sf_dir) -> DataFrame:
    mu = vectors.mean_vector(read(spark, sf_dir, "embeddings"), "label")
    return mu.groupBy(F.col("label").alias("cid")).agg(F.array_sort(F.collect_list(F.struct("i", "mu"))).alias("s")).select("cid", F.transform("s", lambda x: x["mu"]).alias("c_embs"))


def _centroid_sql(metric: str) -> str:
    c = "list_transform(c, lambda x: x / sqrt(list_dot_product(c, c)))" if metric == "cosine" else "c"
    score = "round(sqrt(greatest(0.0, list_dot_product(x, x) - 2 * list_dot_product(x, k) + list_dot_product(k, k))), 9)" if metric == "l2_norm" else "round(list_dot_product(x, k), 9)"
    order = "score, cid" if metric == "l2_norm" else "-score, cid"
    return f"""WITH {_E}, {_CENTROIDS}, x AS (SELECT vec_id, list_transform(v, lambda q: q / sqrt(list_dot_product(v, v))) AS x FROM e), k AS (SELECT cid, {c} AS k FROM c),
s AS (SELECT vec_id, cid, {score} AS score FROM x, k) SELECT vec_id, cid, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY {order}) AS n FROM s) WHERE n = 1"""


def _centroid(metric: str):
    return lambda spark, sf_dir: vectors.nearest_centroid(read(spark, sf_dir, "embeddings"), centroids(spark, sf_dir), metric)


for _m in ("l2_norm", "dot_product", "cosine"):
    _QUERIES[f"nearest_centroid_{_m}"], _SQL[f"nearest_centroid_{_m}"] = _centroid(_m), _centroid_sql(_m)


@query(f"WITH {_E}, p AS (SELECT a.label, 1 - list_cosine_similarity(a.v, b.v) AS d FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id) SELECT label, count(*) AS n, round(avg(d), 6) AS mean, round(stddev_pop(d), 6) AS std FROM p WHERE d <> 0 GROUP BY label")
def distance_stats(spark, sf_dir):
    out = vectors.class_distance_statistics(read(spark, sf_dir, "embeddings"), "label")
    return out.select("label", "n", r6("mean").alias("mean"), r6("std").alias("std"))


def _positive(spark, sf_dir) -> DataFrame:
    """Squares of the class means stand for variances."""
    return centroids(spark, sf_dir).select(F.col("cid").alias("vec_id"), F.transform("c_embs", lambda x: x * x + 0.01).alias("embedding"))


_POS = f"{_E}, {_CENTROIDS}, h AS (SELECT cid, list_transform(c, lambda x: x * x + 0.01) AS h FROM c), q AS (SELECT a.cid AS a, b.cid AS b, unnest(a.h) AS x, unnest(b.h) AS y FROM h a JOIN h b ON a.cid < b.cid)"
_PAIRWISE = {
    "kl": "sum(greatest(0.5 * (x / y - 1 + ln(y) - ln(x)), 0.5 * (y / x - 1 + ln(x) - ln(y))))",
    "asymmetric_kl": "sum(0.5 * (x / y - 1 + ln(y) - ln(x)))",
    "jsd": "avg(0.5 * (0.5 * (x / (0.5 * (x + y)) - 1 + ln(0.5 * (x + y)) - ln(x)) + 0.5 * (y / (0.5 * (x + y)) - 1 + ln(0.5 * (x + y)) - ln(y))))",
    "cosine": "1 - sum((x / (x + y + 1e-8)) * (y / (x + y + 1e-8))) / (sqrt(sum((x / (x + y + 1e-8)) ** 2)) * sqrt(sum((y / (x + y + 1e-8)) ** 2)))",
    "normalized_cosine": "1 - sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y)))",
    "correlation": "1 - corr(x, y)",
    "entropy": "ln(2.0) - avg(-(x / (x + y + 1e-8)) * ln(x / (x + y + 1e-8)) - (1 - x / (x + y + 1e-8)) * ln(1 - x / (x + y + 1e-8)))",
}


@query(f"WITH {_POS} SELECT a, b, " + ", ".join(f"round({s}, 6) AS d_{k}" for k, s in _PAIRWISE.items()) + " FROM q GROUP BY a, b")
def pair_distances(spark, sf_dir):
    h = _positive(spark, sf_dir)
    a, b = h.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x")), h.select(F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", *[r6(f(F.col("x"), F.col("y"))).alias(f"d_{k}") for k, f in vector.DISTANCES.items()])


@query(f"WITH {_E}, f AS (SELECT label, unnest(range(0, len(v))) AS i, unnest(v) AS x FROM e) SELECT label, CAST(i AS INTEGER) AS i, round(avg(x), 6) AS mu FROM f GROUP BY label, i")
def mean_vectors(spark, sf_dir):
    return vectors.mean_vector(read(spark, sf_dir, "embeddings"), "label").select("label", "i", r6("mu").alias("mu"))


@query(f"""WITH {_E}, f AS (SELECT vec_id, unnest(range(0, len(v))) AS i, unnest(v) AS x FROM e)
SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(covar_samp(a.x, b.x), 6) AS cov FROM f a JOIN f b ON a.vec_id = b.vec_id WHERE a.i <= b.i GROUP BY a.i, b.i""")
def covariance_matrix(spark, sf_dir):
    _, cov = vectors.moments(read(spark, sf_dir, "embeddings"))
    rows = [(i, j, round(float(cov[i, j]), 6)) for i in range(len(cov)) for j in range(i, len(cov))]
    return spark.createDataFrame(rows, "i int, j int, cov double")


def _halves(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return e.where("label < 5"), e.where("label >= 5")


@query()
def frechet_distance(spark, sf_dir):
    return spark.createDataFrame([(round(vectors.frechet(*_halves(spark, sf_dir)), 6),)], "fid double")


@query(f"""WITH {_E}, k AS (SELECT a.label < 5 AS p, b.label < 5 AS q, a.vec_id AS i, b.vec_id AS j, (list_dot_product(a.v, b.v) / len(a.v) + 1) ** 3 AS k FROM e a, e b)
SELECT round((SELECT avg(k) FROM k WHERE p AND q AND i <> j) + (SELECT avg(k) FROM k WHERE NOT p AND NOT q AND i <> j) - 2 * (SELECT avg(k) FROM k WHERE p AND NOT q), 6) AS mmd2""")
def kernel_distance(spark, sf_dir):
    return spark.createDataFrame([(round(vectors.kernel_distance(*_halves(spark, sf_dir)), 6),)], "mmd2 double")


@query(f"""WITH {_E}, s AS (SELECT vec_id, label, list_transform(v, lambda x: exp(x)) AS x FROM e), p AS (SELECT vec_id, label, unnest(range(0, len(x))) AS i, unnest(x) / list_sum(x) AS p FROM s),
m AS (SELECT label, i, avg(p) AS q FROM p GROUP BY label, i) SELECT label, round(exp(sum(p * ln(p / q)) / count(DISTINCT vec_id)), 6) AS score FROM p JOIN m USING (label, i) GROUP BY label""")
def inception_score(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").withColumn("p", vector.softmax(F.col("embedding").cast("array<double>")))
    return vectors.inception(e, "p", "label").select("label", r6("score").alias("score"))


@query()
def vendi_embedding(spark, sf_dir):
    return spark.createDataFrame([(round(vectors.vendi(read(spark, sf_dir, "embeddings")), 2),)], "vendi double")


@query(f"""WITH {_E}, f AS (SELECT vec_id, unnest(range(0, len(v))) AS i, unnest(list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))) AS x FROM e)
SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(sum(a.x * b.x) / (SELECT count(*) FROM e), 6) AS g FROM f a JOIN f b ON a.vec_id = b.vec_id WHERE a.i <= b.i GROUP BY a.i, b.i""")
def vendi_gram(spark, sf_dir):
    n, _, g = vectors.second_moments(read(spark, sf_dir, "embeddings").select(vector.normalise(F.col("embedding")).alias("embedding")))
    return spark.createDataFrame([(i, j, round(float(g[i, j] / n), 6)) for i in range(len(g)) for j in range(i, len(g))], "i int, j int, g double")


@query(f"""WITH {_E}, u AS (SELECT vec_id, list_transform(range(0, 4), lambda k: v[k * 16 + 1:k * 16 + 16]) AS t FROM e), n AS (SELECT vec_id, list_transform(t, lambda x: list_transform(x, lambda y: y / sqrt(list_dot_product(x, x)))) AS t FROM u),
p AS (SELECT a.vec_id, a.t AS h, b.t AS r FROM n a JOIN n b ON b.vec_id = a.vec_id + 1),
s AS (SELECT vec_id, list_avg(list_transform(h, lambda x: list_max(list_transform(r, lambda y: list_dot_product(x, y))))) AS p, list_avg(list_transform(r, lambda x: list_max(list_transform(h, lambda y: list_dot_product(x, y))))) AS r FROM p)
SELECT vec_id, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f FROM s""")
def greedy_match(spark, sf_dir):
    parts = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: vector.normalise(F.slice(F.col("embedding"), k * 16 + 1, 16)))
    e = read(spark, sf_dir, "embeddings").select("vec_id", parts.alias("hyp"))
    pairs = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("hyp").alias("ref")), "vec_id")
    return matching.greedy_match(pairs, "vec_id").select("vec_id", *[r6(c).alias(c) for c in ("precision", "recall", "f")])


@query(f"WITH t AS (SELECT doc_id, {_CLEAN} AS w FROM documents), d AS (SELECT token, count(*) AS df FROM (SELECT unnest(list_distinct(w)) AS token FROM t) GROUP BY token) SELECT token, df, round(ln((SELECT count(*) + 1 FROM documents) / CAST(df + 1 AS DOUBLE)), 6) AS idf, round(ln((SELECT count(*) + 1 FROM documents)), 6) AS unseen_idf FROM d")
def inverse_frequencies(spark, sf_dir):
    return matching.inverse_frequencies(read(spark, sf_dir, "documents"), "doc_id", text.clean_words(F.col("text"))).select("token", "df", r6("idf").alias("idf"), r6("unseen_idf").alias("unseen_idf"))


@query("SELECT user_id, max(value) AS value FROM events GROUP BY user_id")
def reference_max(spark, sf_dir):
    return matching.best_reference(read(spark, sf_dir, "events"), "user_id", "value")


@query("""WITH r AS (SELECT l_linenumber, rank() OVER (PARTITION BY l_linenumber ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_linenumber, l_quantity) - 1) / 2 AS a,
rank() OVER (PARTITION BY l_linenumber ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_linenumber, l_extendedprice) - 1) / 2 AS b FROM lineitem) SELECT l_linenumber, round(corr(a, b), 6) AS spearman FROM r GROUP BY l_linenumber""")
def rank_correlation(spark, sf_dir):
    return matching.spearman(read(spark, sf_dir, "lineitem"), "l_linenumber", "l_quantity", "l_extendedprice").select("l_linenumber", r6("spearman").alias("spearman"))


@query("""WITH p AS (SELECT a.o_orderkey AS k, sign(a.l_quantity - b.l_quantity) AS x, sign(a.l_extendedprice - b.l_extendedprice) AS y FROM (SELECT l_orderkey AS o_orderkey, * FROM lineitem) a JOIN lineitem b ON a.o_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber)
SELECT k AS l_orderkey, round(sum(x * y) / nullif(sqrt(sum(abs(x)) * sum(abs(y))), 0), 6) AS kendall FROM p GROUP BY k""")
def concordance(spark, sf_dir):
    return matching.kendall(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice").select("l_orderkey", r6("kendall").alias("kendall"))


@query("SELECT doc_id, round((n_chars - avg(n_chars) OVER ()) / stddev_pop(n_chars) OVER (), 6) AS gaussian, round((row_number() OVER (ORDER BY n_chars, doc_id) - 1) / count(*) OVER (), 6) AS uniform FROM documents")
def zscore_rank(spark, sf_dir):
    d = matching.rescale(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars")
    return d.select("doc_id", r6("gaussian").alias("gaussian"), r6("uniform").alias("uniform"))


@query("SELECT event_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS change FROM events")
def consecutive_change(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return read(spark, sf_dir, "events").select("event_id", r6(F.col("value") - F.lag("value").over(w)).alias("change"))


_FUSED = " + ".join(f"(v[{i}] - ({mean})) / {deviation} * {weight}" for i, (mean, deviation, weight) in enumerate(matching.FUSED.values(), 1))


@query(f"""WITH {_E}, l AS (SELECT vec_id, list_transform(v[1:6], lambda x: exp(x)) AS x, v FROM e), p AS (SELECT vec_id, list_transform(x, lambda q: q / list_sum(x)) AS p, v FROM l)
SELECT vec_id, round(list_dot_product(p, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]), 6) AS rating, round(p[2] + 2 * p[3], 6) AS textbook, round(1 / (1 + exp(-(v[1] - 0.1) / 0.5)), 6) AS sigmoid,
round(least(greatest(v[2], 0.0), 1.0), 6) AS clipped, list_position(p, list_max(p)) AS label, round(1 / (1 + exp(-({_FUSED}))), 6) AS fused FROM p""")
def model_heads(spark, sf_dir):
    v = F.col("embedding").cast("array<double>")
    six = F.slice(v, 1, 6)
    p = vector.softmax(six)
    d = read(spark, sf_dir, "embeddings")
    return d.select(
        "vec_id",
        r6(heads.expected_rating(six)).alias("rating"),
        r6(heads.textbook(F.slice(p, 1, 3))).alias("textbook"),
        r6(vector.sigmoid((v[0] - 0.1) / 0.5)).alias("sigmoid"),
        F.round(numbers.clip(v[1], 0.0, 1.0), 6).alias("clipped"),
        F.array_position(p, F.array_max(p)).cast("int").alias("label"),
        r6(matching.fuse(v[0], v[1])).alias("fused"),
    )


_LISTS = "CASE WHEN o_orderkey % 3 = 0 THEN '[' || repeat('{\"tag\":\"x\"},', CAST(o_orderkey % 5 AS INTEGER)) || '1]' WHEN o_orderkey % 3 = 1 THEN '{\"k\":' || o_orderkey % 4 || ',\"m\":{\"x\":' || (o_orderkey % 2) || '.5}}' ELSE 'no json' END"


@query(f"""WITH j AS (SELECT o_orderkey, {_LISTS} AS j FROM orders)
SELECT o_orderkey, CAST(CASE WHEN json_valid(j) THEN json_array_length(j) ELSE 0 END AS INTEGER) AS n, CASE WHEN json_valid(j) THEN coalesce(json_extract_string(j, '$.k'), 'none') ELSE 'none' END AS k,
CASE WHEN json_valid(j) THEN coalesce(TRY_CAST(json_extract_string(j, '$.k') AS DOUBLE), 0.0) ELSE 0.0 END AS k_number, CASE WHEN json_valid(j) THEN coalesce(TRY_CAST(json_extract_string(j, '$.m.x') AS DOUBLE), 0.0) ELSE 0.0 END AS m_x FROM j""")
def json_fields(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.expr(_LISTS).alias("j"))
    return o.select("o_orderkey", text.json_list_length(F.col("j")).alias("n"), text.safe_get(F.col("j"), "k", "none").alias("k"), text.dotted(F.col("j"), "k").alias("k_number"), text.dotted(F.col("j"), "m.x").alias("m_x"))


@query("SELECT event_id, CAST(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS INTEGER) AS k FROM events")
def whole_numbers(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", text.whole_number(F.get_json_object("props", "$.k")).alias("k"))


@query(r"SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path, CAST(strlen(html) AS BIGINT) AS n_bytes, lower(html) LIKE '%<html%' AS is_html FROM pages")
def page_predicates(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    x = lambda rx: F.regexp_extract("url", rx, 1)
    return p.select("page_id", x("^([a-z]+)://").alias("scheme"), x("^[a-z]+://([^/?#]+)").alias("host"), x("^[a-z]+://[^/?#]+([^?#]*)").alias("path"), F.octet_length("html").cast("long").alias("n_bytes"), F.lower("html").contains("<html").alias("is_html"))


@query(f"WITH s AS ({_repetition_sql(5)}) SELECT doc_id AS item, 'NgramScorer' AS scorer, 'NgramScore' AS metric, CASE WHEN score = 0 THEN 0.0 ELSE round(score, CAST(3 - floor(log10(score)) AS INTEGER)) END AS score FROM s")
def score_record(spark, sf_dir):
    return record.long_scores(_QUERIES["ngram_repetition"](spark, sf_dir), "doc_id", "NgramScorer", {"NgramScore": "score"})


@query("SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY o_orderstatus")
def label_histogram(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id AS id, text, NULL AS html FROM documents UNION ALL SELECT page_id, NULL, html FROM pages")
def union_mixed(spark, sf_dir):
    return selection.union_all([read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), read(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "html")])


@query(r"WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents) SELECT doc_id, md5(array_to_string(CASE WHEN len(w) > 30 THEN w[1:20] || w[len(w) - 9:] ELSE w END, ' ')) AS digest FROM t")
def head_tail_truncate(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(F.array_join(heads.clip_truncate(text.words(F.col("text")), 20, 10), " ")).alias("digest"))


@query("SELECT event_id, user_id, round(value, 6) AS value FROM events")
def stream_scores(spark, sf_dir):
    """The table's files as a stream, in any order, scored and drained; replays of an event are dropped."""
    from plumbline.streaming import scores

    e = read(spark, sf_dir, "events")
    late = scores.covering_delay(e, "ts")
    plan = lambda rows: scores.score_stream(scores.drop_replays(rows, "event_id", "ts", late), {"value": r6("value")}).select("event_id", "user_id", "value")
    return scores.drain(spark, f"{sf_dir.rstrip('/')}/events.parquet", e.schema, plan, "scores")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS num, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max FROM events GROUP BY 1, 2")
def window_statistics(spark, sf_dir):
    """Statistics by hour and kind, from a stream of the table's files; each batch says what it changed."""
    from plumbline.streaming import scores

    e = read(spark, sf_dir, "events")
    late = scores.covering_delay(e, "ts")
    plan = lambda rows: scores.windowed(rows, "ts", "value", ["event_type"], late=late)
    out = scores.drain(spark, f"{sf_dir.rstrip('/')}/events.parquet", e.schema, plan, "windows", mode="update", keys=["window_start", "event_type"])
    return out.withColumn("window_start", F.col("window_start").cast(e.schema["ts"].dataType)).withColumn("mean", r6("mean"))


def queries() -> dict:
    from plumbline.plans import extras, measures  # noqa: F401  registers the rest

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
