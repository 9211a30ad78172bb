"""Registered queries of model heads, frame arithmetic, paths, samples and distances between sets.

Columns of the tables stand in for what a model would return.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import sinks
from plumbline.functions import nested, numbers, text, vector
from plumbline.operators import accounting, attributes, heads, matching, selection, vectors
from plumbline.plans.catalog import _CLEAN, _E, _LISTS, query, r6, read

_L = "SELECT l_orderkey, l_linenumber, l_quantity AS q, l_extendedprice AS p, l_discount AS d, l_tax AS t FROM lineitem"


def _lines(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_quantity AS q", "l_extendedprice AS p", "l_discount AS d", "l_tax AS t")


@query(f"SELECT l_orderkey, l_linenumber, round(power(10.0, (p / 20000.0) / (q + 1)), 1) AS perplexity FROM ({_L})")
def perplexity_head(spark, sf_dir):
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", heads.perplexity(-F.col("p") / 20000.0, F.col("q") + 1).alias("perplexity"))


@query(f"""SELECT l_orderkey, l_linenumber, CASE WHEN q < 5 THEN NULL WHEN d = 0 THEN 0.0 ELSE round(t / d, 6) END AS score FROM ({_L})""")
def following_difficulty(spark, sf_dir):
    output = F.when(F.col("q") < 5, "").otherwise("x")
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", r6(heads.following_difficulty(F.col("t"), F.col("d"), output)).alias("score"))


@query(f"""WITH {_E} SELECT vec_id, round(exp(v[2]) / (exp(v[1]) + exp(v[2])), 6) AS softmax, round(1 / (1 + exp(-v[2])), 6) AS sigmoid, round(v[1], 6) AS raw, round(least(greatest(v[1] * 10, 0.0), 5.0), 6) AS clipped FROM e""")
def two_class_heads(spark, sf_dir):
    v = F.col("embedding").cast("array<double>")
    two = F.slice(v, 1, 2)
    return read(spark, sf_dir, "embeddings").select(
        "vec_id", heads.two_class(two, 1).alias("softmax"), heads.two_class(two, 1, "sigmoid").alias("sigmoid"),
        heads.two_class(two, 0, "raw").alias("raw"), heads.two_class(F.transform(two, lambda x: x * 10), 0, "raw", 0.0, 5.0).alias("clipped"),
    )


_SCALE = heads.VIDEO_SCALES["FasterVQA"]
_TEN = "list_transform(list_transform(v[{a}:{b}], lambda x: exp(x)), lambda x: x / list_sum(list_transform(v[{a}:{b}], lambda y: exp(y))))"


@query(f"""WITH {_E}, p AS (SELECT vec_id, vec_id % 5 AS k, {_TEN.format(a=1, b=10)} AS a, {_TEN.format(a=11, b=20)} AS b FROM e),
s AS (SELECT vec_id, k, a[1] AS a0, a[2] AS a1, list_dot_product(a, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9]) AS one, list_dot_product(b, [0, .01, .02, .03, .04, .05, .06, .07, .08, .09]) AS two FROM p)
SELECT vec_id, round(CASE k WHEN 0 THEN -1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 0.9 * a0 + a1 WHEN 3 THEN one ELSE one + two END, 6) AS rating,
CASE k WHEN 0 THEN -2.0 WHEN 1 THEN -1000.0 WHEN 2 THEN -1.0 ELSE round(ln(a1), 6) END AS dialog FROM s""")
def rating_heads(spark, sf_dir):
    v = F.col("embedding").cast("array<double>")
    rows = read(spark, sf_dir, "embeddings").select("vec_id", (F.col("vec_id") % 5).alias("k"), vector.softmax(F.slice(v, 1, 10)).alias("a"), vector.softmax(F.slice(v, 11, 10)).alias("b"))
    stated = F.when(F.col("k") == 0, F.lit(None)).when(F.col("k") == 1, 1.5).when(F.col("k") == 2, 1.0).otherwise(0.5)
    second = F.when(F.col("k") == 4, F.col("b"))
    dialog = heads.dialog_score(F.col("k") == 0, F.when(F.col("k") > 2, F.ln(F.get("a", 1))), F.col("k") == 1)
    return rows.select("vec_id", r6(heads.rated(stated.cast("double"), F.col("a"), second)).alias("rating"), F.when(F.col("k") > 2, r6(dialog)).otherwise(dialog).alias("dialog"))


@query(f"""WITH {_E}, x AS (SELECT vec_id, v[1:32] AS a, v[33:64] AS b FROM e) SELECT vec_id, round(100 * list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 6) AS clip,
round(list_dot_product(a, b), 6) AS long_clip, round(exp(-list_avg(a)), 6) AS likelihood, round(1 / (1 + exp(-((a[1] - {_SCALE[0]}) / {_SCALE[1]}))), 6) AS quality FROM x""")
def picture_heads(spark, sf_dir):
    v = F.col("embedding").cast("array<double>")
    x = read(spark, sf_dir, "embeddings").select("vec_id", F.slice(v, 1, 32).alias("a"), F.slice(v, 33, 32).alias("b"))
    return x.select("vec_id", r6(heads.clip_score(F.col("a"), F.col("b"))).alias("clip"), r6(vector.dot(F.col("a"), F.col("b"))).alias("long_clip"), r6(heads.answer_likelihood(F.col("a"))).alias("likelihood"), r6(heads.video_quality(F.get("a", 0))).alias("quality"))


@query(f"""WITH {_E} SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN 0.0 ELSE round(list_avg(v), 6) END AS avg, CASE WHEN vec_id % 7 = 0 THEN 0.0 ELSE round(list_max(v) / 10, 6) END AS max, CASE WHEN vec_id % 7 = 0 THEN 0.0 ELSE round(list_min(v), 6) END AS min,
['Low', 'Medium', 'High'][list_position(v[1:3], list_max(v[1:3]))] AS label FROM e""")
def frame_reductions(spark, sf_dir):
    v = F.col("embedding").cast("array<double>")
    frames = F.when(F.col("vec_id") % 7 == 0, F.array().cast("array<double>")).otherwise(v)
    labels = F.array(F.lit("Low"), F.lit("Medium"), F.lit("High"))
    return read(spark, sf_dir, "embeddings").select(
        "vec_id", r6(heads.reduced(frames)).alias("avg"), r6(heads.reduced(frames, "max", 10.0)).alias("max"), r6(heads.reduced(frames, "min")).alias("min"),
        vector.argmax_label(F.slice(v, 1, 3), labels).alias("label"),
    )


@query("""WITH p AS (SELECT p_partkey, p_size AS n FROM part)
SELECT p_partkey, array_to_string(list_transform(range(0, 12), lambda k: (CASE WHEN n > 7 THEN CAST(floor((k // 4) * ((n - 7) / 3.0) + (n - 7) / 3.0 / 2) AS INTEGER) ELSE 0 END + (k % 4) * 2) % n), ',') AS even,
array_to_string(list_transform(range(0, 6), lambda k: CAST(((n // 3) * (k // 2) + floor(0.5 * greatest(n // 3 - 2, 0)) + k % 2) AS INTEGER) % n), ',') AS fragments,
CASE WHEN least(4, n) = 1 THEN '0.5' ELSE array_to_string(list_transform(range(0, least(4, n)), lambda i: round(i * 1.0 / (least(4, n) - 1), 4)), ',') END AS seconds,
CAST(greatest(least(round_even(n / least(4.0, n), 0), n - 1), 1) AS INTEGER) AS step FROM p""")
def frame_numbers(spark, sf_dir):
    n = F.col("p_size")
    shown = F.array_join(F.transform(heads.extraction_seconds(F.lit(1.0), n, 4), lambda x: F.round(x, 4).cast("string")), ",")
    half = F.array_repeat(F.lit(0.5), 3)
    return read(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(heads.frame_indices(n, 3, 4, 2), ",").alias("even"), F.array_join(heads.fragment_frames(n, 3, 2, 1, half), ",").alias("fragments"),
        shown.alias("seconds"), heads.motion_step(n.cast("double"), n, 4.0).alias("step"),
    )


@query("""WITH p AS (SELECT p_partkey, 100 + p_size AS h, 80 + 3 * p_size AS w FROM part)
SELECT p_partkey, array_to_string(list_transform(range(0, 6), lambda c: (least((h // 2) * (c // 3), h - 32) + CAST(floor(0.25 * greatest(h // 2 - 32, 0)) AS INTEGER)) || ':' || (least((w // 3) * (c % 3), w - 32) + CAST(floor(0.25 * greatest(w // 3 - 32, 0)) AS INTEGER))), ',') AS corners FROM p""")
def patch_corners(spark, sf_dir):
    grid = heads.fragment_grid(F.col("p_size") + 100, F.col("p_size") * 3 + 80, 2, 3, 32, F.array_repeat(F.lit(0.25), 6))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(grid, lambda g: F.concat_ws(":", g["top"], g["left"])), ",").alias("corners"))


@query(r"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')[1:20] AS w FROM documents) SELECT doc_id, len(w) AS real, greatest(16 - len(w), 0) AS fill, list_sum(list_transform(w, lambda x: length(x))) AS total FROM t""")
def padding(spark, sf_dir):
    tokens = F.transform(F.slice(text.words(F.col("text")), 1, 20), lambda x: F.length(x))
    ids, mask = heads.padded(F.col("ids"), 16)
    d = read(spark, sf_dir, "documents").select("doc_id", tokens.alias("ids")).select("doc_id", ids.alias("p"), mask.alias("m"))
    total = F.aggregate("p", F.lit(0), lambda a, x: a + x).cast("decimal(38,0)")
    real = F.aggregate("m", F.lit(0), lambda a, x: a + x).cast("long")
    return d.select("doc_id", real.alias("real"), (F.size("m") - real).cast("long").alias("fill"), F.when(real > 0, total).alias("total"))


@query("""WITH c AS (SELECT conv_id, list(struct_pack(role := role, t := coalesce(text, '')) ORDER BY turn, role, text) AS l FROM conversations GROUP BY conv_id),
k AS (SELECT conv_id, array_to_string(list_filter(list_transform(list_filter(l, lambda x: x.role <> 'user'), lambda x: x.t), lambda x: x <> ''), chr(10) || chr(10)) AS t FROM c)
SELECT conv_id, md5(t) AS content, md5(CASE WHEN length(t) <= 60 THEN t ELSE left(t, 40) || right(t, 20) END) AS cut FROM k""")
def document_content(spark, sf_dir):
    item = F.struct(F.when(F.col("role") == "user", "hr").otherwise("text").alias("type"), F.lit(None).cast("string").alias("md"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("array<string>").alias("drop_it_list"))
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("t"), item.alias("i")))).alias("l"))  # a conversation's own turns
    d = c.select("conv_id", heads.document_content(F.transform("l", lambda x: x["i"])).alias("t"))
    return d.select("conv_id", F.md5("t").alias("content"), F.md5(heads.truncated_content(F.col("t"), 40, 20)).alias("cut"))


@query("SELECT conv_id, turn, role, TRY_CAST(string_split_regex(string_split(trim(coalesce(r, '')), chr(10))[1], '\\s+')[1] AS DOUBLE) AS rating FROM (SELECT conv_id, turn, role, CASE turn % 3 WHEN 0 THEN ' ' || turn || '.5 of 5' || chr(10) || 'why' WHEN 1 THEN 'none ' || turn ELSE '' || turn END AS r FROM conversations)")
def judge_numbers(spark, sf_dir):
    turn = F.col("turn")
    reply = F.when(turn % 3 == 0, F.concat(F.lit(" "), turn.cast("string"), F.lit(".5 of 5\nwhy"))).when(turn % 3 == 1, F.concat(F.lit("none "), turn.cast("string"))).otherwise(turn.cast("string"))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", heads.judge_number(reply).alias("rating"))


@query("""WITH s AS (SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) * o_orderkey * o_orderkey AS n, o_totalprice AS x FROM orders)
SELECT o_orderkey, CASE WHEN n < 1000 THEN CAST(n AS BIGINT) || ' B' WHEN n < 1e6 THEN printf('%.1f KB', n / 1e3) WHEN n < 1e9 THEN printf('%.1f MB', n / 1e6) WHEN n < 1e12 THEN printf('%.1f GB', n / 1e9) ELSE printf('%.1f TB', n / 1e12) END AS size FROM s""")
def readable_size(spark, sf_dir):
    n = F.col("o_orderkey").cast("double") * F.col("o_orderkey") * F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", numbers.size_of(n).alias("size"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, base64(encode(props)) AS coded, sha256(props) AS digest FROM events""")
def stamps_and_codes(spark, sf_dir):
    shown, seconds = text.stamp(F.col("ts"))
    return read(spark, sf_dir, "events").select("event_id", shown.alias("shown"), seconds.alias("seconds"), F.base64(F.encode("props", "UTF-8")).alias("coded"), F.sha2("props", 256).alias("digest"))


@query(r"""WITH p AS (SELECT page_id, unnest([url, regexp_replace(url, '^https?://', 's3://'), regexp_replace(url, '^https?://', 's3a://') || '.jsonl.gz', regexp_replace(url, '^https?:/', '')]) AS p FROM pages)
SELECT page_id, p AS path, regexp_matches(p, '^s3a?://') AS object, regexp_replace(p, '^s3a?://', 's3a://') AS s3a, regexp_extract(p, '^s3a?://([^/]+)(?:/(.*))?$', 1) AS bucket, regexp_extract(p, '^s3a?://([^/]+)(?:/(.*))?$', 2) AS key,
regexp_extract(p, '([^/]+?)(\.jsonl)?(\.gz)?$', 1) || '_output.json' AS output FROM p""")
def object_paths(spark, sf_dir):
    """Addresses of all pages as they are, as objects of either scheme, and as local paths."""
    url = F.col("url")
    forms = [url, F.regexp_replace(url, "^https?://", "s3://"), F.concat(F.regexp_replace(url, "^https?://", "s3a://"), F.lit(".jsonl.gz")), F.regexp_replace(url, "^https?:/", "")]
    p = read(spark, sf_dir, "pages").select("page_id", F.explode(F.array(*forms)).alias("p"))
    bucket, key = text.bucket_and_key(F.col("p"))
    return p.select("page_id", F.col("p").alias("path"), text.is_object_path(F.col("p")).alias("object"), text.object_path(F.col("p")).alias("s3a"), bucket.alias("bucket"), key.alias("key"), sinks.output_name(F.col("p")).alias("output"))


@query("""WITH p AS (SELECT page_id, CASE WHEN html ILIKE '%<form%' THEN 'request' ELSE 'response' END AS kind, CASE WHEN html ILIKE '%<html%' THEN 'text/HTML; charset=utf-8' ELSE 'text/plain' END AS c, CASE WHEN html ILIKE '%404%' THEN 404 ELSE 200 END AS s FROM pages)
SELECT page_id, kind = 'response' AND lower(c) LIKE '%html%' AND s < 400 AS kept FROM p""")
def web_predicates(spark, sf_dir):
    """The three conditions on what the pages hold."""
    from plumbline.sources.warc import keep_pages

    low = F.lower("html")
    kept = keep_pages(F.when(low.contains("<form"), "request").otherwise("response"), F.when(low.contains("<html"), "text/HTML; charset=utf-8").otherwise("text/plain"), F.when(low.contains("404"), 404).otherwise(200))
    return read(spark, sf_dir, "pages").select("page_id", kept.alias("kept"))


@query("""WITH p AS (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'no status' END AS error FROM pages) SELECT page_id FROM p WHERE error IS NULL""")
def error_rows_skipped(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 4 == 0, "no status").alias("error"))
    return accounting.without_errors(rows)


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 7")
def early_stop(spark, sf_dir):
    return accounting.early_stop(read(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 7)


@query("SELECT doc_id, upper(lang) AS content FROM documents WHERE n_chars >= 300")
def rules_by_name(spark, sf_dir):
    rules = selection.Rules()
    rules.filter("short", lambda c: c("n_chars") < 300)
    rules.rewrite("upper", lambda c: F.upper(c("lang")))
    return rules.apply(read(spark, sf_dir, "documents"), drop=["short"], content="upper").select("doc_id", "content")


@query(r"""WITH c AS (SELECT 'd/f' || doc_id % 50 || CASE WHEN doc_id % 2 = 0 THEN '.jsonl.gz' ELSE '.jsonl' END AS content_file, 'd/f' || doc_id % 50 AS stem FROM documents GROUP BY ALL),
a AS (SELECT DISTINCT 'd/f' || doc_id % 70 || '-attr-' || CASE WHEN doc_id % 3 = 0 THEN 'q' ELSE 'len' END || '.npy' AS attribute_file FROM documents)
SELECT content_file, attribute_file FROM c JOIN a ON regexp_extract(attribute_file, '^(.*)-attr-q\b', 1) = stem""")
def attribute_names(spark, sf_dir):
    k = F.col("doc_id")
    d = read(spark, sf_dir, "documents")
    c = d.select(F.concat(F.lit("d/f"), (k % 50).cast("string"), F.when(k % 2 == 0, ".jsonl.gz").otherwise(".jsonl")).alias("content_file")).distinct()
    a = d.select(F.concat(F.lit("d/f"), (k % 70).cast("string"), F.lit("-attr-"), F.when(k % 3 == 0, "q").otherwise("len"), F.lit(".npy")).alias("attribute_file")).distinct()
    return attributes.match_by_name(c, a, "q").select("content_file", "attribute_file")


@query("""WITH r AS (SELECT user_id, event_id AS candidate, unnest(CASE WHEN event_id % 3 = 0 THEN [value, value + 1] ELSE [value] END) AS v FROM events) SELECT candidate, round(max(v), 6) AS best FROM r GROUP BY candidate""")
def references_regrouped(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", "value", F.when(F.col("event_id") % 3 == 0, F.array(F.col("value"), F.col("value") + 1)).otherwise(F.array("value")).alias("refs"))
    rows = matching.expand_references(e, "event_id", "value", "refs")
    return matching.best_reference(rows, "event_id", "reference").select(F.col("event_id").alias("candidate"), r6("reference").alias("best"))


@query(r"""WITH s AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL), n AS (SELECT md5(text) AS digest, CAST(len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS BIGINT) AS words FROM s) SELECT digest, words, CAST(row_number() OVER (ORDER BY words DESC, digest) - 1 AS BIGINT) AS pos FROM n""")
def longest_first(spark, sf_dir):
    return selection.longest_first(read(spark, sf_dir, "documents"), "text")


@query("SELECT source, amount, CAST(row_number() OVER (ORDER BY amount DESC, source) - 1 AS BIGINT) AS pos FROM (SELECT source, CAST(sum(n_chars) AS BIGINT) AS amount FROM documents GROUP BY source)")
def weights_in_order(spark, sf_dir):
    from plumbline.plans.indexing import with_position

    w = accounting.weights(read(spark, sf_dir, "documents"), "source", F.col("n_chars")).select("source", "amount")
    return with_position(w, F.desc("amount"), "source")


@query(f"WITH {_E}, a AS (SELECT * FROM e WHERE label < 2), b AS (SELECT * FROM e WHERE label BETWEEN 2 AND 3), d AS (SELECT 1 - list_cosine_similarity(a.v, b.v) AS d FROM a, b) SELECT count(*) AS n, round(avg(d), 6) AS mean, round(stddev_pop(d), 6) AS std, round(sum(d), 3) AS sum FROM d")
def cross_set_distances(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return vectors.cross_distance_statistics(e.where("label < 2"), e.where("label BETWEEN 2 AND 3")).select("n", r6("mean").alias("mean"), r6("std").alias("std"), F.round("sum", 3).alias("sum"))


@query(f"WITH {_E}, f AS (SELECT vec_id, unnest(range(0, len(v))) AS i, unnest(v) AS x FROM e), q AS (SELECT i, sqrt(avg(x * x)) AS q FROM f GROUP BY i) SELECT CAST(i AS INTEGER) AS i, round(sum(x / q), 5) AS total, round(sum((x / q) ** 2), 5) AS squares FROM f JOIN q USING (i) GROUP BY i")
def normalised_components(spark, sf_dir):
    return vectors.normalised(read(spark, sf_dir, "embeddings")).groupBy("i").agg(F.round(F.sum("x"), 5).alias("total"), F.round(F.sum(F.col("x") * F.col("x")), 5).alias("squares"))


_GRAMS4 = " UNION ALL ".join(f"SELECT c AS i, {n} AS n, unnest(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' '))) AS g FROM t" for n in (1, 2, 3, 4))


@query(rf"""WITH t AS (SELECT conv_id AS c, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM conversations WHERE turn = 0 AND conv_id IN (SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations) ORDER BY md5('0:' || CAST(conv_id AS VARCHAR)), conv_id LIMIT 200)),
g AS ({_GRAMS4}), c AS (SELECT i, n, g, count(*) AS c FROM g GROUP BY ALL), l AS (SELECT i, n, sqrt(sum(c * c)) AS len FROM c GROUP BY i, n), u AS (SELECT i, n, g, c / len AS w FROM c JOIN l USING (i, n))
SELECT a.i AS i, b.i AS j, round(sum(a.w * b.w) / 4, 6) AS k FROM u a JOIN u b ON a.n = b.n AND a.g = b.g AND a.i <= b.i GROUP BY a.i, b.i""")
def ngram_similarity(spark, sf_dir):
    """The similarity matrix of a drawn sample (the operator's input, as the matrix is quadratic): 200 conversations' first turns."""
    turns = read(spark, sf_dir, "conversations")
    drawn = selection.sample_by_hash(turns.select("conv_id").distinct(), "conv_id", 200)
    c = turns.where("turn = 0").join(drawn, "conv_id").select(F.col("conv_id").alias("c"), "text")
    return vectors.ngram_gram(c, "c", text.words(F.col("text"))).select("i", "j", r6("k").alias("k"))


@query(f"""WITH {_E}, s AS (SELECT vec_id, list_transform(v, lambda x: exp(x)) AS x FROM e), p AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos, list_transform(x, lambda y: y / list_sum(x)) AS p FROM s),
d AS (SELECT *, pos // ((SELECT count(*) FROM e) // 7) AS split FROM p WHERE pos < ((SELECT count(*) FROM e) // 7) * 7), f AS (SELECT split, vec_id, unnest(range(0, len(p))) AS i, unnest(p) AS p FROM d),
m AS (SELECT split, i, avg(p) AS q FROM f GROUP BY split, i), k AS (SELECT split, exp(sum(p * ln(p / q)) / count(DISTINCT vec_id)) AS score FROM f JOIN m USING (split, i) GROUP BY split)
SELECT count(*) AS splits, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std FROM k""")
def inception_splits(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("vec_id", vector.softmax(F.col("embedding").cast("array<double>")).alias("p"))
    return vectors.inception_splits(e, "p", "vec_id", 7).select("splits", r6("mean").alias("mean"), r6("std").alias("std"))


@query()
def kernel_distance_subsets(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    out = vectors.kernel_distance_subsets(e.where("label < 5"), e.where("label >= 5"), 20, 100)
    return out.select("subsets", r6("mean").alias("mean"), r6("std").alias("std"))


@query(f"""WITH {_E}, u AS (SELECT vec_id, v, list_transform(range(0, 4), lambda k: v[k * 16 + 1:k * 16 + 16]) AS t, list_transform(range(0, 4), lambda k: 1.0 + abs(v[k + 1])) AS w FROM e), n AS (SELECT vec_id, v, w, list_transform(t, lambda x: list_transform(x, lambda y: y / sqrt(list_dot_product(x, x)))) AS t FROM u),
p AS (SELECT a.vec_id, a.t AS h, b.t AS r, a.w AS hw, b.w AS rw, list_cosine_similarity(a.v, b.v) AS c FROM n a JOIN n b ON b.vec_id = a.vec_id + 1),
s AS (SELECT vec_id, c, list_dot_product(list_transform(h, lambda x: list_max(list_transform(r, lambda y: list_dot_product(x, y)))), hw) / list_sum(hw) AS p, list_dot_product(list_transform(r, lambda x: list_max(list_transform(h, lambda y: list_dot_product(x, y)))), rw) / list_sum(rw) AS r FROM p),
f AS (SELECT *, 2 * p * r / (p + r) AS f FROM s) SELECT vec_id, round(c, 6) AS cogr, round((p + c) / 2, 6) AS full_precision, round((r + c) / 2, 6) AS full_recall, round((f + c) / 2, 6) AS full_f, round(((f + c) / 2 + f) / 2, 6) AS full_f_both FROM f""")
def weighted_match(spark, sf_dir):
    parts = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: vector.normalise(F.slice(F.col("embedding"), k * 16 + 1, 16)))
    weights = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: 1.0 + F.abs(F.get("embedding", k).cast("double")))
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"), parts.alias("hyp"), weights.alias("hw"))
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"), F.col("hyp").alias("ref"), F.col("hw").alias("rw"))
    pairs = e.join(other, "vec_id")
    fine = matching.greedy_match(pairs, "vec_id", hyp_weight="hw", ref_weight="rw").join(pairs.select("vec_id", "a", "b"), "vec_id")
    full = matching.full_match(fine, vector.cosine(F.col("a"), F.col("b")))
    both = matching.combined(full.select("vec_id", "full_f"), full.select("vec_id", F.col("f").alias("full_f")), "vec_id", ["full_f"])
    return full.join(both, "vec_id").select("vec_id", *[r6(c).alias(c) for c in ("cogr", "full_precision", "full_recall", "full_f", "full_f_both")])


@query("""WITH k AS (SELECT l_linenumber AS rater, l_orderkey, rank() OVER (PARTITION BY l_linenumber ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_linenumber, l_discount) - 1) / 2 AS a, rank() OVER (PARTITION BY l_linenumber ORDER BY l_tax) + (count(*) OVER (PARTITION BY l_linenumber, l_tax) - 1) / 2 AS b FROM lineitem WHERE l_linenumber <= 3),
c AS (SELECT rater, corr(a, b) AS c FROM k GROUP BY rater) SELECT count(*) AS raters, round(avg(c), 4) AS spearman FROM c""")
def mean_rater_correlation(spark, sf_dir):
    by = matching.spearman(read(spark, sf_dir, "lineitem").where("l_linenumber <= 3"), "l_linenumber", "l_discount", "l_tax")
    return matching.mean_over_raters(by, "l_linenumber", "spearman")


@query("""WITH s AS (SELECT o_orderkey, o_totalprice AS x FROM orders WHERE o_orderkey % 10 = 0), t AS (SELECT o_totalprice AS y FROM orders WHERE o_orderkey % 10 <> 0), n AS (SELECT count(*) AS n, sum(y) AS t, sum(y * y) AS q FROM t), o AS (SELECT list(y ORDER BY y) AS l FROM t),
b AS (SELECT o_orderkey, x, (SELECT count(*) FROM t WHERE y < x) AS less FROM s)
SELECT o_orderkey, round(less / (n + 1), 6) AS uniform, round((x - (t + x) / (n + 1)) / sqrt((q + x * x) / (n + 1) - ((t + x) / (n + 1)) ** 2), 4) AS gaussian FROM b, n""")
def percentile_against(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    out = matching.percentile_against(o.where("o_orderkey % 10 = 0"), o.where("o_orderkey % 10 <> 0"), "o_totalprice")
    return out.select("o_orderkey", r6("uniform").alias("uniform"), F.round("gaussian", 4).alias("gaussian"))


@query("""SELECT l_orderkey, l_linenumber, list_sum([l_quantity * 2, l_discount * 2]) AS total, CAST(l_tax * 2 AS DOUBLE) AS tax, 2 AS size, CAST(l_discount AS DOUBLE) AS second FROM lineitem""")
def nested_scores(spark, sf_dir):
    shape = F.struct(F.array(F.col("l_quantity").cast("double"), F.col("l_discount").cast("double")).alias("video"), F.struct(F.col("l_tax").cast("double").alias("tax")).alias("meta"))
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", shape.alias("s"))
    kind = rows.schema["s"].dataType
    rows = rows.withColumn("d", nested.map_leaves(F.col("s"), kind, lambda x: x * 2))
    return rows.select("l_orderkey", "l_linenumber", F.aggregate("d.video", F.lit(0.0), lambda a, x: a + x).alias("total"), F.col("d.meta.tax").alias("tax"), nested.leaf_length(F.col("s"), kind).alias("size"), nested.leaf_item(F.col("s"), kind, 1)["video"].alias("second"))


@query(r"""WITH r AS (SELECT source, doc_id, list_transform(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''), lambda x: length(x)) AS w FROM documents) SELECT source, doc_id, CAST(len(w) AS BIGINT) AS len, md5(array_to_string(w, ',')) AS digest FROM r""")
def ragged_round_trip(spark, sf_dir):
    """Arrays laid flat by source, and back by their offsets."""
    from plumbline.plans.indexing import with_running

    rows = read(spark, sf_dir, "documents").select("source", "doc_id", F.transform(text.words(F.col("text")), lambda x: F.length(x)).alias("w"))
    layout = attributes.flat_layout(rows, "source", "doc_id", F.col("w"))
    flat = layout.select("source", "off", F.posexplode("w").alias("k", "value")).select("source", (F.col("off") + F.col("k")).alias("i"), "value")
    back = attributes.read_ragged(layout.select("source", "doc_id", "off", "len"), flat, "source")
    return back.select("source", "doc_id", "len", F.md5(F.array_join("values", ",")).alias("digest"))


@query(f"WITH j AS (SELECT o_orderkey, {_LISTS} AS j FROM orders) SELECT o_orderkey, json_valid(j) AS valid FROM j")
def lenient_json(spark, sf_dir):
    """Python literals of the same values are read as JSON is."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.expr(_LISTS).alias("j"))
    return o.select("o_orderkey", text.lenient_json(F.replace("j", F.lit('"'), F.lit("'"))).isNotNull().alias("valid"))


@query(f"WITH t AS (SELECT doc_id, {_CLEAN} AS w FROM documents) SELECT doc_id, CAST(len(list_distinct(w)) AS BIGINT) AS types FROM t")
def distinct_words(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.size(F.array_distinct(text.clean_words(F.col("text")))).cast("long").alias("types"))
