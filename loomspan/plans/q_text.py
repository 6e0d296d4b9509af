"""Queries of text, diff, schedule and cost functions."""

from pyspark.sql import functions as F

from loomspan.functions import text as X

from .registry import Registry, table

Q = Registry()


@Q.query("SELECT p_partkey AS id, 1 - levenshtein(p_name, p_type) / greatest(strlen(p_name), strlen(p_type))::DOUBLE AS similarity FROM part")
def text_edit_similarity(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), X.edit_similarity(F.col("p_name"), F.col("p_type")).alias("similarity"))


@Q.query("""WITH w AS (SELECT a.item_id, list_distinct(list_filter(regexp_split_to_array(lower(a.text), '\\s+'), lambda x: x <> '')) AS x, list_distinct(list_filter(regexp_split_to_array(lower(b.text), '\\s+'), lambda x: x <> '')) AS y FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1)
SELECT item_id, len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y)))::DOUBLE AS jaccard FROM w""")
def text_word_jaccard(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    n = b.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other"))
    return b.join(n, "item_id").select("item_id", X.word_jaccard(F.col("text"), F.col("other")).alias("jaccard"))


SIDES = """SELECT doc_id, coalesce(text, '') || ' 12 3.5 ' || doc_id || CASE WHEN doc_id % 3 = 0 THEN chr(10) || '| a |' || chr(10) || '|-|' || chr(10) || '| :--- | ---: |' || chr(10) ELSE '' END AS a,
CASE WHEN doc_id % 7 = 0 THEN '' ELSE substr(coalesce(text, ''), 1, CAST(floor(length(coalesce(text, '')) * (doc_id % 5 + 1) / 4) AS INT)) || CASE WHEN doc_id % 2 = 0 THEN ' 12 ' || doc_id ELSE '' END END AS b FROM documents"""


@Q.query(rf"""WITH d AS ({SIDES}), n AS (SELECT doc_id, a, b, length(a) + len(regexp_extract_all(a, '[\x{{10000}}-\x{{10FFFF}}]')) AS x, length(b) + len(regexp_extract_all(b, '[\x{{10000}}-\x{{10FFFF}}]')) AS y, list_distinct(regexp_extract_all(a, '\d+(?:\.\d+)?')) AS p, list_distinct(regexp_extract_all(b, '\d+(?:\.\d+)?')) AS q FROM d),
k AS (SELECT *, CASE WHEN y > 0 THEN x / y WHEN x > 0 THEN 0 ELSE 1 END AS r, CASE WHEN len(q) > 0 THEN len(list_intersect(p, q)) / len(q) WHEN len(p) > 0 THEN 0 ELSE 1 END AS s FROM n)
SELECT doc_id, CAST(x AS INT) AS length, CAST(y AS INT) AS other_length, floor(r * 1000 + 0.5) / 1000 AS length_ratio, CAST(len(p) AS INT) AS numbers, CAST(len(q) AS INT) AS other_numbers, floor(s * 1000 + 0.5) / 1000 AS numbers_kept,
CAST(len(regexp_extract_all(a, '(?m)^\s*(?:\|\s*:?-+:?\s*)+\|\s*$')) AS INT) AS tables, CAST(len(regexp_extract_all(b, '(?m)^\s*(?:\|\s*:?-+:?\s*)+\|\s*$')) AS INT) AS other_tables, CASE WHEN r >= 0.8 AND s >= 0.9 THEN 'good' WHEN r >= 0.5 AND s >= 0.7 THEN 'acceptable' ELSE 'poor' END AS grade FROM k""")
def text_compare_outputs(spark, sf_dir):
    d = spark.sql(SIDES.replace("FROM documents", "FROM {documents}"), documents=table(spark, sf_dir, "documents"))
    return d.select("doc_id", X.compare_outputs(F.col("a"), F.col("b")).alias("c")).select("doc_id", "c.*")


@Q.query("""SELECT doc_id, substr(coalesce(text, ''), 1, 280) AS trimmed, regexp_replace('<|site-page-1-lllmstxt|>' || chr(10) || doc_id, '<\\|[^|]*page-\\d+[^|]*\\|>\\n?', '', 'g') AS unmarked FROM documents""")
def text_trim(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.trim_tokens(F.coalesce("text", F.lit("")), 100).alias("trimmed"), X.without_page_marks(F.concat(F.lit("<|site-page-1-lllmstxt|>\n"), F.col("doc_id").cast("string"))).alias("unmarked"))


@Q.query("""WITH p(model, pi, po) AS (VALUES ('gpt-4o-mini', 0.15, 0.6), ('openai/gpt-4o', 2.5, 10), ('deepseek/deepseek-r1', 0.55, 2.19)), m AS (SELECT CASE l_linenumber % 5 WHEN 0 THEN 'gpt-4o-mini' WHEN 1 THEN 'openai/gpt-4o' WHEN 2 THEN 'google/gemini-2.5-pro-exp' WHEN 3 THEN 'deepseek/deepseek-r1' ELSE 'unknown' END AS model, CAST(l_partkey * 300 AS BIGINT) AS i, CAST(l_suppkey * 10 AS BIGINT) AS o FROM lineitem)
SELECT model, round(sum(CASE WHEN contains(model, 'gemini-2.5-pro') THEN CASE WHEN i > 200000 THEN (i * 2.5 + o * 15) / 1e6 ELSE (i * 1.25 + o * 10) / 1e6 END ELSE (i * coalesce(pi, 0) + o * coalesce(po, 0)) / 1e6 END), 4)::DOUBLE AS cost FROM m LEFT JOIN p USING (model) GROUP BY model""")
def llm_costs(spark, sf_dir):
    n = F.col("l_linenumber") % 5
    model = F.when(n == 0, "gpt-4o-mini").when(n == 1, "openai/gpt-4o").when(n == 2, "google/gemini-2.5-pro-exp").when(n == 3, "deepseek/deepseek-r1").otherwise("unknown")
    m = table(spark, sf_dir, "lineitem").select(model.alias("model"), (F.col("l_partkey") * 300).alias("n_in"), (F.col("l_suppkey") * 10).alias("n_out"))
    return X.with_llm_cost(m, X.price_table(spark)).groupBy("model").agg(F.round(F.sum("cost"), 4).alias("cost"))


@Q.query("""WITH o AS (SELECT o_orderkey AS id, o_orderdate AS t, o_custkey * 1500 AS ttl FROM orders) SELECT id, t + to_microseconds(CAST(ttl * 1000 AS BIGINT)) AS expires_at FROM o""")
def group_expiry(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), X.expires_at(F.col("o_orderdate"), F.col("o_custkey") * 1500).alias("expires_at"))


@Q.query("""WITH m AS (SELECT p_partkey AS id, [p_brand, p_size::VARCHAR, 'x'] AS a, [p_brand, (p_size + p_partkey % 2)::VARCHAR, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'x' END] AS b FROM part), k AS (SELECT id, unnest(['brand', 'size', 'kind']) AS key, unnest(a) AS previous, unnest(b) AS current FROM m)
SELECT id, key, previous, current FROM k WHERE previous IS DISTINCT FROM current""")
def record_diff(spark, sf_dir):
    i, s = F.col("p_partkey"), F.col("p_size")
    a = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), s.cast("string"), F.lit("kind"), F.lit("x"))
    b = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), (s + i % 2).cast("string"), F.lit("kind"), F.when(i % 3 == 0, None).otherwise("x"))
    d = table(spark, sf_dir, "part").select(i.alias("id"), X.map_diff(a, b).alias("d"))
    return d.select("id", F.explode("d").alias("key", "v")).select("id", "key", "v.previous", "v.current")


@Q.query("""SELECT event_id, 'a' AS path, 'a' AS previous, 'b' AS current FROM events WHERE event_id < 0""")
def json_leaf_diff_same(spark, sf_dir):
    """A document differs from itself nowhere, whatever the order of keys."""
    diff = F.udf(X.json_diff, "array<struct<path:string,previous:string,current:string>>", useArrow=True)
    return table(spark, sf_dir, "events").select("event_id", F.explode(diff("props", "props")).alias("d")).select("event_id", "d.*")


@Q.query()
def json_leaf_diff(spark, sf_dir):
    """Leaves in which each event's properties differ from the user's previous event's."""
    from pyspark.sql import Window

    diff = F.udf(X.json_diff, "array<struct<path:string,previous:string,current:string>>", useArrow=True)
    e = table(spark, sf_dir, "events").select("event_id", "props", F.lag("props").over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("before"))
    return e.where("before is not null").select("event_id", F.explode(diff("before", "props")).alias("d")).select("event_id", "d.*")


@Q.query("""SELECT o_orderkey AS id, date_trunc('hour', o_orderdate) + INTERVAL 1 HOUR AS hourly, date_trunc('day', o_orderdate) + INTERVAL 1 DAY AS daily, date_trunc('day', o_orderdate) + INTERVAL (CASE dayofweek(o_orderdate) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END) DAY + INTERVAL 9 HOUR AS workdays FROM orders""")
def schedule_next(spark, sf_dir):
    t = F.col("o_orderdate").cast("timestamp_ntz")
    hourly, daily = (X.next_runs(X.schedule_text(text), t) for text in ("hourly", "daily"))
    # at nine the day after, on Monday to Friday: times before nine of a working day have their own day's run
    at_nine = F.date_trunc("day", F.col("o_orderdate")).cast("timestamp_ntz") + F.expr("interval 9 hours")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), hourly.alias("hourly"), daily.alias("daily"), X.next_runs("0 9 * * 1-5", at_nine).alias("workdays"))


@Q.query("""SELECT page_id, regexp_matches(hex(encode(substr(html, 1, 1024))), '^(..)*25504446') AS is_pdf, CASE WHEN regexp_matches(lower(url), '\\.odt$') THEN 'odt' WHEN regexp_matches(lower(url), '\\.rtf$') THEN 'rtf' WHEN regexp_matches(lower(url), '\\.xlsx?$') THEN 'xlsx' ELSE 'docx' END AS document_type FROM pages""")
def document_sniff(spark, sf_dir):
    from loomspan.sources.files import document_type

    return table(spark, sf_dir, "pages").select("page_id", X.is_pdf(F.col("html").cast("binary")).alias("is_pdf"), document_type(F.col("url")).alias("document_type"))


