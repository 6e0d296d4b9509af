"""Queries of ranking, sort, limits and paging."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomspan.functions import urls as U
from loomspan.operators import ranking as R

from .q_tallies import JOBS, jobs
from .registry import Registry, table

Q = Registry()


def _count(word, col="lower(url)"):
    return f"len(regexp_extract_all({col}, '{word}'))"


def _vec(col):
    return "[" + ", ".join(f"{_count(w, f'lower({col})')} / length({col})" for w in ("example", "en", "docs")) + "]"


@Q.query(f"""WITH v AS (SELECT page_id, {_vec('url')} AS a, {_vec("'example en docs'")} AS b FROM pages), s AS (SELECT page_id, CASE WHEN list_dot_product(a, a) = 0 THEN 0 ELSE list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))) END AS score FROM v)
SELECT page_id, score::DOUBLE AS score, CAST(row_number() OVER (PARTITION BY regexp_extract(url, '^[^:]*://([^/?#:]*)', 1) ORDER BY round(score, 9) DESC, page_id) AS INT) AS place FROM s JOIN pages USING (page_id)""")
def rank_by_words(spark, sf_dir):
    """Every URL's place among those of its host."""
    s = table(spark, sf_dir, "pages").select("page_id", U.host(F.col("url")).alias("host"), R.word_cosine(F.col("url"), "example en docs").alias("score"))
    return s.withColumn("place", F.row_number().over(Window.partitionBy("host").orderBy(F.round("score", 9).desc(), "page_id"))).drop("host")


@Q.query("""WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id, list_cosine_similarity(embedding::DOUBLE[], q.e::DOUBLE[]) AS score FROM embeddings, q)
SELECT vec_id, round(score, 6) AS score FROM s""")
def rank_by_embedding(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id = 0").select("embedding").first()  # one row
    s = e.select("vec_id", R.cosine(F.col("embedding"), F.array(*[F.lit(float(x)) for x in q.embedding])).alias("s"))
    return s.select("vec_id", F.round("s", 6).alias("score"))


@Q.query("""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
c AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: x = 'and')) AS f0, len(list_filter(w, lambda x: x = 'that')) AS f1 FROM t), s AS (SELECT count(*) AS docs, avg(n) AS a, count(*) FILTER (f0 > 0) AS d0, count(*) FILTER (f1 > 0) AS d1 FROM c),
r AS (SELECT doc_id, ln((docs - d0 + 0.5) / (d0 + 0.5) + 1) * f0 * 2.2 / (f0 + 1.2 * (0.25 + 0.75 * n / a)) + ln((docs - d1 + 0.5) / (d1 + 0.5) + 1) * f1 * 2.2 / (f1 + 1.2 * (0.25 + 0.75 * n / a)) AS x FROM c, s)
SELECT doc_id, round(x, 6) AS bm25 FROM r WHERE x > 0""")
def rank_by_bm25(spark, sf_dir):
    return R.bm25(table(spark, sf_dir, "documents"), "that and").withColumn("bm25", F.round("bm25", 6))


@Q.query("""WITH a AS (SELECT p_partkey AS id, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS place FROM part), b AS (SELECT p_partkey AS id, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS place FROM part)
SELECT id, sum(1.0::DOUBLE / (60 + place)) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY id""")
def rank_hybrid(spark, sf_dir):
    """Two rankings of the items of each brand, fused."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_brand", "p_retailprice", "p_size")

    def top(c):
        return p.select("id", F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc(c), "id")).alias("place"))

    return R.reciprocal_rank_fusion([top("p_retailprice"), top("p_size")], "id")


@Q.query("SELECT vec_id, label, round(vec_id % 100 / 100.0, 2)::DOUBLE AS score FROM embeddings WHERE vec_id % 100 / 100.0 > CASE WHEN label % 2 = 0 THEN 0.45 ELSE 0.6 END")
def rank_threshold(spark, sf_dir):
    """Scores of an outside reranker: strictly above .45 for many entities, .6 for one."""
    s = (F.col("vec_id") % 100) / 100.0
    return table(spark, sf_dir, "embeddings").where(s > F.when(F.col("label") % 2 == 0, 0.45).otherwise(0.6)).select("vec_id", "label", F.round(s, 2).alias("score"))


@Q.query(f"WITH {JOBS} SELECT id, priority, created_at FROM j WHERE status = 'queued' ORDER BY priority, created_at, id LIMIT 500")
def queue_dequeue(spark, sf_dir):
    return jobs(spark, sf_dir).where("status = 'queued'").orderBy("priority", "created_at", "id").limit(500).select("id", "priority", "created_at")


@Q.query(f"WITH {JOBS} SELECT id, created_at FROM j WHERE group_id = 7 AND status = 'completed' ORDER BY created_at, id LIMIT 20 OFFSET 5")
def crawl_listing(spark, sf_dir):
    return jobs(spark, sf_dir).where("group_id = 7 and status = 'completed'").orderBy("created_at", "id").offset(5).limit(20).select("id", "created_at")


@Q.query("""WITH r AS (SELECT source, doc_id, n_chars, sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS sent, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents)
SELECT source, doc_id, CAST(sent AS BIGINT) AS sent FROM r WHERE sent <= 20000 OR n = 1""")
def page_by_bytes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return R.byte_budget(d, ["source"], ["doc_id"], "n_chars", 20000).select("source", "doc_id", "sent")


@Q.query("SELECT o_orderkey AS id, o_orderdate AS created_at FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' OR (o_orderdate = TIMESTAMP '1996-01-01' AND o_orderkey < 100) ORDER BY created_at DESC, id DESC LIMIT 25")
def page_by_keyset(spark, sf_dir):
    import datetime

    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at"))
    return R.keyset_page(o, "created_at", "id", 25, (datetime.datetime(1996, 1, 1), 100))[0]


@Q.query("""WITH d AS (SELECT regexp_extract(url, '^[^:]*://([^/?#]*)', 1) AS domain, url, page_id FROM pages), r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY length(url) DESC, page_id) AS place FROM d) SELECT domain, url, CAST(place AS INT) AS place FROM r WHERE place <= 3""")
def top_urls_per_domain(spark, sf_dir):
    d = table(spark, sf_dir, "pages").select(F.regexp_extract("url", r"^[^:]*://([^/?#]*)", 1).alias("domain"), "url", "page_id")
    return R.top_per_group(d, ["domain"], [F.length("url").desc(), "page_id"], 3).select("domain", "url", "place")


@Q.query("""WITH u AS (SELECT 'web' AS kind, page_id AS pos, url, 'd' AS description FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT 'news', page_id, url, 's' FROM pages WHERE page_id % 3 = 1 UNION ALL SELECT 'images', page_id, url, NULL FROM pages WHERE page_id % 3 = 2),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY pos) AS place FROM u) SELECT kind, url, description, CAST(place AS INT) AS place FROM r WHERE place <= 10""")
def search_flatten(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    web = p.where("page_id % 3 = 0").select(F.lit("web").alias("kind"), F.col("page_id").alias("pos"), "url", F.lit("d").alias("description"))
    news = p.where("page_id % 3 = 1").select(F.lit("news").alias("kind"), F.col("page_id").alias("pos"), "url", F.lit("s").alias("snippet")).withColumnRenamed("snippet", "description")
    images = p.where("page_id % 3 = 2").select(F.lit("images").alias("kind"), F.col("page_id").alias("pos"), "url", F.lit(None).cast("string").alias("description"))
    return R.top_per_group(web.unionByName(news).unionByName(images), ["kind"], ["pos"], 10).select("kind", "url", "description", "place")
