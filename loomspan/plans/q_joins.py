"""Queries of the joins that the service does by hand: lookups, anti and semi joins, latest before."""

from pyspark.sql import functions as F

from loomspan.operators import snapshots as S

from .q_tallies import JOBS, backlog, jobs
from .registry import Registry, table

Q = Registry()


@Q.query("""WITH q AS (SELECT o_orderkey AS id, o_orderstatus AS status FROM orders), d AS (SELECT o_orderkey + 1 AS id, o_totalprice AS price FROM orders), b AS (SELECT o_orderkey * 2 AS id, o_orderpriority AS blob FROM orders)
SELECT id, status, price, coalesce(blob, status) AS result FROM q FULL JOIN d USING (id) LEFT JOIN b USING (id)""")
def join_job_lookup(spark, sf_dir):
    """A job by id in the queue, in the database or in both, with its stored result."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    q = o.select(key.alias("id"), F.col("o_orderstatus").alias("status"))
    d = o.select((key + 1).alias("id"), F.col("o_totalprice").alias("price"))
    b = o.select((key * 2).alias("id"), F.col("o_orderpriority").alias("blob"))
    return S.job_lookup(q, d, b)


@Q.query("""WITH i AS (SELECT page_id, url, 'snippet' AS description FROM pages), d AS (SELECT url, max_by(page_id, page_id) AS doc, count(*) AS n FROM pages WHERE page_id % 3 <> 0 GROUP BY url)
SELECT i.page_id, i.url, coalesce('doc ' || d.doc, i.description) AS description FROM i LEFT JOIN d USING (url)""")
def join_search_scraped(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    d = p.where("page_id % 3 <> 0").groupBy("url").agg(F.max("page_id").alias("doc"))  # a later copy wins
    return p.join(d, "url", "left").select("page_id", "url", F.coalesce(F.concat(F.lit("doc "), F.col("doc").cast("string")), F.lit("snippet")).alias("description"))


@Q.query(f"WITH {JOBS} SELECT DISTINCT group_id FROM j WHERE group_id NOT IN (SELECT group_id FROM j WHERE status = 'active' AND priority = 1 AND id % 7 = 0) AND group_id NOT IN (SELECT c_custkey % 50 FROM customer WHERE c_acctbal < -900)")
def join_finished_groups(spark, sf_dir):
    j = jobs(spark, sf_dir)
    late = table(spark, sf_dir, "customer").where("c_acctbal < -900").select((F.col("c_custkey") % 50).alias("group_id"))
    return j.select("group_id").distinct().join(j.where("status = 'active' and priority = 1 and id % 7 = 0"), "group_id", "left_anti").join(late, "group_id", "left_anti")


@Q.query(f"WITH {JOBS} SELECT id, group_id FROM j WHERE group_id IN (SELECT group_id FROM j GROUP BY group_id ORDER BY min(created_at), group_id LIMIT 10)")
def join_cleaned_jobs(spark, sf_dir):
    j = jobs(spark, sf_dir)
    old = j.groupBy("group_id").agg(F.min("created_at").alias("t")).orderBy("t", "group_id").limit(10)
    return j.join(old, "group_id", "left_semi").select("id", "group_id")


@Q.query("SELECT p.page_id, p.url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM pages v WHERE v.page_id % 4 = 0 AND regexp_replace(v.url, '^https?://(www\\.)?', '') = regexp_replace(p.url, '^https?://(www\\.)?', ''))")
def join_frontier_unseen(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url").withColumn("key", F.regexp_replace("url", r"^https?://(www\.)?", ""))
    return p.join(p.where("page_id % 4 = 0").select("key"), "key", "left_anti").select("page_id", "url")


@Q.query("SELECT url, page_id FROM pages WHERE url NOT IN (SELECT CASE WHEN page_id % 6 = 0 THEN url || '#moved' ELSE url END FROM pages)")
def join_removed_pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("url", "page_id")
    now = p.withColumn("url", F.when(F.col("page_id") % 6 == 0, F.concat("url", F.lit("#moved"))).otherwise(F.col("url")))
    return S.removed_pages(p, now)


@Q.query("""WITH e AS (SELECT user_id, ts, max_by(value, event_id) AS value FROM events GROUP BY ALL), q AS (SELECT user_id, event_id, ts - INTERVAL 1 HOUR AS t FROM events)
SELECT q.event_id, e.value AS last_value FROM q ASOF LEFT JOIN e ON q.user_id = e.user_id AND q.t >= e.ts""")
def join_latest_before(spark, sf_dir):
    """For each event what its user's last event an hour before or earlier was worth."""
    e = table(spark, sf_dir, "events")
    known = e.select("user_id", F.struct("ts", "event_id").alias("at"), "value")
    asked = e.select("user_id", "event_id", F.struct((F.col("ts") - F.expr("interval 1 hour")).alias("ts"), F.lit(2**63 - 1).alias("event_id")).alias("at"))
    return S.latest_before(known, asked, ["user_id"], "at", "at", ["value"]).select("event_id", "last_value")


@Q.query("""WITH x AS (SELECT p_brand AS brand, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS size FROM part), k AS (SELECT brand, size, count(*) AS n FROM x GROUP BY ALL)
SELECT p_partkey AS item, CAST(sum(n) AS BIGINT) AS sources FROM part JOIN k ON brand = p_brand AND (size IS NULL OR size = p_size) GROUP BY p_partkey""")
def join_mergeable_sources(spark, sf_dir):
    """For each item the number of sources whose known fields agree with it."""
    p = table(spark, sf_dir, "part")
    i = p.select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    x = p.select(F.col("p_brand").alias("brand"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size")).alias("size"))
    return S.agreeing_sources(i, x, ["brand"], "size", "sources").where("sources > 0").select("item", "sources")


@Q.query("""WITH d AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 9000) SELECT n_name AS domain, count(*) AS urls FROM d JOIN nation ON n_nationkey = k JOIN supplier ON s_nationkey = k GROUP BY n_name""")
def join_domain_urls(spark, sf_dir):
    d = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).distinct()
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    return s.join(n, s.s_nationkey == n.n_nationkey).join(d, F.col("n_nationkey") == F.col("k")).groupBy(F.col("n_name").alias("domain")).agg(F.count("*").alias("urls"))


@Q.query("SELECT c_custkey AS id FROM customer WHERE c_acctbal < 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')")
def join_backlog_missing(spark, sf_dir):
    open_ = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("owner_id"))
    return backlog(spark, sf_dir).join(open_, "owner_id", "left_anti").select(F.col("owner_id").alias("id"))
