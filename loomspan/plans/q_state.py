"""Queries of stateful operators over tables: snapshots, monitors, queues, the cache."""

from pyspark.sql import functions as F

from loomspan.operators import cache_index as C
from loomspan.operators import queues as K
from loomspan.operators import snapshots as S

from .registry import Registry, table

Q = Registry()
NOW = "TIMESTAMP '1998-01-01 00:00:00'"
BODY = "CASE WHEN event_id % 3 = 0 THEN 'ab [iframe](x) c' WHEN event_id % 3 = 1 THEN 'c  ba' ELSE 'other ' || event_id % 2 END"


@Q.query(f"""WITH s AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 19 = 0 THEN 404 ELSE 200 END AS code, array_to_string(list_sort(string_split(regexp_replace(regexp_replace({BODY}, '\\s+', '', 'g'), '\\[iframe\\]\\([^)]*\\)', '', 'g'), '')), '') AS m FROM events),
l AS (SELECT *, lag(m) OVER w AS pm, lag(ts) OVER w AS pt FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, pt AS previous_at, CASE WHEN code = 404 THEN 'removed' WHEN pt IS NULL THEN 'new' WHEN pm IS DISTINCT FROM m THEN 'changed' ELSE 'same' END AS change_status FROM l""")
def change_tracking(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 19 == 0, 404).otherwise(200).alias("code"), F.expr(BODY).alias("markdown"))
    # the time and then the id: two snapshots of a moment keep one order
    e = e.withColumn("at", F.struct("ts", "event_id"))
    return S.change_status(e, ["user_id"], "at", "code", "markdown").select("event_id", F.col("previous_at.ts").alias("previous_at"), "change_status")


#: What the state held before the check, and what the check reported: other URLs are new, some were not reported.
KNOWN = "SELECT url, 'c0' AS first_seen, 'c0' AS last_seen, 'c0' AS last_changed, CASE WHEN page_id % 5 = 0 THEN 'removed' ELSE 'same' END AS status, page_id % 5 = 0 AS is_removed, CASE WHEN page_id % 5 = 0 THEN TIMESTAMP '1997-01-01 00:00:00' END AS removed_at FROM pages"
REPORTED = "SELECT CASE WHEN page_id % 7 = 0 THEN url || '/next' ELSE url END AS url, CASE WHEN page_id % 4 = 0 THEN 'changed' WHEN page_id % 6 = 0 THEN 'removed' WHEN page_id % 7 = 0 THEN 'new' WHEN page_id % 11 = 0 THEN 'error' ELSE 'same' END AS status FROM pages"


@Q.query(f"""WITH s AS ({KNOWN}), n AS ({REPORTED})
SELECT url, coalesce(s.first_seen, 'c1') AS first_seen, CASE WHEN n.status IS NULL OR n.status = 'removed' THEN s.last_seen ELSE 'c1' END AS last_seen, CASE WHEN n.status IN ('new', 'changed') THEN 'c1' ELSE s.last_changed END AS last_changed, coalesce(n.status, s.status) AS status,
CASE WHEN n.status IS NULL THEN s.is_removed ELSE n.status = 'removed' END AS is_removed, CASE WHEN n.status IS NULL THEN s.removed_at WHEN n.status = 'removed' THEN {NOW} END AS removed_at FROM s FULL JOIN n USING (url)""")
def monitor_upsert(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    s, n = (spark.sql(q.replace("FROM pages", "FROM {pages}"), pages=p) for q in (KNOWN, REPORTED))
    return S.upsert_pages(s, n, "c1", F.expr(NOW))


@Q.query(r"""WITH p AS (SELECT event_id, user_id, value, CASE WHEN event_id % 13 <> 0 THEN CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'a b' ELSE 'c ' || event_id % 3 END END AS md, lag(event_id) OVER w AS pid, event_id % 17 = 0 AS gone FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
q AS (SELECT *, lag(md) OVER w AS pmd FROM (SELECT p.*, e.ts FROM p JOIN events e USING (event_id)) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, CASE WHEN pid IS NULL OR gone THEN 'new' WHEN pmd IS NULL OR md IS NULL THEN 'changed' WHEN array_to_string(list_sort(string_split(regexp_replace(md, '\s+', '', 'g'), '')), '') <> array_to_string(list_sort(string_split(regexp_replace(pmd, '\s+', '', 'g'), '')), '') THEN 'changed' ELSE 'same' END AS diff_status FROM q)
SELECT event_id, diff_status, CASE WHEN diff_status = 'changed' AND md IS NOT NULL AND pmd IS NOT NULL THEN 'markdown' END AS diff_kind FROM s""")
def monitor_page_diff(spark, sf_dir):
    from pyspark.sql import Window

    w, i = Window.partitionBy("user_id").orderBy("ts", "event_id"), F.col("event_id")
    md = F.when(i % 13 != 0, F.when(i % 4 == 0, "").when(i % 4 == 1, "a b").otherwise(F.concat(F.lit("c "), (i % 3).cast("string"))))
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", md.alias("markdown"), (i % 17 == 0).alias("was_removed"))
    e = e.withColumns({"previous_id": F.lag("event_id").over(w), "previous_markdown": F.lag("markdown").over(w), "json": F.lit(None).cast("map<string,string>"), "previous_json": F.lit(None).cast("map<string,string>")})
    return S.page_diff(e).select("event_id", "diff_status", "diff_kind")


@Q.query("""WITH e AS (SELECT event_id, user_id, event_type AS a, CAST(floor(value / 50) AS VARCHAR) AS b, event_id % 19 = 0 AS none, lag(event_type) OVER w AS pa, lag(CAST(floor(value / 50) AS VARCHAR)) OVER w AS pb, lag(event_id) OVER w AS pid FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, CASE WHEN pid IS NULL THEN 'new' WHEN none OR a <> pa OR b <> pb THEN 'changed' ELSE 'same' END AS diff_status, CASE WHEN pid IS NOT NULL AND NOT none AND (a <> pa OR b <> pb) THEN (a <> pa)::INT + (b <> pb)::INT END AS fields FROM e""")
def monitor_json_diff(spark, sf_dir):
    from pyspark.sql import Window

    w, i = Window.partitionBy("user_id").orderBy("ts", "event_id"), F.col("event_id")
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.create_map(F.lit("a"), F.col("event_type"), F.lit("b"), F.floor(F.col("value") / 50).cast("double").cast("string")).alias("full"))
    e = e.withColumns({"previous_id": F.lag("event_id").over(w), "previous_json": F.lag("full").over(w), "json": F.when(i % 19 != 0, F.col("full")), "was_removed": F.lit(False), "markdown": F.lit("m"), "previous_markdown": F.lit("m")})
    d = S.page_diff(e, ("json", "git-diff"))
    return d.select("event_id", "diff_status", F.when(F.col("diff_kind").isNotNull(), F.size("diff_json")).alias("fields"))


JOBS = f"SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active' ELSE 'failed' END AS status, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey % 50 END AS group_id, o_orderdate AS created_at, o_orderdate AS locked_at, CAST(o_orderkey % 11 AS INT) AS stalls FROM orders"


def jobs(spark, sf_dir):
    return spark.sql(JOBS.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


@Q.query(f"""WITH j AS ({JOBS}), k AS (SELECT *, status = 'active' AND locked_at <= {NOW} - INTERVAL 1 MINUTE AS stale FROM j WHERE NOT (group_id IS NULL AND ((status = 'completed' AND created_at < {NOW} - INTERVAL 1 HOUR) OR (status = 'failed' AND created_at < {NOW} - INTERVAL 6 HOUR))))
SELECT id, CASE WHEN stale AND stalls < 9 THEN 'queued' WHEN stale THEN 'failed' ELSE status END AS status, stalls + stale::INT AS stalls FROM k""")
def queue_reap(spark, sf_dir):
    return K.reap(jobs(spark, sf_dir), F.expr(NOW)).select("id", "status", "stalls")


@Q.query(f"""WITH j AS ({JOBS}), b AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal < 0) SELECT id, status FROM j UNION ALL SELECT id, 'queued' FROM b WHERE id NOT IN (SELECT id FROM j)""")
def queue_promote(spark, sf_dir):
    b = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    return K.promote(jobs(spark, sf_dir).select("id", "status"), b)


RECON = "SELECT o_orderkey AS id, o_custkey % 20 AS owner_id, CASE WHEN o_orderkey % 2 = 0 THEN 'crawl' ELSE 'extract' END AS kind, o_orderdate AS created_at, o_orderstatus AS s FROM orders"


@Q.query(f"""WITH o AS ({RECON}), l AS (SELECT * FROM o WHERE s = 'O' AND id % 3 <> 0), a AS (SELECT owner_id, kind, count(*) AS busy FROM o WHERE s = 'P' GROUP BY ALL), r AS (SELECT l.id, coalesce(busy, 0) + row_number() OVER (PARTITION BY l.owner_id, l.kind ORDER BY created_at, l.id) AS n FROM l LEFT JOIN a ON l.owner_id = a.owner_id AND l.kind = a.kind)
SELECT id, CASE WHEN n <= 30 THEN 'start' ELSE 'requeue' END AS action FROM r""")
def queue_reconcile(spark, sf_dir):
    o = spark.sql(RECON.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))
    return K.reconcile(o.where("s = 'O'"), o.where("s = 'O' and id % 3 = 0"), o.where("s = 'P'"), 30).select("id", "action")


@Q.query("SELECT user_id, CAST(time_bucket(INTERVAL 1 HOUR, ts) AS TIMESTAMP) AS start, count(*) AS n, greatest(count(*) - 2, 0) AS refused FROM events GROUP BY ALL")
def rate_limit_windows(spark, sf_dir):
    return K.rate_limited(table(spark, sf_dir, "events"), ["user_id"], "ts", 2, "1 hour")


@Q.query(f"WITH j AS ({JOBS}) SELECT group_id, count(*) AS jobs, count(*) FILTER (status IN ('completed', 'failed')) AS done, count(*) = count(*) FILTER (status IN ('completed', 'failed')) AS finished FROM j GROUP BY group_id")
def crawl_finished(spark, sf_dir):
    return K.finished(jobs(spark, sf_dir))


MON = "SELECT o_orderkey AS id, o_orderdate AS next_run_at, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 1 HOUR WHEN o_orderkey % 3 = 1 THEN TIMESTAMP '1997-12-31 23:30:00' END AS running_since FROM orders"


@Q.query(f"WITH m AS ({MON}) SELECT id, CASE WHEN next_run_at > {NOW} THEN 'wait' WHEN running_since IS NULL THEN 'run' WHEN running_since < {NOW} - INTERVAL 60 MINUTE THEN 'fail_stale' ELSE 'skipped_overlap' END AS action FROM m")
def monitors_due(spark, sf_dir):
    m = spark.sql(MON.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))
    return K.due(m, F.expr(NOW)).select("id", "action")


INDEX = "SELECT event_id AS id, 'h' || user_id AS url_hash, ts AS created_at, CASE WHEN event_id % 4 = 0 THEN 200 ELSE 500 END AS status FROM events"


@Q.query(f"""WITH m AS (SELECT max(ts) AS now FROM events), f AS (SELECT i.* FROM ({INDEX}) i, m WHERE created_at >= now - INTERVAL 20 DAY), r AS (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY created_at DESC, id DESC) AS rn FROM f),
g AS (SELECT *, min(CASE WHEN status BETWEEN 200 AND 299 THEN rn END) OVER (PARTITION BY url_hash) AS good FROM r) SELECT url_hash, id, status FROM g WHERE rn = CASE WHEN good IS NULL OR good > 3 THEN 1 ELSE good END""")
def cache_lookup(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    now = e.agg(F.max("ts").alias("m")).first().m
    return C.lookup(spark.sql(INDEX.replace("FROM events", "FROM {events}"), events=e), F.lit(now), "20 days").select("url_hash", "id", "status")


@Q.query(r"""SELECT page_id, CASE WHEN length(url || url) > 60 THEN substr(url || url, 1, 57) || '...' ELSE url || url END AS title, CASE WHEN length(html) > 160 THEN substr(html, 1, 157) || '...' ELSE html END AS description,
sha256(h || CASE WHEN t = '' THEN '/' ELSE t END || q) AS url_hash, CAST(least(10, len(list_filter(string_split(t, '/'), lambda x: x <> '')) + 1 + (q <> '')::INT) AS INT) AS prefixes, sha256(regexp_extract(url, '([^./]+\.[^./]+)(/|$)', 1)) AS domain_hash
FROM (SELECT *, 'https://' || regexp_replace(lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)), '^www\.', '') AS h, regexp_replace(regexp_replace(regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1), '/index\.html$', '/'), '/$', '') AS t, regexp_extract(url, '(\?[^#]+)', 1) AS q FROM pages)""")
def cache_rows(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.concat("url", "url").alias("title"), F.col("html").alias("description"))
    return C.index_rows(p).select("page_id", "title", "description", "url_hash", F.size("url_split_hashes").alias("prefixes"), F.element_at("domain_split_hashes", 1).alias("domain_hash"))


@Q.query("""WITH p AS (SELECT doc_id, text, CASE WHEN doc_id % 13 = 0 THEN 500 ELSE 200 END AS status FROM documents) SELECT doc_id, status BETWEEN 200 AND 299 AND length(coalesce(text, '')) >= 200 AND doc_id % 5 <> 0 AND doc_id % 7 <> 0 AS indexed FROM p""")
def search_index_rows(spark, sf_dir):
    i = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("markdown"), F.when(i % 13 == 0, 500).otherwise(200).alias("status"), (i % 5 == 0).alias("has_auth"), (i % 7 == 0).alias("private"))
    return d.select("doc_id", C.searchable(d).alias("indexed"))


@Q.query("""WITH e AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'crawl.page' WHEN 1 THEN 'crawl.completed' WHEN 2 THEN 'monitor.check.completed' ELSE 'extract.failed' END AS event, CASE event_id % 3 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN ['page', 'check.completed'] ELSE ['crawl.completed', 'failed'] END AS f FROM events)
SELECT event_id FROM e WHERE len(f) = 0 OR list_contains(f, event) OR list_contains(f, split_part(event, '.', 2)) OR list_contains(f, substr(event, instr(event, '.') + 1))""")
def webhook_filter(spark, sf_dir):
    i = F.col("event_id")
    event = F.when(i % 4 == 0, "crawl.page").when(i % 4 == 1, "crawl.completed").when(i % 4 == 2, "monitor.check.completed").otherwise("extract.failed")
    wanted = F.when(i % 3 == 0, F.array().cast("array<string>")).when(i % 3 == 1, F.array(F.lit("page"), F.lit("check.completed"))).otherwise(F.array(F.lit("crawl.completed"), F.lit("failed")))
    return table(spark, sf_dir, "events").where(C.webhook_wanted(wanted, event)).select("event_id")
