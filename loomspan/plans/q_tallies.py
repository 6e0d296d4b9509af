"""Queries of group counts, billing, usage and quotas. Orders stand in for jobs, line items for billed operations."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomspan.operators import brand as B
from loomspan.operators import doc_quality as DQ
from loomspan.operators import tallies as T

from .registry import Registry, table

Q = Registry()
STATUS = "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'queued' WHEN 'P' THEN 'active' ELSE 'failed' END"
JOBS = f"j AS (SELECT o_orderkey AS id, o_custkey % 50 AS group_id, {STATUS} AS status, o_orderdate AS created_at, CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority, o_totalprice AS price FROM orders)"
COUNTED = f"{JOBS}, c AS (SELECT group_id, status, count(*) AS n FROM j GROUP BY ALL UNION ALL SELECT c_custkey % 50, 'backlog', count(*) FROM customer WHERE c_acctbal < 0 GROUP BY 1)"


def jobs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 50).alias("group_id"), F.expr(STATUS).alias("status"), F.col("o_orderdate").alias("created_at"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), F.col("o_totalprice").alias("price"))


def backlog(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_acctbal < 0").select((F.col("c_custkey") % 50).alias("group_id"), F.col("c_custkey").alias("owner_id"))


@Q.query(f"WITH {COUNTED} SELECT * FROM c")
def job_status_counts(spark, sf_dir):
    return T.status_counts(jobs(spark, sf_dir), backlog(spark, sf_dir))


@Q.query(f"WITH {COUNTED} SELECT group_id, CAST(coalesce(sum(n) FILTER (status = 'completed'), 0) AS BIGINT) AS completed, CAST(coalesce(sum(n) FILTER (status IN ('completed', 'active', 'queued', 'backlog')), 0) AS BIGINT) AS total FROM c GROUP BY group_id")
def crawl_progress(spark, sf_dir):
    return T.progress(T.status_counts(jobs(spark, sf_dir), backlog(spark, sf_dir)))


@Q.query(f"WITH {JOBS} SELECT status, count(*) AS n FROM j WHERE status IN ('queued', 'active') GROUP BY status")
def queue_metrics(spark, sf_dir):
    return jobs(spark, sf_dir).where(F.col("status").isin("queued", "active")).groupBy("status").agg(F.count("*").alias("n"))


@Q.query("SELECT DISTINCT c_custkey AS owner_id FROM customer WHERE c_acctbal < 0")
def backlogged_owners(spark, sf_dir):
    return backlog(spark, sf_dir).select("owner_id").distinct()


@Q.query("""WITH o AS (SELECT CASE WHEN l_suppkey % 10 = 0 THEN 'preview_' ELSE 'team_' END || l_suppkey AS team_id, l_returnflag AS subscription_id, l_linestatus AS endpoint, CAST(l_quantity AS BIGINT) AS credits, l_linenumber % 2 = 0 AS tracked FROM lineitem)
SELECT team_id, subscription_id, endpoint, CAST(sum(credits) AS BIGINT) AS credits, CAST(sum(CASE WHEN NOT tracked THEN credits ELSE 0 END) AS BIGINT) AS untracked, count(*) AS ops FROM o WHERE team_id NOT LIKE 'preview%' GROUP BY ALL""")
def billing_batch(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    team = F.concat(F.when(F.col("l_suppkey") % 10 == 0, "preview_").otherwise("team_"), F.col("l_suppkey").cast("string"))
    return T.billing_batches(li.select(team.alias("team_id"), F.col("l_returnflag").alias("subscription_id"), F.col("l_linestatus").alias("endpoint"), F.col("l_quantity").cast("long").alias("credits"), (F.col("l_linenumber") % 2 == 0).alias("tracked")))


@Q.query("""WITH o AS (SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 5 WHEN p_size % 7 = 0 THEN 5 ELSE 1 END AS base, p_size AS s FROM part)
SELECT id, CAST(base + CASE WHEN s % 4 = 0 THEN 4 ELSE 0 END + CASE WHEN s % 5 = 0 THEN 4 ELSE 0 END + CASE WHEN s % 11 = 0 THEN 4 ELSE 0 END + CASE WHEN s % 13 = 0 THEN 29 ELSE 0 END + CASE WHEN s % 2 = 0 AND s % 7 <> 0 THEN 1 ELSE 0 END + greatest(s % 6 - 1, 0) AS BIGINT) AS credits FROM o""")
def scrape_credits(spark, sf_dir):
    s = F.col("p_size")
    formats = F.filter(F.array(F.when(s % 3 == 0, "json"), F.when(s % 4 == 0, "question"), F.when(s % 5 == 0, "highlights")), lambda x: x.isNotNull())
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), T.scrape_credits(formats, s % 7 == 0, s % 2 == 0, s % 6, s % 11 == 0, s % 13 == 0).cast("long").alias("credits"))


@Q.query("SELECT p_partkey AS id, CAST(ceil(p_size / 10.0) * CASE WHEN p_size % 2 = 0 THEN 10 ELSE 2 END AS BIGINT) AS credits FROM part")
def search_credits(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), T.search_credits(F.col("p_size"), F.col("p_size") % 2 == 0).alias("credits"))


@Q.query("""WITH m AS (SELECT o_orderpriority AS api_key, date_trunc('month', o_orderdate) AS start_date, count(*) AS credits FROM orders GROUP BY ALL)
SELECT api_key, CAST(start_date AS TIMESTAMP) AS start_date, credits, CASE WHEN start_date = max(start_date) OVER (PARTITION BY api_key) THEN NULL ELSE CAST(start_date + INTERVAL 1 MONTH AS TIMESTAMP) END AS end_date, credits * 15 AS tokens FROM m""")
def usage_by_month(spark, sf_dir):
    points = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("api_key"), F.col("o_orderdate").alias("date"), F.lit(1).cast("long").alias("value"))
    return T.monthly_usage(points, ["api_key"])


KINDS = ["same", "new", "changed", "removed", "error"]
PAGE_STATUS = "CASE WHEN event_id % 97 = 0 THEN 'error' WHEN event_id % 7 = 0 THEN 'new' WHEN event_id % 5 = 0 THEN 'changed' WHEN event_id % 11 = 0 THEN 'removed' ELSE 'same' END"


@Q.query(f"WITH p AS (SELECT user_id AS check_id, {PAGE_STATUS} AS s FROM events) SELECT check_id, " + ", ".join(f"count(*) FILTER (s = '{k}') AS {k}" for k in KINDS) + ", count(*) AS total, CASE WHEN count(*) FILTER (s = 'error') > 0 THEN 'partial' ELSE 'completed' END AS status FROM p GROUP BY check_id")
def monitor_summary(spark, sf_dir):
    p = table(spark, sf_dir, "events").select(F.col("user_id").alias("check_id"), F.expr(PAGE_STATUS).alias("s"))
    return T.summary_counts(p, "check_id", "s", KINDS)


@Q.query("""WITH d AS (SELECT o_custkey AS domain, sqrt(count(*)) AS priority FROM orders GROUP BY o_custkey HAVING count(*) >= 2), t AS (SELECT * FROM d ORDER BY priority DESC, domain LIMIT 50),
x AS (SELECT *, min(priority) OVER () AS lo, max(priority) OVER () AS hi, greatest(sum(priority) OVER (), 1) AS total, count(*) OVER () AS n FROM t)
SELECT domain, priority, CAST(floor(10 + CASE WHEN hi = lo THEN 0 ELSE (priority - lo) / (hi - lo) END * 40 + 0.5) AS BIGINT) AS urls, CAST(floor(priority / total * CASE WHEN n <= 25 THEN least(50000, 3000 + (n - 1) * 500) WHEN n <= 100 THEN least(50000, 10000 + (n - 5) * 200) ELSE 50000 END) AS BIGINT) AS budget FROM x""")
def precrawl_quotas(spark, sf_dir):
    d = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("domain")).agg(F.count("*").alias("n")).where("n >= 2").select("domain", F.sqrt("n").alias("priority"))
    t = d.orderBy(F.desc("priority"), "domain").limit(50)
    w = Window.partitionBy()
    x = t.select("*", F.min("priority").over(w).alias("lo"), F.max("priority").over(w).alias("hi"), F.greatest(F.sum("priority").over(w), F.lit(1.0)).alias("total"), F.count("*").over(w).alias("n"))
    share = F.when(F.col("hi") == F.col("lo"), 0.0).otherwise((F.col("priority") - F.col("lo")) / (F.col("hi") - F.col("lo")))
    return x.select("domain", "priority", F.floor(10 + share * 40 + 0.5).cast("long").alias("urls"), F.floor(F.col("priority") / F.col("total") * T.precrawl_budget(F.col("n"))).cast("long").alias("budget"))


RESULTS = """SELECT user_id AS site, CASE WHEN event_id % 9 <> 0 THEN event_type || ' ' || event_id END AS browser, CASE WHEN event_id % 10 = 0 THEN 'stealth ' || event_id ELSE CASE WHEN event_id % 27 = 0 THEN '' END END AS browser_stealth, CASE WHEN event_id % 8 <> 0 THEN event_type || CASE WHEN event_id % 3 = 0 THEN ' x' ELSE ' ' END || event_id END AS light, CASE WHEN event_id % 16 = 0 THEN event_type || ' ' || event_id END AS light_stealth FROM events"""


@Q.query(f"""WITH r AS ({RESULTS}), p AS (SELECT site, coalesce(browser_stealth, browser, '') AS g, coalesce(light_stealth, light, '') AS l FROM r), o AS (SELECT site, g = '' AS failed, CASE WHEN g <> '' AND l <> '' THEN 1 - levenshtein(g, l) / greatest(strlen(g), strlen(l)) END AS s FROM p),
c AS (SELECT site, count(*) AS total, count(*) FILTER (failed) AS failed, count(*) FILTER (NOT failed AND s >= 0.9) AS sufficient, count(*) FILTER (NOT failed AND (s IS NULL OR s < 0.9)) AS insufficient FROM o GROUP BY site)
SELECT *, CASE WHEN failed / total > 0.12 OR total = failed THEN 'Uncertain' WHEN sufficient / (total - failed) >= 0.7 THEN 'TlsClientOk' ELSE 'ChromeCdpRequired' END AS verdict FROM c""")
def engine_verdict(spark, sf_dir):
    r = spark.sql(RESULTS.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))
    return T.engine_verdict(r, "site", similarity=0.9, success_rate=0.7, failure_rate=0.12)


@Q.query("SELECT user_id AS request, CAST(sum(coalesce(CASE WHEN event_id % 3 <> 0 THEN event_id % 7 END, 0)) AS BIGINT) AS credits FROM events GROUP BY user_id")
def search_scrape_credits(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("request"), F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 7).alias("credits_used"))
    return T.scrape_credit_sum(e, ["request"])


@Q.query("""WITH d AS (SELECT page_id AS pos, 'https://s' || page_id % 60 AS url, CASE WHEN page_id % 4 = 0 THEN 'T' || page_id END AS title FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY title IS NULL, pos) AS n, min(pos) OVER (PARTITION BY url) AS first_pos FROM d) SELECT url, title, first_pos FROM r WHERE n = 1""")
def map_dedupe(spark, sf_dir):
    d = table(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), F.concat(F.lit("https://s"), (F.col("page_id") % 60).cast("string")).alias("url"), F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("T"), F.col("page_id").cast("string"))).alias("title"))
    best = F.min(F.struct(F.col("title").isNull().alias("blank"), "pos", "title"))
    return d.groupBy("url").agg(best.alias("b"), F.min("pos").alias("first_pos")).select("url", "b.title", "first_pos")


@Q.query("""WITH i AS (SELECT p_brand AS doc, unnest([{'name': p_type, 'size': p_size % 5}, {'name': p_type, 'size': p_size % 5}]) AS item FROM part) SELECT doc, item.name AS name, item.size AS size, count(*) AS seen FROM i GROUP BY ALL""")
def dedupe_objects(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    item = F.struct(F.col("p_type").alias("name"), (F.col("p_size") % 5).alias("size"))
    return p.select(F.col("p_brand").alias("doc"), F.explode(F.array(item, item)).alias("item")).groupBy("doc", "item").agg(F.count("*").alias("seen")).select("doc", "item.*", "seen")


@Q.query("""WITH x AS (SELECT p_brand AS item, 'https://s/' || p_partkey AS url FROM part) SELECT item, list_sort(list_distinct(list(url))) AS sources, count(*) AS n FROM x GROUP BY item""")
def item_provenance(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("item"), F.concat(F.lit("https://s/"), F.col("p_partkey").cast("string")).alias("url"))
    return p.groupBy("item").agg(F.array_sort(F.collect_set("url")).alias("sources"), F.count("*").alias("n"))


@Q.query("""WITH c AS (SELECT p_type AS site, '#' || upper(substr(md5(p_brand), 1, 6)) AS hex, CASE p_size % 3 WHEN 0 THEN 0.5 + log10(p_size + 10) WHEN 1 THEN 1 ELSE 0.3 END AS w FROM part), s AS (SELECT site, hex, sum(w) AS weight FROM c GROUP BY ALL)
SELECT site, hex, weight, CAST(row_number() OVER (PARTITION BY site ORDER BY round(weight, 6) DESC, hex) AS INT) AS place, (299 * ('0x' || substr(hex, 2, 2))::INT + 587 * ('0x' || substr(hex, 4, 2))::INT + 114 * ('0x' || substr(hex, 6, 2))::INT) / 1000.0 AS yiq FROM s""")
def brand_palette(spark, sf_dir):
    s = F.col("p_size")
    w = F.when(s % 3 == 0, 0.5 + F.log10(s + 10)).when(s % 3 == 1, 1.0).otherwise(0.3)
    c = table(spark, sf_dir, "part").select(F.col("p_type").alias("site"), F.concat(F.lit("#"), F.upper(F.substring(F.md5("p_brand"), 1, 6))).alias("hex"), w.alias("weight"))
    return B.palette(c)


@Q.query("""WITH v AS (SELECT p_partkey % 97 AS site, CASE WHEN p_partkey % 97 % 3 = 0 THEN p_size * 6 WHEN p_partkey % 97 % 3 = 1 THEN p_size * 2.5 ELSE 5 + p_partkey // 97 % 3 * 0.5 END::DOUBLE AS v, CASE WHEN p_partkey % 97 % 5 <> 0 THEN p_size / 2 END AS r FROM part),
g AS (SELECT site, list(CAST(floor(v + 0.5) AS INT)) FILTER (v > 0 AND v <= 128) AS l, list_sort(list(r) FILTER (r IS NOT NULL)) AS rs FROM v GROUP BY site),
f AS (SELECT site, list_sort(l) AS l, rs, list_extract(list_filter([4, 6, 8, 10, 12], lambda c: len(list_filter(l, lambda x: x % c <= 1 OR x % c >= c - 1)) / len(l) >= 0.6), 1) AS c FROM g)
SELECT site, CASE WHEN l IS NULL THEN 8 ELSE coalesce(c, greatest(2, least(12, CAST(floor(l[len(l) // 2 + 1] / 2 + 0.5) AS INT) * 2))) END AS base_unit, CASE WHEN rs IS NULL THEN '8px' ELSE CAST(floor(rs[len(rs) // 2 + 1] + 0.5) AS INT) || 'px' END AS radius FROM f""")
def brand_spacing(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    site = k % 97
    v = F.when(site % 3 == 0, s * 6.0).when(site % 3 == 1, s * 2.5).otherwise(5 + F.floor(k / 97) % 3 * 0.5)
    g = table(spark, sf_dir, "part").select(site.alias("site"), v.alias("v"), F.when(site % 5 != 0, s / 2).alias("r")).groupBy("site").agg(F.collect_list("v").alias("v"), F.collect_list("r").alias("r"))
    return g.select("site", B.spacing_unit(F.col("v")).alias("base_unit"), B.corner_radius(F.col("r")).alias("radius"))


@Q.query("""WITH f AS (SELECT p_brand AS site, split_part(p_name, ' ', 1) AS family, p_partkey AS pos FROM part), c AS (SELECT site, family, count(*) AS count, min(pos) AS pos FROM f GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY count DESC, pos) AS place FROM c) SELECT site, family, count, CAST(place AS INT) AS place FROM r WHERE place <= 10""")
def brand_fonts(spark, sf_dir):
    f = table(spark, sf_dir, "part").select(F.col("p_brand").alias("site"), F.substring_index("p_name", " ", 1).alias("family"), F.col("p_partkey").alias("at"))
    return B.top_fonts(f)


@Q.query("SELECT c_custkey AS team, least(greatest(CAST(c_acctbal AS BIGINT) * 2000, 50000), 2000000) AS queue_limit, CASE WHEN c_custkey % 100 <= 20 THEN 10 ELSE CAST(ceil(10 + ceil((c_custkey % 100 - 20) * 0.25)) AS BIGINT) END AS priority, CASE WHEN c_custkey <= 900 THEN '15m' WHEN c_custkey <= 1800 THEN '30m' WHEN c_custkey <= 3600 THEN 'hourly' WHEN c_custkey <= 21600 THEN 'sub_daily' WHEN c_custkey <= 86400 THEN 'daily' WHEN c_custkey <= 604800 THEN 'weekly' ELSE 'other' END AS bucket FROM customer")
def team_limits(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = F.col("c_custkey") % 100
    # the DuckDB cast rounds; so does this one
    return c.select(F.col("c_custkey").alias("team"), T.queue_limit(F.bround("c_acctbal").cast("long")).alias("queue_limit"), T.job_priority(F.lit(10), n, F.lit(20), F.lit(0.25)).alias("priority"), T.frequency_bucket(F.col("c_custkey")).alias("bucket"))


@Q.query("SELECT c_custkey % 20 AS monitor_id, CAST(sum(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_nationkey ELSE greatest(1, coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey * 10 END, 10000)) END) AS BIGINT) AS credits, count(*) AS targets FROM customer GROUP BY 1")
def monitor_credit_estimate(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    kind = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "scrape").otherwise("crawl")
    t = c.select((F.col("c_custkey") % 20).alias("monitor_id"), kind.alias("type"), F.array_repeat(F.lit("u"), F.col("c_nationkey").cast("int")).alias("urls"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey") * 10).alias("limit"))
    return T.monitor_credits(t)


@Q.query("""WITH l AS (SELECT doc_id, trim(unnest(string_split(coalesce(text, ''), chr(10)))) AS line FROM documents), g AS (SELECT doc_id, line, count(*) AS c FROM l WHERE length(line) >= 8 GROUP BY ALL)
SELECT doc_id, round(sum(c - 1) / sum(c), 4)::DOUBLE AS repeated_ratio, CAST(sum(CASE WHEN length(line) - length(replace(line, '|', '')) >= 2 THEN c ELSE 0 END) AS BIGINT) AS table_lines FROM g GROUP BY doc_id""")
def repeated_line_ratio(spark, sf_dir):
    li = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line")).select("doc_id", F.trim("line").alias("line")).where(F.length("line") >= 8)
    g = li.groupBy("doc_id", "line").agg(F.count("*").alias("c"))
    piped = F.length("line") - F.length(F.translate("line", "|", "")) >= 2
    return g.groupBy("doc_id").agg(F.round(F.sum(F.col("c") - 1) / F.sum("c"), 4).alias("repeated_ratio"), F.sum(F.when(piped, F.col("c")).otherwise(0)).alias("table_lines"))


def _normal(x):
    """The SQL of a normalised line."""
    for pattern, by in ((r"https?://\S+", ""), (r"\d{1,4}[-/:]\d{1,2}[-/:]\d{1,4}", ""), (r"[ \t\n\r\x0B\x0C]+", " "), ("[^a-z0-9 ]+", "")):
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')" if "lower(" in x else f"regexp_replace(lower({x}), '{pattern}', '{by}', 'g')"
    return f"trim({x})"


def _families(x):
    hit = " , ".join("CASE WHEN " + " + ".join(f"contains({x}, '{t}')::INT" for t in terms) + f" >= 2 THEN '{name}' END" for name, terms in DQ.FAMILIES.items())
    return f"list_filter([{hit}], lambda f: f IS NOT NULL)"


WHITE = r"^[\t\n\x0B\x0C\r ]+|[\t\n\x0B\x0C\r ]+$"
#: Documents whose pages end with a form feed: every second line, and a publisher's note for some.
RENDERED = """SELECT doc_id, coalesce(text, '') || CASE WHEN doc_id % 4 = 0 THEN chr(12) || 'Downloaded from the Wiley Online Library, 2020-01-02' || chr(12) || chr(12) || chr(12) || chr(12) || 'x' WHEN doc_id % 4 = 1 THEN chr(12) || coalesce(text, '') || chr(12) ELSE '' END || CASE WHEN doc_id % 8 = 0 THEN repeat(chr(12), 40) ELSE '' END AS text, CAST(CASE WHEN doc_id % 5 = 0 THEN 9 END AS INT) AS expected FROM documents"""


@Q.query(rf"""WITH d AS ({RENDERED}), p AS (SELECT doc_id, expected, text, regexp_replace(text, '{WHITE}', '', 'g') AS whole, list_transform(string_split(text, chr(12)), lambda x: regexp_replace(x, '{WHITE}', '', 'g')) AS parts FROM d),
q AS (SELECT doc_id, expected, text, length(whole) AS total_chars, CASE WHEN contains(text, chr(12)) THEN list_concat(parts, list_transform(range(greatest(coalesce(expected, 0) - len(parts), 0)), lambda i: '')) WHEN whole = '' THEN []::VARCHAR[] ELSE [whole] END AS pages FROM p),
l AS (SELECT doc_id, regexp_replace(unnest(regexp_split_to_array(text, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]')), '{WHITE}', '', 'g') AS line FROM d), n AS (SELECT doc_id, length(line) AS chars, {_normal('line')} AS normal FROM l WHERE line <> ''),
g AS (SELECT doc_id, normal, count(*) AS times, sum(chars) AS chars, {_families('normal')} AS families FROM n GROUP BY doc_id, normal),
b AS (SELECT doc_id, sum(chars) AS line_chars, sum(CASE WHEN length(normal) >= 30 AND times > 1 THEN chars ELSE 0 END) AS repeated, sum(CASE WHEN len(families) > 0 THEN chars ELSE 0 END) AS publisher, list_sort(list_distinct(flatten(list(families)))) AS families FROM g GROUP BY doc_id),
e AS (SELECT doc_id, {_normal('page')} AS page FROM (SELECT doc_id, unnest(pages) AS page FROM q)), c AS (SELECT doc_id, sum(n) AS long_pages, sum(n - 1) AS repeated_pages FROM (SELECT doc_id, page, count(*) AS n FROM e WHERE length(page) >= 80 GROUP BY ALL) GROUP BY doc_id),
j AS (SELECT q.doc_id, total_chars, len(pages) AS pages, len(list_filter(pages, lambda x: x = '')) AS empty_pages, coalesce(repeated, 0) / greatest(coalesce(line_chars, 0), 1) AS rr, coalesce(publisher, 0) / greatest(coalesce(line_chars, 0), 1) AS pr, coalesce(repeated_pages, 0) AS repeated_pages, coalesce(repeated_pages, 0) / greatest(coalesce(long_pages, 0), 1) AS rp, total_chars / greatest(coalesce(expected, len(pages)), 1) AS cp, coalesce(b.families, []) AS families FROM q LEFT JOIN b ON q.doc_id = b.doc_id LEFT JOIN c ON q.doc_id = c.doc_id),
k AS (SELECT *, CASE WHEN pages > 0 THEN empty_pages / pages ELSE 1 END AS er FROM j), w AS (SELECT *, pages >= 5 AND er > 0.8 AS w1, rr > 0.5 AS w2, pr > 0.45 AS w3, rp > 0.25 AS w4, pages >= 4 AND cp < 200 AS w5 FROM k)
SELECT doc_id, total_chars, CAST(pages AS INT) AS pages, CAST(empty_pages AS INT) AS empty_pages, round(er, 4)::DOUBLE AS empty_page_ratio, round(cp, 2)::DOUBLE AS chars_per_page, round(rr, 4)::DOUBLE AS repeated_ratio, round(pr, 4)::DOUBLE AS publisher_ratio, CAST(repeated_pages AS BIGINT) AS repeated_pages, round(rp, 4)::DOUBLE AS repeated_page_ratio, families,
list_filter([CASE WHEN w1 THEN 'most_pages_empty' END, CASE WHEN w2 THEN 'repeated_text_dominates' END, CASE WHEN w3 THEN 'publisher_boilerplate_dominates' END, CASE WHEN w4 THEN 'repeated_pages_detected' END, CASE WHEN w5 THEN 'very_low_text_density' END], lambda x: x IS NOT NULL) AS warnings,
(w1 AND total_chars < greatest(12000, pages * 900)) OR w3 OR ((w2 OR w4) AND total_chars < greatest(12000, pages * 700)) OR w5 AS low_quality FROM w""")
def document_quality(spark, sf_dir):
    d = spark.sql(RENDERED.replace("FROM documents", "FROM {documents}"), documents=table(spark, sf_dir, "documents"))
    return DQ.judge(d, "\f", "doc_id", expected="expected")


@Q.query("SELECT source, count(*) FILTER (doc_id % 9 = 0) AS blocked, CASE WHEN count(*) FILTER (doc_id % 9 = 0) > 0 THEN count(*) FILTER (doc_id % 9 = 0) || ' URLs were not crawled because of robots.txt' END AS warning FROM documents GROUP BY source")
def robots_blocked_warning(spark, sf_dir):
    n = F.count_if(F.col("doc_id") % 9 == 0)
    g = table(spark, sf_dir, "documents").groupBy("source").agg(n.alias("blocked"))
    return g.withColumn("warning", F.when(F.col("blocked") > 0, F.concat(F.col("blocked").cast("string"), F.lit(" URLs were not crawled because of robots.txt"))))
