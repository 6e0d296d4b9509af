"""Group counts, billing, usage, and the small formulas around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def status_counts(jobs: DataFrame, backlog: DataFrame, group: str = "group_id") -> DataFrame:
    """Jobs by group and status, the backlog as a status of its own."""
    counted = jobs.groupBy(group, "status").agg(F.count("*").alias("n"))
    return counted.unionByName(backlog.groupBy(group).agg(F.count("*").alias("n")).withColumn("status", F.lit("backlog")))


def progress(counts: DataFrame, group: str = "group_id") -> DataFrame:
    """completed of total by group; failed jobs count for neither."""
    def n(*status):
        return F.sum(F.when(F.col("status").isin(*status), F.col("n")).otherwise(0))

    return counts.groupBy(group).agg(n("completed").alias("completed"), n("completed", "active", "queued", "backlog").alias("total"))


def billing_batches(ops: DataFrame) -> DataFrame:
    """Credits by team, subscription and endpoint; preview teams are not billed."""
    billed = ops.where(~F.startswith("team_id", F.lit("preview")))
    return billed.groupBy("team_id", "subscription_id", "endpoint").agg(F.sum("credits").alias("credits"), F.sum(F.when(~F.col("tracked"), F.col("credits")).otherwise(0)).alias("untracked"), F.count("*").alias("ops"))


def scrape_credits(formats: Column, lockdown: Column, zdr: Column, pages: Column, stealth: Column, x_post: Column) -> Column:
    """Credits of one scrape. JSON sets the price to 5 whatever came before; the rest adds."""
    def has(*names):
        out = F.lit(False)
        for n in names:
            out = out | F.array_contains(formats, n)
        return out

    price = F.when(has("json"), 5).otherwise(F.when(lockdown, 5).otherwise(1))
    for extra in (has("question", "query"), has("highlights"), has("audio"), has("video"), stealth):
        price = price + F.when(extra, 4).otherwise(0)
    price = price + F.when(x_post, 29).otherwise(0) + F.when(zdr & ~lockdown, 1).otherwise(0)
    return price + F.greatest(F.coalesce(pages, F.lit(1)) - 1, F.lit(0))


def search_credits(results: Column, zdr: Column) -> Column:
    return (F.ceil(results / 10) * F.when(zdr, 10).otherwise(2)).cast("long")


def monthly_usage(points: DataFrame, keys: list[str], date: str = "date", value: str = "value", tokens_per_credit: int = 15) -> DataFrame:
    """Calendar-month sums; a period ends where the next begins, the last is open."""
    month = points.groupBy(*keys, F.date_trunc("month", date).alias("start_date")).agg(F.sum(value).alias("credits"))
    last = F.max("start_date").over(Window.partitionBy(F.lit(1) if not keys else keys[0]))
    return month.withColumn("end_date", F.when(F.col("start_date") == last, None).otherwise(F.add_months("start_date", 1).cast("timestamp"))).withColumn("tokens", F.col("credits") * tokens_per_credit)


def summary_counts(pages: DataFrame, by: str, status: str, kinds: list[str]) -> DataFrame:
    """Pages by status as columns; a check with an error is partial, else completed."""
    out = pages.groupBy(by).agg(*[F.count_if(F.col(status) == k).alias(k) for k in kinds], F.count("*").alias("total"))
    return out.withColumn("status", F.when(F.col("error") > 0, "partial").otherwise("completed"))


def precrawl_budget(n: Column) -> Column:
    return F.when(n <= 25, F.least(F.lit(50000), 3000 + (n - 1) * 500)).when(n <= 100, F.least(F.lit(50000), 10000 + (n - 5) * 200)).otherwise(50000)


def queue_limit(concurrency: Column) -> Column:
    return F.least(F.greatest(concurrency * 2000, F.lit(50_000)), F.lit(2_000_000))


def job_priority(base: Column, n: Column, limit: Column, modifier: Column) -> Column:
    return F.when(n <= limit, base).otherwise(F.ceil(base + F.ceil((n - limit) * modifier))).cast("long")


def frequency_bucket(seconds: Column) -> Column:
    out = None
    for limit, name in ((900, "15m"), (1800, "30m"), (3600, "hourly"), (21600, "sub_daily"), (86400, "daily"), (604800, "weekly")):
        out = F.when(seconds <= limit, name) if out is None else out.when(seconds <= limit, name)
    return out.otherwise("other")


def monitor_credits(targets: DataFrame, monitor: str = "monitor_id", default_limit: int = 10_000) -> DataFrame:
    """Credits of a run of each monitor: a scrape target's URLs, a crawl target's limit (one at least)."""
    price = F.when(F.col("type") == "scrape", F.size("urls")).otherwise(F.greatest(F.lit(1), F.coalesce("limit", F.lit(default_limit))))
    return targets.groupBy(monitor).agg(F.sum(price).cast("long").alias("credits"), F.count("*").alias("targets"))


def scrape_credit_sum(docs: DataFrame, keys: list[str], credits: str = "credits_used") -> DataFrame:
    """Credits that scraped results used, by request; a result that does not say used none."""
    return docs.groupBy(*keys).agg(F.sum(F.coalesce(credits, F.lit(0))).cast("long").alias("credits"))


def engine_results(results: DataFrame, similarity: float) -> DataFrame:
    """results with similarity and outcome: browser_failed, sufficient or not of the light client against the browser.

    results: browser, browser_stealth, light, light_stealth: the Markdown each
    engine returned, null where it failed. Stealth results count first.
    """
    from loomspan.functions.text import edit_similarity

    gold, light = F.coalesce("browser_stealth", "browser", F.lit("")), F.coalesce("light_stealth", "light", F.lit(""))
    likeness = F.when((gold != "") & (light != ""), edit_similarity(gold, light))
    outcome = F.when(gold == "", "browser_failed").when(F.coalesce(likeness >= similarity, F.lit(False)), "sufficient").otherwise("insufficient")
    return results.withColumns({"similarity": likeness, "outcome": outcome})


def engine_verdict(results: DataFrame, by: str, similarity: float = 0.85, success_rate: float = 0.9, failure_rate: float = 0.5) -> DataFrame:
    """Per site whether the light client will do, the browser is needed, or that cannot be told; the rate is over the URLs that could be compared."""
    def n(*kinds):
        return F.count_if(F.col("outcome").isin(*kinds))

    g = engine_results(results, similarity).groupBy(by).agg(F.count("*").alias("total"), n("browser_failed").alias("failed"), n("sufficient").alias("sufficient"), n("insufficient").alias("insufficient"))
    comparable = F.col("total") - F.col("failed")
    unknown = (F.col("failed") / F.col("total") > failure_rate) | (comparable == 0)
    return g.withColumn("verdict", F.when(unknown, "Uncertain").when(F.col("sufficient") / comparable >= success_rate, "TlsClientOk").otherwise("ChromeCdpRequired"))
