"""The page cache: which rows are written, and which one answers a request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import urls as U


def clipped(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def index_rows(pages: DataFrame, url: str = "url") -> DataFrame:
    """Rows for the index: the key of the URL, hashes of its path prefixes and of its domains, clipped title and description."""
    u = F.col(url)
    key = U.normalize_for_index(u)
    splits = F.transform(F.slice(U.splits(u), 1, 10), lambda s: F.sha2(s, 256))
    domains = F.transform(F.slice(U.domain_splits(U.host(u)), 1, 5), lambda s: F.sha2(s, 256))
    return pages.withColumns({"url_hash": F.sha2(key, 256), "url_split_hashes": splits, "domain_split_hashes": domains, "title": clipped(F.col("title"), 60), "description": clipped(F.col("description"), 160)})


def lookup(index: DataFrame, now: Column, max_age: str, errors: int = 3) -> DataFrame:
    """For each key the newest row within max_age: the newest 2xx, unless `errors` or more newer rows failed or there is none; then the newest."""
    fresh = index.where(F.col("created_at") >= now - F.expr(f"interval {max_age}"))
    w = Window.partitionBy("url_hash").orderBy(F.desc("created_at"), F.desc("id"))
    ranked = fresh.withColumn("rn", F.row_number().over(w))
    good = F.min(F.when(F.col("status").between(200, 299), F.col("rn"))).over(Window.partitionBy("url_hash"))
    pick = F.when(good.isNull() | (good > errors), 1).otherwise(good)
    return ranked.withColumn("pick", pick).where("rn = pick").drop("rn", "pick")


def searchable(pages: DataFrame) -> Column:
    """May go to the search index: answered, long enough, nothing private about the request."""
    return F.col("status").between(200, 299) & (F.length("markdown") >= 200) & ~F.col("has_auth") & ~F.col("private")


def webhook_wanted(events: Column, event: Column) -> Column:
    """No filter, the full name, its second part, or all after its first dot."""
    second = F.get(F.split(event, r"\."), F.lit(1))
    return F.coalesce(F.size(events) == 0, F.lit(True)) | F.array_contains(events, event) | F.array_contains(events, second) | F.array_contains(events, F.substring(event, F.instr(event, ".") + 1, F.lit(2**30)))
