"""Rows that leave the engine: fact rows without private data, results by kind of job, forwarded links, diff artifacts, run tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: what stands for a URL that may not be kept.
REDACTED = "<redacted due to zero data retention>"


def without_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\0"), F.lit(""))


def fact_rows(jobs: DataFrame, private: str = "zero_data_retention", secret: tuple[str, ...] = ("options", "content", "cost_tracking", "pdf_pages"), url: str = "url", team: str = "team_id", preview_team: str = "preview") -> DataFrame:
    """jobs as fact rows: no NUL in any text, URL and secret columns of private jobs redacted, preview teams taken as one."""
    out = jobs.withColumns({f.name: without_nul(F.col(f.name)) for f in jobs.schema if f.dataType.simpleString() == "string"})
    hidden = F.coalesce(F.col(private), F.lit(False))
    out = out.withColumns({c: F.when(~hidden, F.col(c)) for c in secret if c in out.columns})
    preview = (F.col(team) == "preview") | F.startswith(team, F.lit("preview_"))
    return out.withColumns({url: F.when(hidden, F.lit(REDACTED)).otherwise(F.col(url)), team: F.when(preview, F.lit(preview_team)).otherwise(F.col(team))})


def fact_table(rows: DataFrame, kind: str = "kind", is_parse: str = "is_parse") -> Column:
    """The table a fact row goes to: that of its kind; parsed uploads have one of their own."""
    return F.when(F.col(kind).isin("scrape") & F.coalesce(F.col(is_parse), F.lit(False)), "parses").otherwise(F.concat(F.col(kind), F.when(F.endswith(kind, F.lit("h")), "es").otherwise("s")))


def write_facts(rows: DataFrame, folder: str, by: str = "table") -> None:
    """Appends fact rows, a folder for each table."""
    rows.write.mode("append").partitionBy(by).parquet(folder)


def result_blobs(results: DataFrame, kind: str = "kind", job: str = "job_id") -> DataFrame:
    """kind, name, body: a JSON object for each result; private columns are those the caller left out."""
    rest = [c for c in results.columns if c not in (kind, job)]
    return results.select(kind, F.concat(F.col(job).cast("string"), F.lit(".json")).alias("name"), F.to_json(F.struct(*rest)).alias("body"))


def write_blobs(blobs: DataFrame, folder: str, kind: str = "kind") -> None:
    """Blobs by kind of job; the name stays a column, as many small files would not scale."""
    blobs.write.mode("append").partitionBy(kind).json(folder)


def forwarded_links(pages: DataFrame, share: float, page: str = "url", links: str = "links", team: str = "team_id", is_parse: str = "is_parse") -> DataFrame:
    """discovery_url, urls: distinct links of a share of the pages, chosen by a hash of the page's URL, so that a rerun chooses the same; not of uploads, nor of the engine's own requests."""
    own = F.contains(team, F.lit("robots-txt")) | F.contains(team, F.lit("sitemap"))
    chosen = F.pmod(F.xxhash64(page), F.lit(1_000_000)) < int(min(1.0, max(0.0, share)) * 1_000_000)
    kept = pages.where(F.col(team).isNotNull() & ~own & ~F.coalesce(F.col(is_parse), F.lit(False)) & chosen)
    return kept.select(F.col(page).alias("discovery_url"), F.array_distinct(F.coalesce(links, F.array().cast("array<string>"))).alias("urls"))


def diff_artifacts(diffs: DataFrame, keys: tuple[str, ...] = ("team_id", "monitor_id", "check_id", "page_id"), status: str = "diff_status", kind: str = "diff_kind") -> DataFrame:
    """key, body, bytes of the artifact of each changed page whose documents are known. The key is the path of its owner, monitor, check and page."""
    rest = [c for c in diffs.columns if c not in keys]
    kept = diffs.where((F.col(status) == "changed") & F.col(kind).isNotNull())
    body = F.to_json(F.struct(*rest))
    return kept.select(F.concat(F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.lit(".json")).alias("key"), body.alias("body")).withColumn("bytes", F.octet_length("body"))


def run_tables(items: DataFrame, run: str = "run_id", item: str = "item_id", status: str = "status") -> tuple[DataFrame, DataFrame]:
    """A bulk run's own row (counts by status, whether it is complete) and the rows of its items, numbered in order."""
    counted = items.groupBy(run).agg(F.count("*").alias("items"), F.count_if(F.col(status) == "ok").alias("ok"), F.count_if(F.col(status) == "error").alias("failed"))
    done = F.col("ok") + F.col("failed") == F.col("items")
    runs = counted.withColumn("status", F.when(~done, "running").when(F.col("failed") > 0, "completed_with_errors").otherwise("completed"))
    from pyspark.sql import Window

    numbered = items.withColumn("place", F.row_number().over(Window.partitionBy(run).orderBy(item)))
    return runs, numbered
