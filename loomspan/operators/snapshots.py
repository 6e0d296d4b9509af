"""Snapshots over time: the latest before, change status, page state that is merged check by check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def comparable(markdown: Column) -> Column:
    """What counts in a comparison: no white space, no iframe links, characters sorted."""
    t = F.regexp_replace(F.regexp_replace(markdown, r"\s+", ""), r"\[iframe\]\([^)]*\)", "")
    return F.array_join(F.array_sort(F.split(t, "")), "")


def change_status(snapshots: DataFrame, keys: list[str], time: str, status_code: str, markdown: str) -> DataFrame:
    """removed (404), new (no earlier one), changed or same against the latest snapshot before."""
    w = Window.partitionBy(*keys).orderBy(time)
    own = comparable(F.col(markdown))
    before, at = F.lag(own).over(w), F.lag(F.col(time)).over(w)
    s = snapshots.withColumn("__own", own).withColumn("__before", before).withColumn("previous_at", at)
    status = F.when(F.col(status_code) == 404, "removed").when(F.col("previous_at").isNull(), "new").when(~F.col("__before").eqNullSafe(F.col("__own")), "changed").otherwise("same")
    return s.withColumn("change_status", status).drop("__own", "__before")


def latest_before(events: DataFrame, probes: DataFrame, keys: list[str], time: str, probe_time: str, carry: list[str]) -> DataFrame:
    """As-of join without a range join: both sides in one window, the last event's values carried forward."""
    right = events.select(*keys, F.col(time).alias("__t"), F.struct(*carry).alias("__v"), F.lit(None).cast("struct<>" if not probes.columns else probes.select(F.struct(*probes.columns).alias("x")).schema["x"].dataType).alias("__p"))
    left = probes.select(*keys, F.col(probe_time).alias("__t"), F.lit(None).cast(right.schema["__v"].dataType).alias("__v"), F.struct(*probes.columns).alias("__p"))
    w = Window.partitionBy(*keys).orderBy("__t", F.col("__p").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = right.unionByName(left).withColumn("__last", F.last("__v", ignorenulls=True).over(w)).where("__p is not null")
    return both.select("__p.*", *[F.col(f"__last.{c}").alias(f"last_{c}") for c in carry])


def upsert_pages(state: DataFrame, seen: DataFrame, check: str, now: Column | None = None) -> DataFrame:
    """State by url after a check that reports a status for some pages. Rows not reported stay as they are.

    A removed page keeps when it was last seen and last changed, and is marked
    with the time; only new and changed pages move the last change.
    """
    j = state.alias("s").join(seen.select("url", F.col("status").alias("reported")).alias("n"), "url", "full_outer")
    told, gone = F.col("reported").isNotNull(), F.col("reported") == "removed"
    at = F.current_timestamp() if now is None else now
    return j.select(
        "url",
        F.coalesce("s.first_seen", F.lit(check)).alias("first_seen"),
        F.when(told & ~gone, F.lit(check)).otherwise(F.col("s.last_seen")).alias("last_seen"),
        F.when(F.col("reported").isin("new", "changed"), F.lit(check)).otherwise(F.col("s.last_changed")).alias("last_changed"),
        F.coalesce("reported", "s.status").alias("status"),
        F.when(told, gone).otherwise(F.col("s.is_removed")).alias("is_removed"),
        F.when(gone, at).when(told, None).otherwise(F.col("s.removed_at")).alias("removed_at"),
    )


def page_diff(pages: DataFrame, modes: tuple[str, ...] = ("git-diff",)) -> DataFrame:
    """pages with diff_status (new, changed, same), diff_kind and diff_json, against each page's previous scrape.

    pages: previous_id, was_removed, and (previous_)markdown and (previous_)json, the
    latter flat objects as maps. modes: json, git-diff, or both, where a change
    of either counts. A missing document is a change, an empty one is not missing.
    """
    from loomspan.functions.text import map_diff

    wants_json = "json" in modes
    text_differs = comparable(F.col("previous_markdown")) != comparable(F.col("markdown"))
    new = F.col("previous_id").isNull() | F.coalesce("was_removed", F.lit(False))
    none = F.create_map().cast("map<string,string>")
    fields = map_diff(F.coalesce("previous_json", none), F.coalesce("json", none))
    if wants_json:
        both = (F.col("previous_markdown") != "") & (F.col("markdown") != "") if "git-diff" in modes else F.lit(False)
        beside = F.coalesce(both & text_differs, F.lit(False))
        changed = F.col("json").isNull() | (F.size(fields) > 0) | beside
        kept = F.when(~new & changed & F.col("json").isNotNull(), fields)
    else:
        changed = F.col("previous_markdown").isNull() | F.col("markdown").isNull() | text_differs
        kept = F.lit(None).cast("map<string,struct<previous:string,current:string>>")
    missing = F.col("json").isNull() if wants_json else F.col("previous_markdown").isNull() | F.col("markdown").isNull()
    status = F.when(new, "new").when(changed, "changed").otherwise("same")
    kind = F.when((status == "changed") & ~missing, "json" if wants_json else "markdown")
    return pages.withColumns({"diff_status": status, "diff_kind": kind, "diff_json": kept})


def removed_pages(previous: DataFrame, current: DataFrame, key: str = "url") -> DataFrame:
    return previous.join(current.select(key).distinct(), key, "left_anti")


def job_lookup(queue: DataFrame, database: DataFrame, blobs: DataFrame) -> DataFrame:
    """id, status, price, result of every job that the queue or the database knows; the stored result wins over the status."""
    both = queue.join(database, "id", "full_outer").join(blobs, "id", "left")
    return both.select("id", "status", "price", F.coalesce("blob", "status").alias("result"))


def agreeing_sources(items: DataFrame, sources: DataFrame, keys: list[str], field: str, name: str) -> DataFrame:
    """items with the number of sources of equal keys whose field is equal or not known; sources are counted before they are joined."""
    known = sources.where(F.col(field).isNotNull()).groupBy(*keys, field).agg(F.count("*").alias("__n"))
    open_ = sources.where(F.col(field).isNull()).groupBy(*keys).agg(F.count("*").alias("__o"))
    both = items.join(known, [*keys, field], "left").join(open_, keys, "left")
    return both.withColumn(name, F.coalesce("__n", F.lit(0)) + F.coalesce("__o", F.lit(0))).drop("__n", "__o")
