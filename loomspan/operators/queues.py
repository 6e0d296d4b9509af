"""Job queues as tables: reaping, promotion, reconciliation, rate limits, due monitors. Times are parameters, never the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reap(jobs: DataFrame, now: Column, most_stalls: int = 9) -> DataFrame:
    """Active jobs whose lock is older than a minute are queued again, or failed after most_stalls; finished ones without a group expire."""
    stale = (F.col("status") == "active") & (F.col("locked_at") <= now - F.expr("interval 1 minute"))
    alone = F.col("group_id").isNull()
    gone = alone & (((F.col("status") == "completed") & (F.col("created_at") < now - F.expr("interval 1 hour"))) | ((F.col("status") == "failed") & (F.col("created_at") < now - F.expr("interval 6 hours"))))
    status = F.when(stale & (F.col("stalls") < most_stalls), "queued").when(stale, "failed").otherwise(F.col("status"))
    return jobs.where(~F.coalesce(gone, F.lit(False))).withColumns({"stalls": F.col("stalls") + stale.cast("int"), "status": status})


def promote(jobs: DataFrame, backlog: DataFrame) -> DataFrame:
    """Jobs with the backlog's rows that were none yet, queued; the backlog is empty afterwards."""
    new = backlog.join(jobs.select("id"), "id", "left_anti")
    return jobs.unionByName(new.withColumn("status", F.lit("queued")), allowMissingColumns=True)


def reconcile(backlog: DataFrame, queued: DataFrame, active: DataFrame, limit: int, owner: str = "owner_id", kind: str = "kind") -> DataFrame:
    """Backlog jobs that the queue lost: start while the owner's active ones of a kind stay below limit, else queue again."""
    lost = backlog.join(queued.select("id"), "id", "left_anti")
    busy = active.groupBy(owner, kind).agg(F.count("*").alias("busy"))
    w = Window.partitionBy(owner, kind).orderBy("created_at", "id")
    out = lost.join(busy, [owner, kind], "left").withColumn("n", F.row_number().over(w))
    return out.withColumn("action", F.when(F.coalesce("busy", F.lit(0)) + F.col("n") <= limit, "start").otherwise("requeue")).drop("busy", "n")


def rate_limited(events: DataFrame, keys: list[str], time: str, points: int, window: str = "60 seconds") -> DataFrame:
    """Requests by key and window, and how many are over the limit. Works on streams too."""
    counted = events.groupBy(*keys, F.window(time, window).alias("w")).agg(F.count("*").alias("n"))
    return counted.select(*keys, F.col("w.start").alias("start"), "n", F.greatest(F.col("n") - points, F.lit(0)).alias("refused"))


def finished(jobs: DataFrame, group: str = "group_id") -> DataFrame:
    """Groups all of whose jobs are done."""
    g = jobs.groupBy(group).agg(F.count("*").alias("jobs"), F.count_if(F.col("status").isin("completed", "failed")).alias("done"))
    return g.withColumn("finished", F.col("jobs") == F.col("done"))


def due(monitors: DataFrame, now: Column, stale_minutes: int = 60) -> DataFrame:
    """What to do with monitors whose time has come: run, skip while one runs, fail one that hangs."""
    late = F.col("running_since") < now - F.make_dt_interval(mins=F.lit(stale_minutes))
    action = F.when(F.col("next_run_at") > now, "wait").when(F.col("running_since").isNull(), "run").when(late, "fail_stale").otherwise("skipped_overlap")
    return monitors.withColumn("action", action)


def dequeue(jobs: DataFrame, most: int, now: Column, kinds: Column | None = None) -> DataFrame:
    """jobs in which the next `most` queued ones, by priority, time and id, are active and locked now; an update from a selection of ids."""
    ready = jobs.where((F.col("status") == "queued") & (F.lit(True) if kinds is None else kinds))
    chosen = ready.orderBy("priority", "created_at", "id").limit(most).select("id").withColumn("__next", F.lit(True))  # most rows at most
    taken = F.coalesce("__next", F.lit(False))
    both = jobs.join(F.broadcast(chosen), "id", "left")
    return both.withColumns({"status": F.when(taken, "active").otherwise(F.col("status")), "locked_at": F.when(taken, now).otherwise(F.col("locked_at"))}).drop("__next")


def finished_until(jobs: DataFrame, until: Column | None = None, start: int = 0, count: int = -1, done_at: str = "done_at", key: str = "id") -> DataFrame:
    """Finished jobs in the order of their completion, up to a moment, from the start-th on, count of them (-1: all)."""
    done = jobs.where(F.col(done_at).isNotNull() & (F.lit(True) if until is None else F.col(done_at) <= until)).orderBy(done_at, key)
    done = done.offset(start) if start else done
    return done if count < 0 else done.limit(count)


def leases(held: DataFrame, asked: DataFrame, now: Column, ttl_ms: int = 30_000, team: str = "team_id", holder: str = "holder_id") -> DataFrame:
    """The leases after a round of requests: expired ones are gone, holders that ask again are renewed, others are granted in order while the team's limit leaves room.

    held: team, holder, renewed_at. asked: team, holder, limit, asked_at. Result:
    team, holder, renewed_at, granted; requests that got none have a null time.
    """
    alive = held.where(F.col("renewed_at") > now - F.make_dt_interval(secs=F.lit(ttl_ms / 1000).cast("decimal(18,6)")))
    both = alive.select(team, holder, F.col("renewed_at").alias("__held")).join(asked, [team, holder], "full_outer")
    busy = alive.groupBy(team).agg(F.count("*").alias("__busy"))
    w = Window.partitionBy(team).orderBy("asked_at", holder)
    new = F.col("__held").isNull()
    both = both.join(busy, team, "left").withColumn("__n", F.sum(new.cast("int")).over(w))
    granted = ~new | (F.coalesce("__busy", F.lit(0)) + F.col("__n") <= F.col("limit"))
    renewed = F.when(F.col("asked_at").isNotNull() & granted, now).otherwise(F.col("__held"))
    return both.select(team, holder, renewed.alias("renewed_at"), granted.alias("granted"))
