"""Streaming forms of the stateful operators. Each takes a streaming DataFrame and gives one, or a started query."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomspan.operators.queues import rate_limited


def rate_limit_stream(events: DataFrame, keys: list[str], time: str, points: int, late: str = "10 minutes") -> DataFrame:
    """Refusals by key and minute; late rows are waited for (an extension: the service has no event time)."""
    return rate_limited(events.withWatermark(time, late), keys, time, points)


def first_seen(links: DataFrame, key: str, time: str, late: str = "24 hours") -> DataFrame:
    """A link's first occurrence within its time to live: the lock on a URL."""
    return links.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def change_stream(snapshots: DataFrame) -> DataFrame:
    """url, scraped_at, change_status of snapshots (url, scraped_at, status_code, markdown); state by url is the last page's digest."""
    def step(key, frames, state: GroupState):
        last = state.get[0] if state.exists else None
        out = []
        for r in sorted((r for f in frames for r in f.itertuples(index=False)), key=lambda r: r.scraped_at):
            own = "".join(sorted("".join((r.markdown or "").split())))
            status = "removed" if r.status_code == 404 else "new" if last is None else "same" if last == own else "changed"
            last = own
            out.append((key[0], r.scraped_at, status))
        state.update((last,))
        yield pd.DataFrame(out, columns=["url", "scraped_at", "change_status"])

    return snapshots.groupBy("url").applyInPandasWithState(step, "url string, scraped_at timestamp, change_status string", "last string", "append", GroupStateTimeout.NoTimeout)


def drain(rows: DataFrame, sink, every: str = "3 seconds", checkpoint: str | None = None) -> StreamingQuery:
    """Batches to sink(df, batch id) on a timer; with a checkpoint each batch is given once."""
    w = rows.writeStream.foreachBatch(sink).trigger(processingTime=every)
    return (w.option("checkpointLocation", checkpoint) if checkpoint else w).start()


def counted_per_batch(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))
