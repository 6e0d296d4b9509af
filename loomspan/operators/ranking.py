"""Relevance: query-word cosine, embedding cosine, BM25, rank fusion, paging."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def word_cosine(text: Column, query: str) -> Column:
    """Cosine of the query words' counts in the text and in the query itself."""
    words = re.split(r"\W+", query.lower())

    def counts(t: Column) -> Column:
        return F.array(*[F.regexp_count(F.lower(t), F.lit(w)) / F.length(t) for w in words])

    return cosine(counts(text), counts(F.lit(query)))


def cosine(a: Column, b: Column) -> Column:
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size == 0, 0.0).otherwise(dot(a, b) / size)


def bm25(docs: DataFrame, query: str, doc_id: str = "doc_id", text: str = "text", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """doc_id, bm25 of the documents that hold a query word; only query words are counted, so no term table is built."""
    words = sorted(set(re.findall(r"\w+", query.lower())))
    t = docs.select(F.col(doc_id).alias("doc_id"), F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "").alias("w"))

    def times(word: str) -> Column:
        return F.size(F.filter("w", lambda x: x == F.lit(word)))

    t = t.select("doc_id", F.size("w").alias("n"), *[times(v).alias(f"f{k}") for k, v in enumerate(words)])
    s = t.agg(F.count("*").alias("docs"), F.avg("n").alias("avg"), *[F.count_if(F.col(f"f{k}") > 0).alias(f"d{k}") for k in range(len(words))]).first()
    score = F.lit(0.0)
    for k in range(len(words)):
        idf = F.log(F.lit((s.docs - s[f"d{k}"] + 0.5) / (s[f"d{k}"] + 0.5) + 1))
        f = F.col(f"f{k}")
        score = score + idf * f * (k1 + 1) / (f + k1 * (1 - b + b * F.col("n") / F.lit(s.avg or 1.0)))
    return t.select("doc_id", score.alias("bm25")).where("bm25 > 0")


def reciprocal_rank_fusion(ranked: list[DataFrame], key: str, place: str = "place", k: int = 60) -> DataFrame:
    """Sum of 1 / (k + place) over rankings (key, place)."""
    every = ranked[0].select(key, place)
    for r in ranked[1:]:
        every = every.unionByName(r.select(key, place))
    return every.groupBy(key).agg(F.sum(1.0 / (k + F.col(place))).alias("score"))


def top_per_group(df: DataFrame, keys: list[str], order: list, n: int, place: str = "place") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(place, F.row_number().over(w)).where(F.col(place) <= n)


def byte_budget(rows: DataFrame, group: list[str], order: list, size: str, limit: int) -> DataFrame:
    """Rows in order while their sizes add up to limit at most; the first row always."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("sent", F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("place", F.row_number().over(w)).where((F.col("sent") <= limit) | (F.col("place") == 1)).drop("place")


def keyset_page(rows: DataFrame, time: str, key: str, limit: int, after: tuple | None = None) -> tuple[DataFrame, bool]:
    """A page in descending (time, key), and whether there is more."""
    if after:
        rows = rows.where((F.col(time) < F.lit(after[0])) | ((F.col(time) == F.lit(after[0])) & (F.col(key) < after[1])))
    page = rows.orderBy(F.desc(time), F.desc(key)).limit(limit + 1)
    return page.limit(limit), page.count() > limit
