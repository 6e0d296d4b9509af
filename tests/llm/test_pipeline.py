"""The pipeline, stage by stage, on the smallest test data and on odd rows."""

from collections import Counter

import corpus_pipeline as P
from pyspark.sql import functions as F


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    start = {r.doc_id: r for r in docs.collect()}
    seen = set(start)
    for name, stage in P.STAGES[:-1]:
        docs = P.written(stage(spark, docs, small), "test")
        assert docs.columns == P.COLUMNS
        rows = docs.collect()
        ids = {r.doc_id for r in rows}
        assert ids <= seen and all(r.text == start[r.doc_id].text for r in rows)
        if name == "mixing sources to target weights":
            assert ids == seen and max(Counter(r.doc_id for r in rows).values()) <= 3
        else:
            assert len(ids) == len(rows)
        seen = ids
    n = docs.count()
    packed = P.STAGES[-1][1](spark, docs, small)
    assert packed.where("start = 0").count() == n
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert fill.where("n > 1024").count() == 0 and fill.agg(F.avg("n")).first()[0] > 900


def test_odd_rows(spark, small):
    rows = [(None, " ".join(f"w{i}" for i in range(40)), "en", "a", 1), (None, None, None, None, None), (1, "", "en", None, 0), (2, " ".join(f"v{i}" for i in range(40)), None, "a", 1), (2, " ".join(f"v{i}" for i in range(40)), None, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = P.near_dedup_stage(spark, docs, small).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 0, 1, 2]
    kept = P.quality(spark, docs, small).collect()  # two texts are too short; their hosts fail with them or not, by rate
    assert {r.doc_id for r in kept} <= {None, 2} and all(r.text for r in kept)
    assert P.mixing(spark, docs.dropDuplicates(["doc_id", "text"]), small).where("doc_id is null").count() == 2
    odd = spark.createDataFrame([(7, None, None, None, None), (8, "", "en", "a", 0), (9, "人人平等，自由和尊严，理性和良心，关系的精神相对待", None, "a", 1), (10, "the cat and the dog are in the house of the king", None, "a", 1)], docs.schema)
    taught = docs.unionByName(odd).unionByName(spark.createDataFrame([(100 + k, "the dog and the cat were in the old house of the king and the queen", "en", "a", 1) for k in range(9)], docs.schema))
    found = {r.doc_id: r.lang for r in P.language(spark, taught, small).collect() if r.doc_id is not None}
    assert found[10] == "en" and not {7, 8, 9} & set(found)


def test_rows_of_one_id(spark, small):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = spark.createDataFrame([(1, a, "en", "s", 1), (3, a + " x", "en", "s", 1), (3, b, "en", "s", 1), (3, b, "en", "s", 1), (5, b + " y", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    got = P.near_dedup_stage(spark, docs, small).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, a), (3, b)]  # no text is lost because another has its id
    assert P.mixing(spark, docs.dropDuplicates(), small).count() == 4


def test_run(spark, small):
    packed = P.run(spark, small)
    whole = spark.read.parquet(f"{small}/documents.parquet")
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(packed.columns)
    assert packed.select("doc_id").distinct().join(whole, "doc_id", "left_anti").count() == 0 and packed.count() > 0


def test_empty_tables(spark, small):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    none = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, none, small).count() == 0
