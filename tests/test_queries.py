"""Every query against its SQL in DuckDB, on the smallest test data."""

import os

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from loomspan import catalog
from loomspan.operators.page_columns import repeated_signatures, with_repeated
from loomspan.plans import q_service

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


def rows(records, names, order):
    return sorted((tuple(plain(r[names.index(c)]) for c in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for f in os.listdir(small):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{small}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    assert rows(df.collect(), df.columns, order) == rows(cur.fetchall(), names, order)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() >= 0


def test_entry(spark, small):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_metadata_of_odd_pages(spark, tmp_path):
    titles = ["a &quot;b&quot;", "a&amp", "&amp;lt;&copy; &#65;", "\n a\t", "\u00a0\u3000 a b \u2003", "a\u200b\n", " ", "", "<b>x</b>", "a</title><title>b", "$1 \\\\ &gt;&lt;"]
    html = [f'<html dir="x"\n lang="l{k}"><title>{t}</title>' for k, t in enumerate(titles)]
    html += [None, "", "no tags", "<TITLE>a</TITLE>", "<title lang='x'>a</title>", "<html lang=''><title>open", '<html lang="">', "<html lang='en'>", '<html xml:lang="a" lang="b" lang="c">', '<html\x0blang="d">', '<html\u00a0lang="e">', '<meta property="og:title" content="g"><title> </title>']
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").withColumn("url", F.lit("http://a.com/")).write.parquet(str(tmp_path / "pages.parquet"))
    c = duckdb.connect()
    c.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = c.execute(SQL["html_metadata"]).fetchall()
    got = QUERIES["html_metadata"](spark, str(tmp_path)).select("page_id", "language", "title").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(got) == len(html)


def test_repeated_elements_in_one_reading(spark, tmp_path):
    pages = [("a", ["x", "y", "x"]), ("a", ["x"]), ("a", None), ("b", ["y"]), ("b", ["y", "z", None]), ("b", []), ("b", []), ("b", ["z"]), ("c", ["x"]), (None, ["x"]), (None, ["x"])]
    reads = spark.sparkContext.accumulator(0)

    def read(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    p = spark.createDataFrame(pages, "site string, signatures array<string>")
    known = repeated_signatures(p.mapInArrow(read, p.schema))
    assert {r.site: r.repeated for r in known.collect()} == {"a": ["x"]}  # "y" and "z" are on two of five pages of b
    assert reads.value <= len(pages)
    for most in (100, 0):  # as a broadcast, and by a shuffled join
        got = with_repeated(p.select("site"), known, most=most)
        assert sorted(map(str, got.collect())) == sorted(str(Row(site=s, repeated=["x"] if s == "a" else None)) for s, _ in pages)


def test_made_pages_are_spread(spark, tmp_path):
    spark.range(50_000).selectExpr("id as p_partkey", "cast(id % 50 as int) as p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    made = q_service.made_pages(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() >= 4  # one row group, in one task as it is read
    assert made.count() == 50_000
