"""Parsing, diffs, schedules, files and crawl rules on small cases."""

import gzip
import io
import random
import zipfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from loomspan.functions import html as H
from loomspan.functions import text as X
from loomspan.functions import urls as U
from loomspan.operators import crawl, records
from loomspan.operators import snapshots as S
from loomspan.operators.link_filter import Scope, filter_links
from loomspan.operators.page_columns import page_columns
from loomspan.sources import files


def one(spark, expr, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols)).select(expr.alias("x")).first().x


def test_malformed_html():
    root = H.parse('<p>a<p>b <b>c<ul><li>x<li>y</ul><script>var t="</p>"</script>')
    assert [n.tag for n in root.walk()][1:] == ["p", "p", "b", "ul", "li", "li", "script"]
    assert H.parse(None).children == []


def test_selectors():
    root = H.parse('<div id=a class="x y"><p data-k="1">t</p><span><p>u</p></span></div>')
    assert len(H.select(root, "div p")) == 2 and len(H.select(root, "div > p")) == 1
    assert H.select(root, "#a.x")[0].tag == "div" and H.attributes(root, "p", "k") == ["1"]
    assert H.attributes(root, "p:::", "k") == []


def test_links_images_metadata():
    page = '<html lang="en"><head><base href="/b/"><title>T</title><meta name=description content=a><meta name=description content=b><link rel="icon" href="/f.ico"></head><body><a href="x">1</a><a href="#s">2</a><a href="http:/h.org/y">3</a><a href="x">4</a><img src="i.png" srcset="j.png 2x, k.png 1x"><img src="javascript:x"></body></html>'
    root = H.parse(page)
    assert H.links(root, "https://e.com/p") == ["https://e.com/b/x", "http://h.org/y"]
    assert H.metadata(root, "https://e.com/p") == {"language": ["en"], "title": ["T"], "description": ["a, b"], "favicon": ["https://e.com/f.ico"]}
    assert H.images(root, "https://e.com/p") == ["https://e.com/b/i.png", "https://e.com/b/j.png", "https://e.com/b/k.png", "https://e.com/f.ico"]


def test_main_content_and_markdown():
    page = "<body><nav>n</nav><div class=ad><p id=main>kept</p></div><h2>Head</h2><p>Some <b>bold</b> <a href='/l'>link</a></p><pre><code class='language-py'>x = 1\n</code></pre><ol><li>a</li><li>b</li></ol><table><tr><th>h</th><th>i</th></tr><tr><td>1</td><td>2</td></tr></table></body>"
    md = H.markdown(H.transform(H.parse(page), "https://e.com/"))
    assert md.startswith("kept") and "## Head" in md and "Some **bold** [link](https://e.com/l)" in md
    assert "```py\nx = 1\n```" in md and "1. a\n2. b" in md and "| h | i |\n| --- | --- |\n| 1 | 2 |" in md
    rows = H.sentences(md)
    pick = [k for k, r in enumerate(rows) if r[0] in ("1 | 2", "x = 1")]
    assert H.assemble(rows, pick) == "```\nx = 1\n```\n\n| h | i |\n| --- | --- |\n| 1 | 2 |"


def test_page_columns_of_empty_pages(spark):
    df = spark.createDataFrame([(1, "https://e.com", None), (2, None, ""), (3, "https://e.com", "<nav>only</nav>")], "id int, url string, html string")
    got = {r.id: r for r in page_columns(df, "links", "markdown", "title").collect()}
    assert got[1].links == [] and got[2].markdown == "" and got[3].markdown == "only" and got[1].title is None


@pytest.mark.parametrize("link,want", [("a/b", "https://e.com/x/a/b"), ("../c", "https://e.com/c"), ("/r?q", "https://e.com/r?q"), ("//h.org/z", "https://h.org/z"), ("#f", "https://e.com/x/y#f"), ("?k=1", "https://e.com/x/y?k=1"), ("https://o.com", "https://o.com")])
def test_resolve(spark, link, want):
    assert one(spark, U.resolve(F.col("b"), F.col("l")), b="https://e.com/x/y", l=link) == want


def test_permutations_are_a_class(spark):
    first = one(spark, U.permutations(F.col("u")), u="https://e.com/a")
    assert len(first) == 16
    for form in first:
        assert one(spark, U.permutations(F.col("u")), u=form) == first


def test_splits_and_domains(spark):
    assert one(spark, U.splits(F.col("u")), u="http://www.e.com/a/b.html?q=1") == ["https://e.com/", "https://e.com/a", "https://e.com/a/b.html", "https://e.com/a/b.html?q=1"]
    assert one(spark, U.domain_splits(F.col("h")), h="a.b.e.co.uk") == ["e.co.uk", "b.e.co.uk", "a.b.e.co.uk"]
    assert one(spark, U.domain_splits(F.col("h")), h="www.e.com") == ["e.com"]


def test_filter_includes_and_external(spark):
    links = spark.createDataFrame([("/en/a",), ("/fr/a",), ("https://o.org/",), ("https://o.org/p",), ("tel:1",)], "link string")
    scope = Scope("https://e.com/", "https://e.com/", includes=("^/en",), allow_external=True, allow_backward=True)
    got = {r.link: r.denial_reason for r in filter_links(links, scope).collect()}
    assert got == {"/en/a": None, "/fr/a": "INCLUDE_PATTERN", "https://o.org/": "EXTERNAL_LINK", "https://o.org/p": None, "tel:1": "NON_WEB_PROTOCOL"}


def test_crawl_cycle_limit_and_depth(spark):
    edges = spark.createDataFrame([("https://e.com/", "/a"), ("https://e.com/a", "/b"), ("https://e.com/b", "/"), ("https://e.com/a", "https://www.e.com/b/"), ("https://e.com/b", "/c")], "src string, dst string")
    seeds = spark.createDataFrame([("https://e.com/",)], "url string")
    scope = Scope("https://e.com/", "https://e.com/")
    assert sorted(r.depth for r in crawl.crawl(edges, seeds, scope).collect()) == [0, 1, 2, 3]
    assert crawl.crawl(edges, seeds, scope, limit=2).count() == 2


def test_map_site_cuts_only_its_own_urls(spark):
    rows = [(f"https://other.org/{k}", None, k) for k in range(20)] + [(f"https://example.com/fr/{k}", None, 20 + k) for k in range(20)] + [(f"https://example.com/en/{k}", None, 40 + k) for k in range(12)]
    pages = spark.createDataFrame(rows, "url string, title string, pos long")
    for search in (None, "en docs"):
        got = [r.url for r in crawl.map_site([pages], "https://example.com/en", search=search, limit=10).collect()]
        assert got == [f"https://example.com/en/{k}" for k in range(10)]


def test_change_status_and_as_of(spark):
    s = spark.createDataFrame([("u", 1, 200, "a b"), ("u", 2, 200, "ba"), ("u", 3, 200, "c"), ("u", 4, 404, None)], "url string, t int, code int, md string")
    assert [r.change_status for r in S.change_status(s, ["url"], "t", "code", "md").orderBy("t").collect()] == ["new", "same", "changed", "removed"]


def test_json_and_line_diffs():
    assert X.json_diff('{"a":{"b":[1,2]},"c":"x  y"}', '{"c":"x y","a":{"b":[1,3,4]}}') == [("a.b[1]", "2", "3"), ("a.b[2]", "null", "4")]
    assert X.json_equal({"a": 1, "b": "é"}, {"b": "é", "a": 1})
    chunks = X.parse_diff(X.line_diff("a\nb\nc", "a\nx\nc"))
    assert [(c["type"], c["content"]) for c in chunks[0]["changes"]] == [("normal", "a"), ("del", "b"), ("add", "x"), ("normal", "c")]


def test_schedules():
    at = datetime(2024, 2, 28, 23, 59, tzinfo=timezone.utc)
    assert X.next_run("0 0 29 2 *", at) == datetime(2024, 2, 29, tzinfo=timezone.utc)
    assert X.next_run("*/15 9-10 * * 1", at) == datetime(2024, 3, 4, 9, 0, tzinfo=timezone.utc)
    assert X.next_run("0 0 31 2 *", at) is None
    assert X.schedule_text("every 15 minutes") == "*/15 * * * *" and X.schedule_text("daily at 9:30") == "30 9 * * *"
    with pytest.raises(ValueError):
        X.schedule_text("every 7 minutes")


def test_records():
    assert records.merge_complements([{"a": 1, "b": None}, {"a": 1, "b": 2}, {"a": 2, "b": "null"}]) == [{"a": 1, "b": 2}, {"a": 2, "b": None}]
    assert not records.mergeable({"a": 1}, {"b": 1})
    single, multi = records.split_schema({"properties": {"x": {}, "y": {}}, "required": ["x"]}, ["y.z"])
    assert list(single["properties"]) == ["x"] and list(multi["properties"]) == ["y"]


def zipped(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in parts.items():
            z.writestr(name.replace("__", "/") + ".xml", body)
    return out.getvalue()


def test_office_documents(spark, tmp_path):
    w = 'xmlns:w="urn:w"'
    docx = zipped(word__document=f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:rPr><w:b/></w:rPr><w:t>bold</w:t></w:r></w:p></w:body></w:document>')
    assert files.docx_html(docx) == "<h1>Head</h1><p><strong>bold</strong></p>"
    xlsx = zipped(xl__workbook='<workbook><sheets><sheet name="S"/></sheets></workbook>', xl__worksheets__sheet1="<worksheet><sheetData><row><c><v>1</v></c></row></sheetData></worksheet>")
    assert files.xlsx_html(xlsx) == "<h2>S</h2><table><tr><td>1</td></tr></table>"
    assert files.rtf_text(rb"{\rtf1{\fonttbl x}Caf\'e9\par two}") == "Café\ntwo"
    (tmp_path / "a.docx").write_bytes(docx)
    (tmp_path / "b.docx").write_bytes(b"broken")
    got = {r.path[-6:]: r for r in files.documents(spark, str(tmp_path)).collect()}
    assert got["a.docx"].html.startswith("<h1>") and got["b.docx"].html is None and got["b.docx"].error


def test_sitemaps_robots_charsets():
    xml = '<?xml version="1.0"?><sitemapindex xmlns="http://x"><sitemap><loc> https://e.com/a.xml </loc></sitemap></sitemapindex>'
    assert files.parse_sitemap(gzip.compress(xml.encode())) == ("sitemapindex", ["https://e.com/a.xml"])
    with pytest.raises(ValueError):
        files.parse_sitemap("<html/>")
    assert not files.robots_allows("User-agent: *\nDisallow: /private/", "https://e.com/private")
    assert files.decode_page("<meta charset=latin-1>é".encode("latin-1")).endswith("é")


def test_streams(spark, tmp_path):
    from loomspan.streaming import jobs

    src = tmp_path / "in"
    spark.createDataFrame([("u", datetime(2024, 1, 1), 200, "a"), ("u", datetime(2024, 1, 2), 200, "b")], "url string, scraped_at timestamp, status_code int, markdown string").coalesce(1).write.parquet(str(src))
    stream = spark.readStream.schema("url string, scraped_at timestamp, status_code int, markdown string").parquet(str(src))
    q = jobs.change_stream(stream).writeStream.format("memory").queryName("changes").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert [r.change_status for r in spark.sql("select * from changes order by scraped_at").collect()] == ["new", "changed"]


def test_plain_pages_parse_alike():
    g = random.Random(4)
    parts = ["<p>", "</p>", "<li>", "<ul>", "</ul>", "<div class=\"a  b\">", "</div>", "<br>", "<td>", "<tr>", "<table>", "</table>", "<a href=\"x>y<z\" href=\"\">", "</a>", "<b>", "</b>", "text > 'x'\n", "\x00\"", "</stray>", "<h1 id=\"'t'\">"]
    odd = ["&amp;", "<P>", "<br/>", "<script>", "<title>", "<", "<a b=c>", "<a  b=\"c\">", "<!-- x -->", "</p >", "<x_y>", "<a b=\"c\"d=\"e\">", "<a b=\"c\" >"]

    def tree(n):
        return n if isinstance(n, str) else (n.tag, n.attrs, [tree(c) for c in n.children])

    plain = 0
    for k in range(3000):
        html = "".join(g.choice(parts if k % 2 or g.random() < 0.9 else odd) for _ in range(g.randrange(30)))
        b = H._Builder()
        b.feed(html)
        b.close()
        fast = H._plainly_parsed(html)
        plain += fast is not None
        assert tree(H.parse(html)) == tree(b.root) and (fast is None or tree(fast) == tree(b.root))
        assert k % 2 == 0 or fast is not None
    assert 1500 < plain < 3000
