"""Operators of the service against expected values written by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomspan.functions import html as H
from loomspan.functions import schema as J
from loomspan.functions import text as X
from loomspan.operators import brand, crawl, doc_quality, queues, robots, sinks, tallies
from loomspan.operators import snapshots as S
from loomspan.operators.link_filter import Scope, blocked
from loomspan.operators.page_columns import page_columns
from loomspan.sources import files


def value(spark, column, **given):
    return spark.createDataFrame([tuple(given.values())], list(given)).select(column.alias("v")).first().v


@pytest.mark.parametrize("a,b,want", [("1 2 aaaa", "1 2", "good"), ("xxxxxxxxxxxxxxxxx 1", "x", "poor"), ("x", "xxxxxx", "poor"), ("", "", "good"), ("12345 1 2 3", "12345 1 2 3 4", "acceptable")])
def test_output_grades(spark, a, b, want):
    assert value(spark, X.compare_outputs(F.col("a"), F.col("b")), a=a, b=b).grade == want


def test_table_count_takes_one_column_and_one_dash(spark):
    assert value(spark, X.table_count(F.col("t")), t="| a |\n|-|\n| 1 |\n\n|---\n|:--|--:|\n") == 2


def test_removed_pages_keep_what_was_seen(spark):
    kind = "url string, first_seen string, last_seen string, last_changed string, status string, is_removed boolean, removed_at timestamp"
    state = spark.createDataFrame([("a", "c0", "c1", "c0", "same", False, None), ("b", "c0", "c1", "c1", "removed", True, datetime(2024, 1, 1)), ("z", "c0", "c1", "c0", "same", False, None)], kind)
    seen = spark.createDataFrame([("a", "removed"), ("b", "same"), ("n", "new"), ("r", "removed"), ("e", "error")], "url string, status string")
    got = {r.url: r for r in S.upsert_pages(state, seen, "c2", F.lit(datetime(2024, 2, 2))).collect()}
    assert (got["a"].last_seen, got["a"].last_changed, got["a"].is_removed, got["a"].removed_at) == ("c1", "c0", True, datetime(2024, 2, 2))
    assert (got["b"].last_seen, got["b"].last_changed, got["b"].is_removed, got["b"].removed_at) == ("c2", "c1", False, None)
    assert (got["n"].first_seen, got["n"].last_seen, got["n"].last_changed) == ("c2", "c2", "c2")
    assert (got["r"].last_seen, got["r"].last_changed, got["r"].is_removed) == (None, None, True) and got["e"].last_changed is None and got["z"].last_seen == "c1"


def test_engine_verdict_counts_what_can_be_compared(spark):
    rows = [("a", "full text", None, "full text", None)] * 3 + [("a", None, None, "x", None)] + [("b", None, "", "x", None)] + [("c", "text", None, None, None), ("c", "text", None, "text", None)]
    r = spark.createDataFrame(rows, "site string, browser string, browser_stealth string, light string, light_stealth string")
    got = {x.site: x for x in tallies.engine_verdict(r, "site").collect()}
    assert (got["a"].verdict, got["a"].failed, got["b"].verdict, got["c"].verdict, got["c"].insufficient) == ("TlsClientOk", 1, "Uncertain", "ChromeCdpRequired", 1)


@pytest.mark.parametrize("values,want", [([4.0, 9.0, 15.0, 24.0, 31.0], 4), ([6.0, 13.0, 18.0, 12.0], 6), ([6.4, 6.0, 18.0], 6), ([2.0, 2.0, 2.0], 2), ([300.0, -1.0], 8), ([22.0] * 3, 12), ([14.0, 14.2, 26.0], 12)])
def test_spacing_unit(spark, values, want):
    assert value(spark, brand.spacing_unit(F.col("v")), v=values) == want


def test_logo_of_a_page(spark):
    cols = "page string, idx int, src string, alt string, location string, top int, left int, width int, height int, visible boolean, href string, home_link boolean, in_header boolean, alt_match boolean, src_match boolean, class_match boolean, is_svg boolean, brand string"
    rows = [
        ("p", 0, "/i/logo.png?1", "Acme", "footer", 900, 10, 120, 40, True, "/", True, False, True, True, False, False, "Acme"),
        ("p", 1, "/x/logo.png", "", "header", 10, 10, 120, 40, True, "/", True, True, True, True, True, False, "Acme"),  # the same file as the first
        ("p", 2, "/i/partner.png", "Partner", "body", 400, 600, 60, 60, True, "", False, False, False, False, False, False, "Acme"),
        ("q", 0, "/a.png", "", "body", 500, 500, 20, 20, False, None, False, False, False, False, False, False, "Acme"),
    ]
    got = {r.page: r for r in brand.pick_logo(spark.createDataFrame(rows, cols), brand="brand").collect()}
    # one image in two places (15 + 8), home link in header 50, header 20, visible 15, top left 10, highest 12, marks 8 + 5 + 5, fair size 5
    assert (got["p"].idx, got["p"].score, got["p"].confidence) == (1, 153, 0.9)
    assert (got["q"].score, got["q"].confidence) == (-15 - 25 - 8 - 12 - 10, 0.4)


def test_document_quality_warnings(spark):
    page = "a page with quite some text that is long enough to count as a page of a document, one may hope so"
    docs = [(1, "\f".join([page] * 3), None), (2, "\f" * 9 + "x", None), (3, "Downloaded from Wiley Online Library", None), (4, "", None), (5, "one page only", 6), (6, None, None)]
    got = {r.id: r for r in doc_quality.judge(spark.createDataFrame(docs, "id int, text string, expected int"), "\f", "id", expected="expected").collect()}
    assert got[1].warnings == ["repeated_text_dominates", "repeated_pages_detected"] and got[1].low_quality
    assert got[2].warnings == ["most_pages_empty", "very_low_text_density"] and got[2].pages == 10
    assert got[3].families == ["wiley"] and got[3].warnings == ["publisher_boilerplate_dominates"] and got[4].pages == 0 and got[4].empty_page_ratio == 1.0
    assert got[5].pages == 1 and got[5].warnings == [] and got[6].total_chars == 0
    flags = doc_quality.page_flags(spark.createDataFrame(docs, "id int, text string, expected int"), "\f", "id").where("id = 2").orderBy("page").collect()
    assert flags[0].flags == ["empty"] and flags[-1].flags == ["low_text"]


def test_blocklist_keywords(spark):
    def asked(url, *keywords, **more):
        return value(spark, blocked(F.col("u"), ("shop.com", "x.org"), keywords, **more), u=url)

    assert asked("https://a.shop.com/") and asked("https://shop.net/") and not asked("https://other.com/") and not asked("https://x.net")
    assert not asked("https://shop.com/Docs", "regex:/docs") and asked("https://shop.com/Docs", "/docs/") and not asked("https://shop.com/Docs", "/docs/i")
    assert asked("https://shop.com/", "regex:(") and not asked("https://shop.com/", unblocked=("shop.com",)) and not asked("not a url")


def test_robots_groups(spark):
    text = "User-agent: *\nDisallow: /\n\nUser-agent: a\nUser-agent: B\nAllow: /ok\nDisallow: /ok/no\nDisallow: /*.pdf$\n"
    held = spark.createDataFrame([("e.com", text), ("free.com", ""), ("null.com", None)], "host string, robots_txt string")
    urls = spark.createDataFrame([(u,) for u in ("https://e.com/ok", "https://e.com/ok/no", "https://e.com/x.pdf", "https://e.com/x.pdf?y", "https://free.com/", "https://null.com/", "https://else.com/")], "url string")
    for agents, want in (((), [False] * 4 + [True] * 3), (("b",), [True, False, False, True, True, True, True])):
        got = {r.url: r.robots_allowed for r in robots.with_robots(urls, robots.rules(held, agents)).collect()}
        assert [got[r.url] for r in urls.collect()] == want


def test_schemas():
    s = {"type": "object", "properties": {"a": {"type": "array", "items": {"type": "object", "properties": {"n": {"type": "string", "minLength": 1}}}}}, "default": {}}
    assert J.strict(J.without_keywords(s))["properties"]["a"]["items"] == {"type": "object", "properties": {"n": {"type": "string"}}, "required": ["n"], "additionalProperties": False}
    assert J.is_recursive({"properties": {"x": {"$ref": "#/$defs/y"}}}) and not J.is_recursive(s)
    assert J.gather(s, [{"a": [{"n": "x"}, {"n": 1}]}, None, {"a": [{"n": "x"}, {"n": "y"}]}, {"a": None}]) == {"a": [{"n": "x"}, {"n": "y"}]}
    assert J.gather({"properties": {"x": {"type": "object"}}}, [{"x": {"a": 1}}, {"x": {"b": 2}, "y": 0}]) == {"x": {"a": 1, "b": 2}, "y": 0}
    nested = {"properties": {"c": {"type": "object", "properties": {"name": {"type": "string"}, "l": {"type": "array", "items": {"type": "object", "properties": {"v": {"type": "number"}}}}}}}}
    assert J.gather(nested, [{"c": {"name": "N", "l": [{"v": 1}]}}, {"c": {"name": "M", "l": [{"v": 1}, {"v": 2}]}}]) == {"c": {"l": [{"v": 1}, {"v": 2}], "name": "N"}}
    assert J.gather({}, [{"a": 1}]) == {}


def test_deep_pages(spark):
    deep = "<div>" * 50_000 + "<p>in <b>deep</b></p>" + "</div>" * 50_000 + "<p>after</p>"
    got = page_columns(spark.createDataFrame([(1, "https://e.com", deep)], "id int, url string, html string"), "markdown", "html", "text", exclude=["p:first-child", "nav"]).first()
    assert "deep" in got.markdown and got.markdown.endswith("after") and got.html.count("<div>") == 50_000
    assert H.markdown(H.parse("<div><p>a</p></div><p>b</p>")) == "a\n\nb"


def test_frames_and_signatures():
    root = H.parse('<iframe src="data:text/html,%3Ca href=%22/a%22%3E%3C/a%3E"></iframe><iframe class="x"></iframe><p class="ad">x</p><p>y</p>')
    assert H.frame_links(root, "https://e.com/") == ["https://e.com/a"]
    assert H.frame_selector("iframe, p iframe.x,iframes") == 'div[data-original-tag="iframe"], p div[data-original-tag="iframe"].x,iframes'
    known = {H.signature(n) for n in H.select(root, ".ad")}
    assert H.markdown(H.without_signatures(root, known)) == "y"


def test_broken_sitemaps():
    assert files.sitemap_rows("<urlset><url><loc>https://e.com/a</loc></url></urlset>") == ("urlset", ["https://e.com/a"], None)
    for bad in ("<urlset><url>", "", None, b"\x1f\x8bxx", "<html/>"):
        kind, urls, error = files.sitemap_rows(bad)
        assert kind is None and urls == [] and error


def test_sitemaps_within_sitemaps(spark):
    rows = [("https://e.com/a.xml", "<sitemapindex><sitemap><loc>https://e.com/b.xml</loc></sitemap><sitemap><loc>https://e.com/a.xml</loc></sitemap></sitemapindex>"), ("https://e.com/b.xml", "<urlset><url><loc>https://e.com/1</loc></url><url><loc>https://e.com/c.xml</loc></url></urlset>"), ("https://e.com/c.xml", "<broken")]
    got = crawl.sitemap_pages(spark.createDataFrame([("https://e.com/a.xml",)], "url string"), spark.createDataFrame(rows, "url string, content string")).collect()
    assert [(r.url, r.sitemap, r.round) for r in got] == [("https://e.com/1", "https://e.com/b.xml", 1)]
    assert crawl.sitemap_pages(spark.createDataFrame([], "url string"), spark.createDataFrame(rows, "url string, content string")).count() == 0


def test_redirects(spark):
    moved = spark.createDataFrame([("https://e.com/a", "https://e.com/t", 2), ("https://e.com/b", "https://www.e.com/t/", 1), ("https://e.com/c", "https://e.com/c/index.html", 3), ("https://e.com/d", "https://o.com/", 4), ("https://e.com/f", "https://e.com/seen", 5)], "source_url string, url string, at int")
    seen = crawl.canonical(spark.createDataFrame([("http://e.com/seen",)], "url string"), "key", F.col("url"))
    got = {r.source_url[-1]: r.action for r in crawl.reconciled(moved, seen, Scope("https://e.com/", "https://e.com/")).collect()}
    assert got == {"a": "raced", "b": "locked", "c": "same", "d": "denied", "f": "raced"}


def test_leases_expire_and_renew(spark):
    t = [datetime(2024, 1, 1, 0, 0, s) for s in range(60)]
    held = spark.createDataFrame([("x", "old", t[5]), ("x", "live", t[40]), ("x", "idle", t[45])], "team_id string, holder_id string, renewed_at timestamp")
    asked = spark.createDataFrame([("x", "live", 3, t[50]), ("x", "old", 3, t[51]), ("x", "late", 3, t[52])], "team_id string, holder_id string, limit int, asked_at timestamp")
    got = {r.holder_id: r for r in queues.leases(held, asked, F.lit(t[55])).collect()}
    assert got["live"].renewed_at == t[55] and got["idle"].renewed_at == t[45] and got["old"].granted and not got["late"].granted and got["late"].renewed_at is None


def test_facts_hide_private_jobs(spark, tmp_path):
    rows = [("preview_1", "https://e.com/\0x", "o", "c", True), ("team", "https://e.com/y", "o\0", "c", None)]
    f = sinks.fact_rows(spark.createDataFrame(rows, "team_id string, url string, options string, content string, zero_data_retention boolean")).collect()
    assert (f[0].url, f[0].team_id, f[0].options, f[0].content) == (sinks.REDACTED, "preview", None, None) and (f[1].url, f[1].options) == ("https://e.com/y", "o")
    blobs = sinks.result_blobs(spark.createDataFrame([("map", 1, "a")], "kind string, job_id long, v string"))
    sinks.write_blobs(blobs, str(tmp_path / "b"))
    assert spark.read.json(str(tmp_path / "b")).first().body == '{"v":"a"}'


def test_page_diff_modes(spark):
    kind = "id int, previous_id int, was_removed boolean, markdown string, previous_markdown string, json map<string,string>, previous_json map<string,string>"
    rows = [(1, None, None, "a", None, {"k": "1"}, None), (2, 1, True, "a", "a", {}, {}), (3, 1, False, "", "", {"k": "1"}, {"k": "1"}), (4, 1, False, None, "a", None, {"k": "1"}), (5, 1, False, "b", "a", {"k": "1"}, {"k": "1"}), (6, 1, False, "a", "a", {"k": "2"}, {"k": "1"}), (7, 1, False, "", "a", {"k": "1"}, {"k": "1"})]
    pages = spark.createDataFrame(rows, kind)

    def status(*modes):
        return [r.diff_status for r in S.page_diff(pages, modes).orderBy("id").collect()]

    assert status("git-diff") == ["new", "new", "same", "changed", "changed", "same", "changed"]
    assert status("json") == ["new", "new", "same", "changed", "same", "changed", "same"]
    assert status("json", "git-diff") == ["new", "new", "same", "changed", "changed", "changed", "same"]
