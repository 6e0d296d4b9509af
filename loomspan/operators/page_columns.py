"""Columns of raw pages: each page is parsed once per projection set, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import html as H
from loomspan.operators.crawl import checkpointed

LISTS = {"links": "array<string>", "images": "array<string>"}
KINDS = {"frame_links": "array<string>", "signatures": "array<string>", "title": "string", "language": "string", "base_url": "string", "links": "array<string>", "images": "array<string>", "metadata": "map<string,array<string>>", "text": "string", "html": "string", "markdown": "string"}
ARROW = {"array<string>": pa.list_(pa.string()), "map<string,array<string>>": pa.map_(pa.string(), pa.list_(pa.string())), "string": pa.string()}


def _one(html: str | None, url: str, wanted: list[str], options: dict, repeated: list[str] | None = None) -> dict:
    root, out = H.parse(html), {}
    meta = H.metadata(root, url) if {"title", "language", "metadata"} & set(wanted) else {}
    out["metadata"] = list(meta.items())
    out["title"], out["language"] = (meta.get("title") or [None])[0], (meta.get("language") or [None])[0]
    if "base_url" in wanted:
        out["base_url"] = H.base_href(root, url)
    if "links" in wanted:
        out["links"] = H.links(root, url)
    if "images" in wanted:
        out["images"] = H.images(root, url)
    if "frame_links" in wanted:
        out["frame_links"] = H.frame_links(root, url)
    if "signatures" in wanted:
        out["signatures"] = sorted({H.signature(n) for n in root.walk() if n.tag not in ("#root", "html", "head", "body") and n.attrs.get("id", n.attrs.get("class"))})
    if repeated:
        H.without_signatures(root, set(repeated))
    if "text" in wanted:
        out["text"] = H.inner_text(root)
    if {"html", "markdown"} & set(wanted):
        main = H.transform(root, url, **options)
        out["html"] = H.render(main) if "html" in wanted else None
        out["markdown"] = H.markdown(main) if "markdown" in wanted else None
        if out["markdown"] is not None and not out["markdown"].strip() and options.get("only_main", True):
            full = H.transform(H.parse(html), url, **{**options, "only_main": False})
            out["markdown"] = H.markdown(full)
    return out


def page_columns(pages: DataFrame, *wanted: str, url: str = "url", html: str = "html", repeated: str | None = None, **options) -> DataFrame:
    """The columns of pages but the HTML, and the wanted ones of KINDS.

    options: include, exclude (selectors), only_main. Empty main content falls
    back to the whole page. A null page gives empty columns. repeated: a column
    with the signatures of elements that repeat on the site; text, HTML and
    Markdown are without them.
    """
    bounded(pages.sparkSession)
    wanted = list(wanted) or list(KINDS)
    own = [c for c in pages.columns if c not in (html, repeated) and c not in wanted]
    u = own.index(url)
    # the last columns are the page itself and the site's signatures, and go no further
    known = F.col(repeated) if repeated else F.lit(None).cast("array<string>")
    src = pages.select(*own, F.col(html).alias("__html"), known.alias("__repeated"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_one(h, a or "", wanted, options, r) for h, a, r in zip(b.column(len(own)).to_pylist(), b.column(u).to_pylist(), b.column(len(own) + 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *[pa.array([r[w] for r in rows], ARROW[KINDS[w]]) for w in wanted]], [*own, *wanted])

    schema = ", ".join([f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in own] + [f"{w} {KINDS[w]}" for w in wanted])
    return src.mapInArrow(run, schema)


def bounded(spark, size: str = "16m") -> None:
    """Batches of pages are bounded by their bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def repeated_signatures(pages: DataFrame, site: str = "site", least: int = 2, share: float = 0.5) -> DataFrame:
    """site, repeated: signatures on at least `least` pages of a site and on that share of them. pages: site, signatures.

    Pages are read once: each counts for its signatures, and as a page under null.
    """
    marks = F.coalesce(F.array_distinct(F.array_compact("signatures")), F.array().cast("array<string>"))
    seen = pages.where(F.col(site).isNotNull()).select(site, F.explode(F.concat(F.array(F.lit(None).cast("string")), marks)).alias("s")).groupBy(site, "s").agg(F.count("*").alias("__n"))
    of_site = F.max(F.when(F.col("s").isNull(), F.col("__n"))).over(Window.partitionBy(site))
    some = seen.where(F.col("s").isNull() | (F.col("__n") >= least)).withColumn("__pages", of_site)
    return some.where(F.col("s").isNotNull() & (F.col("__n") >= share * F.col("__pages"))).groupBy(site).agg(F.sort_array(F.collect_list("s")).alias("repeated"))


def with_repeated(pages: DataFrame, known: DataFrame, site: str = "site", most: int = 100_000) -> DataFrame:
    """pages with what repeated_signatures found on their site.

    What was found is kept, so that pages are not read again for it. Up to
    `most` signatures in all it is a broadcast: pages of one large site stay
    where they are; beyond, the join is shuffled.
    """
    known = checkpointed(known)
    small = (known.agg(F.sum(F.size("repeated") + 1).alias("n")).first().n or 0) <= most
    return pages.join(F.broadcast(known) if small else known, site, "left")


def spread(rows: DataFrame, at_once: int = 20_000) -> DataFrame:
    """Rows over tasks of about `at_once` rows: a small file of rows that each become a page is a task or two as it is read."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // at_once)))


def links_fast(html: Column) -> Column:
    """Raw hrefs of well-formed anchors without a parse, inside code generation."""
    return F.regexp_extract_all(html, F.lit(r'<a[^>]*\shref="([^"]*)"'), F.lit(1))


def language_fast(html: Column) -> Column:
    """The lang of a well-formed html tag without a parse; null if none."""
    return F.nullif(F.regexp_extract(html, r'<html[^>]*[\t\n\f\r ]lang="([^"]*)"', 1), F.lit(""))


def title_fast(html: Column) -> Column:
    """The first plain title without a parse: only &lt;, &gt; and &amp; are decoded, only space separators are trimmed; empty if none."""
    out = F.regexp_replace(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1), r"\A\p{Zs}+|\p{Zs}+\z", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def without_base64_images(md: Column) -> Column:
    return F.regexp_replace(md, r"(!\[.*?\])\(data:image/.*?;base64,.*?\)", "$1(<Base64-Image-Removed>)")


def without_skip_links(md: Column) -> Column:
    return F.regexp_replace(md, r"(?i)\[Skip to Content\]\(#[^)]*\)", "")


def json_as_markdown(body: Column, content_type: Column, md: Column) -> Column:
    return F.when(F.contains(content_type, F.lit("application/json")), F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(md)


def header_chunk(html: Column, size: int = 5500) -> Column:
    """The start of the page's header, without comments, scripts and styles, white space collapsed."""
    t = F.regexp_replace(F.regexp_replace(html, r"(?s)<!--.*?-->", ""), r"(?is)<(script|style)\b.*?</\1>", "")
    low = F.lower(t)
    marks = [F.nullif(F.instr(low, m), F.lit(0)) for m in ("<header", "<nav", "<body")]
    return F.trim(F.regexp_replace(F.substring(t, F.coalesce(F.least(*marks), F.lit(1)), F.lit(size)), r"\s+", " "))
