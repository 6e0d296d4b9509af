"""Files as tables: lists of URLs, uploads, robots.txt, sitemaps, office documents."""

from __future__ import annotations

import gzip
import io
import re
import zipfile
from urllib.robotparser import RobotFileParser
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Document kinds by ending and by content type.
ENDINGS = {"odt": "odt", "rtf": "rtf", "xlsx": "xlsx", "xls": "xlsx", "doc": "doc", "docx": "docx"}
CONTENT_TYPES = {"application/vnd.oasis.opendocument.text": "odt", "application/rtf": "rtf", "text/rtf": "rtf", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx", "application/vnd.ms-excel": "xlsx", "application/msword": "doc"}


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files that are neither blank nor comments."""
    lines = spark.read.text(path).select(F.trim("value").alias("url"))
    return lines.where((F.col("url") != "") & ~F.startswith("url", F.lit("#")))


def document_type(url: Column, content_type: Column | None = None) -> Column:
    """Of an office document; docx if nothing tells."""
    path = F.lower(F.regexp_extract(url, r"^([^?#]*)", 1))
    out = F.lit("docx")
    for end, kind in ENDINGS.items():
        out = F.when(F.endswith(path, F.lit("." + end)), F.lit(kind)).otherwise(out)
    for name, kind in (CONTENT_TYPES if content_type is not None else {}).items():
        out = F.when(F.startswith(content_type, F.lit(name)), F.lit(kind)).otherwise(out)
    return out


def upload_kind(name: Column, content_type: Column) -> Column:
    n = F.lower(name)
    pdf = F.endswith(n, F.lit(".pdf")) | (content_type == "application/pdf")
    office = n.rlike(r"\.(docx?|odt|rtf|xlsx?)$") | content_type.isin(*CONTENT_TYPES)
    page = n.rlike(r"\.(html?|xhtml)$") | F.startswith(content_type, F.lit("text/html"))
    return F.when(pdf, "pdf").when(office, "document").when(page, "html")


def decode_page(content: bytes, content_type: str | None = None) -> str:
    """By the header's charset, else the page's, else UTF-8."""
    m = re.search(r"charset=([\w-]+)", content_type or "", re.I)
    charset = m[1] if m else None
    if not charset and (m := re.search(rb"<meta[^>]+charset=[\"']?([\w-]+)", content[:4096], re.I)):
        charset = m[1].decode()
    try:
        return content.decode(charset or "utf-8", "replace")
    except LookupError:
        return content.decode("utf-8", "replace")


def robots_allows(robots_txt: str, url: str, agent: str = "*") -> bool:
    """Whether robots.txt allows a URL, with and without a slash at its end."""
    p = RobotFileParser()
    p.parse(robots_txt.splitlines())
    return p.can_fetch(agent, url) and p.can_fetch(agent, url + ("" if url.endswith("/") else "/"))


def robots_sitemaps(robots_txt: Column) -> Column:
    return F.regexp_extract_all(robots_txt, F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), F.lit(1))


def parse_sitemap(content: bytes | str) -> tuple[str, list[str]]:
    """(urlset or sitemapindex, locations); gzip is seen through. ValueError for another root."""
    if isinstance(content, str):
        content = content.encode()
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    root = ElementTree.parse(io.BytesIO(content)).getroot()
    kind = root.tag.rpartition("}")[2]
    if kind not in ("urlset", "sitemapindex"):
        raise ValueError(f"no sitemap: {kind}")
    return kind, [e.text.strip() for item in root for e in item if e.tag.rpartition("}")[2] == "loc" and e.text and e.text.strip()]


def sitemap_rows(content: bytes | str | None) -> tuple[str | None, list[str], str | None]:
    """parse_sitemap with the error instead of raising it, so that one broken sitemap costs no query."""
    try:
        return (*parse_sitemap(content or ""), None)
    except (ValueError, ElementTree.ParseError, OSError, EOFError) as e:
        return None, [], f"{type(e).__name__}: {e}"


def sitemap_actions(locations: DataFrame, url: str = "url", kind: str = "kind") -> DataFrame:
    """recurse into sitemaps, process pages; files are dropped."""
    from loomspan.functions import urls as U

    p = F.lower(U.path(F.col(url)))
    deeper = (F.col(kind) == "sitemapindex") | F.endswith(p, F.lit(".xml")) | F.endswith(p, F.lit(".xml.gz"))
    return locations.withColumn("action", F.when(deeper, "recurse").when(~U.is_file(p), "process")).where("action is not null")


# office documents ---------------------------------------------------------------
def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _attr(e, name: str) -> str | None:
    return next((v for k, v in e.attrib.items() if _local(k) == name), None)


def docx_html(data: bytes) -> str:
    """Headings, paragraphs, lists, tables and emphasis of a .docx body as HTML."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml"))
        styles = ElementTree.fromstring(z.read("word/styles.xml")) if "word/styles.xml" in z.namelist() else None
    names = {}
    for s in styles.iter() if styles is not None else ():
        if _local(s.tag) == "style":
            name = next((_attr(c, "val") for c in s if _local(c.tag) == "name"), "") or ""
            level = next((_attr(c, "val") for c in s.iter() if _local(c.tag) == "outlineLvl"), None)
            names[_attr(s, "styleId")] = (name.lower(), int(level) + 1 if level is not None and level.isdigit() else None)

    def run(r):
        from html import escape

        text = "".join({"t": e.text or "", "tab": "\t", "br": "\n"}.get(_local(e.tag), "") for e in r)
        flags = {_local(e.tag) for p in r if _local(p.tag) == "rPr" for e in p if _attr(e, "val") not in ("0", "false")}
        text = escape(text, quote=False)
        for flag, tag in (("b", "strong"), ("i", "em")):
            text = f"<{tag}>{text}</{tag}>" if flag in flags and text else text
        return text

    def paragraph(p):
        text = "".join(run(r) for r in p.iter() if _local(r.tag) == "r")
        style = next((_attr(e, "val") for e in p.iter() if _local(e.tag) == "pStyle"), None)
        direct = next((_attr(e, "val") for e in p.iter() if _local(e.tag) == "outlineLvl"), None)
        name, level = names.get(style, ((style or "").lower(), None))
        if direct is not None and direct.isdigit():
            level = int(direct) + 1
        if level is None and (m := re.search(r"heading ?(\d)", name)):
            level = int(m[1])
        level = level or {"title": 1, "heading": 2}.get(name)
        if any(_local(e.tag) == "numPr" for e in p.iter()):
            return "li", text
        if level:
            return "block", f"<h{min(level, 6)}>{text}</h{min(level, 6)}>"
        return "block", f"<blockquote>{text}</blockquote>" if "quote" in name else f"<p>{text}</p>" if text else ""

    def blocks(parent):
        out, items = [], []
        for e in parent:
            kind, html = paragraph(e) if _local(e.tag) == "p" else ("block", "")
            if _local(e.tag) == "tbl":
                html = "<table>" + "".join("<tr>" + "".join(f"<td>{blocks(c)}</td>" for c in r if _local(c.tag) == "tc") + "</tr>" for r in e if _local(r.tag) == "tr") + "</table>"
            if kind == "li":
                items.append(f"<li>{html}</li>")
                continue
            if items:
                out.append("<ul>" + "".join(items) + "</ul>")
                items = []
            out.append(html)
        return "".join(out) + ("<ul>" + "".join(items) + "</ul>" if items else "")

    return blocks(body[0])


def odt_html(data: bytes) -> str:
    from html import escape

    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("content.xml"))
    body = next(e for e in root.iter() if _local(e.tag) == "text" and "office" in e.tag)

    def render(e):
        t, text = _local(e.tag), lambda: escape("".join(e.itertext()), quote=False)
        if t == "h":
            n = min(int(_attr(e, "outline-level") or 1), 6)
            return f"<h{n}>{text()}</h{n}>"
        if t == "p":
            return f"<blockquote>{text()}</blockquote>" if "quot" in (_attr(e, "style-name") or "").lower() else f"<p>{text()}</p>" if text() else ""
        if t == "list":
            return "<ul>" + "".join("<li>" + "".join(render(c) for c in i) + "</li>" for i in e) + "</ul>"
        if t == "table":
            return "<table>" + "".join("<tr>" + "".join("<td>" + "".join(render(x) for x in c) + "</td>" for c in r if _local(c.tag) == "table-cell") + "</tr>" for r in e.iter() if _local(r.tag) == "table-row") + "</table>"
        return "".join(render(c) for c in e)

    return "".join(render(e) for e in body)


def xlsx_html(data: bytes) -> str:
    """A heading and a table for each sheet."""
    from html import escape

    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = ["".join(x.text or "" for x in si.iter() if _local(x.tag) == "t") for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        sheets = [_attr(s, "name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if _local(s.tag) == "sheet"]
        out = []
        for k, name in enumerate(sheets):
            rows = []
            for r in (e for e in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{k + 1}.xml")).iter() if _local(e.tag) == "row"):
                cells = []
                for c in r:
                    v = "".join(x.text or "" for x in c.iter() if _local(x.tag) in ("v", "t"))
                    cells.append(shared[int(v)] if c.get("t") == "s" and v else v)
                rows.append("<tr>" + "".join(f"<td>{escape(v, quote=False)}</td>" for v in cells) + "</tr>")
            out.append(f"<h2>{escape(name or '')}</h2><table>{''.join(rows)}</table>")
    return "".join(out)


def rtf_text(data: bytes) -> str:
    """Text of an RTF document: groups of destinations skipped, escapes decoded as cp1252."""
    src, out, stack, skip = data.decode("latin-1"), [], [], False
    for m in re.finditer(r"\\([a-z]+)(-?\d+)? ?|\\'([0-9a-fA-F]{2})|\\([^a-z'])|([{}])|([^\\{}\r\n]+)", src):
        word, num, hexa, sign, brace, text = m.groups()
        if brace == "{":
            stack.append(skip)
        elif brace == "}":
            skip = stack.pop() if stack else False
        elif sign == "*" or word in ("fonttbl", "colortbl", "stylesheet", "info", "pict"):
            skip = True
        elif skip:
            continue
        elif word in ("par", "line", "row"):
            out.append("\n")
        elif word in ("tab", "cell"):
            out.append("\t")
        elif word == "u":
            out.append(chr(int(num) % 65536))
        elif hexa:
            out.append(bytes([int(hexa, 16)]).decode("cp1252", "replace"))
        elif sign in ("\\", "{", "}"):
            out.append(sign)
        elif text:
            out.append(text)
    return "".join(out).strip()


PARSERS = {"docx": docx_html, "odt": odt_html, "xlsx": xlsx_html, "rtf": lambda d: "<p>" + rtf_text(d).replace("\n", "</p><p>") + "</p>"}


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Office files as path, kind, html; a file that can't be parsed has null html and its error."""
    files = spark.read.format("binaryFile").load(path)

    def one(kind, content):
        try:
            return PARSERS[kind](content), None
        except Exception as e:  # of any kind: the file is foreign
            return None, f"{type(e).__name__}: {e}"[:200]

    parse = F.udf(one, "struct<html:string,error:string>", useArrow=True)
    return files.select("path", document_type(F.col("path")).alias("kind"), "content").select("path", "kind", parse("kind", "content").alias("d")).select("path", "kind", "d.*")
