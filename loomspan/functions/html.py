"""HTML to columns. One parse of a page serves all projections: links, metadata, images, text, Markdown.

The tree is built leniently, as pages in the wild need: void elements, implied
ends of p, li, td, tr and option, raw text in script and style, stray end tags
ignored. Selectors: tag, #id, .class, [attr], [attr=value], [attr*=value],
their combinations, descendants and `>`, lists by comma.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import escape, unescape
from html.parser import HTMLParser
from urllib.parse import unquote, urljoin, urlsplit

#: Elements without content; elements whose start ends an open one of the same kind.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
BLOCKS = {"p", "div", "section", "article", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "table", "tr", "pre", "blockquote", "br", "hr", "header", "footer", "nav", "main", "aside", "figure"}
#: Boilerplate selectors, and those whose presence keeps a boilerplate element.
BOILERPLATE = (
    "header", "footer", "nav", "aside", ".header", ".top", ".navbar", "#header", ".footer", ".bottom", "#footer", ".sidebar", ".side", ".aside", "#sidebar", ".modal", ".popup", "#modal", ".overlay", ".ad", ".ads", ".advert", "#ad",
    ".lang-selector", ".language", "#language-selector", ".social", ".social-media", ".social-links", "#social", ".menu", ".navigation", "#nav", ".breadcrumbs", "#breadcrumbs", ".share", "#share", ".widget", "#widget", ".cookie", "#cookie", ".fc-decoration",
)
KEPT = ("#main", ".swoogo-cols", ".swoogo-text", ".swoogo-table-div", ".swoogo-space", ".swoogo-alert", ".swoogo-sponsors", ".swoogo-title", ".swoogo-tabs", ".swoogo-logo", ".swoogo-image", ".swoogo-button", ".swoogo-agenda")
NOISE = ("head", "meta", "noscript", "style", "script")


#: Elements nested deeper are taken as siblings, as browsers do beyond some hundreds, so that no walk is too deep.
MOST_DEEP = 200


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: "Node | None" = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], parent

    def walk(self) -> Iterator["Node"]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            if n.children:
                stack.extend([c for c in reversed(n.children) if isinstance(c, Node)])

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag not in ("script", "style"):
                stack.extend(reversed(n.children))
        return "".join(out)

    def drop(self) -> None:
        if self.parent:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")
        self.depth: dict[int, int] = {id(self.root): 0}
        self.beyond: list[str] = []  # open elements below MOST_DEEP; they become children of the deepest one

    def handle_starttag(self, tag, attrs):
        if self.beyond:
            self.at.children.append(Node(tag, {k: v if v is not None else "" for k, v in attrs}, self.at))
            if tag not in VOID:
                self.beyond.append(tag)
            return
        ends = CLOSES.get(tag, set())
        if ends:
            n = self.at
            while n.tag != "#root" and n.tag not in ("ul", "ol", "table", "div", "section", "article", "select", "dl", "body"):
                if n.tag in ends:
                    self.at = n.parent
                    break
                n = n.parent
        elif tag in BLOCKS and tag != "br" and self.at.tag == "p":
            self.at = self.at.parent
        node = Node(tag, {k: v if v is not None else "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            deep = self.depth[id(self.at)] + 1
            if deep < MOST_DEEP:
                self.at, self.depth[id(node)] = node, deep
            else:
                self.beyond.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.beyond:
            while tag in self.beyond:
                if self.beyond.pop() == tag:
                    return
            return
        n = self.at
        while n.tag not in ("#root", tag):
            n = n.parent
        if n.tag == tag:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


#: Tags and texts that need no further reading: names in lower case, values in double quotes, no references.
_TOKEN = re.compile(r'<([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*="[^"&]*")*)>|</([a-z][a-z0-9]*)>|([^<&]+)')
_VALUE = re.compile(r' ([a-z][a-z0-9-]*)="([^"]*)"')
#: Elements whose content the parser may read as text.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


def _plainly_parsed(html: str) -> Node | None:
    """The tree of a page that consists of plain tokens only, as the parser gives it; None for any other."""
    b, at = _Builder(), 0
    for m in _TOKEN.finditer(html):
        tag, values, end, text = m.groups()
        if m.start() != at or tag in _RAW:
            return None
        at = m.end()
        if tag:
            b.handle_starttag(tag, _VALUE.findall(values) if values else ())
        elif end:
            b.handle_endtag(end)
        else:
            b.handle_data(text)
    return b.root if at == len(html) else None


def parse(html: str | None) -> Node:
    html = html or ""
    if (root := _plainly_parsed(html)) is not None:
        return root
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


_SIMPLE = re.compile(r"([#.]?[\w-]+|\*|\[\s*[\w:-]+\s*(?:[*^$~|]?=\s*(?:\"[^\"]*\"|'[^']*'|[^\]]*))?\s*\])")


def _matcher(simple: str):
    tests = []
    for t in _SIMPLE.findall(simple):
        if t[0] == "#":
            tests.append(lambda n, v=t[1:]: n.attrs.get("id") == v)
        elif t[0] == ".":
            tests.append(lambda n, v=t[1:]: v in n.attrs.get("class", "").split())
        elif t[0] == "[":
            m = re.match(r"\[\s*([\w:-]+)\s*(?:([*^$~|]?)=\s*[\"']?(.*?)[\"']?)?\s*\]$", t)
            name, op, value = m[1].lower(), m[2], m[3]
            if op is None:
                tests.append(lambda n, k=name: k in n.attrs)
            else:
                how = {"": str.__eq__, "*": str.__contains__, "^": str.startswith, "$": str.endswith, "~": lambda a, b: b in a.split(), "|": lambda a, b: a == b or a.startswith(b + "-")}[op]
                tests.append(lambda n, k=name, v=value, f=how: k in n.attrs and f(n.attrs[k], v))
        elif t != "*":
            tests.append(lambda n, v=t.lower(): n.tag == v)
    if not tests and simple != "*" or "".join(_SIMPLE.findall(simple)) != simple:
        raise ValueError(f"selector not understood: {simple}")
    return lambda n: n.tag != "#root" and all(t(n) for t in tests)


def select(root: Node, selector: str) -> list[Node]:
    """Nodes that fit, in document order; ValueError for a selector that isn't understood."""
    found = []
    chains = []
    for one in selector.split(","):
        steps = re.split(r"\s*(>)\s*|\s+", one.strip())
        steps = [s for s in steps if s]
        chains.append([s if s == ">" else _matcher(s) for s in steps])
    for n in root.walk():
        if any(_fits(n, c) for c in chains):
            found.append(n)
    return found


def _fits(n: Node, chain: list) -> bool:
    if not chain or not chain[-1](n):
        return False
    at, k = n.parent, len(chain) - 2
    while k >= 0:
        if chain[k] == ">":
            if at is None or not chain[k - 1](at):
                return False
            at, k = at.parent, k - 2
        else:
            while at is not None and not chain[k](at):
                at = at.parent
            if at is None:
                return False
            at, k = at.parent, k - 1
    return True


def _join(base: str, link: str) -> str | None:
    try:
        out = urljoin(base, link)
        urlsplit(out).port
        return out
    except ValueError:
        return None


def base_href(root: Node, url: str) -> str:
    for n in root.walk():
        if n.tag == "base" and "href" in n.attrs:
            return _join(url, n.attrs["href"]) or url
    return url


def raw_links(root: Node) -> list[str]:
    return [re.sub(r"^(https?):/(?=[^/])", r"\1://", n.attrs["href"]) for n in root.walk() if n.tag == "a" and "href" in n.attrs]


def links(root: Node, url: str) -> list[str]:
    """Absolute, trimmed, in order and distinct; without fragments-only links."""
    base, out = base_href(root, url), {}
    for href in raw_links(root):
        href = href.strip()
        if not href or href.startswith("#"):
            continue
        full = href if re.match(r"(https?://|mailto:)", href) else _join(base, href)
        if full:
            out[full] = None
    return list(out)


def metadata(root: Node, url: str) -> dict[str, list[str]]:
    """Lists of values by name. Repeated descriptions are joined, of titles the first counts."""
    out: dict[str, list[str]] = {}
    for n in root.walk():
        if n.tag == "title" and "title" not in out:
            out["title"] = [n.text().strip()]
        elif n.tag == "html" and n.attrs.get("lang"):
            out.setdefault("language", [n.attrs["lang"]])
        elif n.tag == "link" and "icon" in n.attrs.get("rel", "") and n.attrs.get("href") and "favicon" not in out:
            if full := _join(url, n.attrs["href"]):
                out["favicon"] = [full]
        elif n.tag == "meta":
            name, value = n.attrs.get("name") or n.attrs.get("property") or n.attrs.get("itemprop"), n.attrs.get("content")
            if name and value is not None:
                if name == "description" and name in out:
                    out[name] = [", ".join([*out[name], value])]
                elif name != "title" or name not in out:
                    out.setdefault(name, []).append(value)
    if not (out.get("title") or [""])[0]:
        first = next((out[k][0] for k in ("ogTitle", "og:title", "twitter:title") if k in out), "")
        if first:
            out["title"] = [first]
    return out


def srcset(value: str, src: str | None = None) -> list[tuple[float, str]]:
    out, only_x = [], True
    for c in value.split(","):
        p = c.split()
        if p:
            unit = p[1] if len(p) > 1 else "1x"
            only_x &= unit.endswith("x")
            try:
                out.append((float(unit[:-1]), p[0]))
            except ValueError:
                continue
    if only_x and src:
        out.append((1.0, src))
    return sorted(out, key=lambda x: -x[0])


def images(root: Node, url: str) -> list[str]:
    base, out = base_href(root, url), set()

    def add(link: str | None):
        link = (link or "").strip()
        if link and not link.lower().startswith("javascript:"):
            full = _join(url if link.startswith("//") else base, link)
            if full:
                out.add(full)

    for n in root.walk():
        a = n.attrs
        if n.tag == "img":
            add(a.get("src"))
            add(a.get("data-src"))
        if n.tag in ("img", "source"):
            for _, link in srcset(a.get("srcset", "")):
                add(link)
        if n.tag == "meta" and (a.get("property") in ("og:image", "og:image:url", "og:image:secure_url") or a.get("name") in ("twitter:image", "twitter:image:src") or a.get("itemprop") == "image"):
            add(a.get("content"))
        if n.tag == "link" and "icon" in a.get("rel", ""):
            add(a.get("href"))
        if n.tag == "video":
            add(a.get("poster"))
        for m in re.findall(r"background(?:-image)?\s*:[^;]*?url\(\s*['\"]?([^'\")]+)", a.get("style", "")):
            add(m)
    return sorted(out)


def attributes(root: Node, selector: str, name: str) -> list[str]:
    """Values of an attribute, or of data-<name>; nothing for a selector that isn't understood."""
    try:
        return [v for n in select(root, selector) if (v := n.attrs.get(name, n.attrs.get(f"data-{name}"))) is not None]
    except ValueError:
        return []


def _index(root: Node) -> dict[str, list[Node]]:
    """Nodes by tag, .class and #id, in document order: one walk for all simple selectors."""
    by: dict[str, list[Node]] = {}
    for n in root.walk():
        for key in (n.tag, f"#{n.attrs['id']}" if "id" in n.attrs else None, *(f".{c}" for c in set(n.attrs.get("class", "").split()))):
            if key:
                by.setdefault(key, []).append(n)
    return by


def frame_selector(selector: str) -> str:
    """A selector of iframes as it reads for the div that stands for an iframe."""
    return re.sub(r"(^|[\s,])iframe(?=\s|$|[.#\[:,])", r'\1div[data-original-tag="iframe"]', selector)


def _selected(root: Node, selector: str) -> list[Node]:
    """select() for selectors of a request: iframes also as divs, nothing for one that isn't understood."""
    try:
        framed = frame_selector(selector)
        return select(root, selector if framed == selector else f"{selector},{framed}")
    except ValueError:
        return []


def frame_links(root: Node, url: str, most_deep: int = 5) -> list[str]:
    """Links inside frames whose page stands in their own address (data:text/html), frames within frames too."""
    out: dict[str, None] = {}
    for n in root.walk():
        src = n.attrs.get("src", "") if n.tag == "iframe" else ""
        if src.startswith("data:text/html") and "," in src and most_deep:
            inner = parse(unquote(src.split(",")[1]))
            out |= dict.fromkeys([*links(inner, url), *frame_links(inner, url, most_deep - 1)])
    return list(out)


def without_signatures(root: Node, known: set[str]) -> Node:
    """Without the elements whose signature() is known to repeat on the site. Changes the tree."""
    # an element comes after its parent, whose own mark is known by then
    marks: dict[int, str] = {}
    for n in list(root.walk()):
        own = marks[id(n)] = _mark(n)
        if n.tag not in ("#root", "html", "body") and (f"{marks[id(n.parent)]}>{own}" if n.parent is not None else own) in known:
            n.drop()
    return root


def transform(root: Node, url: str, include: Iterable[str] = (), exclude: Iterable[str] = (), only_main: bool = True) -> Node:
    """Without noise and boilerplate, images at their largest, links absolute. Changes the tree."""
    if include := list(include):
        new = Node("#root")
        for sel in include:
            for n in _selected(root, sel):
                copy = Node(n.tag, n.attrs, new)
                copy.children = n.children
                new.children.append(copy)
        root = new
    base = base_href(root, url)
    by = _index(root)
    for sel in NOISE:
        for n in by.get(sel, ()):
            n.drop()
    for sel in exclude:
        if m := re.fullmatch(r"\*(.*)\*", sel):
            rx = re.compile(m[1], re.I)
            nodes = [n for n in root.walk() if n.tag != "#root" and (rx.search(n.tag) or any(rx.search(f'{k}="{v}"') for k, v in n.attrs.items()))]
        else:
            nodes = _selected(root, sel)
        for n in nodes:
            n.drop()
    if only_main:
        kept = {id(n) for sel in KEPT for n in by.get(sel, ())}
        for sel in BOILERPLATE:
            for n in by.get(sel, ()):
                if not (kept and any(id(x) in kept and x is not n for x in n.walk())):
                    n.drop()
    for n in root.walk():
        if n.tag == "img":
            best = srcset(n.attrs.get("srcset", ""), n.attrs.get("src")) if n.attrs.get("srcset") else []
            if best:
                n.attrs["src"] = best[0][1]
            if n.attrs.get("src"):
                n.attrs["src"] = _join(base, n.attrs["src"]) or n.attrs["src"]
        elif n.tag == "a" and n.attrs.get("href"):
            n.attrs["href"] = _join(base, n.attrs["href"]) or n.attrs["href"]
    return root


def render(node: Node | str) -> str:
    out, stack = [], [node]
    while stack:
        n = stack.pop()
        if isinstance(n, tuple):
            out.append(n[0])
        elif isinstance(n, str):
            out.append(escape(n, quote=False))
        else:
            if n.tag != "#root":
                out.append(f"<{n.tag}" + "".join(f' {k}="{escape(v)}"' for k, v in n.attrs.items()) + ">")
                if n.tag not in VOID:
                    stack.append((f"</{n.tag}>",))
            if n.tag not in VOID:
                stack.extend(reversed(n.children))
    return "".join(out)


def inner_text(root: Node) -> str:
    body = next((n for n in root.walk() if n.tag == "body"), root)
    return body.text()


def signature(node: Node) -> str:
    """What marks a repeated element of a site: its tag, id and classes, and those of its parent."""
    return _mark(node) if node.parent is None else f"{_mark(node.parent)}>{_mark(node)}"


def _mark(n: Node) -> str:
    return f"{n.tag}#{n.attrs.get('id', '')}.{'.'.join(sorted(n.attrs.get('class', '').split()))}" if n.attrs else f"{n.tag}#."


def _inline(node: Node | str) -> str:
    if isinstance(node, str):
        return re.sub(r"\s+", " ", node)
    inner = "".join(_inline(c) for c in node.children)
    t, s = node.tag, inner.strip()
    if t in ("strong", "b") and s:
        return f"**{s}**"
    if t in ("em", "i") and s:
        return f"*{s}*"
    if t == "code" and s:
        return f"`{s}`"
    if t == "br":
        return "\n"
    if t == "img":
        return f"![{node.attrs.get('alt', '')}]({node.attrs['src']})" if node.attrs.get("src") else ""
    if t == "a" and node.attrs.get("href"):
        return f"[{s}]({node.attrs['href']})"
    return "" if t in ("script", "style", "head") else inner


_APART = BLOCKS - {"br"} | {"html", "body", "#root", "form", "dl", "tbody", "thead", "head", "script", "style", "figcaption", "center"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def _blocks(node: Node, depth: int = 0) -> Iterator[str]:
    run: list[str] = []

    def flush():
        text = "".join(run).strip()
        run.clear()
        return [re.sub(r" *\n *", "\n", text)] if text else []

    for c in node.children:
        if isinstance(c, str) or c.tag not in _APART:
            run.append(_inline(c))
            continue
        yield from flush()
        if c.tag in ("head", "script", "style"):
            continue
        if c.tag in _HEADINGS:
            if text := "".join(_inline(x) for x in c.children).strip():
                yield "#" * int(c.tag[1]) + " " + re.sub(r"\s+", " ", text)
        elif c.tag == "pre":
            lang = next((m[1] for n in c.walk() if (m := re.search(r"(?:language|lang)-([\w+-]+)", n.attrs.get("class", "")))), "")
            yield f"```{lang}\n{c.text().strip(chr(10))}\n```"
        elif c.tag == "blockquote":
            yield "\n".join(f"> {x}" if x else ">" for x in "\n\n".join(_blocks(c, depth)).split("\n"))
        elif c.tag in ("ul", "ol"):
            rows = []
            for k, li in enumerate([x for x in c.children if isinstance(x, Node) and x.tag == "li"]):
                mark = f"{k + 1}. " if c.tag == "ol" else "- "
                rows.append(mark + "\n".join(_blocks(li, depth + 1)).replace("\n", "\n" + " " * len(mark)))
            yield "\n".join(rows)
        elif c.tag == "table":
            rows = [[re.sub(r"\s+", " ", "".join(_inline(y) for y in x.children)).strip().replace("|", "\\|") for x in tr.children if isinstance(x, Node) and x.tag in ("td", "th")] for tr in c.walk() if tr.tag == "tr"]
            rows = [r for r in rows if r]
            if rows:
                width = max(map(len, rows))
                rows = [r + [""] * (width - len(r)) for r in rows]
                yield "\n".join("| " + " | ".join(r) + " |" for r in [rows[0], ["---"] * width, *rows[1:]])
        elif c.tag == "hr":
            yield "---"
        else:
            yield from _blocks(c, depth)
    yield from flush()


def tidy_markdown(md: str) -> str:
    """Line feeds inside link texts escaped, skip links removed."""
    out, deep = [], 0
    if "[" not in md:
        return md
    for ch in md:
        deep = deep + (ch == "[") - (ch == "]" and deep > 0)
        out.append("\\\n" if ch == "\n" and deep else ch)
    return re.sub(r"(?i)\[Skip to Content\]\(#[^)]*\)", "", "".join(out))


def markdown(root: Node) -> str:
    return tidy_markdown("\n\n".join(_blocks(root)))


def sentences(md: str) -> list[tuple[str, str, int, bool]]:
    """(text, kind, block, header) of headings, sentences, table rows and lines of code."""
    out, block, code, table = [], 0, False, False
    para: list[str] = []

    def flush():
        nonlocal block
        if para:
            for s in re.split(r"(?<=[.!?])\s+", " ".join(para)):
                if s.strip():
                    out.append((unescape(s.strip()), "text", block, False))
            para.clear()
            block += 1

    for line in md.split("\n"):
        if line.startswith("```"):
            flush()
            block += code
            code = not code
        elif code:
            out.append((line, "code", block, False))
        elif re.match(r"#{1,6} ", line):
            flush()
            out.append((unescape(line.lstrip("# ").strip()), "heading", block, True))
            block += 1
        elif line.strip().startswith("|"):
            flush()
            cells = [c.strip() for c in line.strip().strip("|").split("|")]
            if not all(re.fullmatch(r":?-+:?", c) for c in cells):
                out.append((unescape(" | ".join(cells)), "table", block, not table))
            table = True
            continue
        elif line.strip():
            para.append(line.strip())
        else:
            flush()
        block += table
        table = False
    flush()
    return out


def assemble(rows: list[tuple[str, str, int, bool]], chosen: Iterable[int]) -> str:
    """Chosen sentences in order; a table row brings its header, code lines are fenced again."""
    want = set(chosen)
    for k in list(want):
        if rows[k][1] == "table":
            want |= {j for j, r in enumerate(rows) if r[1] == "table" and r[2] == rows[k][2] and r[3]}
    out, last = [], None
    for k in sorted(want):
        text, kind, block, header = rows[k]
        if kind == "code":
            if last == ("code", block):
                out[-1] = out[-1][:-4] + "\n" + text + "\n```"
            else:
                out.append(f"```\n{text}\n```")
        elif kind == "table":
            line = f"| {text} |" + ("\n| " + " | ".join(["---"] * len(text.split(" | "))) + " |" if header else "")
            if last == ("table", block):
                out[-1] += "\n" + line
            else:
                out.append(line)
        else:
            out.append(("## " if kind == "heading" else "") + text)
        last = (kind, block)
    return "\n\n".join(out)
