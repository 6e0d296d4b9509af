"""URL algebra on columns: parse, normalise, permute, split, hash, scope. All run inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of more than one label under which names are registered.
PUBLIC_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "co.nz", "com.br", "co.in", "co.za", "com.cn", "com.mx", "github.io", "vercel.app", "herokuapp.com")
#: Path endings that name a file rather than a page.
FILE_EXTENSIONS = (".png", ".jpg", ".jpeg", ".gif", ".css", ".js", ".ico", ".svg", ".tiff", ".zip", ".exe", ".dmg", ".mp4", ".mp3", ".wav", ".pptx", ".xlsx", ".avi", ".flv", ".woff", ".ttf", ".woff2", ".webp", ".inc")

_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def scheme(url: Column) -> Column:
    return F.lower(part(url, 1))


def host(url: Column) -> Column:
    return F.lower(part(url, 2))


def port(url: Column) -> Column:
    """Empty if absent or the scheme's own."""
    p = part(url, 3)
    own = ((scheme(url) == "http") & (p == "80")) | ((scheme(url) == "https") & (p == "443"))
    return F.when(own, "").otherwise(p)


def path(url: Column) -> Column:
    p = part(url, 4)
    return F.when(p == "", "/").otherwise(p)


def query(url: Column) -> Column:
    q = part(url, 5)
    return F.when(q == "?", "").otherwise(q)


def fragment(url: Column) -> Column:
    f = part(url, 6)
    return F.when(f == "#", "").otherwise(f)


def build(scheme_: Column, host_: Column, port_: Column, path_: Column, query_: Column, fragment_: Column) -> Column:
    return F.concat(scheme_, F.lit("://"), host_, F.when(port_ == "", "").otherwise(F.concat(F.lit(":"), port_)), path_, query_, fragment_)


def route_fragment(url: Column) -> Column:
    """The fragment if a client-side route (#/ or #!/ and more), else empty."""
    f = fragment(url)
    return F.when((F.length(f) > 2) & f.rlike("^#!?/"), f).otherwise("")


def normalize(url: Column, ignore_query: bool = False) -> Column:
    return build(scheme(url), host(url), port(url), path(url), F.lit("") if ignore_query else query(url), route_fragment(url))


def bare_host(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def normalize_for_index(url: Column) -> Column:
    """https, no www., no default port, no index file, no trailing slash, no fragment but a route's."""
    p = F.regexp_replace(path(url), r"/index\.(html|php|htm|shtml|xml)$", "/")
    # what is stripped is one index file or slash; an index file leaves its folder without the slash
    p = F.regexp_replace(p, r"/$", "")
    p = F.when(p == "", "/").otherwise(p)
    prt = F.when(port(url).isin("80", "443"), "").otherwise(port(url))
    return build(F.lit("https"), bare_host(url), prt, p, query(url), route_fragment(url))


def hash_url(url: Column) -> Column:
    return F.concat(F.lit("\\x"), F.sha2(url, 256))


def splits(url: Column) -> Column:
    """Every prefix of the path, then the whole, each normalised for the index, distinct."""
    parts = F.split(path(url), "/")
    root = F.concat(F.lit("https://"), bare_host(url), F.when(port(url).isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port(url))))
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(root, F.array_join(F.slice(parts, F.lit(1), i), "/")))
    tidy = F.transform(prefixes, lambda u: normalize_for_index(u))
    return F.array_distinct(F.concat(tidy, F.array(normalize_for_index(url))))


def registrable(host_: Column) -> Column:
    """The registrable domain; null for a bare suffix or an address."""
    labels = F.split(host_, r"\.")
    n = F.size(labels)
    two = F.concat_ws(".", F.element_at(labels, -2), F.element_at(labels, -1))
    k = F.when((n >= 2) & two.isin(*PUBLIC_SUFFIXES), 3).otherwise(2)
    return F.when((n < k) | host_.rlike(r"^[0-9.]+$") | (host_ == ""), None).otherwise(F.array_join(F.slice(labels, n - k + 1, k), "."))


def domain_splits(host_: Column) -> Column:
    """The registrable domain, then one more label each; a lone www adds none."""
    labels = F.split(host_, r"\.")
    base = registrable(host_)
    k = F.size(F.split(base, r"\."))
    n = F.size(labels) - k
    grown = F.transform(F.sequence(F.lit(0), n), lambda i: F.array_join(F.slice(labels, n - i + 1, k + i), "."))
    return F.when(base.isNull(), F.array().cast("array<string>")).when((n == 1) & (labels[0] == "www"), F.array(base)).otherwise(grown)


def permutations(url: Column) -> Column:
    """All forms taken as the same page: www or not, http or https, index.html, index.php, slash, bare."""
    h = bare_host(url)
    p = path(url)
    stem = F.regexp_replace(F.regexp_replace(p, r"/index\.(html|php)$", "/"), r"/$", "")
    # a path that names an index file or ends in a slash comes down to its stem
    forms = [F.concat(stem, F.lit("/index.html")), F.concat(stem, F.lit("/index.php")), F.concat(stem, F.lit("/")), F.when(stem == "", "/").otherwise(stem)]
    tail = F.concat(query(url), fragment(url))
    prt = F.when(port(url) == "", "").otherwise(F.concat(F.lit(":"), port(url)))
    heads = F.transform(F.array(*[F.lit(f"{s}://{w}") for w in ("www.", "") for s in ("http", "https")]), lambda x: F.concat(x, h, prt))
    ends = F.transform(F.array(*forms), lambda f: F.concat(f, tail))
    return F.array_distinct(F.flatten(F.transform(heads, lambda x: F.transform(ends, lambda e: F.concat(x, e)))))


def with_protocol(url: Column) -> Column:
    return F.when(url.rlike("^https?://"), url).otherwise(F.concat(F.lit("http://"), url))


def one_protocol(url: Column) -> Column:
    """False for `http://http://…`: more than one colon before the first dot."""
    return F.size(F.split(F.substring_index(url, ".", 1), ":")) == 2


def last_two(host_: Column) -> Column:
    labels = F.split(host_, r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")


def same_domain(a: Column, b: Column) -> Column:
    """By the last two labels, not by the suffix list."""
    return last_two(host(a)) == last_two(host(b))


def for_map(url: Column, ignore_query: bool = False) -> Column:
    u = with_protocol(url)
    if ignore_query:
        u = F.substring_index(u, "?", 1)
    return F.regexp_replace(u, "/$", "")


def canonical(url: Column) -> Column:
    """Without scheme, www. and one trailing slash."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "^https?://", ""), r"^www\.", ""), "/$", "")


def depth(path_: Column) -> Column:
    return F.size(F.filter(F.split(path_, "/"), lambda s: ~s.isin("", "index.php", "index.html")))


def extension(path_: Column) -> Column:
    return F.regexp_extract(path_, r"(\.[^.]*)$", 1)


def is_file(path_: Column) -> Column:
    return extension(path_).isin(*FILE_EXTENSIONS)


def rewrite(url: Column) -> Column:
    """Export address of a shared online document; null if none."""
    docs, word = r"^https?://docs\.google\.com/", r"/d/([-\w]+)"
    gid = F.regexp_extract(url, r"[?&#]gid=(\d+)", 1)
    published = url.rlike("/(document|presentation|spreadsheets)/d/e/")

    def doc(kind):
        return F.concat(F.lit(f"https://docs.google.com/{kind}/d/"), F.regexp_extract(url, f"/{kind}{word}", 1), F.lit("/export?format=html"))

    sheet = F.concat(F.lit("https://docs.google.com/spreadsheets/d/"), F.regexp_extract(url, "/spreadsheets" + word, 1), F.lit("/gviz/tq?tqx=out:html"), F.when(gid == "", "").otherwise(F.concat(F.lit("&gid="), gid)))
    drive = F.concat(F.lit("https://drive.google.com/uc?export=download&id="), F.regexp_extract(url, "/file" + word, 1))
    return (
        F.when(published, None).when(url.rlike(docs + "document" + word), doc("document")).when(url.rlike(docs + "presentation" + word), doc("presentation"))
        .when(url.rlike(docs + "spreadsheets" + word), sheet).when(url.rlike(r"^https?://drive\.google\.com/file" + word), drive)
    )


def tracking_form(url: Column) -> Column:
    p = F.regexp_replace(path(url), "/+$", "")
    return build(scheme(url), host(url), port(url), F.when(p == "", "/").otherwise(p), query(url), F.lit(""))


def matches_domain(host_: Column, pattern: str) -> Column:
    """Equal, or below; `*.x` needs a label more."""
    name = pattern.removeprefix("*.").lower()
    below = F.endswith(host_, F.lit("." + name))
    return below if pattern.startswith("*.") else (host_ == name) | below


def resolve(base: Column, link: Column) -> Column:
    """A link against a base URL: absolute, protocol-relative, root-relative, query, fragment or relative."""
    root = F.concat(scheme(base), F.lit("://"), host(base), F.when(port(base) == "", "").otherwise(F.concat(F.lit(":"), port(base))))
    folder = F.regexp_replace(path(base), "[^/]*$", "")
    joined = F.concat(folder, link)
    # each turn takes out one `x/../`; eight levels cover what browsers meet
    tail = F.regexp_extract(joined, r"^([^?#]*)(.*)$", 2)
    p = F.regexp_replace(F.regexp_extract(joined, r"^([^?#]*)(.*)$", 1), r"/(\./)+", "/")
    for _ in range(8):
        p = F.regexp_replace(p, r"^/\.\./", "/")
        p = F.regexp_replace(p, r"/(?!\.\./)[^/]+/\.\./", "/")
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.\\-]*:"), link).when(F.startswith(link, F.lit("//")), F.concat(scheme(base), F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(root, link)).when(F.startswith(link, F.lit("?")), F.concat(root, path(base), link))
        .when(F.startswith(link, F.lit("#")), F.concat(root, path(base), query(base), link)).when(link == "", F.concat(root, path(base), query(base)))
        .otherwise(F.concat(root, p, tail))
    )
