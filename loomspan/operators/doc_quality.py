"""Whether the text of a rendered document is worth keeping: empty, repeated and boilerplate parts by page and line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Terms by family of publisher boilerplate, of which two in a line tell the family.
FAMILIES = {
    "wiley": ["wiley online library", "onlinelibrary.wiley.com", "downloaded from", "terms and conditions"],
    "oup": ["academic.oup.com", "oxford university press", "downloaded from", "authorized users"],
    "elsevier_sciencedirect": ["sciencedirect", "elsevier", "all rights reserved"],
    "springer": ["springer nature", "link.springer.com", "springerlink"],
    "taylor_francis": ["taylor & francis", "tandfonline.com", "routledge"],
    "jstor": ["jstor", "stable url", "terms and conditions of use"],
    "ssrn": ["ssrn", "electronic copy available", "papers.ssrn.com"],
    "generic_license": ["for personal use only", "all use subject to", "copyright", "license"],
}
#: What the warnings are called, and the bounds beyond which they are given.
MOST_EMPTY, REPEATED_TEXT, PUBLISHER, REPEATED_PAGES, THIN = "most_pages_empty", "repeated_text_dominates", "publisher_boilerplate_dominates", "repeated_pages_detected", "very_low_text_density"
BOUNDS = {MOST_EMPTY: 0.8, REPEATED_TEXT: 0.5, PUBLISHER: 0.45, REPEATED_PAGES: 0.25, THIN: 200}
LINE_ENDS = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def normal_line(text: Column) -> Column:
    """Lower case, without URLs, dates and all but letters, digits and single spaces."""
    out = F.lower(text)
    for pattern, by in ((r"https?://\S+", ""), (r"\d{1,4}[-/:]\d{1,2}[-/:]\d{1,4}", ""), (r"\s+", " "), (r"[^a-z0-9 ]+", "")):
        out = F.regexp_replace(out, pattern, by)
    return F.trim(out)


def families_in(normal: Column) -> Column:
    """The families of which a normalised text holds two terms or more."""
    hits = [F.when(sum((F.contains(normal, F.lit(t)).cast("int") for t in terms), F.lit(0)) >= 2, F.lit(name)) for name, terms in FAMILIES.items()]
    return F.array_compact(F.array(*hits))


def pages_of(text: Column, marker: str, expected: Column) -> Column:
    """Stripped pages between markers, filled with empty ones up to the expected number; without a marker the whole text is one page."""
    parts = F.transform(F.split(text, "\\Q" + marker + "\\E"), lambda p: stripped(p))
    short = F.greatest(F.coalesce(expected, F.lit(0)) - F.size(parts), F.lit(0))
    marked = F.concat(parts, F.array_repeat(F.lit(""), short.cast("int")))
    whole = F.when(stripped(text) == "", F.array().cast("array<string>")).otherwise(F.array(stripped(text)))
    return F.when(F.contains(text, F.lit(marker)), marked).otherwise(whole)


def page_flags(docs: DataFrame, marker: str, key: str, text: str = "text", expected: str | None = None) -> DataFrame:
    """A row for each page: its number, characters, words, flags and boilerplate families (of its first 4,000 characters)."""
    known = F.col(expected) if expected else F.lit(None).cast("int")
    p = docs.select(key, F.posexplode(pages_of(F.coalesce(text, F.lit("")), marker, known)).alias("at", "page"))
    words = F.size(F.array_remove(F.split("page", r"\s+"), ""))
    found = families_in(normal_line(F.substring("page", 1, 4000)))
    p = p.select(key, (F.col("at") + 1).alias("page"), F.length("page").alias("chars"), words.alias("words"), found.alias("families"))
    flag = F.array_compact(F.array(F.when(F.col("chars") == 0, "empty").when(F.col("words") < 25, "low_text"), F.when(F.size("families") > 0, "publisher_boilerplate")))
    return p.withColumn("flags", flag)


def judge(docs: DataFrame, marker: str, key: str, text: str = "text", expected: str | None = None) -> DataFrame:
    """Ratios, warnings and low_quality by document. Lines and pages are counted as rows, so a document of any length is no single value."""
    known = F.col(expected).cast("int") if expected else F.lit(None).cast("int")
    d = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias("t"), known.alias("expected"))
    shape = d.select(key, "expected", F.length(stripped(F.col("t"))).alias("total_chars"), F.transform(pages_of(F.col("t"), marker, F.col("expected")), lambda p: F.length(p)).alias("sizes"))
    shape = shape.select(key, "expected", "total_chars", F.size("sizes").alias("pages"), F.size(F.filter("sizes", lambda n: n == 0)).alias("empty_pages"))

    lines = d.select(key, F.explode(F.split("t", LINE_ENDS)).alias("line")).select(key, stripped(F.col("line")).alias("line")).where("line <> ''")
    lines = lines.select(key, F.length("line").alias("chars"), normal_line(F.col("line")).alias("normal"))
    lines = lines.groupBy(key, "normal").agg(F.count("*").alias("times"), F.sum("chars").alias("chars")).withColumn("families", families_in(F.col("normal")))
    repeated = (F.length("normal") >= 30) & (F.col("times") > 1)
    by_line = lines.groupBy(key).agg(
        F.sum("chars").alias("line_chars"), F.sum(F.when(repeated, F.col("chars")).otherwise(0)).alias("repeated_chars"), F.sum(F.when(F.size("families") > 0, F.col("chars")).otherwise(0)).alias("publisher_chars"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("families")))).alias("families"),
    )

    parts = d.select(key, F.explode(pages_of(F.col("t"), marker, F.col("expected"))).alias("page")).select(key, normal_line(F.col("page")).alias("page")).where(F.length("page") >= 80)
    by_page = parts.groupBy(key, F.xxhash64("page").alias("h"), "page").agg(F.count("*").alias("n")).groupBy(key).agg(F.sum("n").alias("long_pages"), F.sum(F.col("n") - 1).alias("repeated_pages"))

    j = shape.join(by_line, key, "left").join(by_page, key, "left")
    n, chars = F.col("pages"), F.col("total_chars")
    whole = F.greatest(F.coalesce("line_chars", F.lit(0)), F.lit(1))
    j = j.withColumns({
        "empty_page_ratio": F.when(n > 0, F.col("empty_pages") / n).otherwise(1.0),
        "repeated_ratio": F.coalesce("repeated_chars", F.lit(0)) / whole,
        "publisher_ratio": F.coalesce("publisher_chars", F.lit(0)) / whole,
        "repeated_pages": F.coalesce("repeated_pages", F.lit(0)),
        "repeated_page_ratio": F.coalesce("repeated_pages", F.lit(0)) / F.greatest(F.coalesce("long_pages", F.lit(0)), F.lit(1)),
        "chars_per_page": chars / F.greatest(F.coalesce(F.nullif("expected", F.lit(0)), n), F.lit(1)),
        "families": F.coalesce("families", F.array().cast("array<string>")),
    })
    given = {
        MOST_EMPTY: (n >= 5) & (F.col("empty_page_ratio") > BOUNDS[MOST_EMPTY]), REPEATED_TEXT: F.col("repeated_ratio") > BOUNDS[REPEATED_TEXT], PUBLISHER: F.col("publisher_ratio") > BOUNDS[PUBLISHER],
        REPEATED_PAGES: F.col("repeated_page_ratio") > BOUNDS[REPEATED_PAGES], THIN: (n >= 4) & (F.col("chars_per_page") < BOUNDS[THIN]),
    }
    j = j.withColumn("warnings", F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in given.items()])))
    thin = F.greatest(F.lit(12_000), n * 700)
    low = (given[MOST_EMPTY] & (chars < F.greatest(F.lit(12_000), n * 900))) | given[PUBLISHER] | ((given[REPEATED_TEXT] | given[REPEATED_PAGES]) & (chars < thin)) | given[THIN]
    j = j.withColumn("low_quality", low)
    return j.select(key, "total_chars", "pages", "empty_pages", F.round("empty_page_ratio", 4).alias("empty_page_ratio"), F.round("chars_per_page", 2).alias("chars_per_page"), F.round("repeated_ratio", 4).alias("repeated_ratio"), F.round("publisher_ratio", 4).alias("publisher_ratio"), "repeated_pages", F.round("repeated_page_ratio", 4).alias("repeated_page_ratio"), "families", "warnings", "low_quality")
