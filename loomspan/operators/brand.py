"""A site's brand: its logo among a page's images, its spacing unit, radius, fonts and palette; engine races and starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Points of a logo candidate, and what the first one's points and lead say of its confidence.
POINTS = {
    "repeated": 15, "variants": 8, "home link in header": 50, "home link": 35, "in header": 25, "no link": -15, "header": 20, "visible": 15, "hidden": -25, "top left": 10, "highest": 12, "alt": 8, "src": 5, "class": 5,
    "alt is brand": 20, "alt holds brand": 12, "src holds brand": 6, "fair size": 5, "tiny": -8, "large": -10, "huge": -20, "small square": -12, "vector": 3, "footer": -15, "body": -10,
}
CONFIDENCE = ((60, 20, 0.9), (45, 15, 0.75), (30, None, 0.6))
LEAST_CONFIDENCE = 0.4


def _same_image(a: Column, b: Column) -> Column:
    """Whether two candidates show one image: the same alt text, source or file name, or nearly one place."""
    alt_a, alt_b = (F.regexp_replace(F.lower(x["alt"]), r"\s+", "") for x in (a, b))
    near = (F.abs(a["top"] - b["top"]) < 20) & (F.abs(a["left"] - b["left"]) < 50) & (F.abs(a["width"] - b["width"]) < 30)
    return F.coalesce((a["alt"] != "") & (b["alt"] != "") & (alt_a == alt_b), F.lit(False)) | (a["src"] == b["src"]) | ((a["file"] != "") & (a["file"] == b["file"])) | near


def logo_scores(candidates: DataFrame, page: str = "page", brand: str | None = None) -> DataFrame:
    """page, idx, score of one candidate for each image of a page.

    candidates: idx (their order), src, alt, location, top, left, width, height,
    visible, href, and the marks home_link, in_header, alt_match, src_match,
    class_match, is_svg. In order, a candidate stands with the first earlier
    image that it resembles. A page's candidates are one array, as pages have dozens.
    """
    c = candidates.withColumn("file", F.regexp_extract(F.substring_index("src", "?", 1), r"([^/]*)$", 1)).withColumn("alt", F.coalesce("alt", F.lit("")))
    name = F.lower(F.trim(F.col(brand))) if brand else F.lit(None).cast("string")
    c = c.withColumn("__brand", name)
    all_ = c.groupBy(page).agg(F.sort_array(F.collect_list(F.struct("idx", *[x for x in c.columns if x not in (page, "idx")]))).alias("all"))
    first = F.aggregate("all", F.slice("all", 1, 0), lambda held, x: F.when(F.exists(held, lambda h: _same_image(h, x)), held).otherwise(F.concat(held, F.array(x))))
    led = all_.withColumn("leaders", first).select(page, "leaders", F.explode("all").alias("c"))
    led = led.withColumn("group", F.get(F.filter("leaders", lambda h: _same_image(h, F.col("c"))), F.lit(0))["idx"]).select(page, "group", "c.*")
    file_key = F.lower(F.when(F.col("file") != "", F.col("file")).otherwise(F.col("src")))
    places = F.size(F.collect_set("location").over(Window.partitionBy(page, "__key")))
    led = led.withColumn("__key", file_key).withColumn("__repeated", places > 1).withColumn("__highest", F.col("top") == F.min("top").over(Window.partitionBy(page)))
    group = Window.partitionBy(page, "group")
    best = group.orderBy(~F.col("visible"), ~F.col("in_header"), "top", ~F.col("home_link"), "idx")
    led = led.withColumn("__n", F.row_number().over(best)).withColumn("__any", F.max(F.col("__repeated")).over(group)).withColumn("__size", F.count("*").over(group)).where("__n = 1")

    def points(*cases):
        out = None
        for c, k in cases:
            out = F.when(c, POINTS[k]) if out is None else out.when(c, POINTS[k])
        return out.otherwise(0)

    area, alt, own = F.col("width") * F.col("height"), F.lower(F.trim("alt")), F.col("__brand")
    linked, header = F.col("home_link"), F.col("in_header")
    small = (F.abs(F.col("width") - F.col("height")) < 5) & ((F.col("width") < 40) | (F.col("height") < 40))
    score = (
        points((F.col("__any"), "repeated")) + points((F.col("__size") > 1, "variants")) + points((linked & header, "home link in header"), (linked, "home link"), (header, "in header"))
        + points((F.coalesce(F.trim("href"), F.lit("")) == "", "no link")) + points((F.col("location") == "header", "header")) + points((F.col("visible"), "visible"), (F.lit(True), "hidden"))
        + points(((F.col("top") < 100) & (F.col("left") < 300), "top left")) + points((F.col("__highest") & (F.col("top") < 200), "highest")) + points((F.col("alt_match"), "alt")) + points((F.col("src_match"), "src")) + points((F.col("class_match"), "class"))
        + points((alt == own, "alt is brand"), ((alt != "") & (F.contains(alt, own) | F.contains(own, alt)), "alt holds brand")) + points((F.contains(F.lower("src"), own), "src holds brand"))
        + points(((area > 1000) & (area < 50_000), "fair size"), (area < 500, "tiny"), ((area >= 50_000) & (area <= 200_000), "large"), (area > 200_000, "huge")) + points((small, "small square")) + points((F.col("is_svg"), "vector"))
        + points((F.col("location") == "footer", "footer")) + points(((F.col("location") == "body") & ~header, "body"))
    )
    return led.select(page, "idx", score.alias("score"))


def pick_logo(candidates: DataFrame, page: str = "page", brand: str | None = None) -> DataFrame:
    """page, idx, score, confidence of the best candidate of each page; confidence by its score and its lead."""
    order = Window.partitionBy(page).orderBy(F.desc("score"), "idx")
    s = logo_scores(candidates, page, brand).withColumn("n", F.row_number().over(order)).withColumn("second", F.lead("score").over(order)).where("n = 1")
    lead, sure = F.col("score") - F.coalesce("second", F.lit(0)), F.lit(LEAST_CONFIDENCE)
    for least, ahead, value in reversed(CONFIDENCE):
        sure = F.when((F.col("score") >= least) & (lead >= ahead if ahead is not None else F.lit(True)), value).otherwise(sure)
    return s.select(page, "idx", "score", sure.alias("confidence"))


def _rounded(v: Column) -> Column:
    return F.floor(v + 0.5).cast("int")


def spacing_unit(values: Column) -> Column:
    """Of an array of lengths: the first of 4, 6, 8, 10, 12 that six tenths are multiples of, give or take one; else half the upper median doubled, between 2 and 12; 8 without lengths."""
    vs = F.transform(F.filter(values, lambda v: (v > 0) & (v <= 128)), _rounded)
    n = F.size(vs)

    def near(v, c):
        return (v % c <= 1) | (v % c >= c - 1)

    fits = F.filter(F.array(*[F.lit(c) for c in (4, 6, 8, 10, 12)]), lambda c: F.size(F.filter(vs, lambda v: near(v, c))) / n >= 0.6)
    middle = F.get(F.array_sort(vs), F.floor(n / 2).cast("int"))
    other = F.greatest(F.lit(2), F.least(F.lit(12), _rounded(middle / 2) * 2))
    return F.when(n == 0, 8).otherwise(F.coalesce(F.get(fits, F.lit(0)), other))


def corner_radius(values: Column) -> Column:
    """The upper median as pixels; 8px without values."""
    rs = F.array_sort(F.filter(values, lambda v: v.isNotNull()))
    return F.when(F.size(rs) == 0, "8px").otherwise(F.concat(_rounded(F.get(rs, F.floor(F.size(rs) / 2).cast("int"))).cast("string"), F.lit("px")))


def top_fonts(fonts: DataFrame, site: str = "site", family: str = "family", most: int = 10) -> DataFrame:
    """The most used font families of a site, ties by first place."""
    counted = fonts.where(F.col(family) != "").groupBy(site, family).agg(F.count("*").alias("count"), F.min("at").alias("first"))
    w = Window.partitionBy(site).orderBy(F.desc("count"), "first")
    return counted.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).select(site, family, "count", "place")


def palette(colours: DataFrame, site: str = "site", colour: str = "hex", weight: str = "weight") -> DataFrame:
    """Colours of a site by weight, with their place and brightness (YIQ)."""
    g = colours.groupBy(site, colour).agg(F.sum(weight).alias("weight"))
    r, y, b = (F.conv(F.substring(colour, k, 2), 16, 10).cast("int") for k in (2, 4, 6))
    place = F.row_number().over(Window.partitionBy(site).orderBy(F.round("weight", 6).desc(), colour))
    return g.withColumn("place", place).withColumn("yiq", (r * 299 + y * 587 + b * 114) / 1000.0)


def first_success(attempts: DataFrame, key: str, rank: str = "rank", ok: str = "ok") -> DataFrame:
    """Of each key the attempt of lowest rank that succeeded."""
    return attempts.where(ok).groupBy(key).agg(F.min_by(F.struct(*[c for c in attempts.columns if c not in (key, ok)]), rank).alias("a")).select(key, "a.*")


def next_allowed(queue: DataFrame, running: DataFrame, owner: str, limit: str, now) -> DataFrame:
    """Jobs that may start: waiting ones that have not expired, in order, up to what the owner's limit leaves; a delay allows one at a time."""
    alive = running.where(F.col("expires_at") > now).groupBy(owner).agg(F.count("*").alias("busy"))
    w = Window.partitionBy(owner).orderBy("priority", "created_at", "id")
    waiting = queue.where(F.col("times_out_at") > now).join(alive, owner, "left")
    room = F.when(F.col("delay") > 0, 1).otherwise(F.col(limit)) - F.coalesce("busy", F.lit(0))
    return waiting.withColumn("n", F.row_number().over(w)).where(F.col("n") <= room).drop("n", "busy")
