"""robots.txt as a table of rules by host, and which URLs it allows: native columns, no parse per URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import urls as U


def rules(robots: DataFrame, agents: tuple[str, ...] = (), host: str = "host", text: str = "robots_txt") -> DataFrame:
    """host, rules (allow, path, length): those of the groups that name one of the agents, else of the groups for all.

    Consecutive User-agent lines open one group. A rule with an empty path says nothing.
    """
    lines = robots.select(F.col(host).alias("host"), F.posexplode(F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n")).alias("at", "line"))
    plain = F.trim(F.substring_index("line", "#", 1))
    lines = lines.select("host", "at", F.lower(F.regexp_extract(plain, r"^([A-Za-z-]+)\s*:", 1)).alias("key"), F.regexp_extract(plain, r"^[A-Za-z-]+\s*:\s*(.*?)\s*$", 1).alias("value")).where("key in ('user-agent', 'allow', 'disallow')")
    w = Window.partitionBy("host").orderBy("at")
    opens = (F.col("key") == "user-agent") & F.coalesce(F.lag("key").over(w) != "user-agent", F.lit(True))
    lines = lines.withColumn("opens", opens).withColumn("group", F.sum(F.col("opens").cast("int")).over(w))
    group = Window.partitionBy("host", "group")
    names = F.collect_set(F.when(F.col("key") == "user-agent", F.lower("value"))).over(group)
    own = F.exists(names, lambda n: n.isin(*[a.lower() for a in agents])) if agents else F.lit(False)
    lines = lines.withColumns({"own": own, "all": F.array_contains(names, "*")})
    lines = lines.withColumn("named", F.max(F.col("own")).over(Window.partitionBy("host"))).where("key <> 'user-agent' and value <> ''")
    lines = lines.where(F.when(F.col("named"), F.col("own")).otherwise(F.col("all")))
    rule = F.struct((F.col("key") == "allow").alias("allow"), pattern(F.col("value")).alias("path"), F.length("value").alias("length"))
    return lines.groupBy("host").agg(F.collect_list(rule).alias("rules"))


def pattern(path: Column) -> Column:
    """A rule's path as a regular expression: * for anything, $ at the end for the end."""
    quoted = F.regexp_replace(path, r"([.+?^(){}\[\]|\\])", r"\\$1")
    ends = F.endswith(quoted, F.lit("$"))
    body = F.when(ends, F.substring(quoted, F.lit(1), F.length(quoted) - 1)).otherwise(quoted)
    body = F.replace(F.replace(body, F.lit("$"), F.lit("\\$")), F.lit("*"), F.lit(".*"))
    return F.concat(F.lit("^"), body, F.when(ends, F.lit("$")).otherwise(F.lit("")))


def allowed(target: Column, held: Column) -> Column:
    """Of a path with its query: the longest rule that fits decides, Allow where two are as long; no rule allows."""
    fit = F.filter(held, lambda r: F.rlike(target, r["path"]))
    best = F.array_max(F.transform(fit, lambda r: F.struct(r["length"].alias("length"), r["allow"].alias("allow"))))
    return F.coalesce(best["allow"], F.lit(True))


def with_robots(urls: DataFrame, held: DataFrame, url: str = "url", name: str = "robots_allowed") -> DataFrame:
    """urls with whether the robots.txt of their host allows them, as they are and with a slash at the end. Rules come as one row a host, so no URL is multiplied."""
    u = F.col(url)
    path = F.concat(U.path(u), U.query(u))
    both = urls.withColumn("__host", U.host(u)).join(held.select(F.col("host").alias("__host"), F.col("rules").alias("__rules")), "__host", "left")
    slash = F.when(F.endswith(path, F.lit("/")), path).otherwise(F.concat(path, F.lit("/")))
    ok = F.col("__rules").isNull() | (allowed(path, F.col("__rules")) & allowed(slash, F.col("__rules")))
    return both.withColumn(name, ok).drop("__host", "__rules")


def denied_by_robots(filtered: DataFrame, held: DataFrame, site: str, url: str = "url", reason: str = "denial_reason") -> DataFrame:
    """filtered links, where those of the site that were allowed so far and that robots.txt denies bear ROBOTS_TXT."""
    asked = with_robots(filtered, held, url)
    bare = F.regexp_replace(U.host(F.col(url)), r"^(www\.)+", "")
    own = bare == F.regexp_replace(U.host(F.lit(site)), r"^(www\.)+", "")
    return asked.withColumn(reason, F.when(F.col(reason).isNull() & own & ~F.col("robots_allowed"), "ROBOTS_TXT").otherwise(F.col(reason))).drop("robots_allowed")
