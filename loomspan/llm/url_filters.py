"""URL verdicts: allow and block rules, and gradient-boosted trees on lexical features for the rest.

The trees are trained on URLs that a rule labels. Features are the lengths of
the URL, host and path, depth, digit ratio, character entropy, numbers of
parameters, hyphens and host labels, a fragment flag, and statistics of the
host's suffix (its last label): how often it occurs in the table and how often
it is blocked among labelled URLs, both over all rows. A URL that the trees are
trained on gets the rate of the other folds of URLs, so that its own label is
no part of its features.

Defined results: a null URL or one without `://` has an empty host and path
and fits no rule; if no URL, or URLs of one label only, are labelled, the
trees give that label (`allow` if there is none); repeated rows are judged
each for itself; an empty table gives an empty result; columns other than the
id and the URL are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.lit(2**30))).otherwise("")
    return F.translate(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.lit(2**30))).otherwise("")
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (host and start of path) that fits the host or a parent of it; else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        out = F.when(((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest)), F.lit(rule)).otherwise(out)
    return out


FEATURES = ("length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "labels", "fragment", "suffix_log_count", "suffix_block_rate")


def features(url: str, host: str, path: str, n: int, rate: float) -> list[float]:
    size = max(1, len(url))
    counts = [url.count(c) for c in set(url)]
    query = url.partition("?")[2].partition("#")[0]
    return [
        len(url), len(host), len(path), sum(1 for p in path.split("/") if p), sum(c.isdigit() for c in url) / size,
        -sum(c / size * log2(c / size) for c in counts), sum(1 for p in query.split("&") if p), url.count("-"),
        host.count(".") + 1 if host else 0, float("#" in url), log(1 + n), rate,
    ]


#: Parts of the labelled URLs, by hash; a training URL's suffix rate is that of the other parts.
FOLDS = 5


class Trees:
    """Boosted regression trees of equal depth under logistic loss, over quantile bins."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        if not len(y) or y.min() == y.max():
            self.base = -10.0 if not len(y) or y[0] == 0 else 10.0
            return self
        p = y.mean()
        self.base = float(np.log(p / (1 - p)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            g, h = y - q, q * (1 - q)
            node = np.zeros(len(y), int)
            splits = np.full((2**self.depth - 1, 2), -1.0)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-9)
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    key = (node - first) * self.bins + code[:, j]
                    gs = np.bincount(key, g, count * self.bins).reshape(count, -1).cumsum(1)
                    hs = np.bincount(key, h, count * self.bins).reshape(count, -1).cumsum(1)
                    gl, hl, gt, ht = gs[:, : len(c)], hs[:, : len(c)], gs[:, -1:], hs[:, -1:]
                    gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                    at = gain.argmax(1)
                    top = gain[np.arange(count), at]
                    for k in np.flatnonzero(top > best + 1e-12):
                        best[k], splits[first + k] = top[k], (j, c[at[k]])
                node = self._down(x, node, splits)
            leaf = node - (2**self.depth - 1)
            value = self.rate * np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + self.ridge)
            self.trees.append((splits, value))
            score += value[leaf]
        return self

    @staticmethod
    def _down(x: np.ndarray, node: np.ndarray, splits: np.ndarray) -> np.ndarray:
        j, cut = splits[node, 0].astype(int), splits[node, 1]
        right = (j >= 0) & (x[np.arange(len(x)), np.maximum(j, 0)] > cut)
        return 2 * node + 1 + right

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for splits, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = self._down(x, node, splits)
            out += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-out))


def judge_urls(pages: DataFrame, rules: dict[str, str], page_id: str = "page_id", url: str = "url", sample: int = 20_000, most_suffixes: int = 50_000) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score (of the trees).

    sample: distinct labelled URLs that the trees are trained on, those of lowest hash.
    most_suffixes: up to so many, suffix statistics are broadcast; beyond, joined.
    """
    spark = pages.sparkSession
    small_batches(spark)
    p = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    p = p.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    p = p.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules)).withColumn("suffix", F.substring_index("host", ".", -1))
    label = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        label = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(label)
    p = p.withColumn("label", label)
    fold, blocked = F.pmod(F.xxhash64("url"), F.lit(FOLDS)), (F.col("label") == "block").cast("long")
    counts = [F.array(*[F.count(F.when(fold == f, F.col("label"))) for f in range(FOLDS)]).alias("labelled"), F.array(*[F.coalesce(F.sum(F.when(fold == f, blocked)), F.lit(0)) for f in range(FOLDS)]).alias("blocked")]
    stats = written(p.groupBy("suffix").agg(F.count("*").alias("n"), *counts), "suffixes")
    total = {c: F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y) for c in ("labelled", "blocked")}
    facts = stats.agg(F.count("*").alias("suffixes"), *[F.sum(total[c]).alias(c) for c in total]).first()
    prior = (facts.blocked or 0) / max(1, facts.labelled or 0)
    rate = lambda blocked, labelled: (blocked + 10 * prior) / (labelled + 10)
    others = F.transform(F.arrays_zip("labelled", "blocked"), lambda f: rate(total["blocked"] - f["blocked"], total["labelled"] - f["labelled"]))
    stats = stats.select("suffix", "n", rate(total["blocked"], total["labelled"]).alias("rate"), others.alias("others"))
    p = p.join(F.broadcast(stats) if facts.suffixes <= most_suffixes else stats, "suffix", "left")
    labelled = p.where("label is not null")
    # so few rows are below this hash that the cut to the sample moves little
    urls = labelled.agg(F.approx_count_distinct("url", 0.02)).first()[0]
    below = -(2**63) + int(2**64 * min(1.0, 1.25 * (sample + 100) / max(1, urls))) - 1
    known = labelled.where(F.xxhash64("url") <= below).select("url", "host", "path", "n", F.get("others", fold).alias("rate"), "label").dropDuplicates(["url"])
    rows = known.orderBy(F.xxhash64("url"), "url").limit(sample).collect()
    x = np.array([features(r.url, r.host, r.path, r.n, r.rate) for r in rows], float).reshape(-1, len(FEATURES))
    trees = Trees().fit(x, np.array([r.label == "block" for r in rows], float))
    sent = spark.sparkContext.broadcast(trees)  # rounds * 2^depth splits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = [batch.column(k).to_pylist() for k in range(5)]
            x = np.array([features(*r) for r in zip(*c, strict=True)], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[5:], batch.column(1), batch.column(2), pa.array(sent.value.score(x))], ["page_id", "rule", "label", "host", "path", "block_score"])

    kind = pages.schema[page_id].dataType.simpleString()
    scored = p.select("url", "host", "path", "n", "rate", "page_id", "rule", "label").mapInArrow(run, f"page_id {kind}, rule string, label string, host string, path string, block_score double")
    verdict = F.coalesce("label", F.when(F.col("block_score") > 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")
