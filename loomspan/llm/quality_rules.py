"""Quality rules judged per document and per host.

Every document is measured with column expressions only. Failures are summed
by host, each host's failure rate is shrunk towards the corpus rate with a
beta prior whose strength is fitted to the spread of the hosts' rates (method
of moments), and the host's verdict is joined back to its documents.

Defined results: a null or blank text has no words and fails; a null host is a
host of its own; repeated rows count each for itself; an empty table gives an
empty result; other columns pass through untouched unless dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, written

#: Fixed value: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in windows found twice or more in the text, all occurrences included.

    Each window is one long: its hash above its position. Sorted as plain
    longs, equal windows stand side by side; neighbours of equal hash are then
    compared word by word.
    """
    n = F.size(words)
    bits = F.coalesce(F.greatest(F.ceil(F.log2(n + 1)).cast("int"), F.lit(1)), F.lit(1))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

    def top(x):
        return F.call_function("shiftright", x, bits)

    def at(x):
        return x.bitwiseAND(mask).cast("int")

    def packed(hashes):
        def one(i):
            h = F.xxhash64(*[F.get(hashes, i + k) for k in range(window)])
            return F.coalesce(F.call_function("shiftleft", top(h), bits) + i, F.lit(0).cast("long"))

        return F.transform(F.sequence(F.lit(0), n - window), one)

    def same(x, y):
        return (top(x) == top(y)) & (F.slice(words, at(x) + 1, window) == F.slice(words, at(y) + 1, window))

    def repeated(s):
        return F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))

    def covered(found):
        start = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(F.sort_array(F.transform(found, at)), start, lambda acc, p: F.struct(p.alias("last"), (acc["total"] + F.least(F.lit(window), p - acc["last"])).alias("total")), lambda acc: acc["total"])

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = let(F.sort_array(let(hashes, packed)), repeated)
    return F.when(n > window, covered(found)).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))

    def of(words):
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            dup.alias("n_dup_lines"),
            n_repeat_words(words).alias("n_repeat_words"),
        )

    return let(words_of(text), of)


def judge(docs: DataFrame, host: str = "source", text: str = "text", min_words: int = 10, max_repeat_percent: int = 20, max_host_rate: float = 0.5, drop_text: bool = False) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rate and kept.

    kept: the document passed, and its host's shrunk failure rate is at most max_host_rate.
    Columns of docs with these names are replaced.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate", "kept"]
    own = [c for c in docs.columns if c not in new and not (drop_text and c == text)]
    m = docs.select(*own, F.col(host).alias("__host"), measures(F.col(text)).alias("__m")).select(*own, "__host", "__m.*")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    m = written(m.withColumn("base_failed", failed), "quality")
    hosts = m.groupBy("__host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("f").alias("f"), F.sum(F.col("f") * F.col("f") / F.col("n")).alias("ff")).first()
    n, f, ff = total.n or 1, total.f or 0, total.ff or 0.0
    mean = f / n
    spread = max(ff / n - mean * mean, 0.0)  # of the hosts' rates, weighted by documents
    strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1000.0) if spread > 0 else 1000.0
    rates = hosts.select(F.col("__host").alias("__key"), ((F.col("f") + strength * mean) / (F.col("n") + strength)).alias("host_rate"))
    judged = m.join(rates, F.col("__host").eqNullSafe(F.col("__key")), "left")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate)).select(*own, *new)


#: DuckDB: the query of the production parameters.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT rid, p, array_to_string(w[p:p+4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)
), rep AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c >= 2
), cov AS (
  SELECT rid, count(DISTINCT pos) AS n_repeat_words
  FROM (SELECT rid, unnest(range(p, p + 5)) AS pos FROM rep) GROUP BY rid
), m AS (
  SELECT d.rid, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cov USING (rid)
), b AS (
  SELECT *, (n_words < 10 OR n_repeat_words * 100 > n_words * 20) AS base_failed FROM m
), h AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b GROUP BY source
), g AS (
  SELECT sum(f) / sum(n) AS mean, greatest(sum(f * f / n) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)), 0) AS spread FROM h
), k AS (
  SELECT mean, CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 1), 1000) ELSE 1000 END AS strength FROM g
), r AS (
  SELECT source, (f + strength * mean) / (n + strength) AS rate FROM h, k
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND rate <= 0.5) AS kept
FROM b JOIN r ON b.source IS NOT DISTINCT FROM r.source
"""
