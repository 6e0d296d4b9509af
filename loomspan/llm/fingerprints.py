"""Order MinHash fingerprints of documents, with column expressions only.

The k-mers of a document are its runs of k words, each numbered by its
occurrence so that repeats count. A hash deals them to the coordinates of the
sketch; in each coordinate the smallest ones are selected, put back into the
order of the text, and their tuple is hashed. Two texts share a coordinate if
they share the selected k-mers in the same order, so likeness falls with edit
distance and not only with set overlap.

All steps work on arrays of longs that hold a hash above a position, so that
Spark's sort of plain longs does the grouping.

Defined results: null and blank texts have an empty fingerprint (''), two of
them are alike (1.0), one of them and any other text are not (0.0); a text of
fewer than k words is one k-mer; beyond 2^24 words positions are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let
from .quality_rules import words_of

BITS = 24  # of a position
TOP = 58  # the coordinate stands above


def _shift(name: str, x: Column, by: int) -> Column:
    return F.call_function(name, x, F.lit(by))


def sketch(text: Column, k: int = 3, coordinates: int = 32, chosen: int = 2) -> Column:
    """Array of longs, ascending: coordinate above the hash of its tuple; coordinates without a k-mer are left out."""
    mask = (1 << BITS) - 1

    def kmers(words):
        n = F.size(words)

        def runs(h):
            return F.transform(F.sequence(F.lit(0), n - k), lambda i: F.coalesce(F.xxhash64(*[F.get(h, i + j) for j in range(k)]), F.lit(0).cast("long")))

        some = let(F.transform(words, lambda w: F.xxhash64(w)), runs)
        return F.when(n >= k, some).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))

    def at(x):
        return x.bitwiseAND(F.lit(mask))

    def top(x):
        return _shift("shiftright", x, BITS)

    def key(x, occurrence):
        h = F.xxhash64(top(x), occurrence)
        low = _shift("shiftleft", _shift("shiftrightunsigned", h, 64 - TOP + BITS), BITS)
        return F.coalesce(_shift("shiftleft", F.pmod(h, F.lit(coordinates)), TOP).bitwiseOR(low).bitwiseOR(at(x)), F.lit(0).cast("long"))

    def numbered(s):
        """Keys of k-mers with their occurrence numbers; s is sorted, so repeats stand together."""
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (top(F.get(s, i)) != top(F.get(s, i - 1))))
        first = F.lit(0)

        def with_runs(b):
            def run(i, j):
                return F.transform(F.slice(s, i + 1, F.coalesce(F.get(b, j + 1), F.size(s)) - i), lambda x, o: key(x, o))

            return F.when(F.size(b) == F.size(s), F.transform(s, lambda x: key(x, first))).otherwise(F.flatten(F.transform(b, run)))

        return F.when(F.size(s) > 0, let(starts, with_runs)).otherwise(F.array().cast("array<bigint>"))

    def smallest(s):
        return F.filter(s, lambda x, i: (i < chosen) | (_shift("shiftright", x, TOP) != _shift("shiftright", F.get(s, i - F.lit(chosen)), TOP)))

    def tuples(s):
        def coordinate(x):
            return _shift("shiftright", x, TOP)

        heads = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (coordinate(x) != coordinate(F.get(s, i - 1))), i)), lambda i: i.isNotNull())

        def hashed(i):
            own = F.filter(F.slice(s, i + 1, chosen), lambda x: coordinate(x) == coordinate(F.get(s, i)))
            ordered = F.array_sort(F.transform(own, lambda x: F.struct(at(x).alias("p"), top(x).alias("h"))))
            h = F.xxhash64(F.transform(ordered, lambda z: z["h"]))
            return _shift("shiftleft", coordinate(F.get(s, i)), 32).bitwiseOR(h.bitwiseAND(F.lit(0xFFFFFFFF)))

        return F.transform(heads, hashed)

    placed = let(words_of(text), lambda w: let(kmers(w), lambda h: F.sort_array(F.transform(h, lambda x, i: F.coalesce(_shift("shiftleft", top(x), BITS) + F.least(i, F.lit(mask)), F.lit(0).cast("long"))))))
    keys = F.sort_array(let(placed, numbered))
    return let(let(keys, smallest), tuples)


def likeness(a: Column, b: Column) -> Column:
    """Share of coordinates, among those that either text has, in which two sketches agree."""

    def where(x):
        return F.transform(x, lambda c: _shift("shiftright", c, 32))

    either = F.size(F.array_union(where(a), where(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_text(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda c: F.lower(F.lpad(F.hex(c), 10, "0"))), "")


def with_next(docs: DataFrame, doc_id: str, carried: list[str], rows_per_bucket: int = 2000, most_buckets: int = 65_536) -> DataFrame:
    """docs (the id and carried columns) with next_<c>: those columns of the row with the next smaller id, after the last the first.

    Ids are dealt to ranges by their quantiles; each range also receives the
    first row of the next one, so that no window spans more than a range.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), *carried)
    facts = docs.agg(F.count("*").alias("n"), F.percentile_approx("doc_id", [k / 256 for k in range(257)], 20_000).alias("q")).first()
    cuts = sorted(set(facts.q or [0]))
    sub = max(1, min(most_buckets // 256, -(-facts.n // (256 * rows_per_bucket))))
    low = F.array(*[F.lit(c).cast("long") for c in cuts])
    part = F.greatest(F.size(F.filter(low, lambda c: c <= F.coalesce(F.col("doc_id"), F.lit(cuts[0])))) - 1, F.lit(0))
    width = F.greatest(F.coalesce(F.get(low, F.col("part") + 1), F.get(low, F.col("part"))) - F.get(low, F.col("part")), F.lit(1))
    within = F.least(F.floor((F.col("doc_id") - F.get(low, F.col("part"))) * sub / width), F.lit(sub - 1))
    placed = docs.withColumn("part", part).withColumn("range", F.col("part") * sub + F.greatest(F.coalesce(within, F.lit(0)), F.lit(0))).drop("part")
    heads = [(r.range, r.head) for r in placed.groupBy("range").agg(F.max("doc_id").alias("head")).collect()]  # most_buckets rows at most
    heads.sort()
    spark = docs.sparkSession
    above = spark.createDataFrame([(heads[(k + 1) % len(heads)][0], heads[k][0], heads[k][1], int(k == len(heads) - 1)) for k in range(len(heads))], "above long, range long, head long, wraps int")
    sent = placed.join(F.broadcast(above.select(F.col("range").alias("r"), "head", "above")), (F.col("range") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("head")), "left")
    own, ahead = F.struct(F.col("range").alias("range"), F.lit(0).alias("ahead")), F.struct(F.col("above").alias("range"), F.lit(1).alias("ahead"))
    sent = sent.withColumn("to", F.explode(F.when(F.col("r").isNull(), F.array(own)).otherwise(F.array(own, ahead)))).select("doc_id", *carried, "to.*")
    order = Window.partitionBy("range").orderBy("ahead", F.desc_nulls_last("doc_id"), *[F.col(c) for c in carried[:1]])
    return sent.select("doc_id", *carried, "ahead", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried]).where("ahead = 0").drop("ahead")


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **sketch_options) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text keeps the first half; the last floor(n/2) code points are
    replaced by the first as many of the next document.
    """
    made = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    made = made.withColumn("sketch", sketch(F.col("text"), **sketch_options))
    both = with_next(made, "doc_id", ["text", "sketch"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    both = both.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
    both = both.select("doc_id", "n_chars", "sketch", "next_sketch", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited"), **sketch_options).alias("edited_sketch"))
    return both.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"), likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
