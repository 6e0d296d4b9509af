"""Near-duplicate documents by circulant MinHash with exact verification.

A document's set holds its distinct 5-word shingles (ASCII lower case; fewer
words: the whole sequence as one). One permutation (a multiplicative hash)
deals shingles to positions of a circle, a second one labels the positions;
coordinate k of the signature is the smallest label after turning the circle
by k. The labels that a shingle meets over all turns stand side by side, so a
whole signature is one sliding window per shingle and a minimum over rows.

Bands of the signature give candidate buckets; texts of equal sets are folded
into one class first. Links are confirmed on full sets, in two steps that cost
in proportion to the members of a group, not to their pairs:

1. stars: in each bucket one class is the anchor and every other class is
   compared with one anchor of its buckets, so a large group of copies costs
   one comparison per member. Linked classes form components. What a bucket
   holds outside its largest component gets new anchors, drawn by hash, for as
   long as a round links a twentieth of it, so large families come together.
2. rarest shingles first: classes of buckets that still hold several components
   put their shingles in one order, rare ones first. Two sets of sizes s and t
   at the limit share ceil(p (s + t) / (1 + p)) shingles, so they share one of
   the first s - that + 1 of the one, and of the other; sizes are cut into
   steps of two in a hundred to keep these prefixes short. Classes that share
   such a shingle at places that still allow the overlap are compared. No pair
   at the limit is lost, and a member that has more shingles of its own than
   the limit allows meets nobody, however large its group.

The order is by counts in a table of fixed size (shingles hashed to slots): any
order that all classes agree on is exact. Components come from min-label rounds
over the confirmed links, each round written to the shared folder.

Defined results: a null or blank text has an empty set and is linked with
nothing; a row without an id is kept and linked with nothing; rows of one id
are judged each by its own text; repeated rows have equal results; an empty
table gives an empty result; columns other than the id and the text are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cached_by, emitted, released, small_batches, summed, written

CIRCLE_BITS = 20
MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """64-bit hash by word; forgets all when full."""

    most = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        got = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = got
        return got


_words = _Words()
cached_by("near_dedup", _words.clear)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - size + 1)
    h = np.full(n, np.uint64(len(w) if len(w) < size else size))
    for k in range(min(size, len(w))):
        h = _mix(h * MIX + w[k : k + n])
    return np.unique(h)


def labels(coordinates: int, seed: int = 7) -> np.ndarray:
    """The second permutation, and its first labels once more so that windows need no wrap."""
    p = np.random.default_rng(seed).permutation(1 << CIRCLE_BITS).astype(np.int32)
    return np.concatenate([p, p[:coordinates]])


def signature(sets: list[np.ndarray], ring: np.ndarray, coordinates: int) -> np.ndarray:
    """A row of circulant MinHash coordinates for each non-empty set."""
    windows = np.lib.stride_tricks.sliding_window_view(ring, coordinates)
    out = np.empty((len(sets), coordinates), np.int32)
    for i, s in enumerate(sets):
        at = ((s * MIX) >> np.uint64(64 - CIRCLE_BITS)).astype(np.int64)
        low = np.full(coordinates, np.iinfo(np.int32).max, np.int32)
        for b in range(0, len(at), 4096):
            np.minimum(low, windows[at[b : b + 4096]].min(0), out=low)
        out[i] = low
    return out


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _sketch(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring = labels(bands * rows)
        seeds = np.random.default_rng(11).integers(1, 2**63, size=rows, dtype=np.uint64) | np.uint64(1)
        for batch in batches:
            sets = [shingles(t, size) for t in batch.column(1).to_pylist()]
            full = [s for s in sets if len(s)]
            coordinates = signature(full, ring, bands * rows).reshape(len(full), bands, rows).astype(np.uint64)
            keys = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), (len(full), bands)) * MIX
            for k in range(rows):
                keys = _mix(keys + coordinates[:, :, k] * seeds[k])
            it = iter(keys.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary()), pa.array([next(it) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "bands"],
            )

    return released("near_dedup", run)


def _sets(size: int):
    """id and shingles of the rows whose set has the class's digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for node, digest, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = shingles(text, size)
                if _digest(s) == digest:
                    ids.append(node)
                    out.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["id", "tokens"])

    return released("near_dedup", run)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of intersections of two sets; rows of one a come together as a rule."""
    last, left = object(), np.zeros(0, np.uint64)
    for batch in batches:
        common = []
        for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if a != last:
                last, left = a, np.frombuffer(x, np.uint64)
            right = np.frombuffer(y, np.uint64)
            at = np.searchsorted(left, right)
            at[at == len(left)] = 0
            common.append(int(np.count_nonzero(left[at] == right)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64())], ["a", "b", "common"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, label: str) -> DataFrame:
    """Of pairs (a, b, size_a, size_b) those that are links."""
    # the set of an a with many pairs goes to several tasks
    share = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / 512).cast("int").alias("shares"))
    own = sets.select(F.col("id").alias("a"), F.col("tokens").alias("set_a")).join(share, "a").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
    other = sets.select(F.col("id").alias("b"), F.col("tokens").alias("set_b"))
    dealt = pairs.select("a", "b").join(share, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("shares")).cast("int").alias("share"))
    both = dealt.join(other, "b").join(own, ["a", "share"]).select("a", "b", "set_a", "set_b")
    found = both.mapInArrow(released("near_dedup", _compare), "a long, b long, common long")
    return written(pairs.join(found, ["a", "b"]).where(similar_enough(F.col("common"), F.col("size_a"), F.col("size_b"), percent)).select("a", "b"), label)


def similar_enough(common: Column, size_a: Column, size_b: Column, percent: int) -> Column:
    return common * 100 >= (size_a + size_b - common) * percent


def components(links: DataFrame, label: str) -> DataFrame:
    """node, root: the smallest node reachable over links (a, b); only nodes that have a link."""
    edges = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), f"{label}-edges")
    at = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), label)
    while True:  # roots only fall
        around = edges.join(at.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        near = at.join(around, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = at.select(F.col("node").alias("root"), F.col("root").alias("above"))  # a root's own root
        new = written(near.join(up, "root", "left").select("node", "old", F.least("root", F.coalesce("above", "root")).alias("root")), label)
        done = new.where("root <> old").limit(1).count() == 0
        at = new.select("node", "root")
        if done:
            return at


def close_sizes(x: Column, y: Column, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def star(placed: DataFrame, percent: int) -> DataFrame:
    """Each class of placed (bucket, id, size, root, weight) with one anchor (a, b, size_a, size_b): the heaviest of its buckets."""
    heads = placed.groupBy("bucket").agg(F.max(F.struct("weight", "id", "size", "root")).alias("head"))
    best = placed.join(heads, "bucket").where("root <> head.root").groupBy("id", "size").agg(F.max("head").alias("head"))
    return best.select(F.col("head.id").alias("a"), F.col("id").alias("b"), F.col("head.size").alias("size_a"), F.col("size").alias("size_b")).where(close_sizes(F.col("size_a"), F.col("size_b"), percent))


def _slots(bits: int):
    """How often each slot occurs among the shingles of all sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for s in batch.column(0).to_pylist():
                np.add.at(total, slot_of(np.frombuffer(s, np.uint64), bits), 1)
        yield from emitted(total)

    return released("near_dedup", run)


def slot_of(tokens: np.ndarray, bits: int) -> np.ndarray:
    return (_mix(tokens) >> np.uint64(64 - bits)).astype(np.int64)


#: Sizes at which a step begins, two in a hundred apart.
STEPS = np.unique(np.ceil(1.02 ** np.arange(1500)).astype(np.int64))


def least_common(x: int, y: int, percent: int) -> int:
    """The fewest shingles that sets of x and y elements at the limit share."""
    return -(-percent * (x + y) // (100 + percent))


def prefixes(tokens: np.ndarray, counts: np.ndarray, percent: int) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
    """Step, whether as the smaller set, places and shingles of the prefixes of a set, without those that no other set has.

    As the smaller of a pair a set stands in its own step only; as the larger in each step of possible partners.
    """
    order = np.lexsort((tokens, counts))
    tokens, shared, s = tokens[order], counts[order] > 1, len(tokens)
    least = -(-percent * s // 100)
    low, high = np.searchsorted(STEPS, [least, s], side="right") - 1
    ends = [(int(high), True, s - least_common(s, s, percent) + 1)]
    ends += [(int(k), False, s - least_common(max(least, int(STEPS[k])), s, percent) + 1) for k in range(low, high + 1)]
    for step, smaller, n in ends:
        at = np.flatnonzero(shared[:n])
        if len(at):
            yield step, smaller, at, tokens[at]


def _prefixes(counts, bits: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                own, steps, roles, places, keys = [], [], [], [], []
                for k, s in enumerate(batch.column(3)[at : at + 64].to_pylist(), at):
                    t = np.frombuffer(s, np.uint64)
                    for step, smaller, place, key in prefixes(t, table[slot_of(t, bits)], percent):
                        own.append(np.full(len(place), k))
                        steps.append(np.full(len(place), step, np.int32))
                        roles.append(np.full(len(place), smaller))
                        places.append(place)
                        keys.append(key.view(np.int64))
                if own:
                    rows = pa.array(np.concatenate(own))
                    cols = [np.concatenate(steps), np.concatenate(keys), np.concatenate(places), np.concatenate(roles)]
                    yield pa.RecordBatch.from_arrays([*(batch.column(j).take(rows) for j in range(3)), *(pa.array(c) for c in cols)], ["id", "size", "root", "step", "token", "place", "smaller"])

    return released("near_dedup", run)


def prefix_pairs(sets: DataFrame, classes: int, percent: int, most_bits: int = 22) -> DataFrame:
    """Pairs (a, b, size_a, size_b) of different roots that may be links: all that are, and few others.

    sets: id, size, root, tokens; classes: their number. The counts have 2 ** most_bits slots at most.
    """
    bits = int(min(most_bits, max(12, np.ceil(np.log2(classes + 1)) + 8)))
    counts = summed(sets.select("tokens").mapInArrow(_slots(bits), "at long, piece binary"), 1 << bits, "<i4")
    sent = sets.sparkSession.sparkContext.broadcast(counts)  # of fixed size
    keys = written(sets.select("id", "size", "root", "tokens").mapInArrow(_prefixes(sent, bits, percent), "id long, size long, root long, step int, token long, place long, smaller boolean"), "prefixes")
    mixed = keys.groupBy("step", "token").agg(F.min("root").alias("main"), F.max("root").alias("other"), F.bool_or("smaller").alias("some"), F.bool_and("smaller").alias("all")).where("main <> other and some and not all").select("step", "token")
    keys = keys.join(mixed, ["step", "token"])
    x, y = keys.where("smaller").alias("x"), keys.where(~F.col("smaller")).alias("y")
    ordered = (F.col("x.size") < F.col("y.size")) | ((F.col("x.size") == F.col("y.size")) & (F.col("x.id") < F.col("y.id")))
    reach = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place")) * (100 + percent) >= (F.col("x.size") + F.col("y.size")) * percent
    may = (F.col("x.step") == F.col("y.step")) & (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & ordered & reach
    return x.join(y, may).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.size").alias("size_a"), F.col("y.size").alias("size_b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, bands: int = 32, rows: int = 7, size: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for each row of docs.

    percent: documents are linked from this Jaccard similarity, in hundredths.
    With 32 bands of 7 rows a pair at 0.85 shares no bucket with a chance of about 5e-6.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    sketch = written(texts.mapInArrow(_sketch(bands, rows, size), f"doc_id {kind}, n_shingles long, digest binary, bands array<long>"), "sketch")
    full = sketch.where("digest is not null and doc_id is not null")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    dealt = classes.select("id", "size", F.explode("bands").alias("bucket"))
    crowded = dealt.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    member = written(dealt.join(crowded, "bucket").select("bucket", "id", "size", "n"), "buckets")
    wanted = classes.join(member.select("id").distinct(), "id", "left_semi").select("id", "digest", F.col("rep").alias("doc_id"))
    sets = texts.join(wanted, "doc_id").select("id", "digest", "text").mapInArrow(_sets(size), "id long, tokens binary")
    if full.groupBy("doc_id").count().where("count > 1").limit(1).count():  # an id has several rows
        sets = sets.groupBy("id").agg(F.first("tokens").alias("tokens"))
    sets = written(sets, "sets")

    # 1. stars, first around the class of most neighbours, then around any outside the largest component
    weights = member.groupBy("id").agg(F.sum("n").alias("weight"))
    placed = member.select("bucket", "id", "size").join(weights, "id").withColumn("root", F.col("id"))
    links, at, turn = None, None, 0
    while True:
        pairs = written(star(placed, percent), "star")
        tried = pairs.count()
        if tried:
            new = confirmed(pairs, sets, percent, "links")
            links = new if links is None else links.unionByName(new)
            at = components(links, f"turn-{turn}")
        if not tried or new.count() * 20 < tried:
            break
        turn += 1
        open_ = _open(member, at)
        placed = open_.where("root <> main").select("bucket", "id", "size", "root", F.xxhash64("id", F.lit(turn)).alias("weight"))

    # 2. what buckets still hold in different components
    if links is not None:
        left = written(_open(member, at).select("id", "size", "root").distinct(), "left")
        n = left.count()
        rest = written(prefix_pairs(left.join(sets, "id"), n, percent), "rest") if n else None
        if n and rest.limit(1).count():
            at = components(links.unionByName(confirmed(rest, sets, percent, "rest-links")), "last")

    roots = classes.select("id", "digest", "rep", "copies")
    if at is not None:
        roots = roots.join(at.withColumnRenamed("node", "id"), "id", "left")
        low = roots.where("root is not null").groupBy("root").agg(F.min("rep").alias("low"))
        roots = roots.join(low, "root", "left").withColumn("rep", F.coalesce("low", "rep"))
    return _told(sketch, roots.select("digest", "copies", F.col("rep").alias("component_id")))


def _open(member: DataFrame, at: DataFrame | None) -> DataFrame:
    """Members of buckets that hold several components, with the largest one there."""
    placed = member.select("bucket", "id", "size")
    placed = placed.join(at.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")) if at is not None else placed.withColumn("root", F.col("id"))
    crowd = placed.groupBy("bucket", "root").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("roots"))
    return placed.join(crowd.where("roots > 1"), "bucket")


def _told(sketch: DataFrame, roots: DataFrame, most: int = 1000) -> DataFrame:
    """Rows with the component of their class. Classes of more than 1 / most of all rows, at most `most` of them, are broadcast; so no key of the join is hot."""
    rows = sketch.select("doc_id", "n_shingles", "digest")
    limit = max(1, rows.count() // most)
    large = roots.where(F.col("copies") > limit).select(F.col("digest").alias("large"), F.col("component_id").alias("large_id"))
    rows = rows.join(F.broadcast(large), F.col("digest") == F.col("large"), "left")
    alone = F.concat(F.lit("none").cast("binary"), F.xxhash64("doc_id").cast("string").cast("binary"))
    rows = rows.withColumn("key", F.when(F.col("large").isNull(), F.col("digest")))
    rows = rows.withColumn("key", F.coalesce("key", alone))
    out = rows.join(roots.where(F.col("copies") <= limit).select(F.col("digest").alias("key"), "component_id"), "key", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "large_id", "doc_id"))
    own = F.col("doc_id") == F.col("component_id")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), F.coalesce(own, F.lit(True)).alias("kept"))
