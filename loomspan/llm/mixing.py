"""Mixing sources to target weights by temperature.

A source's weight is its share of tokens to the power of an exponent between 0
and 1. The exponent is bisected, many candidates to a pass over the table of
sources, until the weights reach a target entropy or until no source is
repeated more often than a limit (relative to the budget). Weights become
token budgets; a budget is realised as whole epochs and a last, partial one.
In each epoch a source's blocks (documents dealt by hash) stand in a new
order, and documents stand in a new order within their block; the last epoch
takes blocks in order while the budget lasts, and of the block in which it
ends the first documents.

Without a budget, the smallest one under which every document is drawn at
least once is taken.

Defined results: a null source is a source of its own; documents without
tokens are drawn once; a null text has no tokens; repeated rows are drawn each
for itself; an empty table gives an empty result; other columns pass through,
unless their names are among the new ones, which replace them.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

NEW = ("n_tokens", "epoch", "block", "block_rank", "doc_rank", "weight")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _facts(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent the entropy of the weights, and the ratio of the most to the least repeated source."""
    share = F.col("share")
    cols = []
    for k, a in enumerate(exponents):
        w = F.pow(share, F.lit(a))
        cols += [F.sum(w).alias(f"z{k}"), F.sum(w * F.log(share)).alias(f"l{k}"), F.max(w / share).alias(f"h{k}"), F.min(w / share).alias(f"m{k}")]
    r = sources.agg(*cols).first()
    return [(log(r[f"z{k}"]) - a * r[f"l{k}"] / r[f"z{k}"], r[f"h{k}"] / r[f"m{k}"]) for k, a in enumerate(exponents)]


def exponent(sources: DataFrame, max_repeats: float | None, entropy: float | None, passes: int = 6, grid: int = 16) -> float:
    """Smallest exponent whose repetition ratio is at most max_repeats, or the largest whose entropy is at least the target."""
    low, high = 0.0, 1.0
    for _ in range(passes):
        points = [low + (high - low) * k / grid for k in range(grid + 1)]
        facts = _facts(sources, points)
        if max_repeats is not None:
            good = [ratio <= max_repeats * (1 + 1e-12) for _, ratio in facts]  # false, then true
            first = good.index(True) if True in good else grid
            low, high = points[max(0, first - 1)], points[first]
        else:
            good = [h >= entropy - 1e-12 for h, _ in facts]  # true, then false
            last = max((k for k, g in enumerate(good) if g), default=0)
            low, high = points[last], points[min(grid, last + 1)]
        if low == high:
            break
    return high if max_repeats is not None else low


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", tokens: Column | None = None, max_repeats: float | None = 2.0, entropy: float | None = None, budget_tokens: float | None = None, block_tokens: int = 500_000, most_blocks: int = 1 << 20, most_sources: int = 100_000, seed: int = 17, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each draw: the id, the source, n_tokens, epoch, block, block_rank, doc_rank, weight.

    Ordering by epoch, block_rank, doc_rank gives each source's stream.
    tokens: number of tokens of a row; by default the words of column text.
    keep: further columns of docs, carried along with one shuffle by block; the
    rows of a block and epoch then stand together, in the order of the draw.
    A source has a block for every block_tokens tokens, most_blocks at most; larger sources have larger blocks.
    most_sources: up to so many, the table of sources is broadcast; beyond, joined.
    """
    if (max_repeats is None) == (entropy is None):
        raise ValueError("give either max_repeats or entropy")
    kept = F.struct(*keep) if keep else F.lit(None).cast("boolean")
    wide = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), (n_words(F.col("text")) if tokens is None else tokens.cast("long")).alias("n_tokens"), kept.alias("__kept"))
    t = written(wide.drop("__kept"), "mixing")
    totals = t.groupBy("source").agg(F.sum("n_tokens").alias("total"))
    everything = totals.agg(F.sum("total").alias("n"), F.count("*").alias("sources")).first()
    if not everything.n:
        return wide.select("doc_id", "source", "n_tokens", *[F.lit(0).cast("long").alias(c) for c in NEW[1:5]], F.lit(0.0).alias("weight"), *[F.col(f"__kept.{c}") for c in keep])
    sources = written(totals.withColumn("share", F.col("total") / F.lit(float(everything.n))), "sources")
    full = sources.where("total > 0")
    a = exponent(full, max_repeats, entropy)
    z = full.agg(F.sum(F.pow("share", F.lit(a))).alias("z"), F.max(F.pow("share", F.lit(1 - a))).alias("m")).first()
    budget = float(budget_tokens) if budget_tokens is not None else z.z * z.m * everything.n  # the source of most tokens comes to one epoch
    weight = F.when(F.col("total") > 0, F.pow("share", F.lit(a)) / F.lit(z.z)).otherwise(F.lit(0.0))
    want = F.when(F.col("total") > 0, F.col("weight") * F.lit(budget)).otherwise(F.lit(0.0))
    plan = sources.withColumn("weight", weight).withColumn("want", want)
    epochs = F.when(F.col("total") > 0, F.floor(F.col("want") / F.col("total") + 1e-9)).otherwise(F.lit(1))
    plan = plan.withColumn("epochs", epochs).withColumn("rest", F.greatest(F.col("want") - F.col("epochs") * F.col("total"), F.lit(0.0)))
    plan = plan.withColumn("blocks", F.greatest(F.lit(1), F.least(F.lit(most_blocks), F.ceil(F.col("total") / block_tokens))))
    # a number for each source, so that a null source needs no null-safe key, and one shuffle serves the join and the windows
    plan = written(plan.select(F.col("source").alias("of"), "weight", "epochs", "rest", "blocks", "total").withColumn("sid", F.monotonically_increasing_id()), "weights")

    def deal(rows: DataFrame) -> DataFrame:
        both = rows.join(F.broadcast(plan) if everything.sources <= most_sources else plan, F.col("source").eqNullSafe(F.col("of")))
        return both.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("blocks")))

    # order of blocks in each epoch, and what is left of the budget before each
    last = F.when(F.col("rest") > 0, F.col("epochs")).otherwise(F.col("epochs") - 1).cast("int")
    block = deal(t).groupBy("sid", "block").agg(F.sum("n_tokens").alias("size"), F.first("epochs").alias("epochs"), F.first("rest").alias("rest"))
    block = block.withColumn("epoch", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))))
    turn = Window.partitionBy("sid", "epoch").orderBy(F.xxhash64("block", "epoch", F.lit(seed)), "block")
    before = F.coalesce(F.sum("size").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    block = block.withColumn("block_rank", F.row_number().over(turn).cast("long")).withColumn("left", F.when(F.col("epoch") < F.col("epochs"), F.lit(float("inf"))).otherwise(F.col("rest") - before))
    block = block.where("left > 0").select("sid", "block", "epoch", "block_rank", "left")
    draws = deal(wide if keep else t.withColumn("__kept", F.lit(None))).select("doc_id", "source", "n_tokens", "weight", "sid", "block", "__kept").join(block, ["sid", "block"])
    order = Window.partitionBy("sid", "block", "epoch").orderBy(F.xxhash64("doc_id", "epoch", F.lit(seed)), "doc_id")
    draws = draws.withColumn("doc_rank", F.row_number().over(order).cast("long")).withColumn("used", F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    drawn = (F.col("used") <= F.col("left")) & ((F.col("n_tokens") > 0) | (F.col("epoch") == 0))
    return draws.where(drawn).select("doc_id", "source", "n_tokens", F.col("epoch").cast("long"), F.col("block").cast("long"), "block_rank", "doc_rank", "weight", *[F.col(f"__kept.{c}") for c in keep])


def temperature(share_high: float, share_low: float, max_repeats: float) -> float:
    """The exponent in closed form, for tests: (high / low) ** (1 - a) = max_repeats."""
    return max(0.0, 1 - log(max_repeats) / log(share_high / share_low)) if share_high > share_low else 0.0


def perplexity(entropy: float) -> float:
    return exp(entropy)
