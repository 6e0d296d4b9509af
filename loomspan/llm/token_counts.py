"""Token counts of whole documents without materialising token ids.

Each text is cut into pre-tokens where the tokenizer can never merge (see
pieces). The corpus vocabulary of distinct pre-tokens is gathered with partial
sums, each is counted once, and the counts are joined to the pre-token
frequencies of each document and summed. The most frequent pre-tokens, at most
`head` of them and none longer than `head_chars`, travel as a broadcast of that
bounded size and are summed where the document is read; all others go through
a shuffled join, so the result is exact for any vocabulary.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted each for itself; an empty table gives an empty result; columns
other than the id and the text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, small_batches, written
from .pieces import PieceEncoder, cut


def frequencies(text: str | None) -> Counter:
    """Pre-tokens of a text and how often each occurs."""
    return Counter(cut(text)) if text else Counter()


def _distinct(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out():
            got = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["piece", "n"])
            found.clear()
            return got

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    found.update(cut(text))
            if len(found) > held:
                yield out()
        yield out()

    return run


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of(path)
        for batch in batches:
            yield batch.append_column("n_tokens", pa.array([encoder.count(p) for p in batch.column(0).to_pylist()], pa.int64()))

    return released("pieces", run)


def vocabulary(docs: DataFrame, tokenizer_path: str, text: str = "text", held: int = 500_000) -> DataFrame:
    """piece, n (occurrences in the corpus), n_tokens (counted once)."""
    distinct = docs.select(F.col(text).alias("text")).mapInArrow(_distinct(held), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return distinct.mapInArrow(_counted(tokenizer_path), "piece string, n long, n_tokens long")


def most_frequent(values: DataFrame, most: int) -> DataFrame:
    """The rows of highest n, by a threshold that at most `most` rows reach.

    The threshold comes from a histogram of n on a logarithmic scale, so no task
    sorts and the driver gets no candidates but the rows themselves.
    """
    step = F.floor(F.log2("n") * 16)
    found, low = 0, None
    for r in values.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect():
        found += r.rows
        if found > most:
            break
        low = r.step
    return values.where(step >= low) if low is not None else values.where(F.lit(False))


def sum_values(docs: DataFrame, frequencies, values: DataFrame, defaults: dict[str, float], head: int, head_chars: int, extras=None, extra_schema: str = "", key_type: str = "string", through=None) -> DataFrame:
    """The columns of docs but text, and for each name in defaults the sum over a document's keys of times * value.

    docs: any columns, the last one text. frequencies: Counter of keys of a text.
    values: key, n (by which the head is chosen) and a double column per name;
    a key without a row has the default. extras: arrays for a batch of texts,
    further columns by extra_schema. through: what the read documents pass
    before the join; it may change the further columns. One row of a document,
    that without a key, holds them.
    """
    spark, names = docs.sparkSession, list(defaults)
    top = most_frequent(values.where(F.length("key") <= head_chars), head)  # bounded by head * head_chars
    common = spark.sparkContext.broadcast({bytes(r.key) if key_type == "binary" else r.key: tuple(r[n] for n in names) for r in top.select("key", *names).collect()})
    own, extra = docs.columns[:-1], [x.split()[0] for x in extra_schema.split(", ") if x]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row, none = common.value, TaskContext.get().partitionId() << 40, (0.0,) * len(names)
        for batch in batches:
            rows, src, keys, times, sums = [], [], [], [], []
            texts = batch.column(len(own)).to_pylist()
            for k, t in enumerate(texts):
                at, total = len(src), [0.0] * len(names)
                rows.append(row)
                src.append(k)
                keys.append(None)
                times.append(None)
                sums.append(none)
                for key, n in frequencies(t).items():
                    value = known.get(key)
                    if value is None:
                        rows.append(row)
                        src.append(None)
                        keys.append(key)
                        times.append(n)
                        sums.append(none)
                    else:
                        for j, v in enumerate(value):
                            total[j] += n * v
                sums[at] = total
                row += 1
            at = pa.array(src, pa.int64())
            cols = [pa.array(rows, pa.int64()), pa.array(keys, pa.binary() if key_type == "binary" else pa.string()), pa.array(times, pa.int32())]
            cols += [pa.array([x[j] for x in sums], pa.float64()) for j in range(len(names))]
            cols += [batch.column(j).take(at) for j in range(len(own))] + [c.take(at) for c in (extras(texts) if extras else [])]
            yield pa.RecordBatch.from_arrays(cols, ["row", "key", "times", *[f"known_{n}" for n in names], *own, *extra])

    schema = f"row long, key {key_type}, times int, " + ", ".join([f"known_{n} double" for n in names] + [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own]) + (", " + extra_schema if extra else "")
    parts = docs.mapInArrow(split, schema)
    if through:
        parts = through(parts)
    carried = parts.columns[3 + len(names) :]
    # a document's own row has no key; one of its own keeps those rows from meeting in one task
    keyed = parts.withColumn("found", F.coalesce("key", F.concat(F.lit("\0"), F.col("row").cast("string")).cast(key_type))).join(values.select(F.col("key").alias("found"), *names), "found", "left")
    terms = [F.sum(F.when(F.col("key").isNull(), F.col(f"known_{n}")).otherwise(F.col("times") * F.coalesce(F.col(n), F.lit(float(d))))).alias(n) for n, d in defaults.items()]
    return keyed.groupBy("row").agg(*[F.max(c).alias(c) for c in carried], *terms).drop("row")


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, head: int = 250_000, head_chars: int = 32, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), a row for each row of docs."""
    small_batches(docs.sparkSession)
    vocab = written(vocabulary(docs, tokenizer_path, text), "vocabulary")
    values = vocab.select(F.col("piece").alias("key"), "n", F.col("n_tokens").cast("double").alias("n_tokens"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    summed = sum_values(rows, frequencies, values, {"n_tokens": 0}, head, head_chars).withColumn("n_tokens", F.col("n_tokens").cast("long"))
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
