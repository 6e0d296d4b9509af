"""Packing token sequences into windows by non-negative least squares.

Every document becomes its token ids and one end id, cut into full windows and
one tail. Lengths are packed, not documents: the histogram of piece lengths
(at most one count per length up to the window) goes to the driver, shallow
combinations of lengths that fill a window are enumerated, non-negative least
squares gives how often each is used, the counts are rounded within what the
histogram holds, and what remains is packed greedily, longest first. The plan
has a size bounded by the window; documents find their slot by their rank
among the pieces of the same length.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each for itself; an empty table gives an empty result; columns other
than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import released, small_batches, written
from .pieces import PieceEncoder

RANK_BITS = 50


def combinations_filling(window: int, present: np.ndarray, depth: int = 3) -> np.ndarray:
    """Rows of up to depth lengths, descending and padded with 0, that sum to window and are all present."""
    have = np.zeros(window + 1, bool)
    have[present] = True
    rows = [np.array([[window, 0, 0]])] if have[window] else []
    lengths = np.flatnonzero(have[:window])
    lengths = lengths[lengths > 0]
    if depth >= 2 and len(lengths):
        a = lengths[lengths * 2 >= window]
        a = a[have[window - a]]
        rows.append(np.stack([a, window - a, 0 * a], 1))
    if depth >= 3 and len(lengths):
        a, b = np.meshgrid(lengths, lengths, indexing="ij")
        c = window - a - b
        ok = (a >= b) & (b >= c) & (c > 0)
        ok &= have[np.clip(c, 0, window)]
        rows.append(np.stack([a[ok], b[ok], c[ok]], 1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), int)


def repeat_counts(combos: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """x >= 0 that brings sum of x * combo near the histogram in least squares (accelerated projected gradient)."""
    if not len(combos):
        return np.zeros(0)
    n = len(counts)
    used = combos > 0

    def times(x):  # lengths used by x
        out = np.zeros(n)
        for k in range(combos.shape[1]):
            out += np.bincount(combos[:, k], weights=x * used[:, k], minlength=n)
        return out

    def back(r):
        return (r[combos] * used).sum(1)

    target = counts.astype(float).copy()
    target[0] = 0
    v = np.ones(len(combos))
    for _ in range(12):  # largest eigenvalue, for the step
        v = back(times(v))
        v /= np.linalg.norm(v) or 1
    step = 1 / max(1e-9, np.linalg.norm(back(times(v))))
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(times(y) - target))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan(counts: np.ndarray, window: int, depth: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences) that use each length exactly as often as counts has it."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    out: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        out.append(((window,), int(left[window])))
        left[window] = 0
    combos = combinations_filling(window, np.flatnonzero(left), depth)
    x = repeat_counts(combos, left)
    whole = np.diff(np.rint(np.cumsum(x)), prepend=0).astype(np.int64)  # rounding that keeps the sum
    for row, want in sorted(zip(combos[whole > 0].tolist(), whole[whole > 0].tolist(), strict=True), key=lambda z: -z[1]):
        parts = [p for p in row if p]
        most = min(want, *(int(left[p]) // parts.count(p) for p in parts))
        if most > 0:
            out.append((tuple(parts), most))
            for p in parts:
                left[p] -= most
    while left.any():  # each turn uses up a length at least
        parts, room, trial = [], window, left.copy()
        while room > 0:
            fits = np.flatnonzero(trial[: room + 1])
            if not len(fits):
                break
            parts.append(int(fits[-1]))
            trial[fits[-1]] -= 1
            room -= int(fits[-1])
        times = min(int(left[p]) // parts.count(p) for p in set(parts))
        out.append((tuple(parts), times))
        for p in parts:
            left[p] -= times
    return out


def slots(packed: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each run of ranks of a length: key (length and first rank), first sequence, offset; sorted by key."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for parts, times in packed:
        offset = 0
        for p in parts:
            rows.append(((p << RANK_BITS) + rank.get(p, 0), sequence, offset))
            rank[p] = rank.get(p, 0) + times
            offset += p
        sequence += times
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 3)
    return a[:, 0], a[:, 1], a[:, 2]


def _cut_documents(id_type: str, path: str, window: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, part = PieceEncoder.of(path), np.zeros(window + 1, np.int64), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            owner, start, length, crc, total, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                got = encoder.encode(text or "") + end
                n = len(got) // 4
                for s in range(0, n, window):
                    piece = got[4 * s : 4 * min(n, s + window)]
                    owner.append(row)
                    start.append(s)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<i4"))
            lengths = np.array(length, np.int64)
            order = np.argsort(lengths, kind="stable")
            by = lengths[order]
            first = np.searchsorted(by, by)
            rank = np.empty(len(by), np.int64)
            rank[order] = np.arange(len(by)) - first
            rank += seen[lengths]
            seen += np.bincount(lengths, minlength=window + 1)
            cols = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(start, pa.int64()), pa.array(lengths), pa.array(crc, pa.int64()), pa.array(total, pa.int64()), pa.array(np.full(len(by), part, np.int64)), pa.array(rank)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "part_rank"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return released("pieces", run), f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, part long, part_rank long" + ", ids array<int>" * with_ids


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0, depth: int = 3, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    tokenizer_path: a tokenizers JSON file of a byte-level BPE, present on every executor.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    run, schema = _cut_documents(docs.schema["doc_id"].dataType.simpleString(), tokenizer_path, window, end_id, with_ids)
    pieces = written(docs.mapInArrow(run, schema), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(window + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # window rows at most
        counts[r.length] = r.n
    key, sequence, offset = slots(plan(counts, window, depth))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = spark.sparkContext.broadcast((key, sequence, offset))  # bounded by the window, not by the data

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sequence, offset = placed.value
        for batch in batches:
            table = pa.Table.from_batches([batch])
            want = (table["length"].to_numpy() << RANK_BITS) + table["rank"].to_numpy()
            at = np.searchsorted(key, want, side="right") - 1
            table = table.drop_columns(["rank"]).append_column("sequence_id", pa.array(sequence[at] + want - key[at])).append_column("offset", pa.array(offset[at]))
            yield from table.to_batches()

    ranked = pieces.join(first, ["part", "length"]).withColumn("rank", F.col("first") + F.col("part_rank"))
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else []), "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank") + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)
