"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds the labelled text of a bounded
sample. A text is parsed against it greedily: the longest match is one phrase,
the next phrase starts where it ended. The language that needs the fewest
phrases, normalised by the text's length, wins.

Every letter of the samples is a class of its own, whatever its script; all
letters that occur in no sample are one class, which no automaton knows, so
that each is a phrase of its own. Automata are flat tables over the most
frequent classes and sorted keys for all others, with the restart after a
failed match folded in, so that many texts step through a table together, one
character at a time. Texts are dealt to lanes of `lane` characters; a lane
begins a new phrase, for all languages alike.

Defined results: a null text, or one without a letter, is `und` with score 0;
a language is learned only from rows with text, label and id; with nothing to
learn from, every text is `und`; ties go to the first language by name;
repeated rows are predicted each for itself; an empty table gives an empty
result; columns other than the named ones are not read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cached_by, fold, released, small_batches, written

LETTER = regex.compile(r"\p{L}")
NO_LETTER = regex.compile(r"\P{L}+")
UND = "und"


def alphabet(texts: list[str], size: int = 48) -> tuple[np.ndarray, int]:
    """Class by code point, and the number of classes.

    0 for all that is no letter, 1.. for the lower-case letters that occur, most
    frequent first, with size - 1 left out: it is that of letters that do not occur.
    """
    seen = Counter("".join(texts).lower())
    ranked = sorted(((c, n) for c, n in seen.items() if c.isalpha()), key=lambda x: (-x[1], x[0]))
    known = {c: k + 1 if k < size - 2 else k + 2 for k, (c, _) in enumerate(ranked)}
    total = max(size, len(known) + 2)
    out = np.zeros(0x110000, np.uint8 if total < 255 else np.int32)  # the highest value stands for the end of a lane
    for code in range(0x40000):  # no letters from here on: unassigned, tags and private use
        c = chr(code)
        if unicodedata.category(c)[0] == "L":
            out[code] = known.get(c.lower()[:1], size - 1)
    return out, total


class Automaton(NamedTuple):
    """Suffix automaton of a sequence. The entry of a state and a class is the next state.

    Where a match cannot be extended the entry is negative: a phrase ends, and
    its absolute value is where the character leads from the start; the number
    of states stands for a class that does not occur.
    """

    table: np.ndarray  # of classes below size: entry state * size + class
    states: int
    keys: np.ndarray  # of other classes, where a match can be extended: state * total + class, ascending
    to: np.ndarray  # their next states
    again: np.ndarray  # by class: the entry where it cannot


def automaton(codes: np.ndarray, size: int, total: int) -> Automaton:
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        cur = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    count = len(step)
    again = np.full(total, -count, np.int32)
    again[list(step[0])] = [-q for q in step[0].values()]
    state = np.repeat(np.arange(count), [len(t) for t in step])
    edge = np.array([e for t in step for e in t.items()], np.int64).reshape(-1, 2)
    table = np.tile(again[:size], (count, 1))
    low = edge[:, 0] < size
    table[state[low], edge[low, 0]] = edge[low, 1]
    keys, to = state[~low] * total + edge[~low, 0], edge[~low, 1]
    order = np.argsort(keys)
    return Automaton(table.ravel(), count, keys[order], to[order], again)


def phrases(lanes: np.ndarray, a: Automaton, size: int) -> np.ndarray:
    """Phrases that each lane (a column of classes, the highest value past its end) is parsed into."""
    end, total = np.iinfo(lanes.dtype).max, len(a.again)
    rarest = np.where(lanes == end, 0, lanes).max(1) >= size if total > size else np.zeros(len(lanes), bool)
    state = np.zeros(lanes.shape[1], np.int64)
    count = np.zeros(lanes.shape[1], np.int64)
    active = lanes.shape[1]
    for row, rare in zip(lanes, rarest, strict=True):  # lanes are ordered by length, so those still running stand first
        while active and row[active - 1] == end:
            active -= 1
        if not active:
            break
        now = row[:active]
        if rare:
            to = a.table[state[:active] * size + np.minimum(now, size - 1)]
            some = np.flatnonzero(now >= size)
            key = state[some] * total + now[some]
            if len(a.keys):
                at = np.minimum(np.searchsorted(a.keys, key), len(a.keys) - 1)
                to[some] = np.where(a.keys[at] == key, a.to[at], a.again[now[some]])
            else:
                to[some] = a.again[now[some]]
        else:
            to = a.table[state[:active] * size + now]
        lone = to == -a.states  # occurs nowhere: a phrase of its own, besides the one that it ends
        count[:active] += (to < 0) + (lone & (state[:active] != 0)).astype(np.int8)
        to = np.abs(to)
        to[lone] = 0
        state[:active] = to
    return count + (state != 0)


class Parser:
    """Automata of the samples by language."""

    def __init__(self, samples: dict[str, str], size: int = 48, lane: int = 512):
        self.names, self.size, self.lane = sorted(samples), size, lane
        self.classes, total = alphabet(list(samples.values()), size)
        self.tables = [automaton(self.codes(samples[n]), size, total) for n in self.names]

    _made: dict[int, "Parser"] = {}

    @classmethod
    def of(cls, samples: dict[str, str]) -> "Parser":
        """The parser of these samples, built once in a worker."""
        key = hash(tuple(sorted(samples.items())))
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls(samples)
        return cls._made[key]

    def codes(self, text: str) -> np.ndarray:
        return self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]

    def parse(self, texts: list[str]) -> np.ndarray:
        """Phrases by text and language."""
        coded = [self.codes(t) for t in texts]
        owner, pieces = [], []
        for k, c in enumerate(coded):
            for at in range(0, len(c), self.lane):
                owner.append(k)
                pieces.append(c[at : at + self.lane])
        out = np.zeros((len(texts), len(self.names)), np.int64)
        lengths = np.array([len(p) for p in pieces], np.int64)
        order = np.argsort(-lengths, kind="stable")
        for b in range(0, len(order), 4096):
            some = order[b : b + 4096]
            lanes = np.full((len(some), lengths[some[0]]), np.iinfo(self.classes.dtype).max, self.classes.dtype)
            for i, j in enumerate(some):
                lanes[i, : lengths[j]] = pieces[j]
            lanes = np.ascontiguousarray(lanes.T)
            own = np.array([owner[j] for j in some])
            for k, table in enumerate(self.tables):
                np.add.at(out[:, k], own, phrases(lanes, table, self.size))
        return out


cached_by("language_id", Parser._made.clear)


def labelled_sample(docs: DataFrame, doc_id: str, text: str, lang: str, where, docs_per_language: int, chars_per_language: int, most_docs: int, most_chars: int) -> dict[str, str]:
    """Text by language, from the rows of lowest hash of their id: pieces that begin anywhere in a text.

    Every language that occurs is learned. Where there are many, each gets its
    share of most_docs documents (one at least) and of most_chars characters (200 at least).
    """
    rows = docs.where(where & F.col(text).isNotNull() & (F.col(text) != "") & F.col(lang).isNotNull() & F.col(doc_id).isNotNull())
    rows = rows.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    languages = max(1, sizes.count())
    n = max(1, min(docs_per_language, most_docs // languages))
    chars = max(200, min(chars_per_language, most_chars // languages))
    # four times as long as needed if all texts were that long, and longer where a language has few documents
    each = F.greatest(F.lit(4 * chars // n), F.ceil(F.lit(2 * chars) / F.col("rows"))).cast("int")
    begin = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.greatest(F.lit(1), F.length("text") - each + 1)).cast("int") + 1
    every = rows.join(F.broadcast(sizes) if languages <= 10_000 else sizes, "lang")
    piece = [F.col("lang"), F.col("doc_id"), F.xxhash64("text").alias("h"), F.substring(F.col("text"), begin, each).alias("piece")]
    # of distinct ids, twice as many as needed have a hash below this one; languages that repeated ids leave short are read in full
    low = (F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5) * F.col("rows") <= 2 * n + 20
    pieces = written(every.where(low).select(*piece), "pieces")
    found = sizes.join(pieces.groupBy("lang").agg(F.count("*").alias("found")), "lang", "left")
    short = found.where(F.coalesce("found", F.lit(0)) < F.least("rows", F.lit(n))).select("lang")
    if short.limit(1).count():
        pieces = pieces.join(short, "lang", "left_anti").unionByName(every.join(short, "lang", "left_semi").select(*piece))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "h")
    chosen = pieces.withColumn("n", F.row_number().over(order)).where(F.col("n") <= n)
    out: dict[str, list[str]] = {}
    held: Counter = Counter()
    for r in chosen.orderBy("n", "lang").toLocalIterator():
        if held[r.lang] < chars:
            out.setdefault(r.lang, []).append(r.piece[: chars - held[r.lang]])
            held[r.lang] += len(out[r.lang][-1]) + 1
    return {k: " ".join(v) for k, v in out.items()}


def identify(docs: DataFrame, samples: dict[str, str], text: str = "text") -> DataFrame:
    """docs with lang_pred, score and letters_per_phrase; columns of these names are replaced.

    score: 1 - fewest phrases / phrases of the runner-up (1 if there is one language only).
    letters_per_phrase: of the language that wins; low where no learned language fits, 0 for `und`.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("lang_pred", "score", "letters_per_phrase")
    sent = spark.sparkContext.broadcast(samples)  # bounded by the sample's parameters
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser.of(sent.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            told = [k for k, t in enumerate(texts) if parser.names and LETTER.search(t)]
            pred, score, per = [UND] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            if told:
                counts = parser.parse([texts[k] for k in told])
                best = counts.argmin(1)
                for i, k in enumerate(told):
                    pred[k] = parser.names[best[i]]
                    per[k] = len(NO_LETTER.sub("", texts[k])) / counts[i].min()
                    ranked = np.sort(counts[i])
                    score[k] = float(1 - ranked[0] / ranked[1]) if len(ranked) > 1 else 1.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(per, pa.float64())], [*batch.schema.names, "lang_pred", "score", "letters_per_phrase"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", lang_pred string, score double, letters_per_phrase double"
    return docs.mapInArrow(released("language_id", run), schema)


def learn(docs: DataFrame, docs_per_language: int = 240, chars_per_language: int = 40_000, most_docs: int = 60_000, most_chars: int = 4_000_000, held_out: int = 2, folds: int = 4, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, str]:
    """Labelled text by language of the documents outside fold held_out; the four bounds fix the size of the sample."""
    return labelled_sample(docs, doc_id, text, lang, fold(doc_id, folds) != held_out, docs_per_language, chars_per_language, most_docs, most_chars)


def predict(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, learned from the rows outside the held-out fold."""
    samples = learn(docs, **options)
    rows = docs.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text")
    return identify(rows, samples).select("doc_id", "held_out", "lang_pred", "score")
