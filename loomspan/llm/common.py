"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space that separates words in every operator here.
SPACE = r"[\x20\x09-\x0D]+"

_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000, size: str = "16m") -> None:
    """Bound what one Arrow batch of whole texts holds, by rows and by bytes; texts may be long.

    Every operator sets the same values, so that a plan made earlier keeps its bounds.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


#: By owner, what empties the caches that its tasks leave in a reused worker.
_caches: dict[str, list] = {}


def cached_by(owner: str, forget) -> None:
    _caches.setdefault(owner, []).append(forget)


def release(owner: str, own: bool) -> None:
    """Empty the owner's caches, or those of all others, and hand spare memory back."""
    for name, all_of in _caches.items():
        if (name == owner) == own:
            for forget in all_of:
                forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not this C library
        pass


def released(owner: str, make):
    """The batch function of an owner, without what other operators left in the reused worker, and leaving no spare memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(owner, False)
        yield from make(batches)
        release("", True)

    return run


def summed(made: DataFrame, size: int, dtype: str = "<f8") -> np.ndarray:
    """Sum of arrays that tasks emit in pieces (at, piece), piece by piece, so that no task but the driver holds all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[at] = total.get(at, 0) + np.frombuffer(piece, "<f8")
        yield pieces_of(total.items(), dtype)

    out = np.zeros(size, dtype)
    for r in made.repartition("at").mapInArrow(run, "at long, piece binary").toLocalIterator():  # a partition at a time
        got = np.frombuffer(r.piece, dtype)
        out[r.at : r.at + len(got)] = got
    return out


def pieces_of(of: Iterable[tuple[int, np.ndarray]], dtype: str = "<f8") -> pa.RecordBatch:
    of = list(of)
    return pa.RecordBatch.from_arrays([pa.array([at for at, _ in of], pa.int64()), pa.array([x.astype(dtype).tobytes() for _, x in of], pa.binary())], ["at", "piece"])


def emitted(total: np.ndarray, piece: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """An array as rows for summed(); pieces of zeros are left out."""
    for at in range(0, len(total), piece):
        if total[at : at + piece].any():
            yield pieces_of([(at, total[at : at + piece])])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local session without the setting gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="loomspan-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder and read it again.

    The files outlive a lost executor. They are deleted when the driver ends
    or by drop_written().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/loomspan/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_written() -> None:
    while _written:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may have ended already
            return


atexit.register(drop_written)


def let(value: Column, body) -> Column:
    """body(v) with v evaluated once: a lambda variable is never inlined."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))


def fold_of(doc_id, modulus: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus
