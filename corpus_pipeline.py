"""Documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the docs of the next one. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm import language_id, near_dedup, quality_rules
from loomspan.llm.common import table, written
from loomspan.llm.mixing import mix
from loomspan.llm.packing import pack
from loomspan.llm.registry import byte_bpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host does."""
    return quality_rules.judge(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is recognised, with lang set to it; learned from the labelled rows of this stage's input.

    Rejected: texts without a letter, and those whose script no learned language
    has: a letter that occurs in no sample is a phrase of its own, so that the
    best language has about one letter to a phrase. Texts of a learned language
    have three and more, and 1.6 at least where most of a short one is numbers.
    """
    found = language_id.identify(docs.select(*COLUMNS), language_id.learn(docs))
    fits = (F.col("lang_pred") != language_id.UND) & (F.col("letters_per_phrase") >= 1.25)
    return found.where(fits).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the smallest id.

    A document is an id and a text: exact repeats of both are one document,
    rows of one id with different texts are several, and so are rows without an id.
    """
    docs = docs.select(*COLUMNS, F.struct("doc_id", F.xxhash64("text").alias("h")).alias("key"))
    kept = near_dedup.near_duplicates(docs, percent=85, doc_id="key").where("kept").select(F.col("doc_id").alias("key")).distinct()
    return docs.join(kept, "key", "left_semi").dropDuplicates(["key"]).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of small sources again, until no source is repeated more than twice as often as another.

    The rows of a block and epoch stand together, in the order of the draw.
    Rows of one id, and rows without one, are drawn each for itself.
    """
    return mix(docs.select(*COLUMNS), max_repeats=2.0, keep=("text", "lang", "n_chars")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, byte_bpe(), window=1024, end_id=0, with_ids=False)


STAGES = [("quality rules", quality), ("language ID", language), ("MinHash near-dedup", near_dedup_stage), ("mixing sources to target weights", mixing), ("packing", packing)]

#: Cross parsing, hashing and packing have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
