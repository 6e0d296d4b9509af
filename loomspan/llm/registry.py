"""The queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, language_id, quality_rules
from .common import table
from .fingerprints import fingerprint_edits
from .lm_scoring import score_documents
from .mixing import mix
from .near_dedup import near_duplicates
from .packing import pack
from .token_counts import count_tokens
from .url_filters import judge_urls

#: The rules of op4.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), byte_bpe(), window=1024, end_id=0, with_ids=False)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), byte_bpe(), limit=1024)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = quality_rules.judge(docs, host="source", drop_text=True)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = r"\### Assistant: </turn> ok"
    two = [(-7, 0, "user", extra), (-7, 1, "assistant", extra)]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(two, "conv_id long, turn long, role string, text string"))
    return chat_format.digests(chat_format.format_conversations(turns.withColumn("parts", chat_format.text_parts(F.col("text")))))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), max_repeats=2.0)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), byte_bpe())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_token_counts, op3_quality_rules, op4_url_filters, op5_language_id, op6_near_dedup, op7_chat_format, op8_fingerprints, op9_mixing, op10_lm_scoring)}


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": quality_rules.ORACLE_SQL, "op7_chat_format": chat_format.ORACLE_SQL}
