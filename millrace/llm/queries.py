"""The registered queries of this subpackage, over the whole of their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    chat,
    decontaminate,
    importance,
    language,
    lines,
    mixing,
    neighbours,
    pieces,
    pii,
    repair,
    simhash,
    substrings,
    topk,
)
from millrace.llm.oracle import ORACLE as ORACLE  # noqa: PLC0414
from millrace.session import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_forged_chat(_table(spark, sf_dir, "conversations"))
    return chat.chat_digests(chat.format_chats(turns))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pii_digest(pii.find_pii(documents))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.tokenize_and_verify(documents, pieces.read_model()).drop("text")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").withColumn(
        "held_out", F.coalesce(language.fold(F.col("doc_id"), 4) == 2, F.lit(False))
    )
    model = language.train(documents.filter("not held_out").select("doc_id", "text", "lang"))
    return language.predict(documents.select("doc_id", "held_out", "text"), model).drop("text")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = language.fold(F.col("doc_id"), 10)
    return mixing.score_documents(
        _table(spark, sf_dir, "documents"),
        held_out=F.coalesce(fold == 0, F.lit(True)),
        mix_fold=fold == 9,
    )


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(_table(spark, sf_dir, "documents"), texts=False).drop("kept")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return simhash.hex_fingerprint(simhash.simhash_components(documents))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(documents)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damaged_and_repaired(_table(spark, sf_dir, "conversations"))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), Scratch(spark)
    )


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_pii": op3_pii,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_language": op5_language,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_neighbours": op7_neighbours,
    "op8_substrings": op8_substrings,
    "op9_simhash": op9_simhash,
    "op10_lines": op10_lines,
    "op11_repair": op11_repair,
    "op12_top_k": op12_top_k,
    "op13_importance": op13_importance,
}
