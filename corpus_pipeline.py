"""A corpus pipeline over ``documents``: five stages, each written and read again.

Every stage takes a session, the documents that its predecessor kept and the folder of the
tables, and returns documents with all their columns; the last one adds the token ids.

Defined results: documents whose text is null or has no letters go in the first stage, also where
nothing is labelled, when all go; of rows with equal columns the later ones go as near-duplicates,
or as emptied by line deduplication; a null doc_id is an ordinary value and comes last where order
decides; texts of any length are read whole; empty documents give no rows, and an empty benchmark
removes none; columns beside those of ``documents``, whatever their names, stay through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, language, lines, pieces, simhash
from millrace.session import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null, without letters, or beyond the reach of every centroid."""
    model = language.train(docs.select("doc_id", "text", "lang"))
    return language.predict(docs, model).filter("not rejected").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one line of each group of similar lines; a document left with no line goes."""
    found = lines.dedup_lines(docs).filter("n_removed = 0 or n_removed < n_lines")
    return found.withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked fingerprints."""
    return simhash.keep_one(docs).select(*docs.columns)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a part of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token ids, their number, and whether decoding gives the text back."""
    return pieces.tokenize_and_verify(docs, pieces.read_model())


STAGES: list[tuple[str, Stage]] = [
    ("language identification", identify_language),
    ("line deduplication", dedup_lines),
    ("SimHash near-duplicates", dedup_documents),
    ("benchmark decontamination", remove_benchmark),
    ("SentencePiece encoding", tokenize),
]

#: No SQL twin: k-means, MinHash and the tokenizer have no SQL form (see tests/llm).
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``; intermediate results go to the shared folder."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs, _ = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
