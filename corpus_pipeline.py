"""Raw documents to token ids: language, near-duplicates, benchmark leaks, personal data, tokens.

Every stage reads what the one before kept, written as Parquet in the shared folder, so
a lost executor repeats one stage at most.  All stages but the last give the columns of
``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.llm import bpe, decontaminate, langid, pii, simhash
from lacuna.llm.common import table
from lacuna.session import work_dir

RANKS = "byte_bpe_multi_50k.tiktoken"


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a learned language stay; a null text or one without a letter goes."""
    found = langid.predict(docs, langid.learn(docs), with_row=True)
    return found.where("lang <> 'und'").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least id of every group at Jaccard 4/5 or more on shingles of five words stays.

    Rows are told apart by all their columns, never by id; rows without an id come last.
    """
    cells = [*docs.columns, *(F.col(c).isNull() for c in docs.columns)]
    rows = docs.withColumns({"_key": F.xxhash64(*cells), "_h": F.xxhash64(F.lit("h"), *reversed(cells))})
    found = simhash.similar(rows.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"),
                                        F.col("_key").alias("key"), F.col("_h").alias("h")), shingle=5)
    heads = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "key", "h")).alias("head"))
    heads = heads.select(F.col("head.key").alias("_key"), F.col("head.h").alias("_h"))
    return rows.join(heads, ["_key", "_h"]).dropDuplicates(["_key", "_h"]).select(docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ten or more words shared with a test item are cut out; a document that is nearly all test items goes."""
    return _counted(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _counted(pii.mask(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, ids_sha256, decoded_sha256)."""
    coded = bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN,
                           keep=["lang", "source"], with_ids=True)
    return coded.select(F.col("id").alias("doc_id"), "row.lang", "row.source", "n_tokens", "ids", "ids_sha256",
                        "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data), ("tokens", tokens)]

#: SQL can state neither the language model nor the fingerprints; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
