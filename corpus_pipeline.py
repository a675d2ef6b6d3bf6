"""A corpus pipeline: language, near-duplicates, benchmark passages, personal data, packing.

Every stage takes a session, its predecessor's documents and the folder of tables, and
returns documents with the columns they came with; the last one returns the pieces of
the documents with their places in sequences. Columns that a stage does not name pass
through as they are, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kudosflow.llm import best_fit_packing, decontaminate, language_id, near_duplicates, pii
from kudosflow.llm.common import all_columns, fresh, stored
from kudosflow.llm.tokens import read_tokenizer


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that language identification rejects: without letters, or far from
    every language of the labelled documents. If none is labelled there is nothing to be far
    from, and only texts without letters go, null and empty ones among them."""
    model = language_id.fit_languages(docs.where(~language_id.held_out()))
    if not model.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language_id.identify(docs, model)
    return judged.where(~F.col(judged.columns[-1])).select(all_columns(docs))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group; rows of one id are one
    document, and rows without id stay."""
    judged = near_duplicates.near_duplicates(docs)
    gone = judged.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(all_columns(docs))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a passage of the table ``benchmark``, each row by its own text;
    null and empty texts stay, and a benchmark without rows drops nothing."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put ``<KIND>`` in place of personal data; all documents stay, and null and empty texts
    stay as they are. An empty table gives an empty one."""
    spans = fresh(docs, "pii_spans")
    found = pii.find_pii(docs, spans=spans)
    redacted = found.withColumn("text", pii.redact(F.col("text"), F.col(spans)))
    return redacted.select(all_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces of at most 2,048 tokens and their places in sequences."""
    tokenizer = read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return best_fit_packing.pack_documents(docs, tokenizer)


STAGES = [
    ("language_id", identify_languages),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither the language model nor the alignment nor the packing; the
#: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
