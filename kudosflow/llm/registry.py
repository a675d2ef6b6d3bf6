"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers

from kudosflow.llm import (
    best_fit_packing,
    chat_format,
    collocations,
    decontaminate,
    importance_resampling,
    language_id,
    near_duplicates,
    periodic_runs,
    pii,
    quality_rules,
    sharding,
    token_files,
    url_rules,
)
from kudosflow.llm.common import let, table
from kudosflow.llm.tokens import read_tokenizer
from kudosflow.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents", "doc_id", "text"))
    return judged.drop("text").withColumn("failed_rules", F.array_join("failed_rules", ","))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark")
    )


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        table(spark, sf_dir, "labels", "doc_id", "quality"),
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates.near_duplicates(documents, scheme=near_duplicates.Scheme(words=4))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    base = [kind.name for kind in pii.BASE]

    def digest(spans):
        def count(kind):
            return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

        counts = [count(kind.name).alias(f"n_{kind.name}") for kind in pii.KINDS]
        based = F.filter(spans, lambda s: s["kind"].isin(*base))
        return F.struct(
            *counts,
            F.sha2(pii.spans_text(based), 256).alias("base_sha256"),
            pii.spans_text(spans).alias("spans"),
        )

    found = pii.find_pii(documents).select("doc_id", let(F.col("pii_spans"), digest).alias("d"))
    return found.select("doc_id", "d.*")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    tokenizer = read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return best_fit_packing.pack_documents(documents, tokenizer)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokenizer = read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    token_files.write_token_files(documents, path, tokenizer)
    return token_files.read_token_files(spark, path)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language_id.fit_languages(documents.where(~language_id.held_out()))
    judged = language_id.identify(documents.drop("lang"), model)
    return judged.select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected"
    )


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_rules.filter_urls(pages, url_rules.PAGE_RULES).drop("url")


def _planted(number: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document repeats its words from some place on."""
    drawn = zlib.crc32(str(number).encode())
    if number is None or drawn % 10 or not words:
        return words
    seed, n = drawn // 10, len(words)
    start = seed % n
    period = 1 + (n - start) // (3 + seed % 8)
    unit = words[start : start + period]
    return words[:start] + (unit * -(-(n - start) // period))[: n - start]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    found = periodic_runs.periodic_runs(documents, change=_planted)
    most = periodic_runs.foremost(F.col("runs"))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        most.alias("most"),
        F.sha2(periodic_runs.written_runs(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "most.start",
        "most.length",
        "most.period",
        F.expr("1000L * most.length DIV most.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    records = chat_format.as_records(rows.unionByName(own), ["turn", "role", "text"])
    formatted = chat_format.format_turns(chat_format.canonical_turns(records))
    return chat_format.read_back(formatted)


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_decontaminate": op2_decontaminate,
        "op3_importance_resampling": op3_importance_resampling,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_pii": op5_pii,
        "op6_sharding": op6_sharding,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_token_files": op8_token_files,
        "op9_language_id": op9_language_id,
        "op10_url_rules": op10_url_rules,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_collocations": op12_collocations,
        "op13_chat_format": op13_chat_format,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_rules.ORACLE_SQL,
        "op4_near_duplicates": near_duplicates.ORACLE_SQL,
        "op5_pii": pii.ORACLE_SQL,
        "op10_url_rules": url_rules.ORACLE_SQL,
        "op12_collocations": collocations.ORACLE_SQL,
        "op13_chat_format": chat_format.ORACLE_SQL,
    }
