"""The registered queries of the operators: whole tables, production parameters, contract columns."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.llm import (
    alignment,
    decontamination,
    embedding_dedup,
    html_text,
    jaccard_join,
    language,
    licenses,
    manifest,
    mixing,
    packing,
    quality,
    sharding,
    token_counts,
)
from dugout.llm.sql import SQL

# Folder of the vocabulary files; None asks the installed package that holds them.
VOCABULARIES = os.environ.get("TOKENIZER_DIR")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SEQUENCE = 2048
TOKEN_LIMIT = 512
SHARDS = 40


def vocabulary(name: str) -> str:
    if VOCABULARIES:
        return os.path.join(VOCABULARIES, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Workers started by this session find the package even where it is not installed.
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), SEQUENCE)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(documents(spark, sf_dir))
    held_out = F.coalesce(~language.in_training(F.col("doc_id")), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), SHARDS)


def op6_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(documents(spark, sf_dir))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), TOKEN_LIMIT)


def op10_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_report(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    rows = manifest.manifest(manifest.document_leaves(documents(spark, sf_dir), tampered, changed))
    proof = F.sha2(F.array_join(F.col("path.digest"), ""), 256)
    folded = F.element_at("copies", -1)
    return rows.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof.alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_language_id,
        op3_license_scan,
        op4_html_main_text,
        op5_jump_sharding,
        op6_divergence_rules,
        op7_ngram_jaccard_join,
        op8_embedding_near_dedup,
        op9_token_counts,
        op10_pivotal_mix,
        op11_benchmark_decontamination,
        op12_merkle_manifest,
        op13_token_alignment,
    )
}

__all__ = ["QUERIES", "SQL"]
