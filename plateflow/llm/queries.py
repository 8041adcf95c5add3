"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plateflow.llm import (
    byte_bpe,
    chat_format,
    collocations,
    conversation_repair,
    decontamination,
    license_scan,
    line_dedup,
    oracles,
    quality_rules,
    sharding,
    simhash_dedup,
    source_mixing,
    substring_dedup,
    suffix_dedup,
)
from plateflow.llm.common import materialise, scan

# File of token ranks among the public tokenizers.
TOKENIZER = "byte_bpe_multi_50k.tiktoken"
# A conversation whose texts hold the template's own control strings.
TRICKY_TEXT = r"\### Assistant: </turn> ok"
TRICKY_TURNS = [(-7, 0, "user", TRICKY_TEXT), (-7, 1, "assistant", TRICKY_TEXT)]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(scan(spark, sf_dir, "documents"), "doc_id")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(
        scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "item_id", "n_shingles", "n_shared", "containment")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_spans(scan(spark, sf_dir, "documents")).drop("t")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_manifest(scan(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(scan(spark, sf_dir, "documents")).drop("detections")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(scan(spark, sf_dir, "pages")).drop("html")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix as documents and passes; their texts stay where they are."""
    docs = scan(spark, sf_dir, "documents")
    counted = docs.select("doc_id", "source", source_mixing.token_count(docs["text"]).alias("n_words"))
    rows = materialise(counted, "document-words")
    return source_mixing.mix(rows, tokens=rows["n_words"]).drop("n_words")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = scan(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(TRICKY_TURNS, "conv_id bigint, turn bigint, role string, text string")
    return chat_format.read_back(chat_format.format_turns(turns.unionByName(tricky)))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicate_groups(scan(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digest(scan(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.read_vocabulary(public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    docs = scan(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode_texts(docs, vocabulary).select("doc_id", "token_ids")
    return byte_bpe.decode_ids(encoded, vocabulary).select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(scan(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(spark, sf_dir, "conversations")
    turns = conversation_repair.damage(rows)
    audits = materialise(conversation_repair.audit_turns(turns, rows), "audits")
    digests = conversation_repair.repaired_digests(conversation_repair.repaired_turns(turns, audits))
    same = audits["conv_id"].eqNullSafe(digests["conv_id"])
    repaired = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))
    return audits.join(digests, same, "left").select(
        *(audits[name] for name in audits.columns), repaired.alias("repaired_sha256")
    )


QUERIES = {
    query.__name__: query
    for query in (
        op1_quality_rules,
        op2_benchmark_decontamination,
        op3_substring_dedup,
        op4_sharding,
        op5_license_scan,
        op6_line_dedup,
        op7_source_mixing,
        op8_chat_formatting,
        op9_simhash_near_dedup,
        op10_suffix_array_dedup,
        op11_byte_bpe,
        op12_phrase_collocations,
        op13_conversation_repair,
    )
}

ORACLE_SQL = oracles.statements()
