"""The operators as queries over the test tables, and their SQL counterparts."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.llm import (
    attention_lm, chat, collocations, conversation_repair, decontaminate, lempel_ziv, licenses, packing, quality_votes, repeats,
    sharding, simhash, toxicity,
)
from murmuration.llm.common import ship_package, table

#: Tokens per sequence, and the id that ends a document.
SEQUENCE, END_ID = 1024, 2
SHARDS = 40
PROBE = "</s>[INST] ok [/INST]"


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), ranks_path(), SEQUENCE, END_ID)
    return packing.pack(pieces, SEQUENCE).placed


def op2_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sharded = sharding.shard_by_rows(docs, SHARDS)
    return sharded.select(
        "doc_id", sharding.record_bytes(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digest(chat.format_chats(chat.as_streamed(turns), chat.PAGE * chat.STEPS))


def op4_weighted_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_lempel_ziv_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lempel_ziv.compare_with_edits(table(spark, sf_dir, "documents"))


def op6_self_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score(table(spark, sf_dir, "documents"), ranks_path())


def op7_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), width=3, radius=3)
    # hex() drops leading zeros.
    shown = F.lower(F.lpad(F.hex(F.element_at("print", 1)), 16, "0"))
    return groups.select("doc_id", shown.alias("fingerprint"), "component_id")


def op8_qgram_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_suffix_array_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


def op10_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_votes.judge(table(spark, sf_dir, "documents"))


def op13_lightest_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


OPERATORS = (op1_best_fit_packing, op2_two_pass_shuffle, op3_event_sourced_chat, op4_weighted_lexicon,
             op5_lempel_ziv_prints,
             op6_self_attention, op7_simhash_blocks, op8_qgram_leaks, op9_suffix_array_repeats,
             op10_license_signatures, op11_son_collocations, op12_weak_supervision,
             op13_lightest_repair)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _shipped(f) for f in OPERATORS}
