"""From raw documents to packed sequences: each stage one operator of ``murmuration.llm``.

Each stage works on all that its predecessor kept, as a Parquet table in the checkpoint
folder. Null and empty texts, null ids, repeated rows and further columns pass through the
filtering stages like any other row; what a stage decides about them is in its docstring.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.llm import decontaminate, packing, queries, repeats, similar, toxicity
from murmuration.llm.common import crc32_mod, free_names, ship_package, table
from murmuration.runtime import materialize

#: Near-duplicates: words of a shingle, and the Jaccard similarity of two texts' sets of them.
SHINGLE, SIMILAR = 5, 0.8

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(function: Stage) -> Stage:
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, docs, sf_dir)
    return run_stage


@_stage
def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5. Null and empty texts stay."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.learn(docs.select("doc_id", F.col("text").cast("string").alias("text")),
                           labels.where(crc32_mod("doc_id", 5) != 0))
    nothing = F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)) == 0
    return docs.where(nothing | (toxicity.score_column(F.col("text"), model) < 0.5))


@_stage
def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates: texts that
    links of a Jaccard similarity of 0.8 or more on five-word shingles connect. Texts without
    words are copies of each other."""
    (row,) = free_names(docs, "row_of_stage")
    # Written out: how rows are dealt into partitions, and with it their numbers, changes with the executors.
    docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    name = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    groups = similar.groups(docs.select(name.alias("doc_id"), F.col("text").cast("string").alias("text")), SHINGLE, SIMILAR)
    stay = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.row").alias(row))
    return docs.join(stay, row, "left_semi").drop(row)


@_stage
def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of passages of 200 bytes and more that occur elsewhere;
    ``n_chars``, where there is one, is that of the text that is left. Nulls stay null."""
    cut = repeats.remove_repeats(docs)
    if "n_chars" in docs.columns:
        size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
        cut = cut.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)
    return cut


@_stage
def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item. Null and empty texts stay."""
    for block in decontaminate.indexes(table(spark, sf_dir, "benchmark"), decontaminate.Limits()):
        docs = docs.where(~decontaminate.leak_column(F.col("text"), block, spark.sparkContext))
    return docs


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: see ``packing``. A null text is its end token."""
    pieces = packing.token_pieces(docs, queries.ranks_path(), queries.SEQUENCE, queries.END_ID)
    return packing.pack(pieces, queries.SEQUENCE).placed


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_out),
    ("simhash_near_dedup", near_duplicates_out),
    ("suffix_array_dedup", repeats_out),
    ("benchmark_decontamination", leaks_out),
    ("best_fit_packing", packed),
]

#: None of the stages can be said in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
