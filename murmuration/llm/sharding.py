"""Shuffled shards by a two-pass external shuffle.

Pass one scatters records uniformly into memory-sized buckets by a seeded hash; pass two
shuffles each bucket in memory (Fisher-Yates) and numbers its records behind those of the
buckets before it. Shards are even ranges of these numbers (law ``rows``: counts at most one
apart).

Defined cases: a null text has no bytes (and stays null), repeated rows are records of their
own, an empty table gives empty shards, other columns travel with their record.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from murmuration.llm.common import bucket_of, free_names
from murmuration.runtime import materialize

#: Bytes of records that one bucket holds on average.
BUCKET_BYTES = 8 << 20
#: A record's bytes besides its text.
RECORD_BYTES = 16


def record_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + RECORD_BYTES


def scatter(df: DataFrame, key: list[str], size: Column, bucket: str, seed: int, bucket_bytes: int) -> DataFrame:
    """Pass one: ``df`` with a long column ``bucket``, written out.

    Buckets depend on the seed and the key. Only where repeated records overfill a bucket
    is it cut further, by the place of the record in the input.
    """
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    (piece,) = free_names(df, "piece_of_bucket")
    hashed = df.withColumn(bucket, bucket_of(buckets, F.lit(seed), *key))
    sizes = hashed.groupBy(bucket).agg(F.sum(size).alias("bytes"), F.max(size).alias("longest"))
    # Hash buckets vary little around the mean; one four times as large holds copies or giants.
    over = sizes.where((F.col("bytes") > 4 * bucket_bytes) & (F.col("bytes") > 2 * F.col("longest"))) \
        .select(bucket, F.ceil(F.col("bytes") / bucket_bytes).cast("long").alias(piece))
    over = materialize(over, "overfull")
    if over.isEmpty():
        return materialize(hashed, "scattered")
    cut = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.coalesce(piece, F.lit(1)))
    return materialize(
        hashed.join(over, bucket, "left")
        .withColumn(bucket, F.col(bucket) * (1 << 24) + cut).drop(piece), "scattered")


def starts_of(counts: DataFrame, key: str, buckets: int, fan_in: int = 4096) -> DataFrame:
    """key, start: records before each bucket. Two levels of running sums, so that no task
    sees more than about ``fan_in`` buckets or that many levels."""
    counts = counts.withColumn("level", bucket_of(-(-buckets // fan_in), F.col(key)))
    ahead = (Window.unboundedPreceding, -1)
    levels = counts.groupBy("level").agg(F.sum("n").alias("n")).select(
        "level", F.coalesce(F.sum("n").over(Window.orderBy("level").rowsBetween(*ahead)), F.lit(0)).alias("base"))
    within = F.sum("n").over(Window.partitionBy("level").orderBy(key).rowsBetween(*ahead))
    return counts.withColumn("within", F.coalesce(within, F.lit(0))).join(levels, "level") \
        .select(key, (F.col("base") + F.col("within")).alias("start"))


def shuffle_records(df: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1,
                    bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """All records of ``df`` with a long column ``position`` (with a suffix where ``df`` has it):
    their place in a random order, 0 .. n-1. Also returns n."""
    (bucket, start, tie) = free_names(df, "bucket", "start_of_bucket", "tie")
    size = record_bytes(F.col(text).cast("string"))
    rows = scatter(df, [doc_id, text], size, bucket, seed, bucket_bytes)
    counts = materialize(rows.groupBy(bucket).agg(F.count("*").alias("n")), "buckets")
    buckets, n = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    starts = starts_of(counts, bucket, buckets).withColumnRenamed("start", start)
    # The order in which a task gets records is not fixed, so records are sorted before the shuffle.
    rows = rows.join(starts, bucket).withColumn(tie, F.xxhash64(F.lit(seed), *df.columns))
    (position,) = free_names(df, "position")
    columns = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(position, T.LongType())])

    def fisher_yates(group: pa.Table) -> pa.Table:
        order = np.lexsort((np.arange(group.num_rows), group.column(tie).to_numpy()))
        first = group.column(start)[0].as_py()
        draw = np.random.default_rng([seed, group.column(bucket)[0].as_py() & ((1 << 63) - 1)])
        for i in range(len(order) - 1, 0, -1):
            j = int(draw.integers(0, i + 1))
            order[i], order[j] = order[j], order[i]
        shuffled = group.select(columns).take(pa.array(order))
        return shuffled.append_column(position, pa.array(np.arange(first, first + len(order))))

    shuffled = rows.groupBy(bucket).applyInArrow(fisher_yates, schema)
    return shuffled, n


def shard_by_rows(df: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", seed: int = 1,
                  bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All records with ``shard`` (0 .. shards-1, counts at most one apart) and ``slot`` (place
    in the shard, gapless from 0), in random order. Input columns of these names are renamed
    away by a suffix on the new ones."""
    (position, shard, slot) = free_names(df, "position", "shard", "slot")
    shuffled, n = shuffle_records(df, doc_id, text, seed, bucket_bytes)
    place = F.col(position)
    # Exact in whole numbers: shard k starts at ceil(k * n / shards).
    number = F.expr(f"CAST(`{position}` * {shards}L DIV {max(1, n)}L AS INT)")
    first = F.expr(f"(CAST(`{position}` * {shards}L DIV {max(1, n)}L AS BIGINT) * {n}L + {shards - 1}L) DIV {shards}L")
    return shuffled.withColumn(shard, number).withColumn(slot, place - first).drop(position)


def write_shards(sharded: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder per shard, records in slot order. A shard of any size is written by as
    many tasks as it has ranges of slots."""
    sharded.repartitionByRange(F.col(shard), F.col(slot)).sortWithinPartitions(shard, slot) \
        .write.partitionBy(shard).parquet(path)
