"""Running aggregates in a given order, spread evenly whatever the keys look like."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmuration.runtime import materialize


def prefix_scan(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    sums: dict[str, str] | None = None,
    maxes: dict[str, str] | None = None,
) -> DataFrame:
    """Add running sums (this row included) and running maxima (this row excluded).

    ``sums`` and ``maxes`` map a new column to the measure it accumulates. ``order`` must
    be unique within ``keys``. Without ``keys`` the order is global.

    A plain window would put a whole key - or, without keys, the whole table - into one
    task. Instead rows are range partitioned by (keys, order), which cuts a hot key into
    as many chunks as its rows need. Each chunk is aggregated per key, an exclusive prefix
    over those few rows gives what a chunk inherits from earlier chunks, and the window
    runs inside (chunk, key) only. A chunk inherits for at most one key, the one it
    shares with its predecessor, so the table of inherited values has at most one row per
    chunk and may be broadcast.

    The chunked table is written out, because chunk bounds come from sampling and both
    readers must see the same ones.
    """
    sums, maxes = sums or {}, maxes or {}
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunked = materialize(
        df.repartitionByRange(n, *keys, *order).withColumn("_chunk", F.spark_partition_id()),
        "scan",
    )

    totals = chunked.groupBy("_chunk", *keys).agg(
        *[F.sum(m).alias(f"_t_{out}") for out, m in sums.items()],
        *[F.max(m).alias(f"_t_{out}") for out, m in maxes.items()],
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    inherited = totals.select(
        "_chunk",
        *keys,
        F.count("*").over(before).alias("_earlier"),
        *[F.sum(f"_t_{out}").over(before).alias(f"_c_{out}") for out in sums],
        *[F.max(f"_t_{out}").over(before).alias(f"_c_{out}") for out in maxes],
    ).filter("_earlier > 0").drop("_earlier")

    here = Window.partitionBy("_chunk", *keys).orderBy(*order)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = here.rowsBetween(Window.unboundedPreceding, -1)
    scanned = chunked.select(
        "*",
        *[F.sum(m).over(upto).alias(f"_r_{out}") for out, m in sums.items()],
        *[F.max(m).over(prior).alias(f"_r_{out}") for out, m in maxes.items()],
    )
    return scanned.join(F.broadcast(inherited), ["_chunk", *keys], "left").select(
        *df.columns,
        *[
            (F.coalesce(f"_r_{out}", F.lit(0)) + F.coalesce(f"_c_{out}", F.lit(0))).alias(out)
            for out in sums
        ],
        *[F.greatest(f"_r_{out}", f"_c_{out}").alias(out) for out in maxes],
    )
