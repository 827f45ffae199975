"""Outliers: feature values far from the mean over all people at the last midnight."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmuration.functions.timing import floor_to
from murmuration.params import DAY_MS


#: Days in a block: spans are split at block ends, and a block's bands are summed up in one row.
BLOCK_DAYS = 32


def held_spans(features: DataFrame, until_ms: int | None = None) -> DataFrame:
    """(feature_id, person_id, value, previous, from_ms, until_ms): latest value of each person
    at the midnights from .. until, and the value that it replaces.

    Per person and active day the last value is a grouped maximum. It then holds for all
    midnights up to the person's next active day, or to the first midnight after the
    feature's last value (or to ``until_ms``); a person has at most one row per day in the
    window.
    """
    valued = features.filter("value is not null")
    day = (floor_to(F.col("ts_ms"), DAY_MS) + F.lit(DAY_MS)).alias("from_ms")
    last = valued.groupBy("feature_id", "person_id", day).agg(
        F.max_by("value", F.struct("ts_ms", "event_id")).alias("value")
    )
    person = Window.partitionBy("feature_id", "person_id").orderBy("from_ms")
    held = last.withColumns({
        "next_ms": F.lead("from_ms").over(person), "previous": F.lag("value").over(person),
    })
    if until_ms is None:
        end = valued.groupBy("feature_id").agg(
            (floor_to(F.max("ts_ms"), DAY_MS) + F.lit(DAY_MS)).alias("end_ms")
        )
        # One row per feature id: six at most.
        held = held.join(F.broadcast(end), "feature_id")
    else:
        held = held.withColumn("end_ms", F.lit(until_ms).cast("long"))
    until = F.coalesce(F.col("next_ms") - F.lit(DAY_MS), "end_ms").alias("until_ms")
    return held.select("feature_id", "person_id", "value", "previous", "from_ms", until)


def _days(spans: DataFrame) -> DataFrame:
    """One row per midnight of each span."""
    return spans.select(
        "feature_id", F.explode(F.sequence("from_ms", "until_ms", F.lit(DAY_MS))).alias("day_ms"), "person_id", "value"
    )


def feature_daily(features: DataFrame, until_ms: int | None = None) -> DataFrame:
    """(feature_id, day_ms, person_id, value): latest value of each person before midnight."""
    return _days(held_spans(features, until_ms))


def span_stats(spans: DataFrame) -> DataFrame:
    """``feature_stats`` of ``held_spans``, from what changes at each midnight.

    Only people whose value changes add to a day's sums; running sums over the days, a few
    rows for each feature, give the statistics. Values are centred on the feature's mean, so
    that sums of squares keep their digits.
    """
    # One row per feature id: six at most.
    centres = spans.groupBy("feature_id").agg(
        F.avg("value").alias("centre"), F.min("from_ms").alias("first_ms"), F.max("until_ms").alias("last_ms"))
    now, past = F.col("value") - F.col("centre"), F.col("previous") - F.col("centre")
    zero = F.lit(0.0)
    changes = spans.join(F.broadcast(centres), "feature_id").groupBy("feature_id", F.col("from_ms").alias("day_ms")).agg(
        F.count_if(F.col("previous").isNull()).alias("people"), F.sum(now - F.coalesce(past, zero)).alias("sum"),
        F.sum(now * now - F.coalesce(past * past, zero)).alias("squares"))
    days = centres.select("feature_id", "centre", F.explode(F.sequence("first_ms", "last_ms", F.lit(DAY_MS))).alias("day_ms"))
    so_far = Window.partitionBy("feature_id").orderBy("day_ms").rowsBetween(Window.unboundedPreceding, 0)
    running = days.join(changes, ["feature_id", "day_ms"], "left").select("feature_id", "day_ms", "centre", *[
        F.sum(F.coalesce(c, F.lit(0))).over(so_far).alias(c) for c in ("people", "sum", "squares")])
    mean, square = F.col("sum") / F.col("people"), F.col("squares") / F.col("people")
    variance = square - mean * mean
    # What is left of rounding where all people have one value.
    spread = F.when(variance > 1e-12 * (square + F.col("centre") * F.col("centre")), F.sqrt(variance)).otherwise(zero)
    return running.select("feature_id", "day_ms", F.col("people").alias("n_people"),
                          (F.col("centre") + mean).alias("mean"), spread.alias("sd"))


def outliers_in_spans(spans: DataFrame, stats: DataFrame, n_sigma: float = 3.0) -> DataFrame:
    """``outliers_daily`` of ``held_spans``: days are looked at only where they can matter.

    Spans are split at block ends; a part whose value lies in the narrowest band of its block
    has no outlier. Only the others become one row per day.
    """
    block_ms = BLOCK_DAYS * DAY_MS
    band = F.lit(float(n_sigma)) * F.col("sd")
    bands = stats.groupBy("feature_id", floor_to(F.col("day_ms"), block_ms).alias("block_ms")).agg(
        F.max(F.col("mean") - band).alias("low"), F.min(F.col("mean") + band).alias("high"))
    blocks = F.sequence(floor_to(F.col("from_ms"), block_ms), floor_to(F.col("until_ms"), block_ms), F.lit(block_ms))
    parts = spans.select("feature_id", "person_id", "value", "from_ms", "until_ms", F.explode(blocks).alias("block_ms"))
    # ``bands`` has one row per feature and block of days.
    outside = parts.join(F.broadcast(bands), ["feature_id", "block_ms"]).filter(
        (F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))
    cut = outside.withColumns({
        "from_ms": F.greatest("from_ms", "block_ms"),
        "until_ms": F.least("until_ms", F.col("block_ms") + F.lit(block_ms - DAY_MS)),
    })
    return outliers_daily(_days(cut), stats, n_sigma)


def feature_stats(daily: DataFrame) -> DataFrame:
    """(feature_id, day_ms, n_people, mean, sd) with the population standard deviation."""
    return daily.groupBy("feature_id", "day_ms").agg(
        F.count("*").alias("n_people"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd")
    )


def _far(n_sigma: float):
    # Rounding alone does not make an outlier.
    distance = F.abs(F.col("value") - F.col("mean"))
    return (distance > F.lit(float(n_sigma)) * F.col("sd")) & (distance > 1e-12 * F.abs("mean"))


def outliers_on_update(features: DataFrame, stats: DataFrame, n_sigma: float = 3.0) -> DataFrame:
    """Values far from the mean of the midnight before them.

    ``stats`` has one row per feature and day, so it is small enough to broadcast.
    """
    return features.filter("value is not null").withColumn(
        "day_ms", floor_to(F.col("ts_ms"), DAY_MS)
    ).join(F.broadcast(stats), ["feature_id", "day_ms"]).filter(_far(n_sigma)).select(
        "person_id", "feature_id", "event_id", "value", "mean", "ts_ms"
    )


def outliers_daily(daily: DataFrame, stats: DataFrame, n_sigma: float = 3.0) -> DataFrame:
    """People whose latest value is far from the mean at a midnight, active or not."""
    return daily.join(F.broadcast(stats), ["feature_id", "day_ms"]).filter(_far(n_sigma)).select(
        "day_ms", "person_id", "feature_id", "value", "mean"
    )
