"""Activity of posts: cumulative comments, replies and unique people at every tick."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuration.functions.timing import floor_to
from murmuration.operators.scan import prefix_scan
from murmuration.params import COMMENT, ENGAGEMENT, KIND_COMMENT, KIND_LIKE, KIND_REPLY, REPLY, Params
from murmuration.runtime import materialize


def comment_kinds(comments: DataFrame) -> DataFrame:
    """Comments with ``kind``: direct unless a parent comment is named."""
    return comments.withColumn(
        "kind", F.when(F.col("reply_to_comment").isNull(), KIND_COMMENT).otherwise(KIND_REPLY)
    )


def engagement_events(resolved: DataFrame, likes: DataFrame) -> DataFrame:
    """Resolved comments and likes as (post_id, kind, person_id, ts_ms, event_id)."""
    return comment_kinds(resolved).select(
        "post_id", "kind", "person_id", "ts_ms", F.col("comment_id").alias("event_id")
    ).unionByName(
        likes.select(
            "post_id", F.lit(KIND_LIKE).alias("kind"), "person_id", "ts_ms",
            F.col("like_id").alias("event_id"),
        )
    )


def first_engagement(events: DataFrame) -> DataFrame:
    """Earliest engagement per (post, person); partial minima are taken before the shuffle."""
    return events.groupBy("post_id", "person_id").agg(F.min("ts_ms").alias("first_ts_ms"))


def activity_buckets(events: DataFrame, tick_ms: int) -> DataFrame:
    """Per post and tick interval: new comments, replies, people, and the latest event.

    At most one row per post and tick interval, so later windows by post stay small.
    """
    bucket = floor_to(F.col("ts_ms"), tick_ms)
    counted = events.groupBy("post_id", bucket.alias("bucket_ms")).agg(
        F.count_if(F.col("kind") == KIND_COMMENT).alias("comments"),
        F.count_if(F.col("kind") != KIND_LIKE).alias("replies"),
        F.lit(0).cast("long").alias("people"),
        F.max("ts_ms").alias("last_ms"),
    )
    joined = first_engagement(events).groupBy(
        "post_id", floor_to(F.col("first_ts_ms"), tick_ms).alias("bucket_ms")
    ).agg(
        F.lit(0).cast("long").alias("comments"),
        F.lit(0).cast("long").alias("replies"),
        F.count("*").alias("people"),
        F.lit(None).cast("long").alias("last_ms"),
    )
    return counted.unionByName(joined).groupBy("post_id", "bucket_ms").agg(
        F.sum("comments").alias("comments"),
        F.sum("replies").alias("replies"),
        F.sum("people").alias("people"),
        F.max("last_ms").alias("last_ms"),
    )


def activity_counts(buckets: DataFrame, last_event_ms, p: Params = Params()) -> DataFrame:
    """Cumulative counts at each tick at which the post is active.

    A bucket row speaks for the ticks from its own end to the end of the next bucket of
    the post, and no longer than the activity horizon, so each row yields a few ticks.
    """
    post = Window.partitionBy("post_id").orderBy("bucket_ms")
    upto = post.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.lit(p.tick_ms)
    running = buckets.select(
        "post_id",
        F.sum("comments").over(upto).alias(COMMENT),
        F.sum("replies").over(upto).alias(REPLY),
        F.sum("people").over(upto).alias(ENGAGEMENT),
        (F.col("bucket_ms") + step).alias("from_ms"),
        F.least(
            F.lead("bucket_ms").over(post),
            floor_to(F.col("last_ms") + F.lit(p.active_ms - 1), p.tick_ms),
            floor_to(last_event_ms, p.tick_ms),
        ).alias("to_ms"),
    )
    return running.filter("from_ms <= to_ms").select(
        F.explode(F.sequence("from_ms", "to_ms", step)).alias("as_of_ms"),
        "post_id", COMMENT, REPLY, ENGAGEMENT,
    )


def post_activity(events: DataFrame, p: Params = Params()) -> DataFrame:
    """(as_of_ms, post_id, metric, n): three rows per tick and active post."""
    last_event = events.agg(F.max("ts_ms")).scalar()
    counts = activity_counts(activity_buckets(events, p.tick_ms), last_event, p)
    return counts.unpivot(["as_of_ms", "post_id"], [COMMENT, REPLY, ENGAGEMENT], "metric", "n")


def activity_digest(activity: DataFrame, p: Params = Params()) -> DataFrame:
    """One message per tick with all its updates, as pages of bounded size.

    All posts of a network are active at a busy tick, so one array per tick would not fit
    a task. Updates are numbered in (post, metric) order and packed ``digest_page`` to an
    array; no update is left out.
    """
    # Written out, as range partitioning reads its input twice.
    numbered = prefix_scan(
        materialize(activity, "activity").withColumn("_one", F.lit(1).cast("long")),
        keys=["as_of_ms"], order=["post_id", "metric"], sums={"_seq": "_one"},
    )
    page = F.floor((F.col("_seq") - 1) / F.lit(p.digest_page)).cast("long")
    return numbered.groupBy("as_of_ms", page.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("post_id", "metric", "n"))).alias("updates")
    ).select(
        "as_of_ms", (F.col("as_of_ms") + F.lit(p.tick_ms)).alias("window_end_ms"), "page", "updates"
    )


def metric_events(events: DataFrame) -> DataFrame:
    """(post_id, metric, ts_ms, event_id): one row per unit that a metric counts."""
    counted = events.filter(F.col("kind") != KIND_LIKE).select(
        "post_id", "ts_ms", "event_id",
        F.explode(
            F.when(F.col("kind") == KIND_COMMENT, F.array(F.lit(COMMENT), F.lit(REPLY)))
            .otherwise(F.array(F.lit(REPLY)))
        ).alias("metric"),
    )
    people = first_engagement(events).select(
        "post_id", F.col("first_ts_ms").alias("ts_ms"),
        F.col("person_id").alias("event_id"), F.lit(ENGAGEMENT).alias("metric"),
    )
    return counted.unionByName(people)


def _units(events: DataFrame) -> DataFrame:
    """Units that a metric counts, as rows of a scan in which questions follow what they ask about."""
    return metric_events(events).select(
        "post_id", "metric", F.col("ts_ms").alias("at_ms"), F.lit(0).alias("is_question"),
        F.col("event_id").cast("string").alias("tie"), F.lit(1).cast("long").alias("unit"),
    )


def asof_counts(events: DataFrame, times: DataFrame) -> DataFrame:
    """Number of units with ``ts_ms <= time_ms`` for each (post_id, metric, time_ms).

    The as-of join is one running count over units and questions put in time order, so no
    pairs of units and questions are formed.
    """
    questions = times.select(
        "post_id", "metric", F.col("time_ms").alias("at_ms"), F.lit(1).alias("is_question"),
        F.lit("").alias("tie"), F.lit(0).cast("long").alias("unit"),
    ).distinct()
    return prefix_scan(
        _units(events).unionByName(questions),
        keys=["post_id", "metric"], order=["at_ms", "is_question", "tie"], sums={"n": "unit"},
    ).filter("is_question = 1").select("post_id", "metric", F.col("at_ms").alias("time_ms"), "n")


def activity_bounds(activity: DataFrame, events: DataFrame, p: Params = Params()) -> DataFrame:
    """Per metric: updates checked, and updates outside the as-of counts around the tick.

    The lower bound is the count one second before the tick, the upper one the count at
    the end of the window that starts with the tick. Each update asks for both in the scan and
    brings its own number along, so nothing is joined.
    """
    def edge(name: str, at: Column) -> Column:
        return F.struct(F.lit(name).alias("tie"), at.alias("at_ms"))

    low, high = F.col("as_of_ms") - F.lit(1000), F.col("as_of_ms") + F.lit(p.tick_ms)
    questions = activity.select("post_id", "metric", F.col("n").alias("told"), F.explode(F.array(edge("low", low), edge("high", high))).alias("e")).select(
        "post_id", "metric", "e.at_ms", F.lit(1).alias("is_question"), "e.tie", F.lit(0).cast("long").alias("unit"), "told")
    asked = materialize(_units(events).unionByName(questions, allowMissingColumns=True), "bounds")
    seen = prefix_scan(
        asked, keys=["post_id", "metric"], order=["at_ms", "is_question", "tie"], sums={"seen": "unit"}).filter("is_question = 1")
    # The lower count is at most the upper one, so an update is outside one of them at most.
    outside = F.when(F.col("tie") == "low", F.col("told") < F.col("seen")).otherwise(F.col("told") > F.col("seen"))
    return seen.groupBy("metric").agg(F.count_if(F.col("tie") == "low").alias("n_updates"), F.count_if(outside).alias("n_violations"))
