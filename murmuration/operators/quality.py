"""Cleaning of the raw streams: time order, referential integrity, reject reasons.

Streams come with ``order`` columns that give their file (or arrival) order. Each audit
adds a ``reason`` column that is null for rows to keep; the clean and reject tables are
the two halves of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration.operators.scan import prefix_scan
from murmuration.operators.threads import resolve_roots
from murmuration.runtime import materialize

# Reject reasons.
BAD_TIME, ORDER_BROKEN = "bad_time", "order_broken"
MISSING_POST, POST_AFTER, MISSING_PARENT = "missing_post", "post_after_child", "missing_parent"


def audit_order(df: DataFrame, order: Sequence[str], ts: str = "ts_ms") -> DataFrame:
    """Reject a row whose time is before the latest time in front of it.

    The latest time of all earlier rows equals that of the kept ones, so the row-by-row
    rule is a running maximum.
    """
    seen = prefix_scan(df, order, maxes={"_latest": ts})
    return seen.withColumn(
        "reason",
        F.when(F.col(ts).isNull(), BAD_TIME).when(F.col("_latest") > F.col(ts), ORDER_BROKEN),
    ).drop("_latest")


def monotone_filter(df: DataFrame, order: Sequence[str], ts: str = "ts_ms") -> DataFrame:
    """Rows whose time is not before the latest time in front of them."""
    return audit_order(df, order, ts).filter("reason is null").drop("reason")


def _post_times(posts: DataFrame) -> DataFrame:
    return posts.select("post_id", F.col("ts_ms").alias("_post_ms"))


def audit_likes(likes: DataFrame, posts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Reject likes of unknown or later posts, and likes behind the last *kept* like."""
    valid = F.col("_post_ms") < F.col("ts_ms")
    matched = likes.join(_post_times(posts), "post_id", "left").withColumn(
        "_valid_ms", F.when(valid, F.col("ts_ms"))
    )
    # Written out, as range partitioning reads its input twice.
    seen = prefix_scan(materialize(matched, "matched-likes"), order, maxes={"_latest": "_valid_ms"})
    return seen.withColumn(
        "reason",
        F.when(F.col("ts_ms").isNull(), BAD_TIME)
        .when(F.col("_latest") > F.col("ts_ms"), ORDER_BROKEN)
        .when(F.col("_post_ms").isNull(), MISSING_POST)
        .when(~valid, POST_AFTER),
    ).select(*likes.columns, "reason")


def clean_likes(likes: DataFrame, posts: DataFrame, order: Sequence[str]) -> DataFrame:
    return audit_likes(likes, posts, order).filter("reason is null").drop("reason")


def audit_direct_comments(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Comments that name a post: reject those of unknown or not earlier posts."""
    direct = comments.filter(F.col("reply_to_post").isNotNull())
    matched = direct.join(
        _post_times(posts).withColumnRenamed("post_id", "reply_to_post"), "reply_to_post", "left"
    )
    return matched.withColumn(
        "reason",
        F.when(F.col("ts_ms").isNull(), BAD_TIME)
        .when(F.col("_post_ms").isNull(), MISSING_POST)
        .when(F.col("_post_ms") >= F.col("ts_ms"), POST_AFTER),
    ).select(*comments.columns, "reason")


def kept_comments(comments: DataFrame, posts: DataFrame, order: Sequence[str]) -> DataFrame:
    """All comments to keep, with ``depth`` (0 = direct).

    A reply stays iff its parent stays and lies before it in file order. Edges that point
    forward are cut first; what then still hangs on a kept direct comment is kept.
    """
    direct = audit_direct_comments(comments, posts).filter("reason is null")
    position = F.struct(*order)
    replies = comments.filter(F.col("reply_to_post").isNull() & F.col("ts_ms").isNotNull()).withColumn(
        "_at", position
    )
    parents = comments.select(
        F.col("comment_id").alias("reply_to_comment"), position.alias("_parent_at")
    )
    backward = replies.join(parents, "reply_to_comment").filter("_parent_at < _at").select(comments.columns)
    nodes = direct.select(comments.columns).unionByName(backward).select(
        F.col("comment_id").alias("id"),
        F.when(F.col("reply_to_post").isNull(), F.col("reply_to_comment")).alias("parent"),
        F.col("reply_to_post").alias("root"),
        *[c for c in comments.columns if c not in ("comment_id", "reply_to_post")],
    )
    kept = resolve_roots(nodes, "clean")
    return kept.select(
        F.col("id").alias("comment_id"), F.when(F.col("depth") == 0, F.col("root")).alias("reply_to_post"),
        *[c for c in comments.columns if c not in ("comment_id", "reply_to_post")], "depth",
    )


def clean_comments(comments: DataFrame, posts: DataFrame, order: Sequence[str]) -> DataFrame:
    return kept_comments(comments, posts, order).drop("depth")


def reject_rows(
    audited_posts: DataFrame, audited_likes: DataFrame, comments: DataFrame,
    known_posts: DataFrame, kept: DataFrame,
) -> DataFrame:
    """(kind, id, reason) of every row that cleaning drops, from audited and kept rows."""
    def bad(df: DataFrame, kind: str) -> DataFrame:
        return df.filter("reason is not null").select(
            F.lit(kind).alias("kind"), F.col(f"{kind}_id").alias("id"), "reason"
        )

    bad_replies = comments.filter(F.col("reply_to_post").isNull()).join(
        kept.filter("depth > 0").select("comment_id"), "comment_id", "left_anti"
    ).withColumn("reason", F.when(F.col("ts_ms").isNull(), BAD_TIME).otherwise(MISSING_PARENT))
    return (
        bad(audited_posts, "post")
        .unionByName(bad(audited_likes, "like"))
        .unionByName(bad(audit_direct_comments(comments, known_posts), "comment"))
        .unionByName(bad(bad_replies, "comment"))
    )


def rejects(
    posts: DataFrame, likes: DataFrame, comments: DataFrame,
    known_posts: DataFrame, order: Sequence[str],
) -> DataFrame:
    """(kind, id, reason) of every row that cleaning drops."""
    return reject_rows(
        audit_order(posts, order), audit_likes(likes, known_posts, order), comments,
        known_posts, kept_comments(comments, known_posts, order),
    )


def with_arrival(df: DataFrame, id_col: str, min_s: int, max_s: int, ts: str = "ts_ms") -> DataFrame:
    """Arrival time: event time plus a delay in [min_s, max_s) fixed by the row's id."""
    is_text = isinstance(df.schema[id_col].dataType, T.StringType)
    number = F.crc32(id_col) if is_text else F.col(id_col) * 7919
    delay_s = F.lit(min_s) + number % (max_s - min_s)
    return df.withColumn("arrival_ms", F.col(ts) + delay_s * 1000)


def late_rows(df: DataFrame, order: Sequence[str], delay_s: int, ts: str = "ts_ms") -> DataFrame:
    """Rows behind a watermark that trails the latest event time so far by ``delay_s``."""
    seen = prefix_scan(df, order, maxes={"_latest": ts})
    return (
        seen.withColumn("watermark_ms", F.col("_latest") - F.lit(delay_s * 1000))
        .withColumn("lateness_ms", F.col("watermark_ms") - F.col(ts))
        .filter("lateness_ms > 0")
        .drop("_latest")
    )
