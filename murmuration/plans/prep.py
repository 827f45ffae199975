"""Cleaning of all nine inputs, and publishing of the cleaned streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.functions.codec import TOPICS, encode_events_of
from murmuration.functions.timing import with_event_time
from murmuration.operators import quality
from murmuration.runtime import materialize
from murmuration.sources.files import (
    INPUTS, ORDER_COLUMNS, STREAMS, clean_table, read_clean, read_raw, with_like_id, write_clean,
)
from murmuration.sources.topics import publish


def _stream(spark: SparkSession, in_dir: str, table: str) -> DataFrame:
    """Raw stream rows with event time and file order, written out once as Parquet."""
    rows = with_event_time(
        read_raw(spark, in_dir, table, file_order=True), "creation_date", INPUTS[table].time_format
    )
    return materialize(rows, f"raw-{table}")


def prepare(spark: SparkSession, in_dir: str, out_dir: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Clean every input of ``in_dir`` into ``out_dir`` and return the cleaned tables.

    Posts come first, since likes and comments are checked against the posts kept. The
    rejects go to ``out_dir/rejects`` with their reasons.
    """
    raw = {table: _stream(spark, in_dir, table) for table in STREAMS}
    order = ORDER_COLUMNS

    posts = materialize(quality.audit_order(raw["post"], order), "audited-posts")
    write_clean(posts.filter("reason is null"), out_dir, "post", fmt)
    kept_posts = posts.filter("reason is null").select("post_id", "ts_ms")

    likes = materialize(quality.audit_likes(with_like_id(raw["like"]), kept_posts, order), "audited-likes")
    write_clean(likes.filter("reason is null"), out_dir, "like", fmt)

    narrow = raw["comment"].select("comment_id", "reply_to_post", "reply_to_comment", "ts_ms", *order)
    kept = materialize(quality.kept_comments(narrow, kept_posts, order).select("comment_id", "depth"), "kept-comments")
    write_clean(raw["comment"].join(kept, "comment_id", "left_semi"), out_dir, "comment", fmt)

    for table, spec in INPUTS.items():
        if not spec.is_stream:
            write_clean(clean_table(read_raw(spark, in_dir, table), table), out_dir, table, fmt)

    quality.reject_rows(posts, likes, narrow, kept_posts, kept).write.format(fmt).save(f"{out_dir}/rejects")
    return {table: read_clean(spark, out_dir, table, fmt) for table in INPUTS}


def event_columns(names: list[str], kind: str) -> dict[str, Column]:
    """The fields of the JSON events that cleaned stream rows with these columns have."""
    date = F.timestamp_millis("ts_ms")
    parts = F.array(*[part(date).cast("int") for part in (F.year, F.month, F.day, F.hour, F.minute, F.second)])
    columns = {
        "timeMilisecond": "ts_ms", "personId": "person_id", "locationIP": "location_ip", "browserUsed": "browser",
        "imageFile": "image_file", "language": "language", "content": "content", "tags": "tags",
        "forumId": "forum_id", "placeId": "place_id", "reply_to_postId": "reply_to_post",
        "reply_to_commentId": "reply_to_comment",
        **({"postId": "post_id"} if kind == "like" else {"id": f"{kind}_id"}),
    }
    return {f: F.col(c) for f, c in columns.items() if c in names} | {"creationDate": parts}


def event_fields(df: DataFrame, kind: str) -> DataFrame:
    """Cleaned stream rows under the field names of the JSON events."""
    return df.select(*[c.alias(f) for f, c in event_columns(df.columns, kind).items()])


def publish_clean(clean: dict[str, DataFrame], options: dict[str, str], fmt: str = "kafka") -> None:
    """Send the cleaned streams as JSON events, one topic per kind."""
    for kind in STREAMS:
        publish(encode_events_of(event_fields(clean[kind], kind), kind), TOPICS[kind], options, fmt)
