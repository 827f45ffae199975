"""Behaviour features of people, running over their events.

Every feature is a ratio of two running sums, so all of them are made the same way: rows
(person_id, feature_id, ts_ms, event_id, num, den) say what an event adds, one prefix scan
per (person, feature) accumulates them.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.functions.text import bad_word_counts, bad_words_of, tokens, uniq_ratio_of
from murmuration.operators.scan import prefix_scan
from murmuration.runtime import materialize

# Feature ids.
POST_UNIQ, POST_BAD, COMMENT_UNIQ, COMMENT_BAD, COMMENT_VOCAB, LIKE_SPREAD = range(6)


def _text_steps(df: DataFrame, id_col: str, lexicon: Collection[str] | DataFrame, uniq: int, bad: int) -> DataFrame:
    """``lexicon``: a list of words that goes into the expression, or a table (word) that is joined."""
    split = df.select("person_id", "ts_ms", F.col(id_col).alias("event_id"), tokens(F.col("content")).alias("words"))
    if isinstance(lexicon, DataFrame):
        found = bad_word_counts(df.withColumnRenamed(id_col, "event_id"), "event_id", "content", lexicon)
        measured = split.join(found, "event_id").select(
            "person_id", "ts_ms", "event_id", uniq_ratio_of(F.col("words")).alias("uniq"), F.col("n_bad").alias("bad"))
    else:
        measured = split.select(
            "person_id", "ts_ms", "event_id",
            uniq_ratio_of(F.col("words")).alias("uniq"), bad_words_of(F.col("words"), lexicon).alias("bad"),
        )
    one = F.lit(1).cast("long")
    step = F.explode(F.array(
        F.struct(
            F.lit(uniq).alias("feature_id"), F.coalesce("uniq", F.lit(0.0)).alias("num"),
            F.col("uniq").isNotNull().cast("long").alias("den"),
        ),
        F.struct(
            F.lit(bad).alias("feature_id"), F.col("bad").cast("double").alias("num"), one.alias("den")
        ),
    ))
    return measured.select("person_id", "ts_ms", "event_id", step.alias("s")).select(
        "person_id", "s.feature_id", "ts_ms", "event_id", "s.num", "s.den"
    )


def _unit_steps(events: DataFrame, feature: int) -> DataFrame:
    """One more event, nothing new."""
    return events.select(
        "person_id", F.lit(feature).alias("feature_id"), "ts_ms", "event_id",
        F.lit(0.0).alias("num"), F.lit(1).cast("long").alias("den"),
    )


def _novelty_steps(units: DataFrame, items: DataFrame) -> DataFrame:
    """Steps of "distinct items so far over events so far".

    An item counts at the event that brings it first; that event is found by a grouped
    minimum, which is combined before the shuffle.
    """
    first = items.groupBy("person_id", "feature_id", "item").agg(F.min(F.struct("ts_ms", "event_id")).alias("at"))
    new = first.select(
        "person_id", "feature_id", "at.ts_ms", "at.event_id",
        F.lit(1.0).alias("num"), F.lit(0).cast("long").alias("den"),
    )
    key = ["person_id", "feature_id", "ts_ms", "event_id"]
    return units.unionByName(new).groupBy(*key).agg(F.sum("num").alias("num"), F.sum("den").alias("den"))


def post_steps(posts: DataFrame, lexicon: Collection[str] | DataFrame) -> DataFrame:
    return _text_steps(posts, "post_id", lexicon, POST_UNIQ, POST_BAD)


def comment_text_steps(comments: DataFrame, lexicon: Collection[str] | DataFrame) -> DataFrame:
    return _text_steps(comments, "comment_id", lexicon, COMMENT_UNIQ, COMMENT_BAD)


def comment_units(comments: DataFrame) -> DataFrame:
    return _unit_steps(comments.withColumnRenamed("comment_id", "event_id"), COMMENT_VOCAB)


def word_items(comments: DataFrame) -> DataFrame:
    """(person_id, feature_id, ts_ms, event_id, item): the distinct words of each comment."""
    return comments.select(
        "person_id", F.lit(COMMENT_VOCAB).alias("feature_id"), "ts_ms", F.col("comment_id").alias("event_id"),
        F.explode(F.array_distinct(tokens(F.col("content")))).alias("item"),
    )


def comment_vocab_steps(comments: DataFrame) -> DataFrame:
    return _novelty_steps(comment_units(comments), word_items(comments))


def comment_steps(comments: DataFrame, lexicon: Collection[str] | DataFrame) -> DataFrame:
    return comment_text_steps(comments, lexicon).unionByName(comment_vocab_steps(comments))


def liked_author(likes: DataFrame, posts: DataFrame) -> DataFrame:
    """Likes with the author of the liked post; null for unknown posts."""
    authors = posts.select("post_id", F.col("person_id").alias("author_id"))
    return likes.join(authors, "post_id", "left")


def like_units(likes: DataFrame) -> DataFrame:
    return _unit_steps(likes.withColumnRenamed("like_id", "event_id"), LIKE_SPREAD)


def author_items(matched: DataFrame) -> DataFrame:
    """The author of each liked post as item; likes of unknown posts have none."""
    return matched.filter("author_id is not null").select(
        "person_id", F.lit(LIKE_SPREAD).alias("feature_id"), "ts_ms", F.col("like_id").alias("event_id"),
        F.col("author_id").alias("item"),
    )


def like_steps(likes: DataFrame, posts: DataFrame) -> DataFrame:
    """Unmatched likes add to the denominator only."""
    return _novelty_steps(like_units(likes), author_items(liked_author(likes, posts)))


def running_features(*steps: DataFrame) -> DataFrame:
    """(person_id, feature_id, event_id, ts_ms, value): value after each event.

    The steps are written out first: range partitioning reads its input twice, and the
    texts should be taken apart only once.
    """
    scanned = prefix_scan(
        materialize(reduce(DataFrame.unionByName, steps), "feature-steps"),
        keys=["person_id", "feature_id"], order=["ts_ms", "event_id"],
        sums={"_num": "num", "_den": "den"},
    )
    return scanned.select(
        "person_id", "feature_id", "event_id", "ts_ms",
        (F.col("_num") / F.nullif(F.col("_den"), F.lit(0))).alias("value"),
    )


def post_features(posts: DataFrame, lexicon: Collection[str] | DataFrame) -> DataFrame:
    return running_features(post_steps(posts, lexicon))


def comment_features(comments: DataFrame, lexicon: Collection[str] | DataFrame) -> DataFrame:
    return running_features(comment_steps(comments, lexicon))


def like_features(likes: DataFrame, posts: DataFrame) -> DataFrame:
    return running_features(like_steps(likes, posts))
