"""The three analyses over cleaned tables in the file layout of ``sources.files``."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.operators import activity, affinity, features, outliers, threads
from murmuration.params import Params

Tables = dict[str, DataFrame]


def resolved_comments(clean: Tables) -> DataFrame:
    narrow = clean["comment"].select("comment_id", "person_id", "ts_ms", "reply_to_post", "reply_to_comment")
    return threads.resolve_replies(narrow)


def post_activity(clean: Tables, p: Params = Params()) -> DataFrame:
    """(as_of_ms, post_id, metric, n) for each active post, every tick."""
    return activity.post_activity(activity.engagement_events(resolved_comments(clean), clean["like"]), p)


def activity_messages(clean: Tables, p: Params = Params()) -> DataFrame:
    """The same as digest messages."""
    return activity.activity_digest(post_activity(clean, p), p)


def _typed(df: DataFrame, id_type: str, *ids: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(id_type) for c in ids})


def static_scores(clean: Tables, p: Params = Params(), selected: DataFrame | None = None, id_type: str = "long") -> DataFrame:
    person = _typed(clean["person"], id_type, "person_id").select(
        "person_id", "browser", F.substring("birthday", 1, 4).try_cast("int").alias("birth_year")
    )
    tables = [_typed(clean[t], id_type, "person_id") for t in ("member", "moderator", "interest", "language")]
    return affinity.static_total(affinity.static_units(person, *tables, p, selected), p)


def friendships(clean: Tables, id_type: str = "long") -> DataFrame:
    return _typed(clean["knows"], id_type, "person1_id", "person2_id")


def friend_suggestions(clean: Tables, p: Params = Params(), selected: DataFrame | None = None, id_type: str = "long") -> DataFrame:
    """(window_end_ms, selected_id, rank, candidate_id, score). ``selected`` (selected_id) takes the place of
    ``p.selected``; ids that are no numbers need ``id_type`` string."""
    rows = affinity.activity_rows(*[_typed(clean[t], id_type, "person_id") for t in ("post", "like", "comment")])
    scores = affinity.activity_scores(rows, p, selected)
    static = static_scores(clean, p, selected, id_type)
    return affinity.as_points(affinity.suggest(scores, static, friendships(clean, id_type), p, selected))


def behaviour_features(clean: Tables, lexicon: Collection[str] | DataFrame) -> DataFrame:
    """(person_id, feature_id, event_id, ts_ms, value) of all six features."""
    # A null text is an empty one in the files.
    posts, comments = (
        clean[t].withColumn("content", F.coalesce("content", F.lit(""))) for t in ("post", "comment")
    )
    return features.running_features(
        features.post_steps(posts, lexicon),
        features.comment_steps(comments, lexicon),
        features.like_steps(clean["like"], clean["post"]),
    )


def unusual_people(clean: Tables, lexicon: Collection[str] | DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """Outliers at each new value, and at each midnight."""
    values = behaviour_features(clean, lexicon)
    daily = outliers.feature_daily(values)
    stats = outliers.feature_stats(daily)
    return outliers.outliers_on_update(values, stats, p.n_sigma), outliers.outliers_daily(daily, stats, p.n_sigma)
