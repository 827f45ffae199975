"""Replies attached to posts, and likes to authors, as they arrive, in whatever order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.operators.threads import resolve_roots
from murmuration.runtime import materialize, scratch
from murmuration.streaming.state import BatchTable, Kept, State


class Waiting:
    """The waiting replies of a ``ThreadResolver``, after a batch or now."""

    def __init__(self, state: State, name: str):
        self.state, self.name = state, name

    def of(self, batch_id: int) -> DataFrame:
        return self.state.after(batch_id, self.name)

    def everything(self) -> DataFrame:
        return self.state.newest(self.name)


class ThreadResolver:
    """``foreachBatch`` body: resolves each micro-batch together with what still waits.

    Keeps an index of resolved comments (post and depth by comment) and the waiting replies. A
    batch looks its open parents up in the buckets of the first, resolves chains inside itself by the
    batch operator, and leaves the rest waiting. ``max_age_ms`` gives up on replies that
    are that much older than the newest comment; they go to ``orphans``.
    """

    def __init__(
        self, spark: SparkSession, state_dir: str, id_type: str = "string",
        max_age_ms: int | None = None, on_resolved: Callable[[DataFrame, int], None] | None = None,
    ):
        comment = (f"comment_id {id_type}, person_id {id_type}, ts_ms long, "
                   f"reply_to_post {id_type}, reply_to_comment {id_type}")
        self.spark = spark
        self.resolved = BatchTable(spark, f"{state_dir}/resolved", f"{comment}, post_id {id_type}, depth long")
        self.orphans = BatchTable(spark, f"{state_dir}/orphans", comment)
        self.state = State(spark, f"{state_dir}/kept", {
            "index": Kept(f"comment_id {id_type}, post_id {id_type}, depth long", keys=("comment_id",)),
            "waiting": Kept(comment),
        })
        self.waiting = Waiting(self.state, "waiting")
        self.max_age_ms, self.on_resolved = max_age_ms, on_resolved

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(self.spark):
            done = self.step(batch, batch_id)
            if self.on_resolved is not None:
                self.on_resolved(done, batch_id)

    def step(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The comments that this batch resolves."""
        self.state.begin(batch_id)
        columns = self.state.schemas["waiting"].names
        rows = materialize(batch.select(*columns).unionByName(self.state.read("waiting")), "stream-comments")
        asked = rows.filter(F.col("reply_to_post").isNull() & F.col("reply_to_comment").isNotNull())
        known = self.state.lookup("index", asked.select(F.col("reply_to_comment").alias("comment_id"))).select(
            F.col("comment_id").alias("reply_to_comment"), F.col("post_id").alias("known_post"),
            (F.col("depth") + 1).alias("start"),
        )
        looked_up = rows.join(known, "reply_to_comment", "left")
        nodes = looked_up.select(
            F.col("comment_id").alias("id"),
            F.coalesce("reply_to_post", "known_post").alias("root"),
            F.when(F.col("reply_to_post").isNull(), F.col("reply_to_comment")).alias("parent"),
            F.when(F.col("reply_to_post").isNull(), F.col("start")).otherwise(F.lit(0)).alias("start"),
            "person_id", "ts_ms", "reply_to_post", "reply_to_comment",
        )
        solved = resolve_roots(nodes, "stream-threads").withColumnRenamed("id", "comment_id").withColumnRenamed("root", "post_id")
        self.resolved.write(solved, batch_id)
        done = self.resolved.of(batch_id)
        self.state.add("index", done)
        left = rows.join(done, "comment_id", "left_anti")
        if self.max_age_ms is not None:
            newest = rows.agg(F.max("ts_ms")).scalar()
            too_old = F.col("ts_ms") < newest - F.lit(self.max_age_ms)
            self.orphans.write(left.filter(too_old), batch_id)
            left = left.filter(~too_old)
        self.state.replace("waiting", left)
        self.state.commit()
        return done


class LikedAuthors:
    """Authors of liked posts, however old the post is, and also when it comes after its like.

    Keeps the author of every post and the likes whose post has not come, both in buckets by post.
    A like counts for its author from the time at which both are there, the later of the two.
    """

    def __init__(self, spark: SparkSession, state_dir: str, id_type: str = "string"):
        def of_open_posts(state: State, parked: DataFrame) -> DataFrame:
            return parked.join(state.read("authors").select("post_id"), "post_id", "left_anti")

        self.state = State(spark, state_dir, {
            "authors": Kept(f"post_id {id_type}, author_id {id_type}, post_ms long", keys=("post_id",)),
            "parked": Kept(f"post_id {id_type}, person_id {id_type}, ts_ms long, like_id {id_type}", keys=("post_id",),
                           prune=of_open_posts),
        })

    def step(self, likes: DataFrame, posts: DataFrame, batch_id: int) -> DataFrame:
        """(post_id, person_id, ts_ms, like_id, author_id): likes that this batch, or a post in it, brings together."""
        state = self.state
        state.begin(batch_id)
        new = materialize(posts.select("post_id", F.col("person_id").alias("author_id"), F.col("ts_ms").alias("post_ms")), "stream-posts")
        come = materialize(likes.select("post_id", "person_id", "ts_ms", "like_id"), "stream-likes")
        # Posts of this batch meet the likes that were parked before it, all known posts meet its own likes.
        waited = state.lookup("parked", new).join(new, "post_id")
        state.add("authors", new)
        known = materialize(state.lookup("authors", come), "stream-authors")
        met = come.join(known, "post_id")
        found = materialize(met.unionByName(waited).select(
            "post_id", "person_id", F.greatest("ts_ms", "post_ms").alias("ts_ms"), "like_id", "author_id"), "stream-liked")
        state.add("parked", come.join(known, "post_id", "left_anti"))
        state.commit()
        return found


def liked_author_stream(likes: DataFrame, posts: DataFrame, delay_s: int, horizon: str) -> DataFrame:
    """Likes with the post's author, null if no post of the last ``horizon`` matches.

    A stream-stream left join, for streams that need no older posts: the time bound lets Spark drop
    posts that no like can reach any more. ``LikedAuthors`` has no bound.
    """
    left = likes.withWatermark("ts", f"{delay_s} seconds")
    right = posts.select(
        F.col("post_id").alias("_post"), F.col("person_id").alias("author_id"), F.col("ts").alias("_post_ts")
    ).withWatermark("_post_ts", f"{delay_s} seconds")
    within = (
        (F.col("post_id") == F.col("_post"))
        & (F.col("_post_ts") <= F.col("ts"))
        & (F.col("_post_ts") >= F.col("ts") - F.expr(f"INTERVAL {horizon}"))
    )
    return left.join(right, within, "left_outer").drop("_post", "_post_ts")
