"""Attach replies to the post they hang under, through any depth of parent comments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.runtime import write_counting


def resolve_roots(nodes: DataFrame, name: str = "roots") -> DataFrame:
    """Nodes whose parent chain ends at a node with a ``root``, with that root and ``depth``.

    ``nodes`` has ``id`` (unique), ``parent``, ``root`` and any payload, which is kept.
    Nodes with a root have depth 0, or the depth given in an optional column ``start``.

    Pointer doubling: an open node points at some ancestor; each round it takes that
    ancestor's root, or, while that is open too, the ancestor's own pointer, so the
    distance covered doubles. Only open nodes are joined and rewritten, and the number of
    rounds is the logarithm of the deepest thread. Nodes whose pointer leads nowhere drop
    out. Joins are on node ids: the pointed-at side is unique, and AQE splits a popular
    ancestor on the pointing side.
    """
    payload = [c for c in nodes.columns if c not in ("id", "parent", "root", "start")]
    is_open = F.col("root").isNull()
    start = F.col("start") if "start" in nodes.columns else F.lit(0)
    step = nodes.filter(F.col("root").isNotNull() | F.col("parent").isNotNull()).select(
        "id",
        F.when(is_open, F.col("parent")).alias("pointer"),
        "root",
        F.when(is_open, 1).otherwise(start).cast("long").alias("depth"),
        *payload,
    )
    read = nodes.sparkSession.read.schema(step.schema).parquet
    path, left = write_counting(step, f"{name}-0", is_open)
    paths = [path]
    # A chain without a cycle is no longer than the number of open nodes; whatever is
    # still open after that many doublings is on a cycle or leads into one.
    for i in range(1, left.bit_length() + 2):
        if not left:
            break
        unresolved = read(paths[-1]).filter(is_open)
        ancestor = read(*paths).filter(~is_open).unionByName(unresolved).select(
            F.col("id").alias("pointer"),
            F.col("root").alias("up_root"),
            F.col("pointer").alias("up_pointer"),
            F.col("depth").alias("up_depth"),
        )
        step = unresolved.join(ancestor, "pointer").select(
            "id",
            F.col("up_pointer").alias("pointer"),
            F.col("up_root").alias("root"),
            (F.col("depth") + F.col("up_depth")).alias("depth"),
            *payload,
        )
        path, left = write_counting(step, f"{name}-{i}", is_open)
        paths.append(path)
    return read(*paths).filter(~is_open).drop("pointer")


def resolve_replies(comments: DataFrame) -> DataFrame:
    """Comments with ``post_id`` and ``depth`` (0 = names its post); orphans drop out.

    A comment that names both a post and a parent comment belongs to that post. Other
    columns are kept, so prune long ones such as the text first.
    """
    nodes = comments.withColumnRenamed("comment_id", "id").withColumnRenamed("reply_to_post", "root")
    return (
        resolve_roots(nodes.withColumn("parent", F.col("reply_to_comment")), "replies")
        .withColumnRenamed("id", "comment_id")
        .withColumnRenamed("root", "post_id")
    )


def thread_stats(resolved: DataFrame) -> DataFrame:
    """Number of comments and deepest nesting per post."""
    return resolved.groupBy("post_id").agg(
        F.count("*").alias("n_comments"), F.max("depth").alias("max_depth")
    )
