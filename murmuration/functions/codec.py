"""Wire formats: JSON events and result tuples written as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _A = T.StringType(), T.LongType(), T.ArrayType

# Fields of the JSON events. creationDate is an array [y, m, d, h, m, s].
EVENT_FIELDS = {
    "post": [
        ("timeMilisecond", _L), ("id", _S), ("personId", _S), ("creationDate", _A(T.IntegerType())),
        ("imageFile", _S), ("locationIP", _S), ("browserUsed", _S), ("language", _S), ("content", _S),
        ("tags", _A(_S)), ("forumId", _S), ("placeId", _S),
    ],
    "comment": [
        ("timeMilisecond", _L), ("id", _S), ("personId", _S), ("creationDate", _A(T.IntegerType())),
        ("locationIP", _S), ("browserUsed", _S), ("content", _S),
        ("reply_to_postId", _S), ("reply_to_commentId", _S), ("placeId", _S),
    ],
    "like": [
        ("timeMilisecond", _L), ("personId", _S), ("postId", _S), ("creationDate", _A(T.IntegerType())),
    ],
}


# Topic of each kind of event.
TOPICS = {"post": "posts", "comment": "comments", "like": "likes"}


def event_schema(kind: str) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in EVENT_FIELDS[kind]])


def decode_json(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """Parse a JSON column into its fields; fields outside the schema are ignored.

    Adds ``bad_json``: whether the text is no JSON object at all.
    """
    parsed = df.withColumn("_event", F.from_json(F.col(col).cast("string"), _with_corrupt(schema)))
    rest = [c for c in df.columns if c != col]
    return parsed.select(
        *rest, *[F.col(f"_event.{f.name}").alias(f.name) for f in schema.fields],
        (F.col("_event").isNull() | F.col("_event._corrupt_record").isNotNull()).alias("bad_json"),
    )


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])


def decode_events(df: DataFrame, kind: str) -> DataFrame:
    """Typed events of one kind from JSON values; null and empty text both become null."""
    schema = event_schema(kind)
    decoded = decode_json(df, schema)
    return decoded.select(*[
        F.nullif(F.col(c), F.lit("")).alias(c) if c in schema.names and schema[c].dataType == _S else F.col(c)
        for c in decoded.columns
    ])


def encode_events(df: DataFrame) -> DataFrame:
    """One JSON object per row, in column order, nulls written out."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def event_json(kind: str) -> Column:
    """One JSON event from its fields, with the derived ones topicName, timestamp and userId."""
    fields = F.struct(
        *[n for n, _ in EVENT_FIELDS[kind]], F.lit(TOPICS[kind]).alias("topicName"),
        F.col("timeMilisecond").alias("timestamp"), F.col("personId").alias("userId"),
    )
    return F.to_json(fields, {"ignoreNullFields": "false"})


def encode_events_of(df: DataFrame, kind: str) -> DataFrame:
    """JSON events with the derived fields."""
    return df.select(event_json(kind).alias("value"))


def tuple_text(*cols: Column) -> Column:
    """``(a,b,c)``."""
    return F.concat(F.lit("("), F.concat_ws(",", *[c.cast("string") for c in cols]), F.lit(")"))


def tuple_list_text(items: Column, *fields: str) -> Column:
    """``[(a,b), (a,b)]`` from an array of structs."""
    texts = F.transform(items, lambda x: tuple_text(*[x[f] for f in fields]))
    return F.concat(F.lit("["), F.concat_ws(", ", texts), F.lit("]"))


def encode_tuple(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(tuple_text(*[F.col(c) for c in cols]).alias("value"))


def encode_suggestions(wide: DataFrame, top_k: int = 5) -> DataFrame:
    """Suggestions as ``(window_end,person,name1,..)``; places without a name are empty."""
    names = [F.coalesce(F.col(f"c{i}").cast("string"), F.lit("")) for i in range(1, top_k + 1)]
    return wide.select(tuple_text(F.col("window_end_ms"), F.col("selected_id"), *names).alias("value"))


def encode_digest(digest: DataFrame) -> DataFrame:
    """Digest messages as ``(window_end,[(post,metric,n), ...])``."""
    return digest.select(tuple_text(
        F.col("window_end_ms"), tuple_list_text(F.col("updates"), "post_id", "metric", "n")
    ).alias("value"))


def encode_digest_pages(digest: DataFrame) -> DataFrame:
    """Digest messages that say their place: ``(window_end,[(post,metric,n), ...],page,pages)``.

    A reader has a tick's whole digest when it has ``pages`` of them, numbered from 0.
    """
    pages = digest.groupBy(F.col("as_of_ms").alias("_tick")).agg(F.count("*").alias("pages"))
    return digest.join(pages, F.col("as_of_ms") == F.col("_tick")).select(tuple_text(
        F.col("window_end_ms"), tuple_list_text(F.col("updates"), "post_id", "metric", "n"), F.col("page"), F.col("pages"),
    ).alias("value"))


def decode_suggestions(df: DataFrame, top_k: int = 5, col: str = "value", id_type: str = "long") -> DataFrame:
    """Rows (window_end_ms, selected_id, c1 .. ck) of suggestion messages; empty places are null."""
    parts = F.split(F.regexp_extract(col, r"^\((.*)\)$", 1), ",", -1)
    names = [F.nullif(parts[i], F.lit("")).cast(id_type) for i in range(1, top_k + 2)]
    return df.select(parts[0].cast("long").alias("window_end_ms"), names[0].alias("selected_id"),
                     *[c.alias(f"c{i}") for i, c in enumerate(names[1:], 1)])


def decode_tuple(df: DataFrame, col: str = "value") -> DataFrame:
    """Rows (window_end_ms, post_id, metric, n) of digest messages written as text."""
    update = F.explode(F.regexp_extract_all(col, F.lit(r"\d+,\w+,\d+"), F.lit(0))).alias("update")
    parts = F.split("update", ",")
    return df.select(F.regexp_extract(col, r"\d+", 0).cast("long").alias("window_end_ms"), update).select(
        "window_end_ms",
        parts[0].cast("long").alias("post_id"), parts[1].alias("metric"), parts[2].cast("long").alias("n"),
    )
