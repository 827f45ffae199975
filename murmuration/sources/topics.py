"""Event topics as streams, and result sinks.

``fmt`` is kafka in production. The Kafka connector is a separate package of Spark
(``spark-sql-kafka``); without it the same functions read and write folders of Parquet or
text files, one sub-folder per topic.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from murmuration.functions.codec import decode_events
from murmuration.runtime import Files


def read_topic(spark: SparkSession, topic: str, options: dict[str, str], fmt: str = "kafka") -> DataFrame:
    """Stream of a topic from its beginning, as one string column ``value``."""
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", topic).option("startingOffsets", "earliest")
        return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))
    rest = {k: v for k, v in options.items() if k != "path"}
    return spark.readStream.format(fmt).schema("value string").options(**rest).load(f"{options['path']}/{topic}")


def to_console(df: DataFrame, checkpoint: str, rows: int = 20, once: bool = False) -> StreamingQuery:
    """Show a stream's new rows on the driver's console, ``rows`` of each micro-batch: for a look at a running job."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("console")
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.option("numRows", rows).option("truncate", "false").start()


def write_topic(
    df: DataFrame, topic: str, options: dict[str, str], checkpoint: str, fmt: str = "kafka", once: bool = False
) -> StreamingQuery:
    """Write a stream with a ``value`` column to a topic."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    if fmt == "kafka":
        return writer.format("kafka").option("topic", topic).options(**options).start()
    return writer.format(fmt).start(f"{options['path']}/{topic}")


def publish(
    df: DataFrame, topic: str, options: dict[str, str], fmt: str = "kafka", batch_id: int | None = None
) -> None:
    """Append a batch table with a ``value`` column to a topic.

    With a ``batch_id`` a batch that runs again replaces what it sent: file topics have a folder
    for each batch; Kafka messages carry the batch as their key, by which readers drop repeats.
    """
    if fmt == "kafka":
        key = [] if batch_id is None else [F.lit(str(batch_id)).alias("key")]
        df.select("value", *key).write.format("kafka").option("topic", topic).options(**options).save()
    elif batch_id is not None:
        df.select("value").write.format(fmt).mode("overwrite").save(f"{options['path']}/{topic}/batch={batch_id}")
    else:
        df.select("value").write.format(fmt).mode("append").save(f"{options['path']}/{topic}")


class Outbox:
    """Sends each batch of a topic once, and says which batches are there.

    A batch is entered in ``folder`` when all its messages are written. One that runs again after
    that sends nothing; one that failed before that is sent again: in file topics it takes the place
    of its first try, in Kafka its messages have the same key and text and are repeats for
    ``sent_messages``.
    """

    def __init__(self, spark: SparkSession, folder: str, options: dict[str, str], fmt: str = "kafka"):
        self.spark, self.folder, self.options, self.fmt, self.files = spark, folder, options, fmt, Files(spark)

    def batches(self, topic: str) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names(f"{self.folder}/{topic}") if n.endswith(".json"))

    def send(self, df: DataFrame, topic: str, batch_id: int) -> None:
        entry = f"{self.folder}/{topic}/{batch_id}.json"
        if f"{batch_id}.json" in self.files.names(f"{self.folder}/{topic}"):
            return
        seen = Observation()
        publish(df.observe(seen, F.count("*").alias("n")), topic, self.options, self.fmt, batch_id)
        self.files.write(entry, json.dumps({"topic": topic, "batch": batch_id, "messages": seen.get["n"]}))

    def sent_messages(self, topic: str) -> DataFrame:
        """The messages of the batches that were sent whole, each once."""
        batches = self.batches(topic)
        if self.fmt == "kafka":
            rows = self.spark.read.format("kafka").option("subscribe", topic).options(**self.options).load()
            keyed = rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
            return keyed.filter(F.col("key").isin([str(b) for b in batches])).distinct().select("value")
        paths = [f"{self.options['path']}/{topic}/batch={b}" for b in batches]
        if not paths:
            return self.spark.createDataFrame([], "value string")
        return self.spark.read.format(self.fmt).schema("value string").load(paths)


def rejects_of(values: DataFrame, kind: str) -> DataFrame:
    """(kind, value, reason) of the messages that ``events_of`` leaves out."""
    raw = values.withColumn("message", F.col("value"))
    decoded = decode_events(raw, kind)
    reason = F.when(F.col("bad_json"), "no JSON object").when(F.col("timeMilisecond").isNull(), "no event time")
    return decoded.select(F.lit(kind).alias("kind"), F.col("message").alias("value"), reason.alias("reason")) \
        .filter("reason is not null")


def events_of(values: DataFrame, kind: str) -> DataFrame:
    """Engine columns of one kind of event from its JSON values, with ``ts`` as event time.

    Values that are no JSON object, or have no event time, are the rows of ``rejects_of``.
    """
    decoded = decode_events(values, kind).filter("not bad_json and timeMilisecond is not null")
    base = [
        F.col("personId").alias("person_id"), F.col("timeMilisecond").alias("ts_ms"),
        F.timestamp_millis("timeMilisecond").alias("ts"),
    ]
    own = {
        "post": [F.col("id").alias("post_id"), F.col("forumId").alias("forum_id"), "content"],
        "comment": [
            F.col("id").alias("comment_id"), F.col("reply_to_postId").alias("reply_to_post"),
            F.col("reply_to_commentId").alias("reply_to_comment"), "content",
        ],
        "like": [F.col("postId").alias("post_id"),
                 F.concat_ws(":", "personId", "postId", "timeMilisecond").alias("like_id")],
    }
    return decoded.select(*base, *own[kind])
