"""Streams as queries: the given tables arrive step by step, worked off until no input is left.

Each step is added to the topics' folders, by as many tasks as it has partitions, and the job, which goes
on from its checkpoint, takes it as a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.functions.codec import EVENT_FIELDS, TOPICS, decode_suggestions, event_json
from murmuration.functions.timing import as_timestamp
from murmuration.operators import affinity, quality, windows
from murmuration.params import DAY_MS, HOUR_MS, MINUTE_MS, Params
from murmuration.plans import prep
from murmuration.runtime import materialize, new_folder
from murmuration.sources.star import LEXICON, SELECTED, START_MS, EngagementTables, PeopleTables, TextTables
from murmuration.sources.topics import Outbox
from murmuration.streaming.activity import ThreadedActivity
from murmuration.streaming.jobs import Run, Topics, start_gate, start_outliers, start_rejects, start_suggestions
from murmuration.streaming.state import BatchTable
from murmuration.streaming.threads import ThreadResolver

STEPS = 4
PARAMS = Params(selected=SELECTED, n_sigma=2.0)
DELAY_S = PARAMS.max_delay_s
#: Every so many events arrive as half a message.
BROKEN = 97
#: Comments reach their topic so much later than posts and likes.
LAG_MS = 5 * DAY_MS
#: One event in so many comes so much later than the others.
STRAY, STRAY_MS = 50, 2 * DAY_MS
#: Days over which the text tables are spread as a stream.
SPREAD_DAYS = 30


def feed(tables: dict[str, DataFrame], write: Callable[[str, DataFrame], None], run: Callable[[], None]) -> None:
    """Hand the tables over in ``STEPS`` equal spans of ``arrival_ms``, and run the job after each."""
    placed = {name: materialize(df, "arrivals") for name, df in tables.items()}
    spans = [df.agg(F.min("arrival_ms"), F.max("arrival_ms")).first() for df in placed.values()]
    first = min((low for low, _ in spans if low is not None), default=0)
    last = max((high for _, high in spans if high is not None), default=0)
    width = (last - first) // STEPS + 1
    for i in range(STEPS):
        for name, df in placed.items():
            here = (F.col("arrival_ms") >= first + i * width) & (F.col("arrival_ms") < first + (i + 1) * width)
            write(name, df.filter(here).drop("arrival_ms"))
        run()


def _arriving(df: DataFrame, id_col: str, later: Column | int = 0) -> DataFrame:
    placed = quality.with_arrival(df, id_col, PARAMS.min_delay_s, DELAY_S)
    return placed.withColumn("arrival_ms", F.col("arrival_ms") + F.lit(later))


def _run(spark: SparkSession, folder: str, schema, transform: Callable[[DataFrame], DataFrame], body=None) -> None:
    """Work off the Parquet rows that are new in ``folder``/in."""
    df = transform(spark.readStream.schema(schema).parquet(f"{folder}/in"))
    writer = df.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    (writer.foreachBatch(body).start() if body else writer.format("parquet").start(f"{folder}/out")).awaitTermination()


def _feed_rows(spark: SparkSession, folder: str, arrivals: DataFrame, transform: Callable[[DataFrame], DataFrame], body=None) -> None:
    rows = arrivals.drop("arrival_ms")

    def write(_: str, part: DataFrame) -> None:
        part.write.mode("append").parquet(f"{folder}/in")

    feed({"rows": arrivals}, write, lambda: _run(spark, folder, rows.schema, transform, body))


def _topic_rows(df: DataFrame, kind: str) -> DataFrame:
    """(value, arrival_ms): each event as its JSON message."""
    ids = ("person_id", "post_id", "comment_id", "reply_to_post", "reply_to_comment", "forum_id")
    rows = df.withColumns({c: F.col(c).cast("string") for c in ids if c in df.columns})
    fields = prep.event_columns(rows.columns, kind)
    event = rows.select("ts_ms", "arrival_ms", *[fields.get(n, F.lit(None).cast(t)).alias(n) for n, t in EVENT_FIELDS[kind]])
    # A table that lies in one row group would be one task's work in all that follows: text by text it is dealt anew.
    return event.repartition("arrival_ms").select(event_json(kind).alias("value"), "ts_ms", "arrival_ms")


def _feed_topics(spark: SparkSession, folder: str, tables: dict[str, DataFrame], run: Callable[[Topics], None], fmt: str = "text") -> Topics:
    """Send events of each kind to file topics step by step."""
    source = Topics({"path": f"{folder}/topics"}, fmt)

    def write(kind: str, part: DataFrame) -> None:
        part.select("value").write.mode("append").format(fmt).save(f"{folder}/topics/{TOPICS[kind]}")

    feed({kind: df.select("value", "arrival_ms") for kind, df in tables.items()}, write, lambda: run(source))
    return source


def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likes per post and sliding window, for windows two steps and more behind the watermark."""
    folder = new_folder(spark, "stream-sliding")
    likes = EngagementTables(spark, sf_dir).likes().select("like_id", "post_id", "ts_ms")

    def counts(rows: DataFrame) -> DataFrame:
        timed = rows.withColumn("ts", as_timestamp(F.col("ts_ms"))).withWatermark("ts", f"{DELAY_S} seconds")
        return windows.sliding_counts(timed, "ts", 4 * HOUR_MS, HOUR_MS, "post_id")

    _feed_rows(spark, folder, _arriving(likes, "like_id"), counts)
    out = spark.read.schema("window struct<start:timestamp,end:timestamp>, post_id long, n long").parquet(f"{folder}/out")
    closed = (likes.agg(F.max("ts_ms")).first()[0] or 0) - 1000 * DELAY_S - 2 * HOUR_MS
    return out.select(F.unix_millis("window.end").alias("window_end_ms"), "post_id", "n").filter(F.col("window_end_ms") <= closed)


def stream_resolve_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments attached to posts as they arrive."""
    folder = new_folder(spark, "stream-threads")
    resolver = ThreadResolver(spark, f"{folder}/state", "long")
    _feed_rows(spark, folder, _arriving(EngagementTables(spark, sf_dir).comments(), "comment_id"), lambda rows: rows, resolver)
    return resolver.resolved.everything().select("comment_id", "post_id", "depth")


def stream_post_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity of posts at every tick that the slower of comments and likes is past."""
    folder = new_folder(spark, "stream-activity")
    a = EngagementTables(spark, sf_dir)
    comments = _arriving(a.comments(), "comment_id").withColumn("topic", F.lit("comment"))
    likes = _arriving(a.likes(), "like_id").withColumn("topic", F.lit("like"))
    body = ThreadedActivity(spark, f"{folder}/state", PARAMS, "long")
    _feed_rows(spark, folder, comments.unionByName(likes, allowMissingColumns=True), lambda rows: rows, body)
    return body.ticks.counts.everything()


def _three_kinds(a: EngagementTables) -> dict[str, DataFrame]:
    """Posts, likes and comments; comments lag by days. A reply to nothing (-1) has no target."""
    nothing = F.col("reply_to_comment") == -1
    comments = a.comments().withColumn("reply_to_comment", F.when(~nothing, F.col("reply_to_comment")))
    return {
        "post": _topic_rows(_arriving(a.raw_posts().drop("k"), "post_id"), "post"),
        "like": _topic_rows(_arriving(a.likes(), "like_id"), "like"),
        "comment": _topic_rows(_arriving(comments, "comment_id", LAG_MS), "comment"),
    }


def stream_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suggestions of every window that all three topics are past, read back from the messages sent."""
    folder = new_folder(spark, "stream-suggestions")
    c = PeopleTables(spark, sf_dir)
    # Made once for all steps.
    side = affinity.static_side(affinity.static_total(affinity.static_units(
        c.person(), c.member(), c.moderator(), c.interest(), c.language(), PARAMS), PARAMS), c.knows(), PARAMS)
    job = Run(folder, once=True, params=PARAMS)
    sink = Topics({"path": f"{folder}/sent"}, "text")
    _feed_topics(spark, folder, _three_kinds(EngagementTables(spark, sf_dir)),
                 lambda source: start_suggestions(spark, source, job, side, None, sink).awaitTermination())
    sent = Outbox(spark, f"{folder}/suggestions/sent", sink.options, sink.fmt).sent_messages("suggestions")
    return decode_suggestions(sent, PARAMS.top_k)


def spread_texts(b: TextTables, a: EngagementTables) -> dict[str, DataFrame]:
    """Texts as events of a month; likes of any time, for posts older and younger than they are."""
    def at(number: Column) -> Column:
        return F.lit(START_MS) + number * 7919 % (SPREAD_DAYS * 1440) * MINUTE_MS

    comments = b.comments()
    return {
        "post": b.posts().withColumn("ts_ms", at(F.col("post_id"))),
        "comment": comments.withColumn("ts_ms", at(F.col("comment_id"))),
        "like": a.likes().withColumn("person_id", F.col("person_id") % 50),
    }


def stream_outliers_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People far from the mean at each midnight that all three topics are past."""
    folder = new_folder(spark, "stream-outliers")
    tables = spread_texts(TextTables(spark, sf_dir), EngagementTables(spark, sf_dir))
    messages = {kind: _topic_rows(_arriving(df, f"{kind}_id"), kind) for kind, df in tables.items()}
    job = Run(folder, once=True, params=PARAMS)
    sink = Topics({"path": f"{folder}/sent"}, "text")
    _feed_topics(spark, folder, messages, lambda source: start_outliers(spark, source, job, LEXICON, sink).awaitTermination(), "parquet")
    daily = spark.read.schema("day_ms long, person_id string, feature_id int, value double, mean double").parquet(f"{folder}/outliers/state/daily")
    return daily.select("day_ms", F.col("person_id").cast("long").alias("person_id"), "feature_id",
                        F.round("value", 6).alias("value"), F.round("mean", 6).alias("mean"))


def _half_messages(messages: DataFrame) -> DataFrame:
    """Every so many events are cut off in the middle."""
    broken = F.pmod(F.col("ts_ms"), F.lit(BROKEN)) == 0
    return messages.withColumn("value", F.when(broken, F.left("value", F.lit(20))).otherwise(F.col("value")))


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events sent, kept, late and rejected, for each topic: some arrive days late, some broken."""
    folder = new_folder(spark, "stream-late")
    a, job = EngagementTables(spark, sf_dir), Run(folder, once=True, params=PARAMS)
    tables = {"post": a.raw_posts().drop("k"), "like": a.likes(), "comment": a.comments()}

    def stray(kind: str) -> Column:
        return F.when(F.col(f"{kind}_id") % STRAY == 0, F.lit(STRAY_MS)).otherwise(F.lit(0))

    messages = {kind: _half_messages(_topic_rows(_arriving(df, f"{kind}_id", stray(kind)), kind)) for kind, df in tables.items()}

    def run(source: Topics) -> None:
        start_rejects(spark, source, job).awaitTermination()
        start_gate(spark, source, job).awaitTermination()

    source = _feed_topics(spark, folder, messages, run)
    event = "topic string, person_id string, ts_ms long"
    parts = {
        "n_kept": spark.read.schema(event).parquet(f"{folder}/gate/state/kept").select(F.col("topic").alias("kind")),
        "n_late": spark.read.schema(event).parquet(f"{folder}/gate/state/late").select(F.col("topic").alias("kind")),
        "n_rejected": spark.read.schema("kind string").parquet(f"{folder}/rejects/state"),
    }
    for kind in tables:
        sent = spark.read.text(f"{source.options['path']}/{TOPICS[kind]}").select(F.lit(kind).alias("kind"))
        parts["n_sent"] = parts["n_sent"].unionAll(sent) if "n_sent" in parts else sent
    names = ("n_sent", "n_kept", "n_late", "n_rejected")
    counted = [df.select("kind", *[F.lit(int(c == name)).alias(c) for c in names]) for name, df in parts.items()]
    united = counted[0]
    for df in counted[1:]:
        united = united.unionByName(df)
    return united.groupBy("kind").agg(*[F.sum(c).alias(c) for c in names])


def stream_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sent, kept and rejected messages of a topic of which some arrive broken."""
    folder = new_folder(spark, "stream-completeness")
    likes = _half_messages(_topic_rows(_arriving(EngagementTables(spark, sf_dir).likes(), "like_id"), "like"))
    job = Run(folder, once=True, params=PARAMS)
    kept = BatchTable(spark, f"{folder}/kept", "person_id string")

    def run(source: Topics) -> None:
        job.start(source.events(spark, "like").select("person_id"), "kept-likes", kept.write).awaitTermination()
        start_rejects(spark, source, job, ("like",)).awaitTermination()

    source = _feed_topics(spark, folder, {"like": likes}, run)
    rejected = spark.read.schema("kind string").parquet(f"{folder}/rejects/state")
    sent = spark.read.text(f"{source.options['path']}/{TOPICS['like']}")
    one = [df.select(*[F.lit(int(i == j)).alias(c) for j, c in enumerate(("n_sent", "n_kept", "n_rejected"))])
           for i, df in enumerate((sent, kept.everything(), rejected))]
    return one[0].unionAll(one[1]).unionAll(one[2]).agg(*[F.sum(c).alias(c) for c in ("n_sent", "n_kept", "n_rejected")])


STREAMS = {f.__name__: f for f in (stream_sliding_counts, stream_resolve_replies, stream_completeness, stream_post_activity,
                                   stream_suggestions, stream_outliers_daily, stream_late)}
