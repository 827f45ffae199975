"""The three analyses as running streams from event topics to result tables and topics."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from murmuration.functions.codec import TOPICS, encode_digest_pages, encode_suggestions, encode_tuple
from murmuration.operators import activity, affinity
from murmuration.params import Params
from murmuration.runtime import materialize, scratch
from murmuration.sources.topics import Outbox, events_of, read_topic, rejects_of
from murmuration.streaming.activity import ThreadedActivity, newest_of
from murmuration.streaming.affinity import SuggestionJob
from murmuration.streaming.outliers import OutlierJob
from murmuration.streaming.state import BatchTable, Clock, State
from murmuration.streaming.threads import ThreadResolver


@dataclass(frozen=True)
class Topics:
    """Where events come from: connector options, and kafka or a file format."""

    options: dict[str, str]
    fmt: str = "kafka"

    def events(self, spark: SparkSession, kind: str) -> DataFrame:
        return events_of(read_topic(spark, TOPICS[kind], self.options, self.fmt), kind)


@dataclass(frozen=True)
class Run:
    """Parameters of a running job. ``once`` stops when the available input is worked off; a topic
    that is silent for ``idle_s`` seconds does not hold the others (off by default)."""

    work_dir: str
    once: bool = False
    idle_s: float | None = None
    params: Params = field(default_factory=Params)

    def start(self, df: DataFrame, name: str, body) -> StreamingQuery:
        writer = df.writeStream.outputMode("append").option("checkpointLocation", f"{self.work_dir}/{name}/checkpoint")
        if self.once:
            writer = writer.trigger(availableNow=True)
        return writer.queryName(name).foreachBatch(body).start()


def start_threads(spark: SparkSession, source: Topics, run: Run, max_age_ms: int | None = None) -> StreamingQuery:
    """Attach comments to posts; results are in ``work_dir/threads/state/resolved``."""
    resolver = ThreadResolver(spark, f"{run.work_dir}/threads/state", max_age_ms=max_age_ms)
    return run.start(source.events(spark, "comment"), "threads", resolver)


def resolved_stream(spark: SparkSession, run: Run) -> DataFrame:
    """Stream of the comments that ``start_threads`` has resolved.

    A batch that failed half-way and ran again may have left files twice, so repeats of a
    comment are dropped.
    """
    table = ThreadResolver(spark, f"{run.work_dir}/threads/state").resolved
    rows = spark.readStream.schema(table.schema).parquet(f"{table.path}/batch=*")
    return (
        rows.withColumn("ts", F.timestamp_millis("ts_ms"))
        .withWatermark("ts", f"{run.params.max_delay_s} seconds")
        .dropDuplicatesWithinWatermark(["comment_id"])
    )


def _topics(source: Topics, spark: SparkSession, *kinds: str) -> DataFrame:
    """Events of several topics in one stream, with the topic they come from."""
    parts = [source.events(spark, k).withColumn("topic", F.lit(k)) for k in kinds]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def start_activity(
    spark: SparkSession, source: Topics, run: Run, sink: Topics | None = None, topic: str = "activity",
    max_age_ms: int | None = None,
) -> StreamingQuery:
    """Activity messages, one or more pages per tick, as text to ``topic`` of ``sink``.

    Replies are attached to their posts in the same batches; one that is resolved late counts
    from the current tick on.
    """
    target = sink or source
    outbox = Outbox(spark, f"{run.work_dir}/activity/sent", target.options, target.fmt)

    def send(counts: DataFrame, batch_id: int) -> None:
        outbox.send(encode_digest_pages(activity.activity_digest(counts, run.params)), topic, batch_id)

    body = ThreadedActivity(spark, f"{run.work_dir}/activity/state", run.params, on_counts=send, max_age_ms=max_age_ms, idle_s=run.idle_s)
    return run.start(_topics(source, spark, "comment", "like"), "activity", body)


def start_suggestions(
    spark: SparkSession, source: Topics, run: Run, static: DataFrame | affinity.StaticSide, knows: DataFrame | None,
    sink: Topics | None = None, topic: str = "suggestions", id_type: str = "long", selected: DataFrame | None = None,
) -> StreamingQuery:
    """Suggestions per closed window in ``work_dir/suggestions/state/suggestions``, and as text to
    ``topic`` of ``sink``. Ids that are no numbers need ``id_type`` string. ``static`` may be a made side (see ``SuggestionJob``)."""
    target = sink or source
    outbox = Outbox(spark, f"{run.work_dir}/suggestions/sent", target.options, target.fmt)

    def send(ranked: DataFrame, batch_id: int) -> None:
        outbox.send(encode_suggestions(affinity.suggest_wide(ranked, run.params), run.params.top_k), topic, batch_id)

    kinds = [source.events(spark, k).withColumn("topic", F.lit(k)) for k in ("post", "like", "comment")]
    rows = affinity.activity_rows(*kinds, "topic").withColumn("person_id", F.col("person_id").cast(id_type))
    body = SuggestionJob(spark, f"{run.work_dir}/suggestions/state", static, knows, run.params, id_type=id_type,
                         on_ranked=send, idle_s=run.idle_s, selected=selected)
    return run.start(rows, "suggestions", body)


def start_outliers(
    spark: SparkSession, source: Topics, run: Run, lexicon: Collection[str] | DataFrame,
    sink: Topics | None = None, topic: str = "outliers",
) -> StreamingQuery:
    """Statistics and outliers per closed day in ``work_dir/outliers/state``, and as text: those at
    new values to ``topic`` of ``sink``, those at midnight to ``topic``-daily."""
    target = sink or source
    outbox = Outbox(spark, f"{run.work_dir}/outliers/sent", target.options, target.fmt)

    def send(on_update: DataFrame, daily: DataFrame, batch_id: int) -> None:
        outbox.send(encode_tuple(on_update, ["person_id", "feature_id", "value", "mean", "ts_ms"]), topic, batch_id)
        outbox.send(encode_tuple(daily, ["day_ms", "person_id", "feature_id", "value", "mean"]), f"{topic}-daily", batch_id)

    body = OutlierJob(spark, f"{run.work_dir}/outliers/state", lexicon, run.params, on_closed=send, idle_s=run.idle_s)
    return run.start(_topics(source, spark, "post", "comment", "like"), "outliers", body)


class LateGate:
    """``foreachBatch`` body that parts events into those in time and those behind the watermark.

    The watermark is that of the slowest topic, as far as earlier batches have seen it. A side
    output in front of any job; what it keeps, what is late and what ``rejects_of`` finds are
    together all that was sent.
    """

    def __init__(self, spark: SparkSession, state_dir: str, inputs: Collection[str], p: Params = Params(), idle_s: float | None = None):
        self.state = State(spark, f"{state_dir}/kept-notes", {})
        event = "topic string, person_id string, ts_ms long"
        self.kept, self.late = (BatchTable(spark, f"{state_dir}/{name}", event) for name in ("kept", "late"))
        self.clock, self.spark = Clock(list(inputs), 1000 * p.max_delay_s, idle_s), spark

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(self.spark):
            batch = materialize(batch.select(*self.kept.schema.names), "events")
            self.state.begin(batch_id)
            passed = self.state.notes.get("passed")
            is_late = F.col("ts_ms") < F.lit(passed) if passed is not None else F.lit(False)
            self.late.write(batch.filter(is_late), batch_id)
            self.kept.write(batch.filter(~is_late), batch_id)
            now = self.clock.advance(self.state.notes, newest_of(batch))
            self.state.notes["passed"] = max((t for t in (passed, now) if t is not None), default=None)
            self.state.commit()


def start_gate(spark: SparkSession, source: Topics, run: Run) -> StreamingQuery:
    """Events in time and late ones, in ``work_dir/gate/state``."""
    kinds = ("post", "like", "comment")
    return run.start(_topics(source, spark, *kinds), "gate", LateGate(spark, f"{run.work_dir}/gate/state", kinds, run.params, run.idle_s))


def start_rejects(spark: SparkSession, source: Topics, run: Run, kinds: Collection[str] = ("post", "like", "comment")) -> StreamingQuery:
    """Messages that are no events, with the reason, in ``work_dir/rejects/state``."""
    parts = [rejects_of(read_topic(spark, TOPICS[k], source.options, source.fmt), k) for k in kinds]
    table = BatchTable(spark, f"{run.work_dir}/rejects/state", "kind string, value string, reason string")
    return run.start(reduce(DataFrame.unionByName, parts), "rejects", table.write)
