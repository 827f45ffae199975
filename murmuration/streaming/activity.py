"""Post activity as a stream: the batch results for all closed ticks.

``TickActivity`` counts whole micro-batches with tables as state; ``stream_activity`` is the form with
state and event-time timers per post.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from murmuration.functions.timing import floor_to
from murmuration.operators import activity
from murmuration.params import COMMENT, ENGAGEMENT, KIND_COMMENT, KIND_LIKE, REPLY, Params
from murmuration.runtime import materialize, scratch
from murmuration.streaming.state import BatchTable, Clock, Kept, State
from murmuration.streaming.threads import ThreadResolver

_PART = "post_id string, tick timestamp, comments long, replies long, people long, last_ms long"
_COUNTS = "as_of timestamp, post_id string, metric string, n long"


class NewPeople(StatefulProcessor):
    """Per (post, shard of people): adds up a tick's rows and counts people not seen before.

    A popular post is spread over the shards, and every person belongs to one shard, so
    the shards' counts add up to the post's.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "person string", "yes boolean", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        totals: dict = {}
        first: dict = {}
        for frame in rows:
            for row in frame.itertuples(index=False):
                part = totals.setdefault(row.tick, [0, 0, 0, 0])
                part[0] += row.comments
                part[1] += row.replies
                part[3] = max(part[3], row.last_ms)
                # One trigger may close several ticks; a person counts in the earliest.
                if row.person_id not in first or row.tick < first[row.person_id]:
                    first[row.person_id] = row.tick
        for person, tick in first.items():
            if not self.seen.containsKey((person,)):
                self.seen.updateValue((person,), (True,))
                totals[tick][2] += 1
        yield pd.DataFrame(
            [(key[0], tick, *part) for tick, part in totals.items()],
            columns=["post_id", "tick", "comments", "replies", "people", "last_ms"],
        )

    def close(self) -> None:
        pass


class TickCounter(StatefulProcessor):
    """Per post: cumulative counts, emitted by an event-time timer at each tick while active.

    Takes at most one row per tick and shard.
    """

    def __init__(self, tick_ms: int, active_ms: int):
        self.tick_ms, self.active_ms = tick_ms, active_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "comments long, replies long, people long, last_ms long")
        self.waiting = handle.getMapState(
            "waiting", "tick_ms long", "comments long, replies long, people long, last_ms long"
        )
        self.timer = handle.getValueState("timer", "tick_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for frame in rows:
            for row in frame.itertuples(index=False):
                tick = int(pd.Timestamp(row.tick).value // 1_000_000)
                old = self.waiting.getValue((tick,)) or (0, 0, 0, 0)
                self.waiting.updateValue((tick,), (
                    old[0] + row.comments, old[1] + row.replies, old[2] + row.people, max(old[3], row.last_ms)
                ))
                earliest = tick if earliest is None else min(earliest, tick)
        armed = self.timer.get()
        if earliest is not None and (armed is None or earliest < armed[0]):
            if armed is not None:
                self.handle.deleteTimer(armed[0])
            self._arm(earliest)
        return iter([])

    def _arm(self, tick: int) -> None:
        self.timer.update((tick,))
        self.handle.registerTimer(tick)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tick, now = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        out = []
        comments, replies, people, last_ms = self.total.get() or (0, 0, 0, 0)
        while True:
            new = self.waiting.getValue((tick,))
            if new is not None:
                comments, replies, people = comments + new[0], replies + new[1], people + new[2]
                last_ms = max(last_ms, new[3])
                self.waiting.removeKey((tick,))
            active = last_ms > tick - self.active_ms
            if active:
                at = pd.Timestamp(tick, unit="ms", tz="UTC")
                out += [(at, key[0], COMMENT, comments), (at, key[0], REPLY, replies), (at, key[0], ENGAGEMENT, people)]
                tick += self.tick_ms
            else:
                # Silent until the next event: jump to its tick, or rest.
                later = [k[0] for k in self.waiting.keys()]
                if not later:
                    tick = None
                    break
                tick = min(later)
            if tick > now:
                break
        self.total.update((comments, replies, people, last_ms))
        if tick is None:
            self.timer.clear()
        else:
            self._arm(tick)
        if out:
            yield pd.DataFrame(out, columns=["as_of", "post_id", "metric", "n"])

    def close(self) -> None:
        pass


def stream_activity(
    events: DataFrame, p: Params = Params(), shards: int = 8, delay_s: int | None = None,
    ttl_ms: int | None = None, watermarked: bool = False,
) -> DataFrame:
    """(as_of, post_id, metric, n) from a stream (post_id, kind, person_id, ts).

    Rows are first counted per tick, post and person by the built-in window aggregate,
    which combines before the shuffle; Python sees those counts only, one call per post, person and
    tick. ``delay_s`` is how far
    rows may be out of order (unless the input is ``watermarked`` already), ``ttl_ms`` an
    optional age after which engaged people are forgotten (off, as in batch).
    """
    delay = p.max_delay_s if delay_s is None else delay_s
    tick = F.window("ts", f"{p.tick_ms} milliseconds")
    timed = events if watermarked else events.withWatermark("ts", f"{delay} seconds")
    counted = (
        timed
        .groupBy(tick.alias("window"), F.col("post_id").cast("string").alias("post_id"),
                 F.col("person_id").cast("string").alias("person_id"))
        .agg(
            F.count_if(F.col("kind") == KIND_COMMENT).alias("comments"),
            F.count_if(F.col("kind") != KIND_LIKE).alias("replies"),
            F.max(F.unix_millis("ts")).alias("last_ms"),
        )
        .select(
            F.col("window.end").alias("tick"), "post_id", "person_id", "comments", "replies", "last_ms",
            F.pmod(F.xxhash64("person_id"), F.lit(shards)).alias("shard"),
        )
    )
    people = counted.groupBy("post_id", "shard").transformWithStateInPandas(
        NewPeople(ttl_ms), _PART, "append", "EventTime", eventTimeColumnName="tick"
    )
    return people.groupBy("post_id").transformWithStateInPandas(
        TickCounter(p.tick_ms, p.active_ms), _COUNTS, "append", "EventTime"
    )


class TickActivity:
    """``foreachBatch`` body for engagement events: the batch results for all closed ticks.

    Counting is done by built-in aggregates: a post's popularity adds rows that are combined before
    any shuffle, and whether a person is new to a post is an anti-join with the pairs seen, spread by both.
    Events wait until every topic is past their tick (``Clock``). An event that is found behind the last
    closed tick, such as a reply whose parent came late, counts from the current tick on and is
    kept in ``late``; whether a post is active is decided by the events' own times.
    """

    def __init__(
        self, spark: SparkSession, state_dir: str, inputs: Sequence[str], p: Params = Params(), delay_s: int | None = None,
        id_type: str = "string", on_counts: Callable[[DataFrame, int], None] | None = None, idle_s: float | None = None,
    ):
        event = f"post_id {id_type}, kind int, person_id {id_type}, ts_ms long, event_id {id_type}"
        self.spark, self.p, self.on_counts = spark, p, on_counts
        self.clock = Clock(inputs, 1000 * (p.max_delay_s if delay_s is None else delay_s), idle_s)
        self.state = State(spark, f"{state_dir}/kept", {
            "open": Kept(f"{event}, at_ms long"),
            "seen": Kept(f"post_id {id_type}, person_id {id_type}", keys=("post_id", "person_id")),
            "posts": Kept(f"post_id {id_type}, comments long, replies long, people long, last_ms long", keys=("post_id",), latest=True),
        })
        self.counts = BatchTable(spark, f"{state_dir}/counts", f"as_of_ms long, post_id {id_type}, metric string, n long")
        self.late = BatchTable(spark, f"{state_dir}/late", event)

    def step(self, events: DataFrame, newest: dict[str, int | None], batch_id: int) -> None:
        """``events`` as of ``activity.engagement_events``; ``newest`` event time of each input."""
        state, tick = self.state, self.p.tick_ms
        state.begin(batch_id)
        passed, done = self.clock.advance(state.notes, newest), state.notes.get("done")
        is_late = F.col("ts_ms") < F.lit(done) if done is not None else F.lit(False)
        self.late.write(events.filter(is_late), batch_id)
        state.add("open", events.withColumn("at_ms", F.when(is_late, F.lit(done).cast("long")).otherwise(F.col("ts_ms"))))
        closed = None if passed is None else passed // tick * tick
        if closed is None or (done is not None and closed <= done):
            self.counts.write(self.counts.empty(), batch_id)
        else:
            self._close(done, closed, batch_id)
            state.notes["done"] = closed
        state.commit()
        if self.on_counts is not None:
            self.on_counts(self.counts.of(batch_id), batch_id)

    def _close(self, done: int | None, closed: int, batch_id: int) -> None:
        state, tick = self.state, self.p.tick_ms
        waiting = state.read("open")
        rows = materialize(waiting.filter(F.col("at_ms") < closed), "closing")
        state.replace("open", waiting.filter(F.col("at_ms") >= closed))
        bucket = floor_to(F.col("at_ms"), tick).alias("bucket_ms")
        zero, nothing = F.lit(0).cast("long"), F.lit(None).cast("long")
        counted = rows.groupBy("post_id", bucket).agg(
            F.count_if(F.col("kind") == KIND_COMMENT).alias("comments"), F.count_if(F.col("kind") != KIND_LIKE).alias("replies"),
            zero.alias("people"), F.max("ts_ms").alias("last_ms"))
        pairs = rows.groupBy("post_id", "person_id").agg(F.min("at_ms").alias("at_ms"))
        new = materialize(pairs.join(state.lookup("seen", pairs), ["post_id", "person_id"], "left_anti"), "new-people")
        state.add("seen", new)
        joined = new.groupBy("post_id", bucket).agg(F.count("*").alias("people")).select(
            "post_id", "bucket_ms", zero.alias("comments"), zero.alias("replies"), "people", nothing.alias("last_ms"))
        # Posts go on from their totals: those with new events, and those that are still active.
        active = F.col("last_ms") > F.lit((done or 0) - self.p.active_ms)
        touched = rows.select("post_id").distinct().withColumn("touched", F.lit(True))
        carried = state.read("posts").join(touched, "post_id", "left").filter(active | F.col("touched")).select(
            "post_id", F.lit((done or 0) - tick).cast("long").alias("bucket_ms"), "comments", "replies", "people", "last_ms")
        measures = ("comments", "replies", "people")
        buckets = materialize(counted.unionByName(joined).unionByName(carried).groupBy("post_id", "bucket_ms").agg(
            *[F.sum(c).alias(c) for c in measures], F.max("last_ms").alias("last_ms")), "tick-buckets")
        # A post has a row for each tick interval since the last close.
        post = Window.partitionBy("post_id").orderBy("bucket_ms")
        upto = post.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = buckets.select(
            "post_id", "bucket_ms", *[F.sum(c).over(upto).alias(c) for c in measures], F.max("last_ms").over(upto).alias("last_ms"),
            F.lead("bucket_ms").over(post).alias("next_ms"))
        first = F.lit(0 if done is None else done + tick).cast("long")
        spans = running.select(
            "post_id", F.col("comments").alias(COMMENT), F.col("replies").alias(REPLY), F.col("people").alias(ENGAGEMENT),
            F.greatest(F.col("bucket_ms") + F.lit(tick), first).alias("from_ms"),
            F.least("next_ms", floor_to(F.col("last_ms") + F.lit(self.p.active_ms - 1), tick), F.lit(closed).cast("long")).alias("to_ms"))
        ticks = spans.filter("from_ms <= to_ms").select(
            F.explode(F.sequence("from_ms", "to_ms", F.lit(tick))).alias("as_of_ms"), "post_id", COMMENT, REPLY, ENGAGEMENT)
        self.counts.write(ticks.unpivot(["as_of_ms", "post_id"], [COMMENT, REPLY, ENGAGEMENT], "metric", "n"), batch_id)
        state.add("posts", running.filter("next_ms is null").join(touched, "post_id", "left_semi"))


class ThreadedActivity:
    """``foreachBatch`` body for (topic, comment and like columns): threads are resolved and their
    replies counted in the same batch, so none is lost between the two."""

    def __init__(self, spark: SparkSession, state_dir: str, p: Params = Params(), id_type: str = "string",
                 on_counts: Callable[[DataFrame, int], None] | None = None, max_age_ms: int | None = None,
                 idle_s: float | None = None):
        self.spark = spark
        self.threads = ThreadResolver(spark, f"{state_dir}/threads", id_type, max_age_ms)
        self.ticks = TickActivity(spark, f"{state_dir}/ticks", ("comment", "like"), p, id_type=id_type, on_counts=on_counts, idle_s=idle_s)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(self.spark):
            batch = materialize(batch, "engagement")
            comments, likes = batch.filter("topic = 'comment'"), batch.filter("topic = 'like'")
            solved = self.threads.step(comments, batch_id)
            self.ticks.step(activity.engagement_events(solved, likes), newest_of(batch), batch_id)


def newest_of(batch: DataFrame) -> dict[str, int]:
    """Newest event time of each topic in a batch: one row a topic."""
    return {r.topic: r.ts_ms for r in batch.groupBy("topic").agg(F.max("ts_ms").alias("ts_ms")).collect()}
