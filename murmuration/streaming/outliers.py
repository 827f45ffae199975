"""Features and outliers as a stream: each day is worked off once it is complete."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.operators import features, outliers
from murmuration.operators.scan import prefix_scan
from murmuration.params import DAY_MS, Params
from murmuration.runtime import materialize, scratch
from murmuration.streaming.state import BatchTable, Clock, Kept, State
from murmuration.streaming.threads import LikedAuthors

_STEP = "person_id string, feature_id int, ts_ms long, event_id string, num double, den long"


class DailyOutliers:
    """``foreachBatch`` body for a stream of feature steps and items.

    Input rows (person_id, feature_id, ts_ms, event_id, num, den, item): what an event adds
    to a feature, and for features that count distinct things one row per thing, with
    ``item`` set and ``den`` 0. See ``feature_rows``.

    Every batch lands its rows. When the newest event of every input is ``delay_s`` past a
    midnight, the days before it are complete: items not seen before count once, running
    values continue from the stored totals, and the statistics of the next midnight come from
    the totals. ``inputs`` are the feature ids of each topic; a topic that lags, or has not
    begun, holds the days open (``idle_s``: see ``Clock``). Rows that come for a day worked off are
    kept in ``late``; those of days worked off leave the state.
    """

    def __init__(
        self, spark: SparkSession, state_dir: str, p: Params = Params(), delay_s: int | None = None,
        inputs: Sequence[Collection[int]] | None = None, idle_s: float | None = None,
    ):
        self.spark, self.p = spark, p
        self.inputs = {str(i): features for i, features in enumerate(inputs or [None])}
        self.clock = Clock(list(self.inputs), 1000 * (p.max_delay_s if delay_s is None else delay_s), idle_s)
        self.state = State(spark, f"{state_dir}/kept", {
            "open": Kept(f"{_STEP}, item string"),
            "seen": Kept("person_id string, feature_id int, item string", keys=("person_id", "feature_id", "item")),
            "totals": Kept("person_id string, feature_id int, num double, den long", keys=("person_id", "feature_id"), latest=True),
            "midnight": Kept("feature_id int, day_ms long, n_people long, mean double, sd double"),
        })

        def table(name: str, schema: str) -> BatchTable:
            return BatchTable(spark, f"{state_dir}/{name}", schema)

        self.late = table("late", f"{_STEP}, item string")
        self.stats = table("stats", "feature_id int, day_ms long, n_people long, mean double, sd double")
        self.on_update = table(
            "on_update", "person_id string, feature_id int, event_id string, value double, mean double, ts_ms long"
        )
        self.daily = table("daily", "day_ms long, person_id string, feature_id int, value double, mean double")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(self.spark):
            self.step(materialize(batch, "feature-rows"), batch_id)

    def step(self, batch: DataFrame, batch_id: int) -> bool:
        """Take a stored batch in; whether days were worked off."""
        state = self.state
        state.begin(batch_id)
        done, passed = state.notes.get("done"), self.clock.advance(state.notes, self._newest(batch))
        is_late = F.col("ts_ms") < F.lit(done) if done is not None else F.lit(False)
        self.late.write(batch.filter(is_late), batch_id)
        state.add("open", batch.filter(~is_late))
        closing = False
        if passed is not None:
            complete = passed // DAY_MS * DAY_MS
            waiting = state.read("open")
            rows = materialize(waiting.filter(F.col("ts_ms") < complete), "closing-days")
            closing = not rows.isEmpty()
            if closing:
                state.replace("open", waiting.filter(F.col("ts_ms") >= complete))
                self._work_off(rows, done, complete, batch_id)
                state.notes["done"] = complete
        state.commit()
        return closing

    def _newest(self, batch: DataFrame) -> dict[str, int | None]:
        """Newest event of each input. Items may have the time of another topic's event; they do not count."""
        # One row per feature: a few.
        now = {r.feature_id: r.ts_ms for r in batch.filter("item is null").groupBy("feature_id").agg(F.max("ts_ms").alias("ts_ms")).collect()}
        return {name: max((ts for f, ts in now.items() if ts is not None and (features is None or f in features)), default=None)
                for name, features in self.inputs.items()}

    def _work_off(self, rows: DataFrame, done: int | None, complete: int, batch_id: int) -> None:
        key, state = ["person_id", "feature_id"], self.state
        carried = state.read("totals")
        first = materialize(rows.filter("item is not null").groupBy(*key, "item").agg(
            F.min(F.struct("ts_ms", "event_id")).alias("at")), "stream-items")
        new = materialize(
            first.join(state.lookup("seen", first), [*key, "item"], "left_anti").select(*key, "item", "at.ts_ms", "at.event_id"),
            "stream-new-items")
        state.add("seen", new)

        steps = rows.filter("item is null").select("person_id", "feature_id", "ts_ms", "event_id", "num", "den").unionByName(
            new.select(*key, "ts_ms", "event_id", F.lit(1.0).alias("num"), F.lit(0).cast("long").alias("den"))
        ).unionByName(
            # The totals so far enter as a step in front of all others.
            carried.select(*key, F.lit(-1).cast("long").alias("ts_ms"), F.lit("").alias("event_id"), "num", "den")
        ).groupBy(*key, "ts_ms", "event_id").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
        running = materialize(
            prefix_scan(steps, keys=key, order=["ts_ms", "event_id"], sums={"_num": "num", "_den": "den"}).select(
                *key, "event_id", "ts_ms", F.col("_num").alias("num"), F.col("_den").alias("den"),
                (F.col("_num") / F.nullif(F.col("_den"), F.lit(0))).alias("value"),
            ),
            "stream-values",
        )
        last = F.max_by(F.struct("num", "den"), F.struct("ts_ms", "event_id"))
        moved = running.filter("ts_ms >= 0").select(*key).distinct()
        state.add("totals", running.groupBy(*key).agg(last.alias("t")).select(*key, "t.num", "t.den").join(moved, key, "left_semi"))
        # The carried totals stand for the last values before these days, that is for the
        # midnight already reported.
        reported = done or 0
        values = running.withColumn("ts_ms", F.greatest("ts_ms", F.lit(reported - 1)))
        daily = materialize(
            outliers.feature_daily(values, complete).filter(F.col("day_ms") > reported), "stream-daily"
        )
        self.stats.write(outliers.feature_stats(daily), batch_id)
        stats = self.stats.of(batch_id)
        # Values of the days worked off are compared with the midnights from the last reported one on.
        known = state.read("midnight").unionByName(stats)
        self.on_update.write(outliers.outliers_on_update(running.filter("ts_ms >= 0"), known, self.p.n_sigma), batch_id)
        state.replace("midnight", known.filter(F.col("day_ms") >= complete))
        self.daily.write(outliers.outliers_daily(daily, self.stats.of(batch_id), self.p.n_sigma), batch_id)


class OutlierJob:
    """``foreachBatch`` body for events (topic and the columns of posts, comments and likes).

    Texts are measured, likes meet their authors however old the post is (``LikedAuthors``), and
    ``DailyOutliers`` takes the feature rows. A day is complete when all three topics are past it.
    """

    INPUTS = ({features.POST_UNIQ, features.POST_BAD},
              {features.COMMENT_UNIQ, features.COMMENT_BAD, features.COMMENT_VOCAB}, {features.LIKE_SPREAD})

    def __init__(self, spark: SparkSession, state_dir: str, lexicon: Collection[str] | DataFrame, p: Params = Params(),
                 on_closed: Callable[[DataFrame, DataFrame, int], None] | None = None, idle_s: float | None = None):
        self.spark, self.lexicon, self.on_closed = spark, lexicon, on_closed
        self.authors = LikedAuthors(spark, f"{state_dir}/authors")
        self.days = DailyOutliers(spark, state_dir, p, inputs=self.INPUTS, idle_s=idle_s)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(self.spark):
            text = F.coalesce("content", F.lit(""))
            events = materialize(batch.withColumn("content", text), "events")
            posts, comments, likes = (events.filter(F.col("topic") == t) for t in ("post", "comment", "like"))
            matched = self.authors.step(likes, posts, batch_id)
            rows = feature_rows(
                [features.post_steps(posts, self.lexicon), features.comment_text_steps(comments, self.lexicon),
                 features.comment_units(comments), features.like_units(likes)],
                [features.word_items(comments), features.author_items(matched)],
            )
            closed = self.days.step(materialize(rows, "feature-rows"), batch_id)
            if closed and self.on_closed is not None:
                self.on_closed(self.days.on_update.of(batch_id), self.days.daily.of(batch_id), batch_id)


def feature_rows(steps: list[DataFrame], items: list[DataFrame]) -> DataFrame:
    """Input of ``DailyOutliers``: plain steps, and item rows (person_id, feature_id, ts_ms, event_id, item)."""
    none = F.lit(None).cast("string")
    parts = [s.withColumn("item", none) for s in steps] + [
        i.withColumn("num", F.lit(0.0)).withColumn("den", F.lit(0).cast("long")) for i in items
    ]
    columns = [
        F.col("person_id").cast("string").alias("person_id"), "feature_id", "ts_ms",
        F.col("event_id").cast("string").alias("event_id"), "num", "den", F.col("item").cast("string").alias("item"),
    ]
    return reduce(DataFrame.unionByName, [part.select(*columns) for part in parts])
