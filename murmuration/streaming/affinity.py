"""Friend suggestions as a stream: results for every window behind the watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.functions.timing import floor_to
from murmuration.operators import affinity
from murmuration.params import Params
from murmuration.runtime import materialize, scratch
from murmuration.streaming.activity import newest_of
from murmuration.streaming.state import BatchTable, Clock, Kept, State


def slice_counts(
    rows: DataFrame, p: Params = Params(), delay_s: int | None = None, watermarked: bool = False
) -> DataFrame:
    """Rows per slide of time, kind, target and person; a slice comes when it is complete.

    ``rows`` is a stream of ``affinity.activity_rows`` with event time ``ts``. A union of
    several topics must have a watermark on each before the union (``watermarked``): then
    the slowest topic decides what is complete, and none loses rows to a faster one.
    """
    delay = p.max_delay_s if delay_s is None else delay_s
    return (
        (rows if watermarked else rows.withWatermark("ts", f"{delay} seconds"))
        .groupBy(F.window("ts", f"{p.slide_ms} milliseconds").alias("slice"), "kind", "target", "person_id")
        .agg(F.count("*").alias("n"))
        .select(F.unix_millis("slice.start").alias("ts_ms"), "kind", "target", "person_id", "n")
    )


class SuggestionWriter:
    """``foreachBatch`` body for ``slice_counts``: appends closed slices, ranks closed windows.

    Ranking is not possible on a stream, so each batch ranks the windows that have become
    complete with the batch operators. It reads only the slices those windows reach.
    """

    def __init__(self, spark: SparkSession, state_dir: str, static: DataFrame, knows: DataFrame, p: Params = Params()):
        self.slices = BatchTable(
            spark, f"{state_dir}/slices", "ts_ms long, kind string, target string, person_id long, n long"
        )
        self.done = BatchTable(spark, f"{state_dir}/done", "window_end_ms long")
        self.suggestions = BatchTable(
            spark, f"{state_dir}/suggestions",
            "window_end_ms long, selected_id long, rank long, candidate_id long, score long",
        )
        self.side, self.p = affinity.static_side(static, knows, p), p

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        p = self.p
        self.slices.write(batch, batch_id)
        # The slices of a batch end behind the watermark, so windows up to the last end are complete.
        last = self.slices.of(batch_id).agg(F.max("ts_ms")).first()[0]
        if last is None:
            return
        upto = last + p.slide_ms
        since = self.done.before(batch_id).agg(F.max("window_end_ms")).first()[0] or 0
        reach = 2 * p.window_ms - p.slide_ms
        past = self.slices.before(batch_id + 1).filter(
            (F.col("ts_ms") >= since + p.slide_ms - reach) & (F.col("ts_ms") < upto)
        )
        closed = affinity.activity_scores(past, p).filter(
            (F.col("window_end_ms") > since) & (F.col("window_end_ms") <= upto)
        )
        self.suggestions.write(affinity.suggest_beside(closed, self.side, p), batch_id)
        self.done.write(self.done.spark.createDataFrame([(upto,)], self.done.schema), batch_id)


class SuggestionJob:
    """``foreachBatch`` body for rows (topic, kind, person_id, target, ts_ms): ranks closed windows.

    Each batch becomes counts per slide of time; a window is complete when every topic is past its
    end, so a topic that lags holds it. Counts that no open window reaches are dropped. Rows behind
    the last ranked window are kept in ``late``. ``static`` may be a side that is made already, for a job that is
    started again and again; friends are in it.
    """

    def __init__(self, spark: SparkSession, state_dir: str, static: DataFrame | affinity.StaticSide, knows: DataFrame | None, p: Params = Params(),
                 inputs: tuple[str, ...] = ("post", "like", "comment"), id_type: str = "long",
                 on_ranked: Callable[[DataFrame, int], None] | None = None, idle_s: float | None = None,
                 selected: DataFrame | None = None):
        self.spark, self.p, self.on_ranked = spark, p, on_ranked
        self.selected = None if selected is None else materialize(selected, "selected")
        # The static side stays the same for all batches: it is computed once.
        self.side = static if isinstance(static, affinity.StaticSide) else affinity.static_side(static, knows, p, self.selected)
        self.clock = Clock(inputs, 1000 * p.max_delay_s, idle_s)
        self.state = State(spark, f"{state_dir}/kept", {
            "slices": Kept(f"ts_ms long, kind string, target string, person_id {id_type}, n long")})
        self.late = BatchTable(spark, f"{state_dir}/late", f"topic string, kind string, target string, person_id {id_type}, ts_ms long")
        self.suggestions = BatchTable(spark, f"{state_dir}/suggestions",
                                      f"window_end_ms long, selected_id {id_type}, rank long, candidate_id {id_type}, score long")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(self.spark):
            self._step(materialize(batch, "acts"), batch_id)

    def _step(self, batch: DataFrame, batch_id: int) -> None:
        p, state = self.p, self.state
        state.begin(batch_id)
        passed, done = self.clock.advance(state.notes, newest_of(batch)), state.notes.get("done")
        is_late = F.col("ts_ms") < F.lit(done) if done is not None else F.lit(False)
        self.late.write(batch.filter(is_late), batch_id)
        state.add("slices", batch.filter(~is_late).groupBy(
            floor_to(F.col("ts_ms"), p.slide_ms).alias("ts_ms"), "kind", "target", "person_id").agg(F.count("*").alias("n")))
        closed = None if passed is None else passed // p.slide_ms * p.slide_ms
        if closed is None or (done is not None and closed <= done):
            self.suggestions.write(self.suggestions.empty(), batch_id)
        else:
            reach = 2 * p.window_ms - p.slide_ms
            slices = state.read("slices")
            past = slices.filter(F.col("ts_ms") < closed)
            scores = affinity.activity_scores(past, p, self.selected).filter(
                (F.col("window_end_ms") > F.lit(done or 0)) & (F.col("window_end_ms") <= closed))
            self.suggestions.write(affinity.suggest_beside(scores, self.side, p, self.selected), batch_id)
            state.replace("slices", slices.filter(F.col("ts_ms") >= closed + p.slide_ms - reach))
            state.notes["done"] = closed
        state.commit()
        if self.on_ranked is not None:
            self.on_ranked(self.suggestions.of(batch_id), batch_id)
