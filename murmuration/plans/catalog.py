"""Every operator as a named query over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration.functions import codec, text
from murmuration.functions.timing import as_timestamp, epoch_ms, with_event_time
from murmuration.operators import activity, affinity, features, outliers, pairs, quality, threads, windows
from murmuration.params import DAY_MS, HOUR_MS, MINUTE_MS, Params
from murmuration.plans import prep
from murmuration.plans.streams import STREAMS
from murmuration.runtime import materialize, new_folder
from murmuration.sources.files import lexicon_table, write_raw
from murmuration.sources.star import LEXICON, SELECTED, EngagementTables, PeopleTables, TextTables, raw_inputs, table

PARAMS = Params(selected=SELECTED)
FILE_ORDER = ["arrival_ms", "event_no"]


def _arriving(df: DataFrame, id_col: str, p: Params = PARAMS) -> DataFrame:
    """Stream rows with their arrival order."""
    return quality.with_arrival(df, id_col, p.min_delay_s, p.max_delay_s).withColumn("event_no", F.col(id_col))


def _six(c: Column | str) -> Column:
    return F.round(c, 6)


class Jobs:
    """The queries over one set of tables. Methods named like a query are that query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.a = EngagementTables(spark, sf_dir)
        self.b = TextTables(spark, sf_dir)
        self.c = PeopleTables(spark, sf_dir)
        self.p = PARAMS

    # -- sources and sinks ---------------------------------------------------------

    def decode_json(self) -> DataFrame:
        rows = self.a.raw.select("event_id", F.col("props").alias("value"))
        schema = T.StructType([T.StructField("k", T.LongType())])
        return codec.decode_json(rows, schema)

    def encode_json(self) -> DataFrame:
        likes = self.a.likes().select(
            F.col("ts_ms").alias("timeMilisecond"), F.col("person_id").cast("string").alias("personId"),
            F.col("post_id").cast("string").alias("postId"), F.lit(None).cast("array<int>").alias("creationDate"),
        )
        return codec.encode_events_of(likes, "like")

    def encode_tuple(self) -> DataFrame:
        return codec.encode_digest(self._digest())

    def encode_digest_pages(self) -> DataFrame:
        """Digest messages with their page and the number of pages."""
        return codec.encode_digest_pages(self._digest())

    def decode_tuple(self) -> DataFrame:
        return codec.decode_tuple(codec.encode_digest(self._digest()))

    # -- cleaning ------------------------------------------------------------------

    def epoch_ms(self) -> DataFrame:
        iso = "yyyy-MM-dd'T'HH:mm:ss"
        texts = self.a.raw.select(
            "event_id",
            F.date_format("ts", f"{iso}'Z'").alias("to_second"), F.date_format("ts", f"{iso}.SSS'Z'").alias("to_milli"),
        )
        parsed = with_event_time(with_event_time(texts, "to_second", "seconds", "second_ms"), "to_milli", "millis", "milli_ms")
        return with_event_time(parsed, "to_milli", "seconds", "wrong_form_ms").drop("to_second", "to_milli")

    def monotone_posts(self) -> DataFrame:
        posts = _arriving(self.a.raw_posts().drop("k"), "post_id")
        return quality.monotone_filter(posts, FILE_ORDER).drop("event_no")

    def _late_likes(self) -> DataFrame:
        return _arriving(self.a.likes(), "like_id")

    def clean_likes(self) -> DataFrame:
        return quality.clean_likes(self._late_likes(), self.a.posts(), FILE_ORDER).drop("event_no")

    def clean_comments(self) -> DataFrame:
        direct = _arriving(self.a.direct_comments(), "comment_id")
        audited = quality.audit_direct_comments(direct, self.a.posts())
        return audited.filter("reason is null").select("comment_id", "person_id", "ts_ms", "reply_to_post")

    def clean_replies(self) -> DataFrame:
        comments = _arriving(self.a.comments(), "comment_id")
        kept = quality.kept_comments(comments, self.a.posts(), FILE_ORDER)
        return kept.filter("depth > 0").select("comment_id", "person_id", "ts_ms", "reply_to_comment", "depth")

    def reject_reasons(self) -> DataFrame:
        return quality.rejects(
            _arriving(self.a.raw_posts(), "post_id"), self._late_likes(),
            _arriving(self.a.comments(), "comment_id"), self.a.posts(), FILE_ORDER,
        )

    def parse_tags(self) -> DataFrame:
        tags = text.parse_tags(F.col("url"))
        return table(self.spark, self.sf_dir, "pages").select(
            "page_id", F.size(tags).cast("long").alias("n_tags"), F.concat_ws(",", tags).alias("tags")
        )

    def _all_events(self) -> DataFrame:
        return _arriving(self.a.events().select("event_id", "ts_ms"), "event_id")

    def late_rows(self) -> DataFrame:
        return quality.late_rows(self._all_events(), FILE_ORDER, 600).drop("event_no")

    # -- threads and activity --------------------------------------------------------

    def comment_kinds(self) -> DataFrame:
        return activity.comment_kinds(self.a.comments()).groupBy("kind").agg(F.count("*").alias("n"))

    def _resolved(self) -> DataFrame:
        return threads.resolve_replies(self.a.comments())

    def resolve_replies(self) -> DataFrame:
        return self._resolved().select("comment_id", "post_id", "depth")

    def thread_stats(self) -> DataFrame:
        return threads.thread_stats(self._resolved())

    def liked_author(self) -> DataFrame:
        return features.liked_author(self.a.likes(), self.a.posts())

    def _events(self) -> DataFrame:
        return activity.engagement_events(self._resolved(), self.a.likes())

    def engagement_events(self) -> DataFrame:
        return self._events()

    def first_engagement(self) -> DataFrame:
        return activity.first_engagement(self._events())

    def post_activity_30m(self) -> DataFrame:
        return activity.post_activity(self._events(), self.p)

    def _digest(self) -> DataFrame:
        return activity.activity_digest(self.post_activity_30m(), self.p)

    def activity_digest(self) -> DataFrame:
        return self._digest().select(
            "as_of_ms", "window_end_ms", "page", F.size("updates").cast("long").alias("n_updates"),
            codec.tuple_list_text(F.col("updates"), "post_id", "metric", "n").alias("updates"),
        )

    def asof_counts(self) -> DataFrame:
        """Counts of each post and metric at the end of each day on which it has events."""
        events = self._events()
        day_end = F.col("ts_ms") - F.col("ts_ms") % DAY_MS + DAY_MS - 1
        times = activity.metric_events(events).select("post_id", "metric", day_end.alias("time_ms")).distinct()
        return activity.asof_counts(events, times)

    def activity_bounds(self) -> DataFrame:
        events = self._events()
        return activity.activity_bounds(activity.post_activity(events, self.p), events, self.p)

    # -- windows ----------------------------------------------------------------------

    def _timed_likes(self) -> DataFrame:
        return self.a.likes().withColumn("ts", as_timestamp(F.col("ts_ms")))

    def tumbling_counts(self) -> DataFrame:
        rows = self.a.events().withColumn("ts", as_timestamp(F.col("ts_ms")))
        counts = windows.tumbling_counts(rows, "ts", 30 * MINUTE_MS, "event_type")
        return counts.select(F.unix_millis("window.end").alias("window_end_ms"), "event_type", "n")

    def sliding_counts(self) -> DataFrame:
        counts = windows.sliding_counts(self._timed_likes(), "ts", 4 * HOUR_MS, HOUR_MS, "post_id")
        return counts.select(F.unix_millis("window.end").alias("window_end_ms"), "post_id", "n")

    def chained_windows(self) -> DataFrame:
        counts = windows.sliding_counts(self._timed_likes(), "ts", 4 * HOUR_MS, HOUR_MS, "person_id")
        again = windows.chained_sums(counts, 4 * HOUR_MS, HOUR_MS, "person_id")
        return again.select(F.unix_millis("window.end").alias("window_end_ms"), "person_id", "n")

    # -- text, features, outliers -------------------------------------------------------

    def tokens(self) -> DataFrame:
        words = text.tokens(F.col("text"))
        return self.b.documents.select(
            "doc_id", F.size(words).cast("long").alias("n_tokens"), F.md5(F.concat_ws("\n", words)).alias("tokens_md5")
        )

    def uniq_ratio(self) -> DataFrame:
        return self.b.documents.select("doc_id", _six(text.uniq_ratio(F.col("text"))).alias("ratio"))

    def bad_words(self) -> DataFrame:
        return self.b.documents.select("doc_id", text.bad_words(F.col("text"), LEXICON).alias("n_bad"))

    def bad_words_lexicon(self) -> DataFrame:
        """Bad words by a lexicon of several hundred words, written to and read from its JSON file."""
        path = f"{new_folder(self.spark, 'lexicon')}/words.json"
        words = table(self.spark, self.sf_dir, "benchmark").select(F.explode(text.tokens(F.col("text"))).alias("w"))
        listed = words.filter("w <> ''").agg(F.sort_array(F.collect_set("w")).alias("BAD_WORDS"))
        listed.select(F.to_json(F.struct("BAD_WORDS"))).write.text(path)
        return text.bad_word_counts(self.b.documents, "doc_id", "text", lexicon_table(self.spark, path))

    def word_counts(self) -> DataFrame:
        return text.word_counts(self.b.documents, "doc_id", "text")

    @staticmethod
    def _rounded(df: DataFrame) -> DataFrame:
        return df.withColumn("value", _six("value"))

    def _post_feature(self, feature: int) -> DataFrame:
        steps = features.post_steps(self.b.posts(), LEXICON).filter(F.col("feature_id") == feature)
        return self._rounded(features.running_features(steps))

    def feat_post_uniq(self) -> DataFrame:
        return self._post_feature(features.POST_UNIQ)

    def feat_post_bad(self) -> DataFrame:
        return self._post_feature(features.POST_BAD)

    def _comment_feature(self, feature: int) -> DataFrame:
        steps = features.comment_steps(self.b.comments(), LEXICON).filter(F.col("feature_id") == feature)
        return self._rounded(features.running_features(steps))

    def feat_comment_uniq(self) -> DataFrame:
        return self._comment_feature(features.COMMENT_UNIQ)

    def feat_comment_bad(self) -> DataFrame:
        return self._comment_feature(features.COMMENT_BAD)

    def feat_comment_vocab(self) -> DataFrame:
        return self._comment_feature(features.COMMENT_VOCAB)

    def feat_like_spread(self) -> DataFrame:
        return self._rounded(features.like_features(self.a.likes(), self.a.posts()))

    def _features(self) -> DataFrame:
        likes = self.a.likes().withColumn("person_id", F.col("post_id") % 50)
        return features.running_features(
            features.post_steps(self.b.posts(), LEXICON),
            features.comment_steps(self.b.comments(), LEXICON),
            features.like_steps(likes, self.a.posts()),
        )

    def feature_long(self) -> DataFrame:
        return self._rounded(self._features())

    def _daily(self) -> DataFrame:
        return outliers.feature_daily(self._features())

    def feature_daily(self) -> DataFrame:
        return self._rounded(self._daily())

    def _spans(self, values: DataFrame | None = None) -> DataFrame:
        """Spans of values, written out because statistics and outliers both read them."""
        return materialize(outliers.held_spans(self._features() if values is None else values), "spans")

    def feature_stats(self) -> DataFrame:
        stats = outliers.span_stats(self._spans())
        return stats.withColumn("mean", _six("mean")).withColumn("sd", _six("sd"))

    def _on_update(self, n_sigma: float) -> DataFrame:
        values = self._features()
        stats = outliers.span_stats(self._spans(values))
        found = outliers.outliers_on_update(values, stats, n_sigma)
        return self._rounded(found).withColumn("mean", _six("mean"))

    def outliers_on_update(self) -> DataFrame:
        return self._on_update(self.p.n_sigma)

    def outliers_on_update_2s(self) -> DataFrame:
        return self._on_update(2.0)

    def _at_midnight(self, n_sigma: float) -> DataFrame:
        spans = self._spans()
        found = outliers.outliers_in_spans(spans, outliers.span_stats(spans), n_sigma)
        return self._rounded(found).withColumn("mean", _six("mean"))

    def outliers_daily(self) -> DataFrame:
        return self._at_midnight(self.p.n_sigma)

    def outliers_daily_2s(self) -> DataFrame:
        return self._at_midnight(2.0)

    def encode_outliers(self) -> DataFrame:
        """Outliers as result text."""
        return codec.encode_tuple(self._exact(self._at_midnight(2.0)), ["day_ms", "person_id", "feature_id", "value", "mean"])

    @staticmethod
    def _exact(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c).cast("decimal(20,6)") for c in ("value", "mean")})

    # -- raw files ----------------------------------------------------------------------

    def prep_roundtrip(self) -> DataFrame:
        """(source, row): the cleaned tables and rejects after writing all nine raw files and preparing them."""
        raw, clean = (new_folder(self.spark, name) for name in ("raw", "clean"))
        for name, df in raw_inputs(self.a, self.c).items():
            write_raw(df, raw, name)
        tables = prep.prepare(self.spark, raw, clean)
        tables["reject"] = self.spark.read.schema("kind string, id string, reason string").parquet(f"{clean}/rejects")

        def shown(name: str, df: DataFrame) -> DataFrame:
            # Times as numbers, tags as text, birth years from the birthday's text.
            fields = [F.concat_ws(",", c) if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c).cast("string")
                      for c in df.columns if c not in ("like_id", "creation_date")]
            if name == "person":
                fields.append(F.substring("birthday", 1, 4).try_cast("int").cast("string"))
            return df.select(F.lit(name).alias("source"), F.concat_ws("|", *[F.coalesce(f, F.lit("-")) for f in fields]).alias("row"))

        return reduce(DataFrame.unionAll, [shown(name, df) for name, df in tables.items()])

    # -- affinity ---------------------------------------------------------------------

    def _static_units(self) -> DataFrame:
        c = self.c
        return affinity.static_units(c.person(), c.member(), c.moderator(), c.interest(), c.language(), self.p)

    def aff_static_features(self) -> DataFrame:
        return affinity.static_features(self._static_units())

    def _static_total(self) -> DataFrame:
        return affinity.static_total(self._static_units(), self.p)

    def aff_static_total(self) -> DataFrame:
        return affinity.as_points(self._static_total())

    def aff_colike(self) -> DataFrame:
        return affinity.co_activity(self.a.likes(), "post_id", self.p)

    def aff_coforum(self) -> DataFrame:
        return affinity.co_activity(self.a.raw_posts(), "forum_id", self.p)

    def aff_copost(self) -> DataFrame:
        return affinity.co_activity(self.a.direct_comments(), "reply_to_post", self.p)

    def aff_cocomment(self) -> DataFrame:
        replies = self.a.comments().filter("reply_to_comment >= 0")
        return affinity.co_activity(replies, "reply_to_comment", self.p)

    def _actors(self) -> DataFrame:
        return self.a.events("signup", "click", "purchase", "view").select(
            F.col("user_id").alias("person_id"), "ts_ms"
        )

    def aff_active(self) -> DataFrame:
        return affinity.active_people(self._actors(), self.p)

    def aff_author_active(self) -> DataFrame:
        return affinity.author_activity(self.a.raw_posts(), self.p)

    def _candidates(self) -> DataFrame:
        # A reply to nothing (-1) is an activity without a target.
        rows = affinity.activity_rows(self.a.raw_posts(), self.a.likes(), self.a.comments()).withColumn(
            "target", F.when(F.col("target") != "-1", F.col("target"))
        )
        return affinity.activity_scores(rows, self.p)

    def aff_window_scores(self) -> DataFrame:
        return affinity.as_points(affinity.window_scores(self._candidates(), self._static_total(), self.p))

    def aff_candidates(self) -> DataFrame:
        return affinity.as_points(
            affinity.suggestion_candidates(self._candidates(), self._static_total(), self.c.knows(), self.p)
        )

    def _top5(self) -> DataFrame:
        return affinity.suggest(self._candidates(), self._static_total(), self.c.knows(), self.p)

    def aff_top5(self) -> DataFrame:
        return affinity.as_points(self._top5())

    def aff_top5_many(self) -> DataFrame:
        """Suggestions for all people of one market segment, a table of a fifth of the people, with text ids."""
        def named(df: DataFrame, *ids: str) -> DataFrame:
            return df.withColumns({c: F.concat(F.lit("p"), F.col(c)) for c in ids})

        c = self.c
        tables = [named(t, "person_id") for t in (c.person(), c.member(), c.moderator(), c.interest(), c.language())]
        selected = materialize(named(c.person().filter("browser = 'BUILDING'"), "person_id").select(
            F.col("person_id").alias("selected_id")), "selected")
        rows = affinity.activity_rows(*[named(df, "person_id") for df in (self.a.raw_posts(), self.a.likes(), self.a.direct_comments())])
        daily = self.p.__class__(selected=self.p.selected, window_ms=DAY_MS, slide_ms=DAY_MS)
        return affinity.as_points(pairs.suggest(rows, tables, named(c.knows(), "person1_id", "person2_id"), daily, selected))

    def aff_top5_wide(self) -> DataFrame:
        return affinity.suggest_wide(self._top5(), self.p)

    def encode_suggestions(self) -> DataFrame:
        """Suggestions as result text, one message per window and selected person."""
        return codec.encode_suggestions(self.aff_top5_wide(), self.p.top_k)


QUERY_NAMES = [name for name in vars(Jobs) if not name.startswith("_")]


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Jobs(spark, sf_dir), name)()

    run.__name__ = name
    run.__doc__ = getattr(Jobs, name).__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(name) for name in QUERY_NAMES} | STREAMS
