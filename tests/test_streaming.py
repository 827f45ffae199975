"""Streams give the batch results for everything behind the watermark."""

from types import SimpleNamespace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from murmuration import runtime
from murmuration.functions.codec import EVENT_FIELDS, TOPICS, decode_tuple, encode_events_of
from murmuration.functions.timing import as_timestamp
from murmuration.operators import activity, affinity, features, outliers, quality, threads, windows
from murmuration.params import Params
from murmuration.plans import prep, streams
from murmuration.plans.catalog import Jobs
from murmuration.runtime import Files
from murmuration.sources.star import LEXICON, EngagementTables
from murmuration.sources.topics import events_of, publish, read_topic
from murmuration.streaming.activity import stream_activity
from murmuration.streaming.affinity import SuggestionWriter, slice_counts
from murmuration.streaming.jobs import Run, Topics, start_activity, start_outliers, start_rejects, start_suggestions, start_threads
from murmuration.streaming.outliers import DailyOutliers, feature_rows
from murmuration.streaming.state import Clock, Kept, State
from murmuration.streaming.threads import LikedAuthors, ThreadResolver, liked_author_stream

SF = "/root/testdata/sf0.001"
DELAY_S = 3000


def arriving(df, id_col, out_dir, files=3):
    """Write rows to ``files`` files in arrival order, to be read one per trigger."""
    rows = quality.with_arrival(df, id_col, 300, 3000)
    placed = rows.withColumn("file", F.ntile(files).over(Window.orderBy("arrival_ms", id_col)))
    for i in range(1, files + 1):
        placed.filter(F.col("file") == i).drop("arrival_ms", "file").coalesce(1).write.mode("append").parquet(str(out_dir))
    return out_dir


def stream_of(spark, path):
    schema = spark.read.parquet(str(path)).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def run(df, tmp_path, name="out", sink=None):
    writer = df.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / f"cp-{name}"))
    writer = writer.trigger(availableNow=True)
    if sink is None:
        query = writer.format("parquet").start(str(tmp_path / name))
    else:
        query = writer.foreachBatch(sink).start()
    query.awaitTermination()
    return query


@pytest.fixture(scope="module")
def engagement(spark):
    a = EngagementTables(spark, SF)
    return activity.engagement_events(threads.resolve_replies(a.comments()), a.likes()).cache()


def test_stream_activity_equals_batch_on_closed_ticks(spark, engagement, tmp_path):
    rows = engagement.withColumn("ts", as_timestamp(F.col("ts_ms")))
    path = arriving(rows, "event_id", tmp_path / "in", 3)
    query = run(stream_activity(stream_of(spark, path).drop("ts_ms", "event_id"), shards=2), tmp_path)
    got = {(int(r.as_of.timestamp() * 1000), r.post_id, r.metric): r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    closed = engagement.agg(F.max("ts_ms")).first()[0] - DELAY_S * 1000
    want = {(r.as_of_ms, str(r.post_id), r.metric): r.n for r in activity.post_activity(engagement).collect()}
    newest = max(k[0] for k in got)
    assert newest > closed - 2 * 1_800_000
    assert {k: v for k, v in got.items() if k[0] <= newest} == {k: v for k, v in want.items() if k[0] <= newest}


def test_replies_are_resolved_whenever_their_parent_comes(spark, tmp_path):
    comments = EngagementTables(spark, SF).comments().cache()
    # Newest first, so nearly every reply comes before its parent.
    backwards = comments.withColumn("arrival", -F.col("ts_ms"))
    placed = backwards.withColumn("file", F.ntile(4).over(Window.orderBy("arrival")))
    for i in range(1, 5):
        placed.filter(F.col("file") == i).drop("arrival", "file").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    told = []
    resolver = ThreadResolver(spark, str(tmp_path / "state"), "long", on_resolved=lambda df, i: told.append((i, df.count())))
    run(stream_of(spark, tmp_path / "in"), tmp_path, sink=resolver)
    got = {(r.comment_id, r.post_id, r.depth) for r in resolver.resolved.everything().collect()}
    want = {(r.comment_id, r.post_id, r.depth) for r in threads.resolve_replies(comments).collect()}
    assert got == want and sum(n for _, n in told) == len(want)
    waiting = {r.comment_id for r in resolver.waiting.of(3).collect()}
    assert waiting == {r.comment_id for r in comments.collect()} - {c for c, _, _ in want}

    # Running a batch again changes nothing.
    last = placed.filter("file = 4").drop("arrival", "file")
    resolver(last, 3)
    assert {(r.comment_id, r.post_id, r.depth) for r in resolver.resolved.everything().collect()} == want


def test_waiting_replies_age_out_as_orphans(spark, tmp_path):
    schema = "comment_id string, person_id string, ts_ms long, reply_to_post string, reply_to_comment string"
    resolver = ThreadResolver(spark, str(tmp_path / "state"), max_age_ms=100)
    resolver(spark.createDataFrame([("a", "u", 10, None, "gone"), ("b", "u", 90, None, "gone")], schema), 0)
    resolver(spark.createDataFrame([("c", "u", 150, "p", None)], schema), 1)
    assert [r.comment_id for r in resolver.orphans.everything().collect()] == ["a"]
    assert [r.comment_id for r in resolver.waiting.of(1).collect()] == ["b"]


def test_liked_author_stream(spark, tmp_path):
    a = EngagementTables(spark, SF)
    likes = a.likes().withColumn("ts", as_timestamp(F.col("ts_ms")))
    posts = a.posts().withColumn("ts", as_timestamp(F.col("ts_ms")))
    likes.coalesce(1).write.parquet(str(tmp_path / "likes"))
    posts.coalesce(1).write.parquet(str(tmp_path / "posts"))
    joined = liked_author_stream(stream_of(spark, tmp_path / "likes"), stream_of(spark, tmp_path / "posts"), DELAY_S, "40 days")
    run(joined, tmp_path)
    got = {r.like_id: r.author_id for r in spark.read.parquet(str(tmp_path / "out")).filter("author_id is not null").collect()}
    want = {
        r.like_id: r.author_id for r in likes.join(
            posts.select("post_id", F.col("person_id").alias("author_id"), F.col("ts").alias("pts")), "post_id"
        ).filter("pts <= ts").collect()
    }
    assert got == want and want


def test_stream_suggestions_equal_batch(spark, tmp_path):
    jobs = Jobs(spark, SF)
    a = jobs.a
    rows = affinity.activity_rows(a.raw_posts(), a.likes(), a.comments()).withColumn("ts", as_timestamp(F.col("ts_ms"))).withColumn(
        "id", F.row_number().over(Window.orderBy("ts", "kind", "person_id")).cast("long")
    )
    path = arriving(rows, "id", tmp_path / "in", 3)
    static, knows = jobs._static_total(), jobs.c.knows()
    writer = SuggestionWriter(spark, str(tmp_path / "state"), static, knows, jobs.p)
    run(slice_counts(stream_of(spark, path).drop("ts_ms", "id"), jobs.p), tmp_path, sink=writer)
    got = {tuple(r) for r in writer.suggestions.everything().collect()}
    upto = max(r[0] for r in got)
    want = affinity.suggest(affinity.activity_scores(rows, jobs.p), static, knows, jobs.p)
    assert got == {tuple(r) for r in want.filter(F.col("window_end_ms") <= upto).collect()}
    closed = rows.agg(F.max("ts_ms")).first()[0] - DELAY_S * 1000
    assert upto > closed - 3 * 3_600_000


def test_stream_outliers_equal_batch(spark, tmp_path):
    jobs = Jobs(spark, SF)
    likes, posts = jobs.a.likes(), jobs.a.posts()
    comments = jobs.b.comments()
    matched = features.liked_author(likes, posts)
    rows = feature_rows(
        [features.post_steps(jobs.b.posts(), LEXICON), features.comment_text_steps(comments, LEXICON),
         features.comment_units(comments), features.like_units(likes)],
        [features.word_items(comments), features.author_items(matched)],
    )
    rows = rows.withColumn("n", F.row_number().over(Window.orderBy("ts_ms", "event_id")).cast("long"))
    path = arriving(rows, "n", tmp_path / "in", 4)
    sink = DailyOutliers(spark, str(tmp_path / "state"), Params(n_sigma=2.0))
    run(stream_of(spark, path).drop("n"), tmp_path, sink=sink)

    values = features.running_features(
        features.post_steps(jobs.b.posts(), LEXICON), features.comment_steps(comments, LEXICON),
        features.like_steps(likes, posts),
    )
    daily = outliers.feature_daily(values)
    stats = outliers.feature_stats(daily)
    got = {(r.feature_id, r.day_ms): (r.n_people, round(r.mean, 9), round(r.sd, 9)) for r in sink.stats.everything().collect()}
    last = max(d for _, d in got)
    want = {(r.feature_id, r.day_ms): (r.n_people, round(r.mean, 9), round(r.sd, 9)) for r in stats.collect() if r.day_ms <= last}
    assert want and {k: got[k] for k in want} == want
    flagged = outliers.outliers_on_update(values, stats, 2.0).filter(F.col("ts_ms") < last)
    assert {(r.feature_id, r.event_id) for r in sink.on_update.everything().collect()} == {
        (r.feature_id, str(r.event_id)) for r in flagged.collect()}
    at_midnight = outliers.outliers_daily(daily, stats, 2.0).filter(F.col("day_ms") <= last)
    in_reach = {k for k in want}
    assert {(r.day_ms, r.person_id, r.feature_id) for r in sink.daily.everything().collect() if (r.feature_id, r.day_ms) in in_reach} == {
        (r.day_ms, str(r.person_id), r.feature_id) for r in at_midnight.collect()}


def test_built_in_windows_close_on_a_stream(spark, tmp_path):
    rows = EngagementTables(spark, SF).likes().withColumn("ts", as_timestamp(F.col("ts_ms")))
    path = arriving(rows, "like_id", tmp_path / "in", 3)
    hour = 3_600_000

    def chain(df):
        return windows.chained_sums(windows.sliding_counts(df, "ts", 4 * hour, hour, "person_id"), 4 * hour, hour, "person_id")

    run(chain(stream_of(spark, path).withWatermark("ts", f"{DELAY_S} seconds")), tmp_path)
    got = {(r.window.end, r.person_id): r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    newest = max(e for e, _ in got)
    want = {(r.window.end, r.person_id): r.n for r in chain(rows).collect()}
    assert got == {k: n for k, n in want.items() if k[0] <= newest} and len(got) > 0.9 * len(want)


def test_nothing_is_lost_between_topic_and_stream(spark, tmp_path):
    """Every published like comes through the decoded stream."""
    likes = EngagementTables(spark, SF).likes().select(
        F.col("ts_ms").alias("timeMilisecond"), F.col("person_id").cast("string").alias("personId"),
        F.col("post_id").cast("string").alias("postId"), F.lit(None).cast("array<int>").alias("creationDate"))
    publish(encode_events_of(likes, "like"), "likes", {"path": str(tmp_path / "topics")}, "text")
    events = events_of(read_topic(spark, "likes", {"path": str(tmp_path / "topics")}, "text"), "like")
    run(events, tmp_path)
    assert spark.read.parquet(str(tmp_path / "out")).count() == likes.count()


@pytest.fixture(scope="module")
def topics(spark, tmp_path_factory):
    """Posts, likes and comments of the test tables as JSON topics, with texts."""
    a, root = EngagementTables(spark, SF), tmp_path_factory.mktemp("topics")
    text = {c: F.col(c).cast("string") for c in ("person_id", "post_id", "comment_id", "reply_to_post", "reply_to_comment", "like_id", "forum_id")}
    tables = {
        "post": a.raw_posts().withColumn("content", F.concat(F.lit("the post "), F.col("k"))),
        "like": a.likes(),
        "comment": a.comments().withColumn("content", F.concat(F.lit("of the "), F.col("person_id"), F.lit(" "), F.col("comment_id"))),
    }
    source = Topics({"path": str(root)}, "text")
    for kind, df in tables.items():
        rows = df.withColumns({c: e for c, e in text.items() if c in df.columns})
        fields = prep.event_fields(rows, kind)
        missing = {n: F.lit(None).cast(t) for n, t in EVENT_FIELDS[kind] if n not in fields.columns}
        publish(encode_events_of(fields.withColumns(missing), kind), TOPICS[kind], source.options, "text")
    return source


def test_topics_to_activity_messages(spark, engagement, topics, tmp_path):
    job = Run(str(tmp_path), once=True)
    start_threads(spark, topics, job).awaitTermination()
    start_activity(spark, topics, job, Topics({"path": str(tmp_path / "out")}, "text")).awaitTermination()
    got = {(r.window_end_ms, r.post_id, r.metric): r.n for r in decode_tuple(spark.read.text(str(tmp_path / "out" / "activity"))).collect()}
    want = {(r.as_of_ms + 1_800_000, r.post_id, r.metric): r.n for r in activity.post_activity(engagement).collect()}
    newest = max(k[0] for k in got)
    assert got == {k: n for k, n in want.items() if k[0] <= newest} and len(got) > 0.99 * len(want)


def test_topics_to_suggestions_and_outliers(spark, topics, tmp_path):
    jobs, job = Jobs(spark, SF), Run(str(tmp_path), once=True, params=Params(selected=tuple(range(10)), n_sigma=1.5))
    start_suggestions(spark, topics, job, jobs._static_total(), jobs.c.knows()).awaitTermination()
    top = spark.read.parquet(f"{tmp_path}/suggestions/state/suggestions")
    assert top.select("selected_id").distinct().count() == 10
    assert top.filter("rank > 5 or candidate_id = selected_id").isEmpty()
    start_outliers(spark, topics, job, ["the"]).awaitTermination()
    stats = spark.read.parquet(f"{tmp_path}/outliers/state/stats")
    assert {r.feature_id for r in stats.select("feature_id").distinct().collect()} == set(range(6))
    assert not spark.read.parquet(f"{tmp_path}/outliers/state/daily").isEmpty()


def test_a_topic_that_lags_holds_its_days_open(spark, tmp_path):
    """Likes of seven days, then posts of the same days, then later events: no day is lost."""
    day = 86_400_000
    schema = "person_id string, feature_id int, ts_ms long, event_id string, num double, den long, item string"

    def rows(feature: int, days) -> list[tuple]:
        return [(f"p{d % 3}", feature, d * day + 5, f"{feature}-{d}", float(d), 1, None) for d in days]

    batches = [rows(5, range(1, 8)), rows(0, range(1, 8)), rows(5, [20]), rows(0, [20]), rows(0, [2])]
    sink = DailyOutliers(spark, str(tmp_path / "state"), Params(), inputs=({0, 1}, {5}))
    for i, batch in enumerate(batches):
        sink(spark.createDataFrame(batch, schema), i)
    first = {r.feature_id: r.day for r in sink.stats.everything().groupBy("feature_id").agg(F.min("day_ms").alias("day")).collect()}
    assert first == {0: 2 * day, 5: 2 * day}
    people = {(r.feature_id, r.day_ms): r.n_people for r in sink.stats.everything().collect()}
    assert people[0, 8 * day] == people[5, 8 * day] == 3
    # What comes for a closed day is kept apart.
    late = [(r.feature_id, r.ts_ms) for r in sink.late.everything().collect()]
    assert late == [(0, 2 * day + 5)]
    # What was sent is in the totals, waits for its day, or is late.
    counted = sink.state.newest("totals").agg(F.sum("den")).first()[0]
    assert counted + sink.state.newest("open").count() + len(late) == sum(map(len, batches))


def test_a_slow_topic_loses_nothing_to_a_fast_one(spark, tmp_path):
    from murmuration.streaming.affinity import slice_counts as slices
    day = 86_400_000

    def topic(name: str, days: list[int]):
        rows = [(n, "like", d, f"t{d}", d * day) for n, d in enumerate(days)]
        df = spark.createDataFrame(rows, "n long, kind string, person_id long, target string, ts_ms long")
        df = df.withColumn("ts", as_timestamp(F.col("ts_ms")))
        path = arriving(df, "n", tmp_path / name, 3)
        return stream_of(spark, path).withWatermark("ts", f"{DELAY_S} seconds")

    united = topic("fast", list(range(10, 21))).unionByName(topic("slow", [1, 2, 3, 4, 5, 6]))
    run(slices(united.drop("n", "ts_ms"), Params(), watermarked=True), tmp_path)
    got = {r.person_id for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {1, 2, 3, 4, 5} <= got


def test_rejects_and_events_are_all_that_was_sent(spark, tmp_path):
    good = '{"personId": "1", "postId": "2", "timeMilisecond": 5}'
    sent = [good, "{broken", '{"personId": "1", "postId": "2"}', good, "[]", ""]
    for topic, lines in (("likes", sent), ("posts", []), ("comments", [])):
        spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(str(tmp_path / "topics" / topic))
    source, job = Topics({"path": str(tmp_path / "topics")}, "text"), Run(str(tmp_path), once=True)
    start_rejects(spark, source, job).awaitTermination()
    rejected = spark.read.parquet(f"{tmp_path}/rejects/state").collect()
    kept = events_of(spark.read.text(str(tmp_path / "topics" / "likes")), "like").count()
    assert kept + len(rejected) == len(sent) and kept == 2
    assert {r.reason for r in rejected} == {"no JSON object", "no event time"}


def test_sending_a_batch_again_adds_nothing(spark, tmp_path):
    batch = spark.createDataFrame([("a",), ("b",)], "value string")
    for _ in range(2):
        publish(batch, "out", {"path": str(tmp_path)}, "text", batch_id=3)
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_state_keeps_few_segments_and_survives_reruns(spark, tmp_path):
    kept = {"seen": Kept("k long, v string", keys=("k",), buckets=4), "last": Kept("k long, n long", keys=("k",), latest=True, buckets=2),
            "open": Kept("k long")}
    state, files = State(spark, str(tmp_path / "s"), kept, fanout=3), []

    def batch(i, fail=False):
        state.begin(i)
        state.add("seen", spark.createDataFrame([(i, f"v{i}"), (1000 + i, None)], "k long, v string"))
        state.add("last", spark.createDataFrame([(i % 7, i), (100, i)], "k long, n long"))
        state.replace("open", state.read("open").filter("k % 2 = 0").unionByName(spark.createDataFrame([(i,)], "k long")))
        state.notes["done"] = i
        if not fail:
            state.commit()

    for i in range(30):
        if i in (0, 9, 10, 20):
            batch(i, fail=True)  # ended before its manifest was switched
        batch(i)
        if i == 14:
            batch(i)  # committed, but run again
        files.append([len(state._segments[n]) for n in kept])
    assert max(map(sum, files)) <= 2 * (2 * 4) + 1 and sum(files[-1]) <= 16
    fresh = State(spark, str(tmp_path / "s"), kept, fanout=3)
    fresh.begin(30)
    assert sorted(r.k for r in fresh.read("seen").collect()) == sorted([*range(30), *range(1000, 1030)])
    assert {r.k: r.n for r in fresh.read("last").collect()} == {100: 29, **{i % 7: i for i in range(30)}}
    assert sorted(r.k for r in fresh.read("open").collect()) == [*range(0, 30, 2), 29] and fresh.notes == {"done": 29}
    asked = spark.createDataFrame([(3,), (1004,), (77,)], "k long")
    assert {(r.k, r.v) for r in fresh.lookup("seen", asked).collect()} == {(3, "v3"), (1004, None)}
    # What is on the disk belongs to the last manifests.
    names = {s["name"] for i in fresh._manifests() for s in fresh._load(i)["segments"]["seen"]}
    assert set(fresh.files.names(f"{tmp_path}/s/seen")) == names and len(fresh._manifests()) == State.HISTORY


def test_resolver_reads_a_level_number_of_files(spark, tmp_path):
    """Fifty batches: the files of the state and the intermediate tables do not grow with them."""
    schema = "comment_id long, person_id long, ts_ms long, reply_to_post long, reply_to_comment long"
    resolver, counts = ThreadResolver(spark, str(tmp_path / "state"), "long"), []
    files = Files(spark)
    before = len(files.names(runtime._run_folder(spark)))
    for i in range(50):
        rows = [(10 * i, 1, i, i, None), (10 * i + 1, 2, i, None, 10 * (i - 3)), (10 * i + 2, 2, i, None, 10 * (i + 2))]
        resolver(spark.createDataFrame(rows, schema).coalesce(1), i)
        counts.append(len(resolver.state._segments["index"]))
    assert max(counts) <= 9 and max(counts[40:]) <= 9
    assert len(files.names(runtime._run_folder(spark))) == before
    got = {r.comment_id: (r.post_id, r.depth) for r in resolver.resolved.everything().collect()}
    assert got == {**{10 * i: (i, 0) for i in range(50)}, **{10 * i + 1: (i - 3, 1) for i in range(3, 50)},
                   **{10 * i + 2: (i + 2, 1) for i in range(48)}}
    assert {r.comment_id for r in resolver.waiting.everything().collect()} == {1, 11, 21, 482, 492}


def test_likes_find_old_and_later_posts(spark, tmp_path):
    day = 86_400_000
    authors = LikedAuthors(spark, str(tmp_path / "a"))
    like, post = "post_id string, person_id string, ts_ms long, like_id string", "post_id string, person_id string, ts_ms long"

    def step(i, likes, posts):
        found = authors.step(spark.createDataFrame(likes, like), spark.createDataFrame(posts, post), i)
        return {(r.like_id, r.author_id, r.ts_ms) for r in found.collect()}

    assert step(0, [("p", "x", 5, "1"), ("q", "x", 6, "2")], [("p", "ann", 4)]) == {("1", "ann", 5)}
    assert step(1, [("q", "y", 7, "3")], []) == set()
    assert step(2, [("p", "y", 9000 * day, "4")], [("q", "bob", 70)]) == {("2", "bob", 70), ("3", "bob", 70), ("4", "ann", 9000 * day)}
    assert step(2, [("p", "y", 9000 * day, "4")], [("q", "bob", 70)]) == {("2", "bob", 70), ("3", "bob", 70), ("4", "ann", 9000 * day)}
    for i in range(3, 12):
        assert step(i, [(f"none{i}", "z", 1, f"n{i}")], []) == set()
    # Matched likes are dropped when segments are merged, the others wait on.
    parked = {r.like_id for r in authors.state.newest("parked").collect()}
    assert parked >= {f"n{i}" for i in range(3, 12)} and not parked & {"1", "4"}


def test_the_slowest_input_and_an_idle_one():
    at = [0.0]
    clock, notes = Clock(["a", "b"], 10, idle_s=60, now=lambda: at[0]), {}
    assert clock.advance(notes, {"a": 500}) is None
    assert clock.advance(notes, {"b": 100}) == 90
    assert clock.advance(notes, {"a": 900, "b": 50}) == 90
    at[0] = 61.0
    assert clock.advance(notes, {"a": 1000}) == 990
    assert clock.advance(notes, {"b": 300}) == 290


def test_messages_of_one_row_group_are_the_work_of_many_tasks(spark):
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    rows = spark.range(4000).coalesce(1).select(
        F.col("id").alias("post_id"), F.lit(1).alias("person_id"), (F.col("id") * 1000).alias("ts_ms"), F.lit("a b").alias("content"),
        (F.col("id") * 1000 + 7).alias("arrival_ms"))
    spark.conf.set(key, "1b")
    try:
        sizes = [r["count"] for r in streams._topic_rows(rows, "post").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(key)
    assert sum(sizes) == 4000 and len(sizes) > 1 and max(sizes) < 2000


def test_the_static_side_is_made_once_for_all_steps(spark, monkeypatch):
    given = []
    query = SimpleNamespace(awaitTermination=lambda: None)
    monkeypatch.setattr(streams, "start_suggestions", lambda spark, source, job, static, knows, sink: given.append(static) or query)
    monkeypatch.setattr(streams, "Outbox", lambda *args: SimpleNamespace(sent_messages=lambda topic: None))
    monkeypatch.setattr(streams, "decode_suggestions", lambda *args: None)
    streams.stream_suggestions(spark, SF)
    assert len(given) > 1 and all(side is given[0] for side in given)
    assert isinstance(given[0], affinity.StaticSide) and not given[0].top.isEmpty()
