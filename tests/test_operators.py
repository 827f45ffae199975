"""Distributed operators against row-by-row models, with hot keys and odd inputs."""

import random

import model
import pytest
from pyspark.sql import functions as F

from murmuration.functions import text
from murmuration.operators import activity, affinity, features, outliers, quality, scan, threads
from murmuration.params import Params

COMMENT_SCHEMA = "comment_id string, person_id string, ts_ms long, reply_to_post string, reply_to_comment string"


@pytest.fixture(scope="module")
def rows():
    return model.social_rows()


def _comments(spark, comments):
    return spark.createDataFrame(
        [tuple(c[k] for k in ("comment_id", "person_id", "ts_ms", "reply_to_post", "reply_to_comment")) for c in comments],
        COMMENT_SCHEMA,
    )


def _likes(spark, likes):
    return spark.createDataFrame(
        [(x["like_id"], x["person_id"], x["post_id"], x["ts_ms"]) for x in likes],
        "like_id string, person_id string, post_id string, ts_ms long",
    )


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_prefix_scan_matches_a_loop_for_hot_and_cold_keys(spark, hot):
    rng = random.Random(1)
    data = [("h" if rng.random() < hot else f"k{rng.randint(0, 40)}", i, rng.randint(0, 9)) for i in range(2000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, i long, x long")
    got = {(r.k, r.i): (r.s, r.m) for r in scan.prefix_scan(df, ["i"], ["k"], {"s": "x"}, {"m": "x"}).collect()}
    total, top = {}, {}
    for k, i, x in sorted(data, key=lambda r: r[1]):
        total[k] = total.get(k, 0) + x
        assert got[k, i] == (total[k], top.get(k))
        top[k] = max(x, top.get(k, x))
    assert len(got) == len(data)


def test_prefix_scan_splits_a_hot_key_over_tasks(spark):
    df = spark.range(4000).select(F.lit("h").alias("k"), F.col("id").alias("i"), F.lit(1).alias("x"))
    sizes = []
    original = scan.materialize

    def spy(chunked, name):
        out = original(chunked, name)
        sizes.extend(r["count"] for r in out.groupBy("_chunk").count().collect())
        return out

    scan.materialize = spy
    try:
        scanned = scan.prefix_scan(df, ["i"], ["k"], {"s": "x"})
    finally:
        scan.materialize = original
    assert scanned.filter("s <> i + 1").isEmpty()
    assert len(sizes) == 4 and max(sizes) < 2000


def test_resolve_replies_with_deep_chains_cycles_and_orphans(spark, rows):
    comments = [dict(c) for c in rows[2]]
    base = {"person_id": "1", "ts_ms": 1, "reply_to_post": None}
    comments.append(base | {"comment_id": "root", "reply_to_post": "p", "reply_to_comment": None})
    comments += [base | {"comment_id": f"d{i}", "reply_to_comment": f"d{i - 1}" if i else "root"} for i in range(37)]
    comments.append(base | {"comment_id": "self", "reply_to_comment": "self"})
    comments += [base | {"comment_id": f"c{i}", "reply_to_comment": f"c{(i + 1) % 3}"} for i in range(3)]
    comments.append(base | {"comment_id": "tail", "reply_to_comment": "c0"})
    comments.append(base | {"comment_id": "lost", "reply_to_comment": "nowhere"})
    comments.append(base | {"comment_id": "both", "reply_to_post": "p", "reply_to_comment": "nowhere"})
    random.Random(3).shuffle(comments)
    got = {r.comment_id: (r.post_id, r.depth) for r in threads.resolve_replies(_comments(spark, comments)).collect()}
    assert got == model.resolve(comments)
    assert got["d36"] == ("p", 37) and got["both"] == ("p", 0) and "tail" not in got


def test_activity_matches_the_model(spark, rows):
    _, likes, comments = rows
    resolved = model.resolve(comments)
    want = model.activity(
        [(resolved[c["comment_id"]][0], 0 if c["reply_to_comment"] else 1, c["person_id"], c["ts_ms"])
         for c in comments if c["comment_id"] in resolved]
        + [(x["post_id"], 2, x["person_id"], x["ts_ms"]) for x in likes]
    )
    events = activity.engagement_events(threads.resolve_replies(_comments(spark, comments)), _likes(spark, likes))
    got = activity.post_activity(events)
    assert {(r.as_of_ms, r.post_id, r.metric): r.n for r in got.collect()} == want
    bounds = activity.activity_bounds(got, events).collect()
    assert sum(r.n_updates for r in bounds) == len(want) and all(r.n_violations == 0 for r in bounds)


def test_activity_edges(spark):
    """An event on a tick belongs to the next one; exactly 12 hours of silence is inactive."""
    hour, tick = 3_600_000, 1_800_000
    events = [("a", 2, "u", 10 * tick), ("a", 1, "u", 10 * tick + 24 * hour), ("b", 2, "v", 100 * tick)]
    df = spark.createDataFrame(
        [(*e, str(i)) for i, e in enumerate(events)], "post_id string, kind int, person_id string, ts_ms long, event_id string"
    )
    got = {(r.as_of_ms, r.post_id, r.metric): r.n for r in activity.post_activity(df).collect()}
    assert got == model.activity(events)
    ticks = {t for t, post, _ in got if post == "a"}
    assert 10 * tick not in ticks and 11 * tick in ticks
    assert 10 * tick + 12 * hour not in ticks
    assert got[11 * tick, "a", "comment"] == 0
    assert got[11 * tick + 24 * hour, "a", "userEngagement"] == 1


def test_digest_pages_hold_every_update(spark):
    activity_rows = spark.range(1000).select(
        F.lit(5).cast("long").alias("as_of_ms"), F.col("id").alias("post_id"), F.lit("reply").alias("metric"), F.col("id").alias("n")
    )
    pages = activity.activity_digest(activity_rows, Params(digest_page=64)).collect()
    assert sorted(u.post_id for page in pages for u in page.updates) == list(range(1000))
    assert max(len(page.updates) for page in pages) == 64 and len(pages) == 16


WORDY = ["", " ", " \t\n", " a", "a  a", "a b A", "BAD word bad", "bad, word", "a\x0bb\fc\rd ", "no end ", "x" * 50]


def test_text_measures(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(WORDY)], "id int, t string")
    got = df.select(
        "id", text.tokens(F.col("t")).alias("w"), text.uniq_ratio(F.col("t")).alias("u"),
        text.bad_words(F.col("t"), ["Bad", "two words"]).alias("b"),
    ).orderBy("id").collect()
    for row, t in zip(got, WORDY):
        w = model.words(t)
        assert row.w == w
        assert row.u == (pytest.approx(len(set(w)) / len(w)) if w else None)
        assert row.b == sum(x.lower() == "bad" for x in w)


@pytest.fixture(scope="module")
def behaviour(spark, rows):
    rng = random.Random(5)
    vocabulary = ["bad", "Bad", "ok", "fine", "day", "sun", "", "la"]

    def say():
        return rng.choice(["", "  "]) if rng.random() < 0.1 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 9)))

    posts = [(p["person_id"], p["post_id"], p["ts_ms"], say()) for p in rows[0]]
    comments = [(c["person_id"], c["comment_id"], c["ts_ms"], say()) for c in rows[2]]
    author = {p["post_id"]: p["person_id"] for p in rows[0]}
    likes = list({x["like_id"]: (x["person_id"], x["like_id"], x["ts_ms"], author.get(x["post_id"])) for x in rows[1]}.values())
    want = model.features(posts, comments, likes, {"bad"})
    post_df = spark.createDataFrame(posts, "person_id string, post_id string, ts_ms long, content string")
    comment_df = spark.createDataFrame(comments, "person_id string, comment_id string, ts_ms long, content string")
    like_df = _likes(spark, rows[1]).dropDuplicates(["like_id"])
    return want, features.running_features(
        features.post_steps(post_df, ["bad"]), features.comment_steps(comment_df, ["bad"]),
        features.like_steps(like_df, post_df),
    )


def test_features_match_the_model(behaviour):
    want, values = behaviour
    got = {(r.feature_id, r.event_id): r.value for r in values.collect()}
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (pytest.approx(value, abs=1e-9) if value is not None else None), key


@pytest.mark.parametrize("n_sigma", [1.5, 3.0])
def test_outliers_match_the_model(behaviour, n_sigma):
    _, values = behaviour
    rows = [(r.person_id, r.feature_id, r.event_id, r.ts_ms, r.value) for r in values.collect()]
    on_update, at_midnight = model.outliers(rows, n_sigma)
    daily = outliers.feature_daily(values)
    stats = outliers.feature_stats(daily)
    assert {(r.event_id, r.feature_id) for r in outliers.outliers_on_update(values, stats, n_sigma).collect()} == on_update
    assert {(r.day_ms, r.person_id, r.feature_id) for r in outliers.outliers_daily(daily, stats, n_sigma).collect()} == at_midnight


def test_zero_deviation_flags_any_other_value_and_three_sd_is_not_far(spark):
    day = model.DAY
    values = [("a", 0, "1", 10, 1.0), ("b", 0, "2", 20, 1.0), ("a", 0, "3", day + 5, 1.5), ("b", 0, "4", day + 6, 1.0)]
    # mean 0, sd 1 at the first midnight of feature 1; value 3 is exactly 3 sd away
    values += [("a", 1, "5", 10, 1.0), ("b", 1, "6", 20, -1.0), ("a", 1, "7", day + 5, 3.0), ("b", 1, "8", day + 6, -3.5)]
    df = spark.createDataFrame(values, "person_id string, feature_id int, event_id string, ts_ms long, value double")
    found = outliers.outliers_on_update(df, outliers.feature_stats(outliers.feature_daily(df)))
    assert {r.event_id for r in found.collect()} == {"3", "8"}


def test_late_rows(spark):
    df = spark.createDataFrame([(1, 100_000, 1), (2, 90_000, 2), (3, 30_000, 3), (4, 120_000, 4)], "id long, ts_ms long, at long")
    late = quality.late_rows(df, ["at", "id"], 60).collect()
    assert [(r.id, r.watermark_ms, r.lateness_ms) for r in late] == [(3, 40_000, 10_000)]


STATIC = {
    "person": ([(1, "ff", 1980), (2, "ff", 1985), (3, "ie", 1986), (4, "ie", 1980)], "person_id long, browser string, birth_year int"),
    "member": ([("x", 1), ("x", 2), ("x", 2), ("y", 3), ("z", 4)], "forum_id string, person_id long"),
    "moderator": ([("y", 1), ("x", 4), ("y", 2)], "forum_id string, person_id long"),
    "interest": ([(1, "t"), (2, "t"), (1, "u"), (3, "u")], "person_id long, tag string"),
    "language": ([(1, "de"), (4, "de"), (2, "fr")], "person_id long, language string"),
}


def test_static_features_by_hand(spark):
    """Selected 1 has everything, selected 9 no row at all."""
    tables = [spark.createDataFrame(*STATIC[t]) for t in ("person", "member", "moderator", "interest", "language")]
    got = {
        (r.candidate_id, r.feature): r.amount
        for r in affinity.static_features(affinity.static_units(*tables, Params(selected=(1, 9)))).collect() if r.candidate_id != 1
    }
    assert got == {
        (2, "sameForumMember"): 2, (4, "sameForumMemberModerator"): 1, (3, "sameForumMemberModerator"): 1,
        (2, "sameForumModerator"): 1, (2, "sameAge"): 1, (4, "sameAge"): 1, (2, "sameBrowser"): 1,
        (2, "sameInterestTag"): 1, (3, "sameInterestTag"): 1, (4, "sameLanguage"): 1,
    }


def test_co_activity_windows(spark):
    h = 3_600_000
    rows = [("1", "p", 10 * h), ("1", "p", 10 * h + 5), ("2", "p", 12 * h), ("2", "p", 12 * h + 1), ("3", "p", 14 * h), ("3", "q", 10 * h)]
    df = spark.createDataFrame([(int(a), b, c) for a, b, c in rows], "person_id long, post_id string, ts_ms long")
    got = {(r.window_end_ms // h, r.selected_id, r.candidate_id): r.amount
           for r in affinity.co_activity(df, "post_id", Params(selected=(1,))).collect()}
    # 1 acts at hour 10: windows ending 11..14; 2 at hour 12: windows ending 13..16. Both: 13 and 14.
    assert got == {(13, 1, 2): 2, (14, 1, 2): 2}


def test_suggestions_equal_ranking_of_everyone(spark):
    """The pruned ranking equals ranking all people in all windows."""
    rng = random.Random(11)
    p = Params(selected=(0, 1), top_k=3)
    h, people = 3_600_000, range(30)
    acts = [(rng.choice(people), rng.randint(0, 12) * h + 1) for _ in range(25)]
    static = [(s, c, rng.choice([1, 1, 2, 3])) for s in p.selected for c in people if rng.random() < 0.6]
    friends = [(0, 5), (7, 0), (1, 2)]
    acted = spark.createDataFrame(acts, "person_id long, ts_ms long")
    static_df = spark.createDataFrame(static, "selected_id long, candidate_id long, score long").withColumn(
        "score", F.col("score") * affinity.UNITS)
    knows = spark.createDataFrame(friends, "person1_id long, person2_id long")
    none = spark.createDataFrame([], "window_end_ms long, selected_id long, candidate_id long, feature string, amount long")
    active = affinity.active_people(acted, p).withColumn("feature", F.lit("active"))
    candidates = affinity.candidate_scores(active, none, p)
    got = {(r.window_end_ms // h, r.selected_id, r.rank): (r.candidate_id, float(r.score))
           for r in affinity.as_points(affinity.suggest(candidates, static_df, knows, p)).collect()}

    window = {}
    for person, ts in set(acts):
        for e in range(1, 5):
            window.setdefault((ts // h + e, person), 10)
    again = {}
    for (e, person), w in window.items():
        for f in range(e, e + 4):
            again[f, person] = again.get((f, person), 0) + w
    fixed = {(s, c): v for s, c, v in static}
    want = {}
    for f in {f for f, _ in again}:
        for s in p.selected:
            banned = {s} | {b for a, b in friends if a == s} | {a for a, b in friends if b == s}
            scored = [(-(again.get((f, c), 0) + fixed.get((s, c), 0)), c) for c in people
                      if c not in banned and ((f, c) in again or (s, c) in fixed)]
            for rank, (score, c) in enumerate(sorted(scored)[: p.top_k], 1):
                want[f, s, rank] = (c, float(-score))
    assert got == want


def test_results_do_not_depend_on_layout(spark, rows):
    _, likes, comments = rows
    results = []
    for seed, parts in ((1, 1), (2, 7)):
        mixed = random.Random(seed).sample(comments, len(comments))
        events = activity.engagement_events(
            threads.resolve_replies(_comments(spark, mixed).repartition(parts)), _likes(spark, likes).repartition(parts)
        )
        results.append(sorted(activity.post_activity(events).collect()))
    assert results[0] == results[1]


def test_negative_weights_and_nobody_selected_are_refused():
    with pytest.raises(ValueError):
        Params(weights={"active": -1})
    with pytest.raises(ValueError):
        Params(selected=())
    # There is no upper limit any more.
    assert len(Params(selected=tuple(range(101))).selected) == 101
