"""Streams without losses, messages sent once, selected people and lexicons as tables, raw files."""

import json
import pickle
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from murmuration import runtime
from murmuration.functions import codec, text
from murmuration.operators import activity, affinity, features, pairs
from murmuration.params import Params
from murmuration.plans.catalog import Jobs
from murmuration.sources.files import lexicon_table, raw_lines, read_lexicon, read_raw, write_raw
from murmuration.sources.star import LEXICON, PeopleTables
from murmuration.sources.topics import Outbox
from murmuration.streaming.activity import ThreadedActivity

SF = "/root/testdata/sf0.001"
TICK = 1_800_000
EVENT = "topic string, comment_id long, person_id long, ts_ms long, reply_to_post long, reply_to_comment long, post_id long, like_id long"


def _comment(i, person, ts, post=None, parent=None):
    return ("comment", i, person, ts, post, parent, None, None)


def _like(i, person, ts, post):
    return ("like", None, person, ts, None, None, post, i)


def _run(spark, path, batches):
    body = ThreadedActivity(spark, str(path), Params(), "long")
    for i, rows in enumerate(batches):
        body(spark.createDataFrame(rows, EVENT), i)
    return body, {(r.as_of_ms, r.post_id, r.metric): r.n for r in body.ticks.counts.everything().collect()}


def test_a_hot_post_counts_like_any_other(spark, tmp_path):
    """A third of all events on one post, from a thousand people, over several closes."""
    rows, step = [], 40_000
    for i in range(3000):
        post = 1 if i % 3 == 0 else 100 + i % 37
        rows.append(_like(i, i % 1009, i * step, post) if i % 2 else _comment(i, i * 7 % 1013, i * step, post))
    body, got = _run(spark, tmp_path / "s", [rows[:1000], rows[1000:2000], rows[2000:]])
    made = spark.createDataFrame(rows, EVENT)
    comments = made.filter("topic = 'comment'").select("comment_id", "person_id", "ts_ms", "reply_to_comment", F.col("reply_to_post").alias("post_id"))
    events = activity.engagement_events(comments, made.filter("topic = 'like'"))
    closed = max(k[0] for k in got)
    want = {(r.as_of_ms, r.post_id, r.metric): r.n for r in activity.post_activity(events).collect()}
    assert got == {k: n for k, n in want.items() if k[0] <= closed} and closed > 2900 * step - 3_000_000 - 2 * TICK
    assert got[closed, 1, "userEngagement"] > 600
    plan = spark.read.parquet(f"{tmp_path}/s/ticks/counts").agg(F.sum("n"))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_replies_that_resolve_late_count_from_the_current_tick_on(spark, tmp_path):
    far = 10 * TICK
    batches = [
        [_comment(1, 1, 1000, post=5), _comment(3, 3, 2000, parent=2), _comment(4, 3, 2500, parent=3), _like(1, 9, 3000, 5)],
        [_comment(9, 8, far, post=6), _like(2, 9, far, 6)],  # closes the ticks before
        [_comment(2, 2, 1500, parent=1)],  # the missing parent: three comments are resolved behind the watermark
        [_comment(10, 8, 2 * far, post=6), _like(3, 9, 2 * far, 6)],
        [_comment(11, 8, 30 * far, post=7), _like(4, 9, 30 * far, 7)],
    ]
    body, got = _run(spark, tmp_path / "s", batches)
    before = max(t for t, p, _ in got if p == 5 and got[t, p, "reply"] == 1)
    last = max(t for t, p, _ in got if p == 5)
    assert got[last, 5, "reply"] == 4 and got[last, 5, "comment"] == 1 and got[last, 5, "userEngagement"] == 4 and last > before
    assert {r.event_id for r in body.ticks.late.everything().collect()} == {2, 3, 4}
    # Every reply is in some tick: the last totals of all posts add up to all comments.
    totals = {r.post_id: (r.replies, r.people) for r in body.ticks.state.newest("posts").collect()}
    assert totals == {5: (4, 4), 6: (2, 2)} and {r.event_id for r in body.ticks.state.newest("open").collect()} == {11, 4}


def test_a_batch_is_sent_once(spark, tmp_path):
    outbox = Outbox(spark, str(tmp_path / "sent"), {"path": str(tmp_path / "topics")}, "text")
    one, two = (spark.createDataFrame([(v,) for v in vs], "value string") for vs in (["a", "b"], ["c"]))
    outbox.send(one, "out", 0)
    outbox.send(one, "out", 0)  # runs again after its entry: nothing is written
    two.write.text(f"{tmp_path}/topics/out/batch=1")  # failed before its entry: a reader does not see it yet
    assert sorted(r.value for r in outbox.sent_messages("out").collect()) == ["a", "b"]
    outbox.send(two, "out", 1)
    assert sorted(r.value for r in outbox.sent_messages("out").collect()) == ["a", "b", "c"]
    assert json.loads(outbox.files.read(f"{tmp_path}/sent/out/1.json")) == {"topic": "out", "batch": 1, "messages": 1}
    assert outbox.batches("out") == [0, 1] and outbox.sent_messages("nothing").collect() == []


def test_digest_pages_can_be_told_complete(spark):
    p = Params(digest_page=4)
    rows = [(1000, i, "comment", i) for i in range(10)] + [(2000, 1, "reply", 3)]
    digest = activity.activity_digest(spark.createDataFrame(rows, "as_of_ms long, post_id long, metric string, n long"), p)
    texts = sorted(r.value for r in codec.encode_digest_pages(digest).collect())
    assert [t.rsplit(",", 2)[1:] for t in texts] == [["0", "3)"], ["1", "3)"], ["2", "3)"], ["0", "1)"]]
    back = codec.decode_tuple(codec.encode_digest_pages(digest)).collect()
    assert sorted((r.window_end_ms - TICK, r.post_id, r.metric, r.n) for r in back) == sorted(rows)


def test_suggestion_messages_are_read_back(spark):
    wide = spark.createDataFrame([(5, "u", "a", None, "b"), (6, "v", None, None, None)], "window_end_ms long, selected_id string, c1 string, c2 string, c3 string")
    back = codec.decode_suggestions(codec.encode_suggestions(wide, 3), 3, id_type="string")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, wide.collect()), key=str)


def _suggested(jobs, p, selected=None, named=lambda df, *ids: df):
    c, a = jobs.c, jobs.a
    tables = [named(t, "person_id") for t in (c.person(), c.member(), c.moderator(), c.interest(), c.language())]
    rows = affinity.activity_rows(*[named(df, "person_id") for df in (a.raw_posts(), a.likes(), a.direct_comments())])
    static = affinity.static_total(affinity.static_units(*tables, p, selected), p)
    found = affinity.suggest(affinity.activity_scores(rows, p, selected), static, named(c.knows(), "person1_id", "person2_id"), p, selected)
    return {(r.window_end_ms, str(r.selected_id), r.rank, str(r.candidate_id), r.score) for r in found.collect()}


def test_selected_people_as_a_table_and_ids_as_texts(spark):
    """A thousand selected people, nearly all of them without activity; the same as a tuple and as texts."""
    jobs, day = Jobs(spark, SF), 86_400_000
    p = Params(selected=(1, 2, 3), window_ms=5 * day, slide_ms=5 * day)
    as_tuple = _suggested(jobs, p)
    table = spark.range(1, 4).withColumnRenamed("id", "selected_id")
    assert _suggested(jobs, p, table) == as_tuple
    texts = table.select(F.col("selected_id").cast("string").alias("selected_id"))
    # Numbers written as texts keep the order of numbers.
    assert _suggested(jobs, p, texts, lambda df, *ids: df.withColumns({c: F.col(c).cast("string") for c in ids})) == as_tuple
    many = _suggested(jobs, p, spark.range(1, 1001).withColumnRenamed("id", "selected_id"))
    assert {r for r in many if r[1] in ("1", "2", "3")} == as_tuple and len({r[1] for r in many}) == 1000
    assert Params(selected=tuple(range(500))).selected[-1] == 499


def test_selected_people_in_a_properties_file_may_have_text_ids():
    assert Params.from_properties({"friendId0": " 7 ", "friendId1": "ann"}).selected == (7, "ann")


def test_lexicon_as_a_table_equals_the_list(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionAll(
        spark.createDataFrame([(-1, ""), (-2, " \n"), (-3, "THE the\tOf x")], "doc_id long, text string"))
    path = str(tmp_path / "words.json")
    with open(path, "w", encoding="utf-8") as out:
        json.dump({"BAD_WORDS": [w.upper() for w in LEXICON] + ["the"]}, out)
    lexicon = lexicon_table(spark, path)
    assert read_lexicon(spark, path) == sorted(LEXICON)
    listed = {r.doc_id: r.n for r in docs.select("doc_id", text.bad_words(F.col("text"), LEXICON).alias("n")).collect()}
    assert {r.doc_id: r.n_bad for r in text.bad_word_counts(docs, "doc_id", "text", lexicon).collect()} == listed
    comments = Jobs(spark, SF).b.comments()
    steps = [{tuple(r) for r in features.comment_text_steps(comments, x).collect()} for x in (LEXICON, lexicon)]
    assert steps[0] == steps[1]


def test_raw_files_come_back_as_they_were(spark, tmp_path):
    knows = spark.createDataFrame([("1", "2"), ("é", None)], "person1_id string, person2_id string")
    write_raw(knows, str(tmp_path), "knows")
    assert sorted(map(tuple, read_raw(spark, str(tmp_path), "knows").collect()), key=str) == sorted(map(tuple, knows.collect()), key=str)
    line = spark.read.option("encoding", "ISO-8859-1").text(f"{tmp_path}/tables/person_knows_person.csv").filter("value like 'Person%'").first()
    assert line.value == "Person.id|Person.id"
    person = PeopleTables(spark, SF).person().select(F.lit("a|b").alias("person_id"), *[
        F.lit("x").alias(c) for c in ("first_name", "last_name", "gender", "birthday", "creation_date", "location_ip", "browser")])
    with pytest.raises(Exception, match="separator"):
        write_raw(person, str(tmp_path), "person")


@pytest.mark.parametrize("text", ["a|b", "a\nb", "a\r"])
def test_texts_of_a_raw_line_are_searched_without_a_row_function(spark, text):
    rows = spark.createDataFrame([(1, 2, None), (3, None, "t"), (5, 6, "")], "forum_id long, person_id long, join_date string")
    lines = raw_lines(rows, "member")
    assert [r[0] for r in lines.collect()] == ["1|2|", "3||t", "5|6|"]
    # A lambda is evaluated row by row, outside of generated code.
    assert "lambda" not in lines._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(Exception, match="separator"):
        raw_lines(rows.fillna(text, ["join_date"]), "member").collect()


def test_tasks_of_static_features_do_not_grow_with_the_tables(spark, monkeypatch):
    """The session has 4 shuffle partitions; purchases are joined with their orders once."""
    monkeypatch.setattr(runtime, "ROWS_A_TASK", 100)
    jobs = Jobs(spark, SF)
    units = jobs._static_units()
    assert units.rdd.getNumPartitions() == -(-4 * len(jobs.p.selected) * jobs.c.person().count() // 100)
    assert jobs.c.member().rdd.getNumPartitions() == -(-jobs.c.read("lineitem").count() // 100)
    assert "orders.parquet" not in "".join(units.inputFiles())


def test_many_selected_people_in_small_blocks(spark, monkeypatch):
    """Blocks of pairs rank as the joins do: overlapping windows, friends, ids as texts, features without weight."""
    monkeypatch.setattr(pairs, "SELECTED_BLOCK", 11)
    monkeypatch.setattr(pairs, "CANDIDATE_BLOCK", 40)
    jobs, day = Jobs(spark, SF), 86_400_000
    names = [str(i) for i in (1, 2, 3, 7, 11, *range(20, 60))]
    p = Params(selected=tuple(names), window_ms=10 * day, slide_ms=5 * day,
               weights=Params().weights | {"sameBrowser": Decimal(0), "sameAge": Decimal(0)})
    table = spark.createDataFrame([(n,) for n in names], "selected_id string")

    def named(df, *ids):
        return df.withColumns({c: F.col(c).cast("string") for c in ids})

    c, a = jobs.c, jobs.a
    tables = [named(t, "person_id") for t in (c.person(), c.member(), c.moderator(), c.interest(), c.language())]
    rows = affinity.activity_rows(*[named(df, "person_id") for df in (a.raw_posts(), a.likes(), a.direct_comments())])
    found = pairs.suggest(rows, tables, named(c.knows(), "person1_id", "person2_id"), p, table)
    blocks = {(r.window_end_ms, r.selected_id, r.rank, r.candidate_id, r.score) for r in found.collect()}
    assert len(blocks) > 1000 and blocks == _suggested(jobs, p, table, named)


def test_word_counts_shuffle_texts_not_words(spark, monkeypatch):
    """One exchange, of whole texts by their id, in as many parts as their words need; repeated and null ids add up."""
    docs = spark.createDataFrame([(1, "a b a"), (1, "a  c"), (None, "x"), (None, "x y"), (2, ""), (3, None), (4, " \n")], "doc_id long, text string")
    found = text.word_counts(docs, "doc_id", "text")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "hashpartitioning(doc_id" in plan and "word" not in plan.split("Exchange ")[1]
    assert {(r.doc_id, r.word, r.n) for r in found.collect()} == {
        (1, "a", 3), (1, "b", 1), (1, "", 1), (1, "c", 1), (None, "x", 2), (None, "y", 1), (2, "", 1)}
    monkeypatch.setattr(runtime, "ROWS_A_TASK", 100)
    assert text.word_counts(docs.unionAll(spark.createDataFrame([(5, "word " * 1200)], docs.schema)), "doc_id", "text").rdd.getNumPartitions() == 11


@pytest.mark.parametrize("dense, crowded, weights", [(512, 8, (3, 1, 2)), (0, 0, (3, 1, 2)), (20, 1 << 20, (3, 1, 2)), (20, 8, (0, 1, 0))])
def test_pairs_that_cannot_reach_a_rank_are_left_out_exactly(monkeypatch, dense, crowded, weights):
    """Blocks without activity are multiplied only for selected people who can gain by them; the ranks are those of all pairs."""
    random, n, n_keys, windows, top_k = np.random.default_rng(5), 360, 40, [10, 20, 30], 3
    kinds = [0, 6, 12]  # tags, years, forums
    value = np.repeat(np.array(weights, float), np.diff([*kinds, n_keys]))
    keys = [np.sort(np.concatenate([random.choice(6, random.integers(1, 7), False), random.integers(6, 12, 1), random.choice(np.arange(12, 40), 2)]))
            if i % 9 else np.empty(0, int) for i in range(n)]
    ids = random.permutation(n)
    acts = {(w, i): int(random.integers(0, 4)) for w in range(3) for i in random.choice(100, 40, False)}
    selected = np.arange(0, n, 7)
    friends = [(s, int(random.integers(n))) for s in range(len(selected)) for _ in range(3)]
    rows = [(w, i, int(t), int(random.integers(1, 3))) for w, i in acts for t in random.choice(5, random.integers(0, 3), False)]
    targets = {(w, s, 5 * w + t) for s, i in enumerate(selected) for w, j, t, _ in rows if i == j}
    own = [np.unique(keys[i]) for i in selected]

    static = np.array([[sum(value[k] for k in keys[c] if k in own[s]) for c in range(n)] for s in range(len(selected))])
    common = np.array([[any(k in own[s] for k in keys[c]) for c in range(n)] for s in range(len(selected))])
    want = set()
    for w, end in enumerate(windows):
        score = static + np.array([acts.get((w, c), 0) for c in range(n)])
        for at, c, t, m in rows:
            for s in range(len(selected)) if at == w else ():
                score[s, c] += 20 * m * ((w, s, 5 * w + t) in targets)
        for s, i in enumerate(selected):
            good = [c for c in range(n) if c != i and (s, c) not in friends and (common[s, c] or (w, c) in acts)]
            for rank, c in enumerate(sorted(good, key=lambda c: (-score[s, c], ids[c]))[:top_k]):
                want.add((end, f"p{i}", rank + 1, f"p{c}", int(score[s, c])))

    def packed(some):
        acting = sorted((w, -acts[w, i], j) for j, i in enumerate(some) for w in range(3) if (w, i) in acts)
        shared = sorted((w, j, 5 * w + t, m) for j, i in enumerate(some) for w, at, t, m in rows if at == i)
        columns = [np.array([x[k] for x in acting], np.int64) for k in (0, 2, 1)]
        return pickle.dumps((ids[some], pa.array([f"p{i}" for i in some]), np.array([len(keys[i]) for i in some], np.int32),
                             np.concatenate([keys[i] for i in some]).astype(np.int32), [columns[0], columns[1], -columns[2]],
                             [np.array([x[k] for x in shared], np.int64) for k in range(4)]), 5)

    values, code = np.unique(np.concatenate([value[k] for k in own]), return_inverse=True)
    mine = sorted(targets)
    ours = pickle.dumps((ids[selected], pa.array([f"p{i}" for i in selected]), (np.array([len(k) for k in own], np.int32), np.concatenate(own), values, code),
                         (np.array([s for _, s, _ in mine]), np.array([t for _, _, t in mine]), np.full(len(mine), 20)),
                         [np.array([s for s, _ in friends]), ids[[c for _, c in friends]]]), 5)
    # Those who act come first, the others in the order of their ids.
    order = np.concatenate([np.arange(100), 100 + np.argsort(ids[100:])])
    blocks = [packed(order[i:i + 50]) for i in range(0, n, 50)]
    batches = [pa.RecordBatch.from_pydict({"s_block": pa.array([0]), "s_data": pa.array([ours], pa.binary()), "c_data": pa.array([b], pa.binary())}) for b in blocks]
    monkeypatch.setattr(pairs, "DENSE", dense)
    monkeypatch.setattr(pairs, "CROWDED", crowded)
    found = [r for b in pairs.best_pairs(top_k, windows, kinds, n_keys, 15, pa.string())(iter(batches)) for r in b.to_pylist()]
    assert len(found) == len(want)
    assert {(r["window_end_ms"], r["selected_id"], r["rank"], r["candidate_id"], r["score"]) for r in found} == want
