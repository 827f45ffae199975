"""Raw files to clean tables and on to the analyses, in the nine-file layout."""

import json

import model
import pytest
from pyspark.sql import functions as F

from murmuration.functions.codec import TOPICS, decode_events, encode_digest, decode_tuple
from murmuration.functions.timing import with_event_time
from murmuration.params import Params
from murmuration.plans import analyses, prep
from murmuration.sources import files

HEADERS = {
    "post": "id|personId|creationDate|imageFile|locationIP|browserUsed|language|content|tags|forumId|placeId",
    "comment": "id|personId|creationDate|locationIP|browserUsed|content|reply_to_postId|reply_to_commentId|placeId",
    "like": "Person.id|Post.id|creationDate",
    "member": "Forum.id|Person.id|joinDate",
    "moderator": "Forum.id|Person.id",
    "person": "id|firstName|lastName|gender|birthday|creationDate|locationIP|browserUsed",
    "interest": "Person.id|Tag.id",
    "language": "Person.id|language",
    "knows": "Person.id|Person.id",
}
ODD = 'a lone " and a back\\slash'


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    posts, likes, comments = model.social_rows(seed=21)
    lines = {
        "post": [f"{p['post_id']}|{p['person_id']}|{model.iso(p['ts_ms'])}||1.1.1.1|Firefox|en|{ODD}|[1, 22]|{p['forum_id']}|9" for p in posts],
        "comment": [f"{c['comment_id']}|{c['person_id']}|{model.iso(c['ts_ms'])}|1.1.1.1|Opera|text {i} bad|{c['reply_to_post'] or ''}|{c['reply_to_comment'] or ''}|9" for i, c in enumerate(comments)],
        "like": [f"{x['person_id']}|{x['post_id']}|{model.iso(x['ts_ms'], True)}" for x in likes],
        "member": [f"{i % 3}|{i}|2012-01-01T00:00:00Z" for i in range(12)],
        "moderator": [f"{i % 3}|{i}" for i in range(0, 12, 5)],
        "person": [f"{i}|Zoë|Müller|f|{1980 + i}-01-02|2011-01-01T00:00:00Z|2.2.2.2|Firefox" for i in range(12)],
        "interest": [f"{i}|{i % 4}" for i in range(12)],
        "language": [f"{i}|{'de' if i % 2 else 'fr'}" for i in range(12)],
        "knows": ["0|1", "2|0", "3|4"],
    }
    root = tmp_path_factory.mktemp("raw")
    for table, spec in files.INPUTS.items():
        path = root / spec.path
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join([HEADERS[table], *lines[table]]) + "\n", encoding=spec.encoding)
    return root, posts, likes, comments


@pytest.fixture(scope="module")
def clean(spark, raw, tmp_path_factory):
    out = tmp_path_factory.mktemp("clean")
    return prep.prepare(spark, str(raw[0]), str(out)), out


def test_prepare_matches_the_row_by_row_rules(spark, raw, clean):
    _, posts, likes, comments = raw
    kept_posts, kept_likes, kept_comments, reasons = model.clean(posts, likes, comments)
    tables, out = clean
    assert {r.post_id for r in tables["post"].collect()} == kept_posts
    assert sorted(r.like_id for r in tables["like"].collect()) == sorted(kept_likes)
    assert {r.comment_id for r in tables["comment"].collect()} == set(kept_comments)
    assert sorted(tuple(r) for r in spark.read.parquet(f"{out}/rejects").select("kind", "id", "reason").collect()) == reasons
    assert {"order_broken", "missing_post", "post_after_child", "missing_parent"} == {r[2] for r in reasons}


def test_fields_survive(clean):
    tables, _ = clean
    post = tables["post"].first()
    assert post.content == ODD and post.tags == ["1", "22"] and post.image_file is None
    assert tables["person"].first().first_name == "Zoë"
    assert tables["knows"].count() == 3  # the first friendship is not mistaken for a header


def test_file_order_holds_over_many_splits(spark, raw):
    posts = raw[1]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = files.read_raw(spark, str(raw[0]), "post", file_order=True)
        assert df.rdd.getNumPartitions() > 3
        got = [r.post_id for r in df.orderBy(*files.ORDER_COLUMNS).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [p["post_id"] for p in posts]


def test_csv_round_trip_and_no_overwrite(spark, clean, tmp_path):
    tables, out = clean
    raw_posts = spark.read.parquet(f"{out}/post")
    files.write_clean(raw_posts, str(tmp_path), "post", "csv")
    again = files.read_clean(spark, str(tmp_path), "post", "csv")
    assert sorted(again.collect()) == sorted(tables["post"].collect())
    with pytest.raises(Exception, match="exist"):
        files.write_clean(raw_posts, str(tmp_path), "post", "csv")


def test_event_time_text(spark):
    df = spark.createDataFrame(
        [("2012-02-02T02:45:14Z",), ("2012-02-02T02:45:14.123Z",), ("yesterday",), ("2012-13-40T00:00:00Z",), (None,)], "t string"
    )
    got = with_event_time(with_event_time(df, "t", "seconds", "s"), "t", "millis", "m").select("s", "m").collect()
    assert [tuple(r) for r in got] == [(1328150714000, None), (None, 1328150714123), (None, None), (None, None), (None, None)]


def test_event_time_does_not_depend_on_the_session_zone(spark):
    from murmuration.functions.timing import epoch_ms

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.123456' a, timestamp'2024-03-10 02:30:00Z' b")
        assert tuple(df.select(epoch_ms(df, "a"), epoch_ms(df, "b")).first()) == (1710037800123, 1710037800000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bad_time_is_rejected_with_a_reason(spark):
    from murmuration.operators import quality

    df = spark.createDataFrame([("1", 5, 1), ("2", None, 2), ("3", 4, 3), ("4", 5, 4)], "post_id string, ts_ms long, at long")
    got = {r.post_id: r.reason for r in quality.audit_order(df, ["at"]).collect()}
    assert got == {"1": None, "2": "bad_time", "3": "order_broken", "4": None}


def test_publish_and_decode(spark, clean, tmp_path):
    tables, _ = clean
    prep.publish_clean(tables, {"path": str(tmp_path)}, "text")
    values = spark.read.text(f"{tmp_path}/{TOPICS['comment']}")
    payload = json.loads(values.first().value)
    assert payload["topicName"] == "comments" and payload["userId"] == payload["personId"] and len(payload["creationDate"]) == 6
    decoded = decode_events(values, "comment")
    assert decoded.filter("bad_json").isEmpty()
    want = {(r.comment_id, r.ts_ms, r.reply_to_post, r.content) for r in tables["comment"].collect()}
    assert {(r.id, r.timeMilisecond, r.reply_to_postId, r.content) for r in decoded.collect()} == want


def test_unknown_fields_are_ignored_and_bad_json_is_marked(spark):
    df = spark.createDataFrame([('{"personId": "1", "timeMilisecond": 5, "extra": [1]}',), ("{oops",), ('{"personId": ""}',)], "value string")
    got = decode_events(df, "like").select("personId", "timeMilisecond", "bad_json").collect()
    assert [tuple(r) for r in got] == [("1", 5, False), (None, None, True), (None, None, False)]


def test_lexicon_and_settings(spark, tmp_path):
    (tmp_path / "words.json").write_text('{\n "BAD_WORDS": ["Darn", "darn", "two words"]\n}')
    assert files.read_lexicon(spark, str(tmp_path / "words.json")) == ["darn", "two words"]
    (tmp_path / "a.properties").write_text("# c\nfriendId0=7\nfriendId10=8\nfriendId2 = 9\nactive=3\nsameBrowser=0.4\nmaxDelayInSec = 60\n")
    p = Params.from_properties(files.read_properties(str(tmp_path / "a.properties")))
    assert p.selected == (7, 9, 8)
    assert float(p.weights["active"]) == float(p.weights["authorActive"]) == 3 and float(p.weights["sameBrowser"]) == 0.4
    assert p.max_delay_s == 60


def test_analyses_run_on_clean_tables(spark, clean):
    tables, _ = clean
    p = Params(selected=(0, 3))
    messages = analyses.activity_messages(tables, p)
    rows = decode_tuple(encode_digest(messages))
    assert rows.count() == analyses.post_activity(tables, p).count() > 0
    top = analyses.friend_suggestions(tables, p).collect()
    assert top and all(r.candidate_id not in (0, 1, 2) for r in top if r.selected_id == 0)
    assert max(r["rank"] for r in top) == 5
    on_update, daily = analyses.unusual_people(tables, ["bad"], Params(n_sigma=1.0))
    assert on_update.count() >= 0 and daily.count() > 0
    assert tables["comment"].select(F.count_distinct("person_id")).first()[0] > 1


def test_command_line(spark, raw, clean, tmp_path):
    from murmuration.__main__ import main

    (tmp_path / "c.properties").write_text("friendId0=0\nfriendId1=3\n")
    main(["suggest", str(clean[1]), str(tmp_path), "--config", str(tmp_path / "c.properties")])
    assert {r.selected_id for r in spark.read.parquet(f"{tmp_path}/suggestions").collect()} == {0, 3}
    with pytest.raises(SystemExit):
        main(["outliers", "a", "b"])
