"""The catalogue's queries in plain SQL, for checking results with another engine.

Written from the definitions, not from the Spark plans: running values are ordinary
windows, threads a recursive query, as-of counts a window over events and questions.
"""

from __future__ import annotations

import re

from murmuration.params import DAY_MS, HOUR_MS
from murmuration.plans.catalog import PARAMS
from murmuration.sources.star import LEXICON, SELECTED, START_MS

SEL = ", ".join(str(s) for s in SELECTED)
WORDS = ", ".join(f"'{w}'" for w in LEXICON)
WEIGHT = {name: str(w) for name, w in PARAMS.weights.items()}
ENDS = "unnest([1, 2, 3, 4])"

# Named sub-queries; each may use the ones before it.
PARTS = {
    # -- engagement from events
    "ev": """SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ts_ms,
        CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k FROM events""",
    "raw_posts": """SELECT event_id AS post_id, user_id AS person_id, ts_ms, k % 10 AS forum_id
        FROM ev WHERE event_type = 'signup'""",
    "posts": """SELECT k AS post_id, arg_min(user_id, event_id) AS person_id, arg_min(ts_ms, event_id) AS ts_ms
        FROM ev WHERE event_type = 'signup' GROUP BY k""",
    "likes": """SELECT event_id AS like_id, user_id AS person_id, k AS post_id, ts_ms
        FROM ev WHERE event_type = 'click'""",
    "placed": """SELECT *, row_number() OVER (PARTITION BY k ORDER BY event_id) AS place
        FROM ev WHERE event_type IN ('purchase', 'view')""",
    "comments": """SELECT event_id AS comment_id, user_id AS person_id, ts_ms, k AS reply_to_post,
            CAST(NULL AS BIGINT) AS reply_to_comment FROM placed WHERE event_type = 'purchase'
        UNION ALL
        SELECT v.event_id, v.user_id, v.ts_ms, NULL, coalesce(e.event_id, -1)
        FROM placed v LEFT JOIN placed e ON e.k = v.k AND e.place = v.place - 1 - v.event_id % 3
        WHERE v.event_type = 'view'""",
    "resolved": """SELECT comment_id, person_id, ts_ms, reply_to_comment, reply_to_post AS post_id,
            CAST(0 AS BIGINT) AS depth FROM comments WHERE reply_to_post IS NOT NULL
        UNION ALL
        SELECT c.comment_id, c.person_id, c.ts_ms, c.reply_to_comment, r.post_id, r.depth + 1
        FROM comments c JOIN resolved r ON c.reply_to_comment = r.comment_id
        WHERE c.reply_to_post IS NULL""",
    "engagement": """SELECT post_id, CASE WHEN reply_to_comment IS NULL THEN 1 ELSE 0 END AS kind,
            person_id, ts_ms, comment_id AS event_id FROM resolved
        UNION ALL SELECT post_id, 2, person_id, ts_ms, like_id FROM likes""",
    "units": """SELECT post_id, 'comment' AS metric, ts_ms FROM engagement WHERE kind = 1
        UNION ALL SELECT post_id, 'reply', ts_ms FROM engagement WHERE kind IN (0, 1)
        UNION ALL SELECT post_id, 'userEngagement', min(ts_ms) FROM engagement GROUP BY post_id, person_id""",
    # -- activity: a full grid of ticks per post, counted from scratch
    "span": "SELECT (max(ts_ms) // 1800000) * 1800000 AS last_tick FROM engagement",
    "first_last": "SELECT post_id, min(ts_ms) AS first_ms FROM engagement GROUP BY post_id",
    "ticks": """SELECT post_id, unnest(range((first_ms // 1800000 + 1) * 1800000, last_tick + 1, 1800000)) AS as_of_ms
        FROM first_last, span""",
    "active": """SELECT t.post_id, t.as_of_ms FROM ticks t ASOF JOIN
            (SELECT DISTINCT post_id, ts_ms FROM engagement) e
        ON t.post_id = e.post_id AND e.ts_ms < t.as_of_ms WHERE e.ts_ms > t.as_of_ms - 43200000""",
    "metrics": "SELECT unnest(['comment', 'reply', 'userEngagement']) AS metric",
    "asked": "SELECT post_id, metric, as_of_ms FROM active, metrics",
    "counted": """SELECT post_id, metric, at_ms, asked, CAST(sum(unit) OVER
            (PARTITION BY post_id, metric ORDER BY at_ms, asked DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n
        FROM (SELECT post_id, metric, ts_ms AS at_ms, 0 AS asked, 1 AS unit FROM units
              UNION ALL SELECT post_id, metric, as_of_ms, 1, 0 FROM asked)""",
    "activity": """SELECT at_ms AS as_of_ms, post_id, metric, n FROM counted WHERE asked = 1""",
    "paged": """SELECT *, (row_number() OVER (PARTITION BY as_of_ms ORDER BY post_id, metric) - 1) // 100 AS page
        FROM activity""",
    "digest": """SELECT as_of_ms, as_of_ms + 1800000 AS window_end_ms, CAST(page AS BIGINT) AS page,
            count(*) AS n_updates,
            '[' || string_agg('(' || post_id || ',' || metric || ',' || n || ')', ', ' ORDER BY post_id, metric) || ']'
              AS updates
        FROM paged GROUP BY as_of_ms, page""",
    # -- arrival order
    "all_arrivals": "SELECT event_id, ts_ms, ts_ms + (300 + event_id * 7919 % 2700) * 1000 AS arrival_ms FROM ev",
    "raw_posts_in": """SELECT *, ts_ms + (300 + post_id * 7919 % 2700) * 1000 AS arrival_ms FROM raw_posts""",
    "posts_seen": """SELECT *, max(ts_ms) OVER (ORDER BY arrival_ms, post_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM raw_posts_in""",
    "likes_in": """SELECT l.*, ts_ms + (300 + like_id * 7919 % 2700) * 1000 AS arrival_ms,
            (SELECT p.ts_ms FROM posts p WHERE p.post_id = l.post_id) AS post_ms FROM likes l""",
    "likes_seen": """SELECT *, max(CASE WHEN post_ms < ts_ms THEN ts_ms END) OVER (ORDER BY arrival_ms, like_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM likes_in""",
    "comments_in": """SELECT c.*, ts_ms + (300 + comment_id * 7919 % 2700) * 1000 AS arrival_ms,
            (SELECT p.ts_ms FROM posts p WHERE p.post_id = c.reply_to_post) AS post_ms FROM comments c""",
    "kept": """SELECT comment_id, person_id, ts_ms, reply_to_comment, arrival_ms, CAST(0 AS BIGINT) AS depth
            FROM comments_in WHERE reply_to_post IS NOT NULL AND post_ms < ts_ms
        UNION ALL
        SELECT c.comment_id, c.person_id, c.ts_ms, c.reply_to_comment, c.arrival_ms, k.depth + 1
        FROM comments_in c JOIN kept k ON c.reply_to_comment = k.comment_id
        WHERE c.reply_to_post IS NULL
          AND (k.arrival_ms < c.arrival_ms OR (k.arrival_ms = c.arrival_ms AND k.comment_id < c.comment_id))""",
    # -- texts
    "doc_body": "SELECT doc_id, text, rtrim(text, E' \\t\\n\\x0B\\f\\r') AS body FROM documents",
    "doc_tokens": """SELECT doc_id, CASE WHEN body = '' AND text <> '' THEN [] ELSE
            string_split_regex(body, '[ \\t\\n\\x0B\\f\\r]') END AS t FROM doc_body""",
    "turn_tokens": """SELECT conv_id, turn, CASE WHEN body = '' AND text <> '' THEN [] ELSE
            string_split_regex(body, '[ \\t\\n\\x0B\\f\\r]') END AS t
        FROM (SELECT conv_id, turn, text, rtrim(text, E' \\t\\n\\x0B\\f\\r') AS body FROM conversations)""",
    "t_posts": f"""SELECT doc_id AS event_id, doc_id % 50 AS person_id, {START_MS} + doc_id * 600000 AS ts_ms, t
        FROM doc_tokens""",
    "t_comments": f"""SELECT conv_id * 1000 + turn AS event_id, conv_id % 50 AS person_id,
            {START_MS} + conv_id * 1800000 + turn * 60000 AS ts_ms, t FROM turn_tokens""",
    "t_likes": "SELECT like_id AS event_id, post_id % 50 AS person_id, ts_ms, post_id FROM likes",
    "a_likes": "SELECT like_id AS event_id, person_id, ts_ms, post_id FROM likes",
    # -- people
    "n": "SELECT count(*) AS n FROM customer",
    "bought": "SELECT o_custkey, l_suppkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "person": """SELECT c_custkey AS person_id, c_mktsegment AS browser, 1940 + c_custkey * 7919 % 60 AS birth_year
        FROM customer""",
    "member": "SELECT DISTINCT l_suppkey AS forum_id, o_custkey AS person_id FROM bought",
    "moderator": """SELECT s_suppkey AS forum_id, s_suppkey * 13 % n AS person_id FROM supplier, n
        UNION ALL SELECT s_suppkey, s_suppkey % 10 FROM supplier""",
    "interest": "SELECT DISTINCT o_custkey AS person_id, p_brand AS tag FROM bought JOIN part ON l_partkey = p_partkey",
    "lang": """SELECT c_custkey AS person_id, n_name AS language FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey""",
    "knows": """SELECT c_custkey AS a, (c_custkey * 17 + 3) % n AS b FROM customer, n
        WHERE c_custkey <> (c_custkey * 17 + 3) % n""",
    "friend": "SELECT a AS s, b AS c FROM knows UNION SELECT b, a FROM knows",
    "s_forum": f"SELECT DISTINCT person_id AS s, forum_id FROM member WHERE person_id IN ({SEL})",
    "s_mod": f"SELECT DISTINCT person_id AS s, forum_id FROM moderator WHERE person_id IN ({SEL})",
    "s_tag": f"SELECT DISTINCT person_id AS s, tag FROM interest WHERE person_id IN ({SEL})",
    "s_lang": f"SELECT DISTINCT person_id AS s, language FROM lang WHERE person_id IN ({SEL})",
    "s_person": f"SELECT * FROM person WHERE person_id IN ({SEL})",
    "static_units": """SELECT s, person_id AS c, 'sameForumMember' AS feature FROM member JOIN s_forum USING (forum_id)
        UNION ALL SELECT s, person_id, 'sameForumModerator' FROM moderator JOIN s_mod USING (forum_id)
        UNION ALL SELECT s, person_id, 'sameForumMemberModerator' FROM member JOIN s_mod USING (forum_id)
        UNION ALL SELECT s, person_id, 'sameForumMemberModerator' FROM moderator JOIN s_forum USING (forum_id)
        UNION ALL SELECT a.person_id, b.person_id, 'sameAge' FROM s_person a JOIN person b
            ON abs(a.birth_year - b.birth_year) <= 5
        UNION ALL SELECT a.person_id, b.person_id, 'sameBrowser' FROM s_person a JOIN person b ON a.browser = b.browser
        UNION ALL SELECT s, person_id, 'sameInterestTag' FROM interest JOIN s_tag USING (tag)
        UNION ALL SELECT s, person_id, 'sameLanguage' FROM lang JOIN s_lang USING (language)""",
    "static_features": """SELECT s AS selected_id, c AS candidate_id, feature, count(*) AS amount
        FROM static_units GROUP BY ALL""",
    "weights": "SELECT * FROM (VALUES " + ", ".join(
        f"('{name}', CAST({w} AS DECIMAL(12, 4)))" for name, w in WEIGHT.items()) + ") AS w(feature, weight)",
    "static_total": """SELECT selected_id, candidate_id, sum(amount * weight) AS score
        FROM static_features JOIN weights USING (feature) GROUP BY ALL""",
    # -- windowed co-activity
    "acts": """SELECT 'likedTheSame' AS feature, person_id AS p, post_id AS target, ts_ms FROM likes
        UNION ALL SELECT 'postedSameForum', person_id, forum_id, ts_ms FROM raw_posts
        UNION ALL SELECT 'commentedSamePost', person_id, reply_to_post, ts_ms FROM comments
            WHERE reply_to_post IS NOT NULL
        UNION ALL SELECT 'commentedSameComment', person_id, reply_to_comment, ts_ms FROM comments
            WHERE reply_to_comment >= 0""",
    "acts_in": f"""SELECT feature, p, target, (ts_ms // {HOUR_MS} + {ENDS}) * {HOUR_MS} AS window_end_ms FROM acts""",
    "co": f"""SELECT feature, a.window_end_ms, b.s AS selected_id, a.p AS candidate_id, count(*) AS amount
        FROM acts_in a JOIN (SELECT DISTINCT feature, p AS s, target, window_end_ms FROM acts_in WHERE p IN ({SEL})) b
        USING (feature, target, window_end_ms) WHERE a.p <> b.s GROUP BY ALL""",
    "actors_in": f"""SELECT user_id AS p, (ts_ms // {HOUR_MS} + {ENDS}) * {HOUR_MS} AS window_end_ms FROM ev
        WHERE event_type IN ('signup', 'click', 'purchase', 'view')""",
    "aff_active": "SELECT DISTINCT window_end_ms, p AS candidate_id, CAST(1 AS BIGINT) AS amount FROM actors_in",
    "aff_author": f"""SELECT window_end_ms, p AS candidate_id, count(*) AS amount FROM acts_in
        WHERE feature = 'postedSameForum' GROUP BY ALL""",
    "sel": f"SELECT unnest([{SEL}]) AS selected_id",
    "win": """SELECT window_end_ms, selected_id, candidate_id, feature, amount FROM co
        UNION ALL SELECT window_end_ms, selected_id, candidate_id, 'active', amount FROM aff_active, sel
        UNION ALL SELECT window_end_ms, selected_id, candidate_id, 'authorActive', amount FROM aff_author, sel""",
    "win_again": f"""SELECT window_end_ms + (unnest([1, 2, 3, 4]) - 1) * {HOUR_MS} AS window_end_ms, selected_id,
        candidate_id, score FROM (SELECT window_end_ms, selected_id, candidate_id, sum(amount * weight) AS score
            FROM win JOIN weights USING (feature) GROUP BY ALL)""",
    "win_score": """SELECT window_end_ms, selected_id, candidate_id, sum(score) AS score FROM win_again GROUP BY ALL""",
    "scored": """SELECT w.window_end_ms, w.selected_id, w.candidate_id, w.score + coalesce(s.score, 0) AS score
        FROM win_score w LEFT JOIN static_total s USING (selected_id, candidate_id)""",
    "cand": """SELECT * FROM scored x WHERE candidate_id <> selected_id
        AND NOT EXISTS (SELECT 1 FROM friend f WHERE f.s = x.selected_id AND f.c = x.candidate_id)""",
    # every person with a static score, in every window
    "quiet": """SELECT e.window_end_ms, s.selected_id, s.candidate_id, s.score
        FROM (SELECT DISTINCT window_end_ms FROM scored) e, static_total s
        WHERE s.candidate_id <> s.selected_id
          AND NOT EXISTS (SELECT 1 FROM friend f WHERE f.s = s.selected_id AND f.c = s.candidate_id)
          AND NOT EXISTS (SELECT 1 FROM scored w WHERE w.window_end_ms = e.window_end_ms
              AND w.selected_id = s.selected_id AND w.candidate_id = s.candidate_id)""",
    "top5": """SELECT window_end_ms, selected_id, rank, candidate_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY window_end_ms, selected_id ORDER BY score DESC, candidate_id) AS rank
        FROM (SELECT * FROM cand UNION ALL SELECT * FROM quiet)) WHERE rank <= 5""",
}


def _ratio_feature(name: str, rows: str, feature: int, num: str, den: str) -> None:
    PARTS[name] = f"""SELECT person_id, {feature} AS feature_id, event_id, ts_ms,
        sum({num}) OVER w / nullif(sum({den}) OVER w, 0) AS value FROM {rows}
        WINDOW w AS (PARTITION BY person_id ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING)"""


_UNIQ = "coalesce(CAST(len(list_distinct(t)) AS DOUBLE) / nullif(len(t), 0), 0)"
_HAS = "CASE WHEN len(t) > 0 THEN 1 ELSE 0 END"
_BAD = f"CAST(len(list_filter(t, lambda x: lower(x) IN ({WORDS}))) AS DOUBLE)"
for _side, _first in (("post", 0), ("comment", 2)):
    PARTS[f"m_{_side}s"] = f"SELECT *, {_UNIQ} AS uniq, {_HAS} AS has, {_BAD} AS bad FROM t_{_side}s"
    _ratio_feature(f"f{_first}", f"m_{_side}s", _first, "uniq", "has")
    _ratio_feature(f"f{_first + 1}", f"m_{_side}s", _first + 1, "bad", "1")
PARTS["vocab"] = """SELECT event_id, count(*) AS new FROM (
        SELECT w.*, row_number() OVER (PARTITION BY person_id, word ORDER BY ts_ms, event_id) AS nth
        FROM (SELECT person_id, event_id, ts_ms, unnest(t) AS word FROM t_comments) w) WHERE nth = 1 GROUP BY event_id"""
PARTS["m_vocab"] = """SELECT c.person_id, c.event_id, c.ts_ms, CAST(coalesce(new, 0) AS DOUBLE) AS new
        FROM t_comments c LEFT JOIN vocab USING (event_id)"""
_ratio_feature("f4", "m_vocab", 4, "new", "1")
for _name, _rows in (("f5", "t_likes"), ("a_f5", "a_likes")):
    PARTS[f"{_name}_seen"] = f"""SELECT l.*, CASE WHEN author IS NOT NULL AND row_number() OVER (
            PARTITION BY person_id, author ORDER BY ts_ms, event_id) = 1 THEN 1.0::DOUBLE ELSE 0 END AS new
        FROM (SELECT l.*, (SELECT p.person_id FROM posts p WHERE p.post_id = l.post_id) AS author FROM {_rows} l) l"""
    _ratio_feature(_name, f"{_name}_seen", 5, "new", "1")
PARTS |= {
    "long": " UNION ALL ".join(f"SELECT * FROM f{i}" for i in range(6)),
    "valued": "SELECT * FROM long WHERE value IS NOT NULL",
    "days": f"""SELECT feature_id, unnest(range((min(ts_ms) // {DAY_MS} + 1) * {DAY_MS},
        (max(ts_ms) // {DAY_MS} + 1) * {DAY_MS} + 1, {DAY_MS})) AS day_ms FROM valued GROUP BY feature_id""",
    "daily": """SELECT d.feature_id, d.day_ms, v.person_id, arg_max(v.value, (v.ts_ms, v.event_id)) AS value
        FROM days d JOIN valued v ON v.feature_id = d.feature_id AND v.ts_ms < d.day_ms GROUP BY ALL""",
    "stats": """SELECT feature_id, day_ms, count(*) AS n_people, avg(value) AS mean, stddev_pop(value) AS sd
        FROM daily GROUP BY ALL""",
}

_RECURSIVE = ("resolved", "kept", "raw_kept")


def sql(body: str) -> str:
    """``body`` with the named sub-queries it needs, directly or through others, in front."""
    def used(text: str) -> set[str]:
        return set(re.findall(r"\b[a-z_0-9]+\b", text)) & PARTS.keys()

    needed, todo = set(), used(body)
    while todo:
        needed |= todo
        todo = set().union(*(used(PARTS[name]) for name in todo)) - needed
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in PARTS if name in needed)
    if not parts:
        return body
    recursive = "RECURSIVE " if needed & set(_RECURSIVE) else ""
    return f"WITH {recursive}{parts}\n{body}"


def _features(rows: str) -> str:
    return f"SELECT person_id, feature_id, event_id, ts_ms, round(value, 6) AS value FROM {rows}"


def _on_update(n: int) -> str:
    return f"""SELECT v.person_id, v.feature_id, v.event_id, round(v.value, 6) AS value, round(s.mean, 6) AS mean, v.ts_ms
        FROM valued v JOIN stats s ON s.feature_id = v.feature_id AND s.day_ms = v.ts_ms // {DAY_MS} * {DAY_MS}
        WHERE abs(v.value - s.mean) > {n} * s.sd"""


def _at_midnight(n: int) -> str:
    return f"""SELECT d.day_ms, d.person_id, d.feature_id, round(d.value, 6) AS value, round(s.mean, 6) AS mean
        FROM daily d JOIN stats s USING (feature_id, day_ms) WHERE abs(d.value - s.mean) > {n} * s.sd"""


def _co(feature: str) -> str:
    return f"""SELECT window_end_ms, selected_id, candidate_id, amount FROM co WHERE feature = '{feature}'"""


BODIES = {
    "decode_json": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        NOT json_valid(props) AS bad_json FROM events""",
    "encode_json": """SELECT CAST(json_object('timeMilisecond', ts_ms, 'personId', CAST(person_id AS VARCHAR),
        'postId', CAST(post_id AS VARCHAR), 'creationDate', NULL, 'topicName', 'likes', 'timestamp', ts_ms,
        'userId', CAST(person_id AS VARCHAR)) AS VARCHAR) AS value FROM likes""",
    "encode_tuple": "SELECT '(' || window_end_ms || ',' || updates || ')' AS value FROM digest",
    "encode_digest_pages": """SELECT '(' || window_end_ms || ',' || updates || ',' || page || ',' ||
        count(*) OVER (PARTITION BY as_of_ms) || ')' AS value FROM digest""",
    "decode_tuple": "SELECT as_of_ms + 1800000 AS window_end_ms, post_id, metric, n FROM activity",
    "epoch_ms": """SELECT event_id, epoch_ms(date_trunc('second', ts)) AS second_ms,
        epoch_ms(date_trunc('millisecond', ts)) AS milli_ms, CAST(NULL AS BIGINT) AS wrong_form_ms FROM events""",
    "monotone_posts": """SELECT post_id, person_id, ts_ms, forum_id, arrival_ms FROM posts_seen
        WHERE latest IS NULL OR ts_ms >= latest""",
    "clean_likes": """SELECT like_id, person_id, post_id, ts_ms, arrival_ms FROM likes_seen
        WHERE post_ms < ts_ms AND (latest IS NULL OR ts_ms >= latest)""",
    "clean_comments": """SELECT comment_id, person_id, ts_ms, reply_to_post FROM comments_in
        WHERE reply_to_post IS NOT NULL AND post_ms < ts_ms""",
    "clean_replies": "SELECT comment_id, person_id, ts_ms, reply_to_comment, depth FROM kept WHERE depth > 0",
    "reject_reasons": """SELECT 'post' AS kind, post_id AS id, 'order_broken' AS reason FROM posts_seen
            WHERE ts_ms < latest
        UNION ALL SELECT 'like', like_id, CASE WHEN ts_ms < latest THEN 'order_broken'
            WHEN post_ms IS NULL THEN 'missing_post' ELSE 'post_after_child' END FROM likes_seen
            WHERE ts_ms < latest OR post_ms IS NULL OR post_ms >= ts_ms
        UNION ALL SELECT 'comment', comment_id, CASE WHEN post_ms IS NULL THEN 'missing_post'
            ELSE 'post_after_child' END FROM comments_in
            WHERE reply_to_post IS NOT NULL AND (post_ms IS NULL OR post_ms >= ts_ms)
        UNION ALL SELECT 'comment', comment_id, 'missing_parent' FROM comments_in
            WHERE reply_to_post IS NULL AND comment_id NOT IN (SELECT comment_id FROM kept)""",
    "parse_tags": """SELECT page_id, CAST(len(t) AS BIGINT) AS n_tags, array_to_string(t, ',') AS tags
        FROM (SELECT page_id, regexp_extract_all(url, '[0-9]+', 0) AS t FROM pages)""",
    "late_rows": """SELECT event_id, ts_ms, arrival_ms, latest - 600000 AS watermark_ms,
            latest - 600000 - ts_ms AS lateness_ms
        FROM (SELECT *, max(ts_ms) OVER (ORDER BY arrival_ms, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM all_arrivals)
        WHERE latest - 600000 > ts_ms""",
    "comment_kinds": """SELECT CASE WHEN reply_to_comment IS NULL THEN 1 ELSE 0 END AS kind, count(*) AS n
        FROM comments GROUP BY 1""",
    "resolve_replies": "SELECT comment_id, post_id, depth FROM resolved",
    "thread_stats": """SELECT post_id, count(*) AS n_comments, max(depth) AS max_depth FROM resolved GROUP BY post_id""",
    "liked_author": """SELECT l.like_id, l.person_id, l.post_id, l.ts_ms, p.person_id AS author_id
        FROM likes l LEFT JOIN posts p USING (post_id)""",
    "engagement_events": "SELECT post_id, kind, person_id, ts_ms, event_id FROM engagement",
    "first_engagement": """SELECT post_id, person_id, min(ts_ms) AS first_ts_ms FROM engagement GROUP BY ALL""",
    "post_activity_30m": "SELECT as_of_ms, post_id, metric, n FROM activity",
    "activity_digest": "SELECT * FROM digest",
    "asof_counts": f"""SELECT post_id, metric, time_ms, CAST(sum(n) OVER
            (PARTITION BY post_id, metric ORDER BY time_ms) AS BIGINT) AS n
        FROM (SELECT post_id, metric, (ts_ms // {DAY_MS} + 1) * {DAY_MS} - 1 AS time_ms, count(*) AS n
              FROM units GROUP BY ALL)""",
    "activity_bounds": """SELECT metric, count(*) AS n_updates,
            count(*) FILTER (WHERE n < low_n OR n > high_n) AS n_violations
        FROM (SELECT a.metric, a.n, coalesce(l.n, 0) AS low_n, coalesce(h.n, 0) AS high_n FROM activity a
            ASOF LEFT JOIN unit_counts l ON l.post_id = a.post_id AND l.metric = a.metric AND l.ts_ms <= a.as_of_ms - 1000
            ASOF LEFT JOIN unit_counts h ON h.post_id = a.post_id AND h.metric = a.metric AND h.ts_ms <= a.as_of_ms + 1800000)
        GROUP BY metric""",
    "tumbling_counts": """SELECT (ts_ms // 1800000 + 1) * 1800000 AS window_end_ms, event_type, count(*) AS n
        FROM ev GROUP BY ALL""",
    "sliding_counts": f"""SELECT window_end_ms, post_id, count(*) AS n FROM (
        SELECT (ts_ms // {HOUR_MS} + {ENDS}) * {HOUR_MS} AS window_end_ms, post_id FROM likes) GROUP BY ALL""",
    "chained_windows": f"""SELECT window_end_ms + (i - 1) * {HOUR_MS} AS window_end_ms, person_id,
            CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT window_end_ms, person_id, count(*) AS n, {ENDS} AS i FROM (
            SELECT (ts_ms // {HOUR_MS} + {ENDS}) * {HOUR_MS} AS window_end_ms, person_id FROM likes) GROUP BY 1, 2)
        GROUP BY 1, 2""",
    "tokens": """SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, chr(10))) AS tokens_md5
        FROM doc_tokens""",
    "uniq_ratio": """SELECT doc_id, round(CAST(len(list_distinct(t)) AS DOUBLE) / nullif(len(t), 0), 6) AS ratio
        FROM doc_tokens""",
    "bad_words": f"""SELECT doc_id, CAST(len(list_filter(t, lambda x: lower(x) IN ({WORDS}))) AS BIGINT) AS n_bad
        FROM doc_tokens""",
    "bad_words_lexicon": """SELECT doc_id, CAST(len(list_filter(t, lambda x: list_contains(words, lower(x)))) AS BIGINT) AS n_bad
        FROM doc_tokens, (SELECT list(DISTINCT lower(w)) AS words FROM (SELECT unnest(t) AS w FROM bench_tokens) WHERE w <> '')""",
    "prep_roundtrip": """SELECT 'post' AS source, concat_ws('|', ts_ms, post_id, person_id, '-', '10.0.0.' || post_id, 'Firefox', 'fr',
            '  Où ça? „' || post_id || '“ ', post_id || ',' || (post_id + 1), post_id % 10, '-') AS row FROM raw_kept_posts
        UNION ALL SELECT 'comment', concat_ws('|', ts_ms, comment_id, person_id, '-', 'Chrome', 'ja: ''né'' "x" \\ ' || comment_id,
            coalesce(CAST(reply_to_post AS VARCHAR), '-'), coalesce(CAST(reply_to_comment AS VARCHAR), '-'), 7) FROM raw_kept
        UNION ALL SELECT 'like', concat_ws('|', ts_ms, person_id, post_id) FROM raw_likes_seen WHERE reason IS NULL
        UNION ALL SELECT 'member', concat_ws('|', forum_id, person_id, '2010-03-11T08:00:00Z') FROM member
        UNION ALL SELECT 'moderator', concat_ws('|', forum_id, person_id) FROM moderator
        UNION ALL SELECT 'person', concat_ws('|', person_id, 'Zoë ' || person_id, 'Müller', 'x', birth_year || '-04-01', '-', browser,
            birth_year) FROM person
        UNION ALL SELECT 'interest', concat_ws('|', person_id, tag) FROM interest
        UNION ALL SELECT 'language', concat_ws('|', person_id, language) FROM lang
        UNION ALL SELECT 'knows', concat_ws('|', a, b) FROM knows
        UNION ALL SELECT 'reject', concat_ws('|', 'post', post_id, 'order_broken') FROM raw_posts_seen WHERE ts_ms < latest
        UNION ALL SELECT 'reject', concat_ws('|', 'like', person_id || ':' || post_id || ':' || ts_ms, reason) FROM raw_likes_seen
            WHERE reason IS NOT NULL
        UNION ALL SELECT 'reject', concat_ws('|', 'comment', comment_id, CASE WHEN reply_to_post IS NULL THEN 'missing_parent'
            WHEN post_ms IS NULL THEN 'missing_post' ELSE 'post_after_child' END) FROM raw_comments_in
            WHERE comment_id NOT IN (SELECT comment_id FROM raw_kept)""",
    "aff_top5_many": """SELECT window_end_ms, selected_id, rank, candidate_id, CAST(score AS DOUBLE) AS score FROM m_top""",
    "word_counts": """SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(t) AS word FROM doc_tokens)
        GROUP BY ALL""",
    "feat_post_uniq": _features("f0"),
    "feat_post_bad": _features("f1"),
    "feat_comment_uniq": _features("f2"),
    "feat_comment_bad": _features("f3"),
    "feat_comment_vocab": _features("f4"),
    "feat_like_spread": _features("a_f5"),
    "feature_long": _features("long"),
    "feature_daily": "SELECT feature_id, day_ms, person_id, round(value, 6) AS value FROM daily",
    "feature_stats": """SELECT feature_id, day_ms, n_people, round(mean, 6) AS mean, round(sd, 6) AS sd FROM stats""",
    "outliers_on_update": _on_update(3),
    "outliers_on_update_2s": _on_update(2),
    "outliers_daily": _at_midnight(3),
    "outliers_daily_2s": _at_midnight(2),
    "encode_outliers": "SELECT '(' || concat_ws(',', day_ms, person_id, feature_id, "
    "CAST(value AS DECIMAL(20,6)), CAST(mean AS DECIMAL(20,6))) || ')' AS value FROM (" + _at_midnight(2) + ")",
    "stream_sliding_counts": f"""SELECT window_end_ms, post_id, count(*) AS n FROM (
        SELECT (ts_ms // {HOUR_MS} + {ENDS}) * {HOUR_MS} AS window_end_ms, post_id FROM likes)
        WHERE window_end_ms <= (SELECT max(ts_ms) FROM likes) - 3000000 - 2 * {HOUR_MS} GROUP BY ALL""",
    "stream_post_activity": """SELECT as_of_ms, post_id, metric, n FROM activity WHERE as_of_ms <=
        (SELECT least((SELECT max(ts_ms) FROM comments), (SELECT max(ts_ms) FROM likes)) - 3000000)""",
    "stream_suggestions": "SELECT window_end_ms, CAST(selected_id AS BIGINT) AS selected_id, " + ", ".join(
        f"max(CASE WHEN rank = {i} THEN candidate_id END) AS c{i}" for i in range(1, 6)
    ) + """ FROM top5 WHERE window_end_ms <= (SELECT least((SELECT max(ts_ms) FROM comments), (SELECT max(ts_ms) FROM likes),
        (SELECT max(ts_ms) FROM raw_posts)) - 3000000) GROUP BY ALL""",
    "stream_outliers_daily": """SELECT day_ms, person_id, feature_id, round(value, 6) AS value, round(mean, 6) AS mean
        FROM s_daily JOIN s_stats USING (feature_id, day_ms) WHERE abs(value - mean) > 2 * sd AND abs(value - mean) > 1e-12 * abs(mean)""",
    "stream_late": """SELECT kind, CAST(count(*) AS BIGINT) AS n_sent, count(*) FILTER (NOT broken AND NOT late) AS n_kept,
            count(*) FILTER (NOT broken AND late) AS n_late, count(*) FILTER (broken) AS n_rejected
        FROM (SELECT m.kind, m.broken, coalesce(m.ts_ms < w.passed, false) AS late
              FROM sent_at m LEFT JOIN passed_at w ON w.step = m.step) GROUP BY kind""",
    "stream_resolve_replies": "SELECT comment_id, post_id, depth FROM resolved",
    "stream_completeness": """SELECT count(*) AS n_sent, count(*) FILTER (ts_ms % 97 <> 0) AS n_kept,
        count(*) FILTER (ts_ms % 97 = 0) AS n_rejected FROM likes""",
    "aff_static_features": "SELECT selected_id, candidate_id, feature, amount FROM static_features",
    "aff_static_total": "SELECT selected_id, candidate_id, CAST(score AS DOUBLE) AS score FROM static_total",
    "aff_colike": _co("likedTheSame"),
    "aff_coforum": _co("postedSameForum"),
    "aff_copost": _co("commentedSamePost"),
    "aff_cocomment": _co("commentedSameComment"),
    "aff_active": "SELECT window_end_ms, candidate_id, amount FROM aff_active",
    "aff_author_active": "SELECT window_end_ms, candidate_id, amount FROM aff_author",
    "aff_window_scores": """SELECT window_end_ms, CAST(selected_id AS BIGINT) AS selected_id, candidate_id,
        CAST(score AS DOUBLE) AS score FROM scored""",
    "aff_candidates": """SELECT window_end_ms, CAST(selected_id AS BIGINT) AS selected_id, candidate_id,
        CAST(score AS DOUBLE) AS score FROM cand""",
    "aff_top5": """SELECT window_end_ms, CAST(selected_id AS BIGINT) AS selected_id, rank, candidate_id,
        CAST(score AS DOUBLE) AS score FROM top5""",
    "aff_top5_wide": "SELECT window_end_ms, CAST(selected_id AS BIGINT) AS selected_id, " + ", ".join(
        f"max(CASE WHEN rank = {i} THEN candidate_id END) AS c{i}" for i in range(1, 6)
    ) + " FROM top5 GROUP BY ALL",
    "encode_suggestions": "SELECT '(' || concat_ws(',', window_end_ms, selected_id, " + ", ".join(
        f"coalesce(CAST(max(CASE WHEN rank = {i} THEN candidate_id END) AS VARCHAR), '')" for i in range(1, 6)
    ) + ") || ')' AS value FROM top5 GROUP BY window_end_ms, selected_id",
}
# Topics of which some events come days late, in four equal spans of arrival.
PARTS["sent_raw"] = """SELECT kind, ts_ms, ts_ms % 97 = 0 AS broken,
        ts_ms + (300 + id * 7919 % 2700) * 1000 + CASE WHEN id % 50 = 0 THEN 172800000 ELSE 0 END AS arrival_ms
    FROM (SELECT 'post' AS kind, post_id AS id, ts_ms FROM raw_posts UNION ALL SELECT 'like', like_id, ts_ms FROM likes
          UNION ALL SELECT 'comment', comment_id, ts_ms FROM comments)"""
PARTS["sent_at"] = """SELECT *, (arrival_ms - (SELECT min(arrival_ms) FROM sent_raw))
        // ((SELECT max(arrival_ms) - min(arrival_ms) FROM sent_raw) // 4 + 1) AS step FROM sent_raw"""
PARTS["newest_at"] = """SELECT s.step, m.kind, max(m.ts_ms) AS newest FROM (SELECT unnest([1, 2, 3]) AS step) s
    JOIN sent_at m ON m.step < s.step AND NOT m.broken GROUP BY ALL"""
PARTS["passed_at"] = """SELECT step, min(newest) - 3000000 AS passed FROM newest_at GROUP BY step HAVING count(*) = 3"""
# Texts spread over a month; a like counts for an author from the time at which like and post are there.
_SPREAD = f"{START_MS} + {{0}} * 7919 % 43200 * 60000"
PARTS["s_posts"] = f"""SELECT CAST(doc_id AS VARCHAR) AS event_id, doc_id, doc_id % 50 AS person_id,
    {_SPREAD.format("doc_id")} AS ts_ms, t FROM doc_tokens"""
PARTS["s_comments"] = f"""SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS event_id, conv_id % 50 AS person_id,
    {_SPREAD.format("(conv_id * 1000 + turn)")} AS ts_ms, t FROM turn_tokens"""
PARTS["s_likes"] = """SELECT CAST(person_id AS VARCHAR) || ':' || post_id || ':' || ts_ms AS event_id, person_id, post_id, ts_ms
    FROM (SELECT person_id % 50 AS person_id, post_id, ts_ms FROM likes)"""
PARTS["s_liked"] = """SELECT l.event_id, l.person_id, greatest(l.ts_ms, p.ts_ms) AS ts_ms, p.person_id AS author
    FROM s_likes l JOIN s_posts p ON p.doc_id = l.post_id"""
for _side, _first in (("post", 0), ("comment", 2)):
    PARTS[f"sm_{_side}s"] = f"SELECT *, {_UNIQ} AS uniq, {_HAS} AS has, {_BAD} AS bad FROM s_{_side}s"
    _ratio_feature(f"sf{_first}", f"sm_{_side}s", _first, "uniq", "has")
    _ratio_feature(f"sf{_first + 1}", f"sm_{_side}s", _first + 1, "bad", "1")
PARTS["s_vocab"] = """SELECT event_id, count(*) AS new FROM (
        SELECT w.*, row_number() OVER (PARTITION BY person_id, word ORDER BY ts_ms, event_id) AS nth
        FROM (SELECT person_id, event_id, ts_ms, unnest(t) AS word FROM s_comments) w) WHERE nth = 1 GROUP BY event_id"""
PARTS["sm_vocab"] = """SELECT c.person_id, c.event_id, c.ts_ms, CAST(coalesce(new, 0) AS DOUBLE) AS new
        FROM s_comments c LEFT JOIN s_vocab USING (event_id)"""
_ratio_feature("sf4", "sm_vocab", 4, "new", "1")
PARTS["sm_likes"] = """SELECT person_id, ts_ms, event_id, CAST(sum(num) AS DOUBLE) AS num, sum(den) AS den FROM (
        SELECT person_id, ts_ms, event_id, 0 AS num, 1 AS den FROM s_likes
        UNION ALL SELECT person_id, (min((ts_ms, event_id)))[1], (min((ts_ms, event_id)))[2], 1, 0 FROM s_liked GROUP BY person_id, author)
    GROUP BY ALL"""
_ratio_feature("sf5", "sm_likes", 5, "num", "den")
PARTS["s_long"] = " UNION ALL ".join(f"SELECT * FROM sf{i}" for i in range(6))
PARTS["s_valued"] = "SELECT * FROM s_long WHERE value IS NOT NULL"
PARTS["s_closed"] = f"""SELECT (least((SELECT max(ts_ms) FROM s_posts), (SELECT max(ts_ms) FROM s_comments),
    (SELECT max(ts_ms) FROM s_likes)) - 3000000) // {DAY_MS} * {DAY_MS} AS closed_ms"""
PARTS["s_days"] = f"""SELECT feature_id, unnest(range((min(ts_ms) // {DAY_MS} + 1) * {DAY_MS}, (SELECT closed_ms FROM s_closed) + 1, {DAY_MS})) AS day_ms
    FROM s_valued GROUP BY feature_id"""
PARTS["s_daily"] = """SELECT d.feature_id, d.day_ms, v.person_id, arg_max(v.value, (v.ts_ms, v.event_id)) AS value
    FROM s_days d JOIN s_valued v ON v.feature_id = d.feature_id AND v.ts_ms < d.day_ms GROUP BY ALL"""
PARTS["s_stats"] = """SELECT feature_id, day_ms, count(*) AS n_people, avg(value) AS mean, stddev_pop(value) AS sd FROM s_daily GROUP BY ALL"""
PARTS["bench_tokens"] = PARTS["doc_tokens"].replace("doc_id, ", "").replace("FROM doc_body", """FROM
    (SELECT text, rtrim(text, E' \\t\\n\\x0B\\f\\r') AS body FROM benchmark)""")
# Raw files keep whole seconds of posts and comments.
PARTS["raw_posts_at"] = """SELECT post_id, person_id, ts_ms // 1000 * 1000 AS ts_ms,
    ts_ms + (300 + post_id * 7919 % 2700) * 1000 AS arrival_ms FROM posts"""
PARTS["raw_posts_seen"] = """SELECT *, max(ts_ms) OVER (ORDER BY arrival_ms, post_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM raw_posts_at"""
PARTS["raw_kept_posts"] = "SELECT * FROM raw_posts_seen WHERE latest IS NULL OR ts_ms >= latest"
PARTS["raw_likes_in"] = """SELECT l.*, ts_ms + (300 + like_id * 7919 % 2700) * 1000 AS arrival_ms,
    (SELECT p.ts_ms FROM raw_kept_posts p WHERE p.post_id = l.post_id) AS post_ms FROM likes l"""
PARTS["raw_likes_seen"] = """SELECT *, CASE WHEN ts_ms < latest THEN 'order_broken' WHEN post_ms IS NULL THEN 'missing_post'
        WHEN post_ms >= ts_ms THEN 'post_after_child' END AS reason
    FROM (SELECT *, max(CASE WHEN post_ms < ts_ms THEN ts_ms END) OVER (ORDER BY arrival_ms, like_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM raw_likes_in)"""
PARTS["raw_comments_in"] = """SELECT c.comment_id, c.person_id, ts_ms // 1000 * 1000 AS ts_ms, reply_to_post, reply_to_comment,
    ts_ms + (300 + comment_id * 7919 % 2700) * 1000 AS arrival_ms,
    (SELECT p.ts_ms FROM raw_kept_posts p WHERE p.post_id = c.reply_to_post) AS post_ms FROM comments c"""
PARTS["raw_kept"] = """SELECT comment_id, person_id, ts_ms, reply_to_post, reply_to_comment, arrival_ms FROM raw_comments_in
        WHERE reply_to_post IS NOT NULL AND post_ms < ts_ms
    UNION ALL
    SELECT c.comment_id, c.person_id, c.ts_ms, c.reply_to_post, c.reply_to_comment, c.arrival_ms
    FROM raw_comments_in c JOIN raw_kept k ON c.reply_to_comment = k.comment_id
    WHERE c.reply_to_post IS NULL
      AND (k.arrival_ms < c.arrival_ms OR (k.arrival_ms = c.arrival_ms AND k.comment_id < c.comment_id))"""
# Suggestions for a market segment, with ids that are texts, over windows of a day.
PARTS["m_sel"] = "SELECT person_id AS s FROM person WHERE browser = 'BUILDING'"
PARTS["m_units"] = """SELECT a.person_id AS s, b.person_id AS c, 'sameForumMember' AS feature FROM member a
        JOIN m_sel ON a.person_id = s JOIN member b USING (forum_id)
    UNION ALL SELECT a.person_id, b.person_id, 'sameForumModerator' FROM (SELECT DISTINCT * FROM moderator) a
        JOIN m_sel ON a.person_id = s JOIN moderator b USING (forum_id)
    UNION ALL SELECT a.person_id, b.person_id, 'sameForumMemberModerator' FROM (SELECT DISTINCT * FROM moderator) a
        JOIN m_sel ON a.person_id = s JOIN member b USING (forum_id)
    UNION ALL SELECT a.person_id, b.person_id, 'sameForumMemberModerator' FROM member a
        JOIN m_sel ON a.person_id = s JOIN moderator b USING (forum_id)
    UNION ALL SELECT a.person_id, b.person_id, 'sameAge' FROM person a JOIN m_sel ON a.person_id = s
        JOIN person b ON abs(a.birth_year - b.birth_year) <= 5
    UNION ALL SELECT a.person_id, b.person_id, 'sameBrowser' FROM person a JOIN m_sel ON a.person_id = s JOIN person b ON a.browser = b.browser
    UNION ALL SELECT a.person_id, b.person_id, 'sameInterestTag' FROM interest a JOIN m_sel ON a.person_id = s JOIN interest b USING (tag)
    UNION ALL SELECT a.person_id, b.person_id, 'sameLanguage' FROM (SELECT DISTINCT * FROM lang) a
        JOIN m_sel ON a.person_id = s JOIN lang b USING (language)"""
PARTS["m_static"] = """SELECT s, c, sum(n * weight) AS score FROM (SELECT s, c, feature, count(*) AS n FROM m_units GROUP BY ALL)
    JOIN weights USING (feature) GROUP BY ALL"""
PARTS["m_acts"] = f"""SELECT feature, p, target, (ts_ms // {DAY_MS} + 1) * {DAY_MS} AS window_end_ms FROM (
    SELECT feature, p, target, ts_ms FROM acts WHERE feature <> 'commentedSameComment')"""
PARTS["m_co"] = """SELECT a.window_end_ms, b.s, a.p AS c, sum(weight) AS score FROM m_acts a
    JOIN (SELECT DISTINCT feature, p AS s, target, window_end_ms FROM m_acts WHERE p IN (SELECT s FROM m_sel)) b
        USING (feature, target, window_end_ms) JOIN weights USING (feature) WHERE a.p <> b.s GROUP BY ALL"""
PARTS["m_own"] = f"""SELECT window_end_ms, p AS c, max(active) + sum(post) * any_value(author) AS base FROM (
        SELECT (ts_ms // {DAY_MS} + 1) * {DAY_MS} AS window_end_ms, user_id AS p, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS post,
            (SELECT weight FROM weights WHERE feature = 'active') AS active, (SELECT weight FROM weights WHERE feature = 'authorActive') AS author
        FROM ev WHERE event_type IN ('signup', 'click', 'purchase')) GROUP BY ALL"""
PARTS["m_scored"] = """SELECT window_end_ms, s, c, sum(score) AS score, bool_or(acted) AS acted FROM (
        SELECT window_end_ms, s, c, base AS score, true AS acted FROM m_own, m_sel
        UNION ALL SELECT window_end_ms, s, c, score, true FROM m_co
        UNION ALL SELECT window_end_ms, s, c, score, false FROM m_static, (SELECT DISTINCT window_end_ms FROM m_own)) GROUP BY ALL"""
PARTS["m_top"] = """SELECT window_end_ms, 'p' || s AS selected_id, rank, 'p' || c AS candidate_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY window_end_ms, s ORDER BY score DESC, 'p' || c) AS rank FROM m_scored x
    WHERE s <> c AND NOT EXISTS (SELECT 1 FROM friend f WHERE f.s = x.s AND f.c = x.c)) WHERE rank <= 5"""
PARTS["unit_counts"] = """SELECT post_id, metric, ts_ms, max(n) AS n FROM (SELECT post_id, metric, ts_ms, count(*) OVER
        (PARTITION BY post_id, metric ORDER BY ts_ms) AS n FROM units) GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in BODIES.items()}
