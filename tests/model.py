"""Row-by-row models of the operators, to check the distributed ones against."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from datetime import datetime, timezone

TICK, ACTIVE, DAY = 30 * 60_000, 12 * 3_600_000, 24 * 3_600_000


def iso(ms: int, millis: bool = False) -> str:
    text = datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    return f"{text}.{ms % 1000:03d}Z" if millis else f"{text}Z"


def clean(posts, likes, comments):
    """The three streams in file order -> kept ids and reject reasons."""
    reasons, post_ms, latest = [], {}, -1
    for p in posts:
        if p["ts_ms"] is None:
            reasons.append(("post", p["post_id"], "bad_time"))
        elif p["ts_ms"] < latest:
            reasons.append(("post", p["post_id"], "order_broken"))
        else:
            latest = post_ms[p["post_id"]] = p["ts_ms"]
    kept_likes, latest = [], -1
    for x in likes:
        at = post_ms.get(x["post_id"])
        if x["ts_ms"] < latest:
            reason = "order_broken"
        elif at is None:
            reason = "missing_post"
        elif at >= x["ts_ms"]:
            reason = "post_after_child"
        else:
            latest = x["ts_ms"]
            kept_likes.append(x["like_id"])
            continue
        reasons.append(("like", x["like_id"], reason))
    kept_comments = []
    for c in comments:
        if c["reply_to_post"] is not None:
            at = post_ms.get(c["reply_to_post"])
            reason = "missing_post" if at is None else "post_after_child" if at >= c["ts_ms"] else None
        else:
            reason = None if c["reply_to_comment"] in kept_comments else "missing_parent"
        if reason:
            reasons.append(("comment", c["comment_id"], reason))
        else:
            kept_comments.append(c["comment_id"])
    return set(post_ms), kept_likes, kept_comments, sorted(reasons)


def resolve(comments):
    """comment_id -> (post_id, depth), walking parents one by one."""
    by_id, out = {c["comment_id"]: c for c in comments}, {}
    for c in comments:
        at, depth, seen = c, 0, set()
        while at is not None and at["reply_to_post"] is None and at["comment_id"] not in seen:
            seen.add(at["comment_id"])
            at, depth = by_id.get(at["reply_to_comment"]), depth + 1
        if at is not None and at["reply_to_post"] is not None:
            out[c["comment_id"]] = (at["reply_to_post"], depth)
    return out


def activity(events):
    """events (post_id, kind, person_id, ts_ms) -> {(as_of, post, metric): n}."""
    out, last_tick = {}, max(e[3] for e in events) // TICK * TICK
    by_post = defaultdict(list)
    for e in events:
        by_post[e[0]].append(e)
    for post, rows in by_post.items():
        tick = (min(e[3] for e in rows) // TICK + 1) * TICK
        while tick <= last_tick:
            past = [e for e in rows if e[3] < tick]
            if max(e[3] for e in past) > tick - ACTIVE:
                out[tick, post, "comment"] = sum(e[1] == 1 for e in past)
                out[tick, post, "reply"] = sum(e[1] in (0, 1) for e in past)
                out[tick, post, "userEngagement"] = len({e[2] for e in past})
            tick += TICK
    return out


def words(text: str) -> list[str]:
    parts = re.split(r"[ \t\n\x0b\f\r]", text)
    if text == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def features(posts, comments, likes, lexicon):
    """{(feature, event_id): value}: posts/comments (person, id, ts, text), likes (person, id, ts, author)."""
    out = {}
    for rows, uniq_id, bad_id in ((posts, 0, 1), (comments, 2, 3)):
        ratios, bad, n = defaultdict(list), defaultdict(int), defaultdict(int)
        for person, eid, _, text in sorted(rows, key=lambda r: (r[2], r[1])):
            w = words(text)
            if w:
                ratios[person].append(len(set(w)) / len(w))
            bad[person] += sum(x.lower() in lexicon for x in w)
            n[person] += 1
            out[uniq_id, eid] = math.fsum(ratios[person]) / len(ratios[person]) if ratios[person] else None
            out[bad_id, eid] = bad[person] / n[person]
    vocab, n = defaultdict(set), defaultdict(int)
    for person, eid, _, text in sorted(comments, key=lambda r: (r[2], r[1])):
        vocab[person] |= set(words(text))
        n[person] += 1
        out[4, eid] = len(vocab[person]) / n[person]
    authors, n = defaultdict(set), defaultdict(int)
    for person, eid, _, author in sorted(likes, key=lambda r: (r[2], r[1])):
        if author is not None:
            authors[person].add(author)
        n[person] += 1
        out[5, eid] = len(authors[person]) / n[person]
    return out


def outliers(values, n_sigma):
    """values (person, feature, id, ts, value) -> ids flagged on update, and (day, person, feature) at midnights."""
    on_update, daily = set(), set()
    for feature in {v[1] for v in values}:
        rows = sorted((v for v in values if v[1] == feature and v[4] is not None), key=lambda v: (v[3], v[2]))
        day, end = (rows[0][3] // DAY + 1) * DAY, (rows[-1][3] // DAY + 1) * DAY
        while day <= end:
            latest = {v[0]: v[4] for v in rows if v[3] < day}
            mean = sum(latest.values()) / len(latest)
            sd = math.sqrt(sum((x - mean) ** 2 for x in latest.values()) / len(latest))
            daily |= {(day, p, feature) for p, x in latest.items() if abs(x - mean) > n_sigma * sd}
            on_update |= {(v[2], feature) for v in rows if day <= v[3] < day + DAY and abs(v[4] - mean) > n_sigma * sd}
            day += DAY
    return on_update, daily


def social_rows(seed: int = 7, n: int = 300, hot: float = 0.4):
    """Random posts, likes and comments in file order; one post and one person are hot."""
    rng, start = random.Random(seed), 1_328_000_000_000
    people = [str(i) for i in range(12)]

    def person():
        return "0" if rng.random() < hot else rng.choice(people)

    def when(i):
        return (start + i * 900_000 + rng.randint(-4_000_000, 4_000_000)) // 1000 * 1000

    posts = [
        {"post_id": str(i), "person_id": person(), "ts_ms": when(i * 5), "forum_id": str(rng.randint(0, 3))}
        for i in range(n // 5)
    ]

    def post():
        return "3" if rng.random() < hot else str(rng.randint(0, n // 5 + 3))

    likes = []
    for i in range(n):
        row = {"person_id": person(), "post_id": post(), "ts_ms": when(i)}
        likes.append(row | {"like_id": f"{row['person_id']}:{row['post_id']}:{row['ts_ms']}"})
    comments = []
    for i in range(n):
        row = {"comment_id": str(i), "person_id": person(), "ts_ms": when(i), "reply_to_post": None, "reply_to_comment": None}
        if rng.random() < 0.4:
            row["reply_to_post"] = post()
        else:
            back = rng.randint(-2, 6)
            row["reply_to_comment"] = "5" if rng.random() < 0.2 else str(i - back)
        comments.append(row)
    return posts, likes, comments
