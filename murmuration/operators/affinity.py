"""Friend suggestions: static similarity, windowed co-activity, scores, ranking.

The people to suggest for are a table ``selected`` (selected_id), of any number, or the tuple
``Params.selected``. One side of every co-occurrence join belongs to selected people,
so results grow with rows times selected people, never with pairs of people. Ids are numbers or texts;
ties go to the smaller number, and to texts behind numbers.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuration.functions.timing import floor_to, window_ends
from murmuration.params import Params
from murmuration.runtime import dealt, materialize

# Scores are whole numbers of 1/10,000 point, so sums and ties are exact and cheap.
UNITS = 10_000

POST, LIKE, COMMENT, REPLY = "post", "like", "comment", "reply"

# What a shared target of each kind of activity counts as.
SHARED_FEATURES = {
    LIKE: "likedTheSame",
    POST: "postedSameForum",
    COMMENT: "commentedSamePost",
    REPLY: "commentedSameComment",
}


def chosen(like: DataFrame, p: Params, selected: DataFrame | None) -> DataFrame:
    """(selected_id): the people to suggest for, each once."""
    if selected is not None:
        return selected.select("selected_id").distinct()
    # A literal table, so Spark knows how small it is.
    ids = F.array(*[F.lit(s if isinstance(s, str) else int(s)) for s in p.selected])
    return like.sparkSession.range(1).select(F.explode(F.array_distinct(ids)).alias("selected_id")).select(
        F.col("selected_id") if any(isinstance(s, str) for s in p.selected) else F.col("selected_id").cast("long").alias("selected_id"))


def _of(people: DataFrame, df: DataFrame, column: str = "person_id") -> DataFrame:
    """Rows of selected people: Spark sends the selected ones to the rows if they are few."""
    return df.join(people.withColumnRenamed("selected_id", column), column, "left_semi")


def id_order(column: str) -> list[Column]:
    """Numbers by size, then texts."""
    return [F.col(column).try_cast("long").asc_nulls_last(), F.col(column)]


def weight_of(weights: dict[str, Decimal], feature: Column) -> Column:
    """Weight of a feature name in score units; an unknown name is an error, not a silent zero."""
    (first, weight), *rest = ((name, int(w * UNITS)) for name, w in weights.items())
    chosen = F.when(feature == first, F.lit(weight).cast("long"))
    for name, weight in rest:
        chosen = chosen.when(feature == name, F.lit(weight).cast("long"))
    return chosen.otherwise(F.raise_error(F.concat(F.lit("no weight for feature "), feature)).cast("long"))


def as_points(df: DataFrame) -> DataFrame:
    """``score`` in points, from score units."""
    return df.withColumn("score", F.col("score") / F.lit(float(UNITS)))


def static_units(
    person: DataFrame, member: DataFrame, moderator: DataFrame,
    interest: DataFrame, language: DataFrame, p: Params = Params(), selected: DataFrame | None = None,
) -> DataFrame:
    """(selected_id, candidate_id, feature, amount) of shared attributes, dealt by candidate; not
    yet summed up over all tables.

    What the selected people have (their forums, tags, languages, browser, years) is
    collected first into one small table whose size Spark then knows. Each big table is
    scanned once and joined with it by equality; the age band becomes an equality too, as
    the selected side lists all years of its band.
    """
    people = chosen(person, p, selected)

    def traits(df: DataFrame, kind: str, key: Column) -> DataFrame:
        return _of(people, df).select(
            F.lit(kind).alias("kind"), F.col("person_id").alias("selected_id"),
            key.cast("string").alias("key"),
        )

    band = F.explode(F.sequence(
        F.col("birth_year") - F.lit(p.age_range), F.col("birth_year") + F.lit(p.age_range)
    ))
    has = materialize(
        reduce(DataFrame.unionByName, [
            traits(member, "member", F.col("forum_id")),
            traits(moderator, "moderator", F.col("forum_id")),
            traits(interest, "tag", F.col("tag")),
            traits(language, "language", F.col("language")),
            traits(person, "browser", F.col("browser")),
            traits(person.withColumn("year", band), "year", F.col("year")),
        ]).distinct(),
        "selected-traits",
    )

    # A selected person shares something with nearly everyone: some units of each feature and pair.
    n_pairs = person.count() * people.count()

    def shared(df: DataFrame, key: str, features: dict[str, str], many: bool = False) -> DataFrame:
        """One unit per row of ``df`` that shares a trait with a selected person. Where a person has ``many``
        rows, these are brought together first, so that their units are counted in place."""
        mine = has.filter(F.col("kind").isin(list(features)))
        feature = F.coalesce(*[F.when(F.col("kind") == k, f) for k, f in features.items()])
        rows = df.select(F.col("person_id").alias("candidate_id"), F.col(key).cast("string").alias("key"))
        units = (dealt(rows, n_pairs, "candidate_id") if many else rows).join(mine, "key").select(
            "selected_id", "candidate_id", feature.alias("feature"))
        one = F.lit(1).cast("long").alias("amount")
        return units.groupBy(*units.columns).agg(F.sum(one).alias("amount")) if many else units.select("*", one)

    units = reduce(DataFrame.unionByName, [
        shared(member, "forum_id", {"member": "sameForumMember", "moderator": "sameForumMemberModerator"}, many=True),
        shared(moderator, "forum_id", {"moderator": "sameForumModerator", "member": "sameForumMemberModerator"}),
        shared(person, "birth_year", {"year": "sameAge"}),
        shared(person, "browser", {"browser": "sameBrowser"}),
        shared(interest, "tag", {"tag": "sameInterestTag"}, many=True),
        shared(language, "language", {"language": "sameLanguage"}),
    ])
    return dealt(units, 4 * n_pairs, "candidate_id")


def static_features(units: DataFrame) -> DataFrame:
    """(selected_id, candidate_id, feature, amount): shared attributes counted."""
    return units.groupBy("selected_id", "candidate_id", "feature").agg(F.sum("amount").alias("amount"))


def static_total(features: DataFrame, p: Params = Params()) -> DataFrame:
    """(selected_id, candidate_id, score): weighted sum of static features or their units.

    Summing the units directly saves the shuffle that counts them per feature.
    """
    return features.groupBy("selected_id", "candidate_id").agg(
        F.sum(F.col("amount") * weight_of(p.weights, F.col("feature"))).alias("score")
    )


def activity_rows(posts: DataFrame, likes: DataFrame, comments: DataFrame, *extra: str) -> DataFrame:
    """(kind, person_id, target, ts_ms) of everything people do, and the ``extra`` columns.

    The target is what people can have in common: the forum of a post, the liked or
    commented post, the comment replied to; null if there is none.
    """
    def rows(df: DataFrame, kind: Column, target: Column) -> DataFrame:
        return df.select(kind.alias("kind"), "person_id", target.cast("string").alias("target"), "ts_ms", *extra)

    direct = F.col("reply_to_comment").isNull()
    return (
        rows(posts, F.lit(POST), F.col("forum_id"))
        .unionByName(rows(likes, F.lit(LIKE), F.col("post_id")))
        .unionByName(rows(
            comments, F.when(direct, COMMENT).otherwise(REPLY),
            F.when(direct, F.col("reply_to_post").cast("string")).otherwise(F.col("reply_to_comment").cast("string")),
        ))
    )


def _keep_n(df: DataFrame, *cols) -> DataFrame:
    return df.select(*cols, *(["n"] if "n" in df.columns else []))


def _slices(df: DataFrame, keys: list[str], p: Params) -> DataFrame:
    """Row counts per slide of time. A column ``n`` says how many rows a row stands for."""
    rows = F.sum("n") if "n" in df.columns else F.count("*")
    return df.groupBy(floor_to(F.col("ts_ms"), p.slide_ms).alias("slice_ms"), *keys).agg(rows.alias("n"))


def _windows(slices: DataFrame, keys: list[str], p: Params) -> DataFrame:
    """Row counts per sliding window: only counts are spread over the windows, not rows."""
    return slices.select(
        F.explode(window_ends(F.col("slice_ms"), p.window_ms, p.slide_ms)).alias("window_end_ms"), *keys, "n",
    ).groupBy("window_end_ms", *keys).agg(F.sum("n").alias("n"))


def _shared(rows: DataFrame, target: list[str], p: Params, selected: DataFrame | None = None) -> DataFrame:
    """(window_end_ms, selected_id, candidate_id, amount) and all but the last of ``target``.

    Only targets that a selected person ever touches can count, so all other rows are
    dropped before anything is aggregated.
    """
    narrow = _keep_n(rows.filter(F.col(target[-1]).isNotNull()), *target, "person_id", "ts_ms")
    keys = [*target, "person_id"]
    mine = _of(chosen(rows, p, selected), narrow)
    near = _slices(narrow.join(mine.select(*target).distinct(), target, "left_semi"), keys, p)
    theirs = _windows(near, keys, p).withColumnRenamed("person_id", "candidate_id")
    ours = _windows(_slices(mine, keys, p), keys, p).select(
        "window_end_ms", *target, F.col("person_id").alias("selected_id")
    )
    group = ["window_end_ms", "selected_id", "candidate_id", *target[:-1]]
    return (
        theirs.join(ours, ["window_end_ms", *target])
        .filter("candidate_id <> selected_id")
        .groupBy(*group)
        .agg(F.sum("n").alias("amount"))
    )


def co_activity(rows: DataFrame, target: str, p: Params = Params(), selected: DataFrame | None = None) -> DataFrame:
    """(window_end_ms, selected_id, candidate_id, amount): rows of a candidate on targets
    that a selected person also has a row on in the same window."""
    return _shared(rows, [target], p, selected)


def shared_features(rows: DataFrame, p: Params = Params(), selected: DataFrame | None = None) -> DataFrame:
    """Co-activity of every kind at once: (window_end_ms, selected_id, candidate_id, feature, amount)."""
    kind = F.col("kind")
    feature = F.coalesce(*[F.when(kind == k, name) for k, name in SHARED_FEATURES.items()])
    return _shared(rows, ["kind", "target"], p, selected).withColumn("feature", feature).drop("kind")


def active_people(events: DataFrame, p: Params = Params()) -> DataFrame:
    """(window_end_ms, candidate_id, amount = 1) for people with any event in the window."""
    slices = _slices(_keep_n(events, "person_id", "ts_ms"), ["person_id"], p)
    return _windows(slices, ["person_id"], p).select(
        "window_end_ms", F.col("person_id").alias("candidate_id"), F.lit(1).cast("long").alias("amount")
    )


def author_activity(posts: DataFrame, p: Params = Params()) -> DataFrame:
    """(window_end_ms, candidate_id, amount): posts written in the window."""
    slices = _slices(_keep_n(posts, "person_id", "ts_ms"), ["person_id"], p)
    return _windows(slices, ["person_id"], p).select(
        "window_end_ms", F.col("person_id").alias("candidate_id"), F.col("n").alias("amount")
    )


def own_features(rows: DataFrame, p: Params = Params()) -> DataFrame:
    """Both at once: (window_end_ms, candidate_id, feature, amount)."""
    n = F.col("n") if "n" in rows.columns else F.lit(1)
    posts = rows.select("person_id", "ts_ms", F.when(F.col("kind") == POST, n).otherwise(0).cast("long").alias("n"))
    counts = _windows(_slices(posts, ["person_id"], p), ["person_id"], p)
    feature = F.explode(F.array(
        F.struct(F.lit("active").alias("feature"), F.lit(1).cast("long").alias("amount")),
        F.struct(F.lit("authorActive").alias("feature"), F.col("n").alias("amount")),
    ))
    return counts.select("window_end_ms", F.col("person_id").alias("candidate_id"), feature.alias("f")).select(
        "window_end_ms", "candidate_id", "f.*"
    )


def _windowed_again(features: DataFrame, keys: list[str], p: Params) -> DataFrame:
    """Weighted window results summed over sliding windows of their window ends."""
    ends = F.array(*[
        F.col("window_end_ms") + F.lit(i * p.slide_ms) for i in range(p.window_ms // p.slide_ms)
    ])
    weighted = F.col("amount") * weight_of(p.weights, F.col("feature"))
    return features.select(F.explode(ends).alias("window_end_ms"), *keys, weighted.alias("score")).groupBy(
        "window_end_ms", *keys
    ).agg(F.sum("score").alias("score"))


def candidate_scores(own: DataFrame, shared: DataFrame, p: Params = Params()) -> DataFrame:
    """(window_end_ms, candidate_id, base, co) after windowing the window results again.

    ``own`` features do not depend on the selected person and make up ``base``; ``shared``
    ones do and go to the map ``co`` from selected person to score. One row per window and
    candidate, instead of one per selected person too, keeps the later joins small.
    """
    base = _windowed_again(own, ["candidate_id"], p).withColumnRenamed("score", "base")
    # At most one entry per selected person goes into each map.
    co = _windowed_again(shared, ["candidate_id", "selected_id"], p).groupBy(
        "window_end_ms", "candidate_id"
    ).agg(F.map_from_entries(F.collect_list(F.struct("selected_id", "score"))).alias("co"))
    return base.join(co, ["window_end_ms", "candidate_id"], "full_outer").select(
        "window_end_ms", "candidate_id", F.coalesce("base", F.lit(0).cast("long")).alias("base"), "co"
    )


def activity_scores(rows: DataFrame, p: Params = Params(), selected: DataFrame | None = None) -> DataFrame:
    """``candidate_scores`` of activity rows.

    All features come from the same counts per slide of time, made and written once.
    """
    slices = materialize(
        _slices(rows, ["kind", "target", "person_id"], p).withColumnRenamed("slice_ms", "ts_ms"), "activity-slices"
    )
    return candidate_scores(own_features(slices, p), shared_features(slices, p, selected), p)


def static_by_candidate(static: DataFrame) -> DataFrame:
    """(candidate_id, static): map from selected person to static score."""
    return static.groupBy("candidate_id").agg(
        F.map_from_entries(F.collect_list(F.struct("selected_id", "score"))).alias("static")
    )


def _spread(rows: DataFrame, people: DataFrame) -> DataFrame:
    """One row per selected person, with the score for that person."""
    zero = F.lit(0).cast("long")

    def entry(name: str) -> Column:
        return F.coalesce(F.try_element_at(F.col(name), F.col("selected_id")), zero)

    # Every candidate has a score for every selected person: one array of them, made once.
    everyone = people.agg(F.collect_list("selected_id")).scalar()
    return rows.select("*", F.explode(everyone).alias("selected_id")).withColumn(
        "score", F.col("base") + entry("co") + entry("static")
    )


def window_scores(candidates: DataFrame, static: DataFrame, p: Params = Params(), selected: DataFrame | None = None) -> DataFrame:
    """(window_end_ms, selected_id, candidate_id, score) of candidates with window activity."""
    rows = candidates.join(static_by_candidate(static), "candidate_id", "left")
    return _spread(rows, chosen(rows, p, selected)).select("window_end_ms", "selected_id", "candidate_id", "score")


def friends_of_selected(knows: DataFrame, p: Params = Params(), selected: DataFrame | None = None) -> DataFrame:
    """(candidate_id, friend_of): for each person, the selected people they are friends with."""
    pair = F.explode(F.array(
        F.struct(F.col("person1_id").alias("s"), F.col("person2_id").alias("c")),
        F.struct(F.col("person2_id").alias("s"), F.col("person1_id").alias("c")),
    ))
    pairs = knows.select(pair.alias("e")).select("e.s", F.col("e.c").alias("candidate_id"))
    return _of(chosen(knows, p, selected), pairs, "s").groupBy("candidate_id").agg(F.collect_set("s").alias("friend_of"))


def _eligible() -> Column:
    """Neither the selected person nor one of that person's friends."""
    known = F.coalesce(F.array_contains("friend_of", F.col("selected_id")), F.lit(False))
    return (F.col("candidate_id") != F.col("selected_id")) & ~known


def suggestion_candidates(
    candidates: DataFrame, static: DataFrame, knows: DataFrame, p: Params = Params(), selected: DataFrame | None = None
) -> DataFrame:
    """Window scores without the selected people themselves and their friends."""
    rows = candidates.join(static_by_candidate(static), "candidate_id", "left").join(
        friends_of_selected(knows, p, selected), "candidate_id", "left"
    )
    return _spread(rows, chosen(rows, p, selected)).filter(_eligible()).select(
        "window_end_ms", "selected_id", "candidate_id", "score"
    )


class StaticSide(NamedTuple):
    """What ``suggest`` needs of static scores and friends: ``by_candidate`` (candidate_id, static, friend_of), and ``top``
    (candidate_id), the best ``top_k`` of each selected person, both written out. It serves any number of windows."""

    by_candidate: DataFrame
    top: DataFrame


def static_side(static: DataFrame, knows: DataFrame, p: Params = Params(), selected: DataFrame | None = None) -> StaticSide:
    by_candidate = materialize(
        static_by_candidate(static).join(friends_of_selected(knows, p, selected), "candidate_id", "full_outer"),
        "static-scores",
    )
    best = Window.partitionBy("selected_id").orderBy(F.desc("score"), *id_order("candidate_id"))
    top = (
        by_candidate.select("candidate_id", "friend_of", F.explode("static").alias("selected_id", "score"))
        .filter(_eligible())
        .withColumn("r", F.row_number().over(best))
        .filter(F.col("r") <= p.top_k)
        .select("candidate_id")
        .distinct()
    )
    return StaticSide(by_candidate, materialize(top, "static-top"))


def suggest(
    candidates: DataFrame, static: DataFrame, knows: DataFrame, p: Params = Params(), selected: DataFrame | None = None
) -> DataFrame:
    """(window_end_ms, selected_id, rank, candidate_id, score): the best ``top_k``."""
    return suggest_beside(candidates, static_side(static, knows, p, selected), p, selected)


def suggest_beside(candidates: DataFrame, side: StaticSide, p: Params = Params(), selected: DataFrame | None = None) -> DataFrame:
    """``suggest`` with a static side that is made already.

    Anyone with a window or a static score qualifies in every window, but without window
    activity only a selected person's static top k can reach a rank: any other such person
    has k people with at least the same score in front, under the same tie rule, since
    weights are not negative. So only those are added to each window.
    """
    by_candidate, static_top = side
    acting = materialize(candidates, "window-scores")

    # static_top has at most top_k people per selected person, all in one short array.
    quiet = acting.select("window_end_ms").distinct().select(
        "window_end_ms",
        F.explode(static_top.agg(F.collect_list("candidate_id")).scalar()).alias("candidate_id"),
    ).join(
        acting.join(static_top, "candidate_id", "left_semi"),
        ["window_end_ms", "candidate_id"], "left_anti",
    )
    rows = acting.withColumn("acted", F.lit(True)).unionByName(
        quiet.withColumn("base", F.lit(0).cast("long")).withColumn("acted", F.lit(False)),
        allowMissingColumns=True,
    )
    people = chosen(rows, p, selected)
    # Ranking sorts one row per selected person of each of these.
    rows = dealt(rows, 2 * acting.count() * people.count(), "candidate_id").join(by_candidate, "candidate_id", "left")
    qualifies = F.col("acted") | F.coalesce(F.map_contains_key("static", F.col("selected_id")), F.lit(False))
    person = Window.partitionBy("window_end_ms", "selected_id").orderBy(F.desc("score"), *id_order("candidate_id"))
    return (
        _spread(rows, people)
        .filter(_eligible() & qualifies)
        .select("window_end_ms", "selected_id", "candidate_id", "score")
        .withColumn("rank", F.row_number().over(person))
        .filter(F.col("rank") <= p.top_k)
        .select("window_end_ms", "selected_id", F.col("rank").cast("long").alias("rank"), "candidate_id", "score")
    )


def suggest_wide(suggestions: DataFrame, p: Params = Params()) -> DataFrame:
    """(window_end_ms, selected_id, c1..ck): names only, null where there are fewer."""
    return suggestions.groupBy("window_end_ms", "selected_id").agg(
        *[F.max(F.when(F.col("rank") == i, F.col("candidate_id"))).alias(f"c{i}") for i in range(1, p.top_k + 1)]
    )
