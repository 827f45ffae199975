"""Social tables derived from the star-schema test tables.

Ids stay numeric here so that the same arithmetic runs in any SQL engine.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.functions.timing import epoch_ms
from murmuration.operators.quality import with_arrival
from murmuration.operators.scan import prefix_scan
from murmuration.params import DAY_MS, MINUTE_MS, Params
from murmuration.runtime import dealt, materialize

# People for whom suggestions are made on the test tables.
SELECTED = tuple(range(10))

# Word list used on the test texts, which hold no profanity.
LEXICON = ("the", "of", "by", "la", "de")

# Epoch milliseconds of 2024-01-01.
START_MS = 19_723 * DAY_MS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class EngagementTables:
    """Posts, likes and comments from ``events``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.raw = table(spark, sf_dir, "events")

    def events(self, *kinds: str) -> DataFrame:
        """Events of the given types with target ``k`` and epoch-ms time."""
        rows = self.raw.filter(F.col("event_type").isin(*kinds)) if kinds else self.raw
        return rows.select(
            "event_id", "user_id", "event_type",
            epoch_ms(rows, "ts").alias("ts_ms"),
            F.regexp_extract("props", "[0-9]+", 0).cast("long").alias("k"),
        )

    def raw_posts(self) -> DataFrame:
        return self.events("signup").select(
            F.col("event_id").alias("post_id"), F.col("user_id").alias("person_id"), "ts_ms",
            (F.col("k") % 10).alias("forum_id"), "k",
        )

    def posts(self) -> DataFrame:
        first = F.min_by(F.struct("user_id", "ts_ms"), "event_id")
        return self.events("signup").groupBy("k").agg(first.alias("p")).select(
            F.col("k").alias("post_id"), F.col("p.user_id").alias("person_id"), "p.ts_ms"
        )

    def likes(self) -> DataFrame:
        return self.events("click").select(
            F.col("event_id").alias("like_id"), F.col("user_id").alias("person_id"),
            F.col("k").alias("post_id"), "ts_ms",
        )

    def direct_comments(self) -> DataFrame:
        return self.events("purchase").select(
            F.col("event_id").alias("comment_id"), F.col("user_id").alias("person_id"), "ts_ms",
            F.col("k").alias("reply_to_post"), F.lit(None).cast("long").alias("reply_to_comment"),
        )

    def comments(self) -> DataFrame:
        """Purchases are direct comments. A view replies to the purchase or view of the
        same ``k`` that lies 1 to 3 places back, or to nothing (-1).

        Places are numbered by a prefix scan and looked up by an equi-join, so a popular
        ``k`` is spread like any other.
        """
        placed = prefix_scan(
            self.events("purchase", "view").withColumn("_one", F.lit(1).cast("long")),
            keys=["k"], order=["event_id"], sums={"place": "_one"},
        )
        direct = placed.filter("event_type = 'purchase'").select(
            F.col("event_id").alias("comment_id"), F.col("user_id").alias("person_id"), "ts_ms",
            F.col("k").alias("reply_to_post"), F.lit(None).cast("long").alias("reply_to_comment"),
        )
        replies = placed.filter("event_type = 'view'").withColumn(
            "back_to", F.col("place") - 1 - F.col("event_id") % 3
        )
        earlier = placed.select("k", F.col("place").alias("back_to"), F.col("event_id").alias("parent"))
        return direct.unionByName(
            replies.join(earlier, ["k", "back_to"], "left").select(
                F.col("event_id").alias("comment_id"), F.col("user_id").alias("person_id"), "ts_ms",
                F.lit(None).cast("long").alias("reply_to_post"),
                F.coalesce("parent", F.lit(-1)).alias("reply_to_comment"),
            )
        )


class TextTables:
    """Posts from ``documents`` and comments from ``conversations``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.documents = table(spark, sf_dir, "documents")
        self.turns = table(spark, sf_dir, "conversations")

    def posts(self) -> DataFrame:
        return self.documents.select(
            F.col("doc_id").alias("post_id"), (F.col("doc_id") % 50).alias("person_id"),
            (F.lit(START_MS) + F.col("doc_id") * (10 * MINUTE_MS)).alias("ts_ms"),
            F.col("text").alias("content"), F.col("lang").alias("language"),
        )

    def comments(self) -> DataFrame:
        comment_id = F.col("conv_id") * 1000 + F.col("turn")
        return self.turns.select(
            comment_id.alias("comment_id"), (F.col("conv_id") % 50).alias("person_id"),
            (F.lit(START_MS) + F.col("conv_id") * (30 * MINUTE_MS) + F.col("turn") * MINUTE_MS).alias("ts_ms"),
            F.col("text").alias("content"),
            F.when(F.col("turn") == 0, F.col("conv_id")).alias("reply_to_post"),
            F.when(F.col("turn") != 0, comment_id - 1).alias("reply_to_comment"),
        )


class PeopleTables:
    """People, forums, interests, languages and friendships from the star schema."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.read = lambda name: table(spark, sf_dir, name)

    def _n_people(self):
        return self.read("customer").agg(F.count("*")).scalar()

    @functools.cached_property
    def _n_lines(self) -> int:
        return self.read("lineitem").count()

    @functools.cached_property
    def _bought(self) -> DataFrame:
        """(person_id, forum_id, listed, tag) of each line, joined and written once; ``listed``: its part is known."""
        def by(name: str, key: str, *columns: str) -> DataFrame:
            return dealt(self.read(name).select(key, *columns), self._n_lines, key)

        lines = by("lineitem", "l_orderkey", "l_suppkey", "l_partkey").join(
            by("orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        part = self.read("part").select("p_partkey", "p_brand")
        return materialize(lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").select(
            F.col("o_custkey").alias("person_id"), F.col("l_suppkey").alias("forum_id"),
            F.col("p_partkey").isNotNull().alias("listed"), F.col("p_brand").alias("tag")), "bought")

    def person(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("person_id"), F.col("c_mktsegment").alias("browser"),
            (F.lit(1940) + (F.col("c_custkey") * 7919) % 60).cast("int").alias("birth_year"),
        )

    def member(self) -> DataFrame:
        return dealt(self._bought.select("forum_id", "person_id"), self._n_lines, "forum_id", "person_id").distinct()

    def moderator(self) -> DataFrame:
        supplier = self.read("supplier").select(F.col("s_suppkey").alias("forum_id"))
        return supplier.select(
            "forum_id",
            F.explode(F.array((F.col("forum_id") * 13) % self._n_people(), F.col("forum_id") % 10)).alias("person_id"),
        )

    def interest(self) -> DataFrame:
        return dealt(self._bought.filter("listed").select("person_id", "tag"), self._n_lines, "person_id", "tag").distinct()

    def language(self) -> DataFrame:
        nation = self.read("nation")
        region = self.read("region")
        names = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("c_nationkey"), F.explode(F.array("n_name", "r_name")).alias("language")
        )
        return self.read("customer").select("c_custkey", "c_nationkey").join(names, "c_nationkey").select(
            F.col("c_custkey").alias("person_id"), "language"
        )

    def knows(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("person1_id"),
            ((F.col("c_custkey") * 17 + 3) % self._n_people()).alias("person2_id"),
        ).filter("person1_id <> person2_id")


def raw_inputs(a: EngagementTables, c: PeopleTables) -> dict[str, DataFrame]:
    """The tables under the columns of the nine raw files; streams lie in the order of their arrival."""
    def arriving(df: DataFrame, id_col: str, fmt: str) -> DataFrame:
        at = F.date_format(F.timestamp_millis("ts_ms"), fmt)
        rows = with_arrival(df, id_col, Params().min_delay_s, Params().max_delay_s).withColumn("creation_date", at)
        return rows.orderBy("arrival_ms", id_col)

    second, milli = "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    none = F.lit(None).cast("string")
    k = F.col("post_id")
    posts = arriving(a.posts(), "post_id", second).withColumns({
        "image_file": none, "location_ip": F.concat(F.lit("10.0.0."), k), "browser": F.lit("Firefox"), "language": F.lit("fr"),
        "content": F.concat(F.lit("  Où ça? „"), k, F.lit("“ ")), "tags": F.concat(F.lit("["), k, F.lit(", "), k + 1, F.lit("]")),
        "forum_id": k % 10, "place_id": none})
    comments = arriving(a.comments(), "comment_id", second).withColumns({
        "location_ip": none, "browser": F.lit("Chrome"), "place_id": F.lit("7"),
        "content": F.concat(F.lit("ja: 'né' \"x\" \\ "), F.col("comment_id"))})
    joined = F.lit("2010-03-11T08:00:00Z")
    person = c.person().withColumns({
        "first_name": F.concat(F.lit("Zoë "), F.col("person_id")), "last_name": F.lit("Müller"), "gender": F.lit("x"),
        "birthday": F.concat("birth_year", F.lit("-04-01")), "creation_date": joined, "location_ip": none})
    return {
        "post": posts, "comment": comments, "like": arriving(a.likes(), "like_id", milli),
        "member": c.member().withColumn("join_date", joined), "moderator": c.moderator(), "person": person,
        "interest": c.interest(), "language": c.language(), "knows": c.knows(),
    }
