"""The nine pipe-separated input files, their cleaned forms, lexicon and settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration.functions.text import parse_tags

ORDER_COLUMNS = ["_file", "_block", "_row"]


@dataclass(frozen=True)
class InputFile:
    path: str
    columns: tuple[str, ...]
    encoding: str = "UTF-8"
    time_format: str | None = None

    @property
    def is_stream(self) -> bool:
        return self.time_format is not None


# Place, columns in file order, and encoding of each input file.
INPUTS = {
    "post": InputFile(
        "streams/post_event_stream.csv",
        ("post_id", "person_id", "creation_date", "image_file", "location_ip", "browser",
         "language", "content", "tags", "forum_id", "place_id"),
        time_format="seconds",
    ),
    "comment": InputFile(
        "streams/comment_event_stream.csv",
        ("comment_id", "person_id", "creation_date", "location_ip", "browser", "content",
         "reply_to_post", "reply_to_comment", "place_id"),
        time_format="seconds",
    ),
    "like": InputFile(
        "streams/likes_event_stream.csv", ("person_id", "post_id", "creation_date"), time_format="millis"
    ),
    "member": InputFile("tables/forum_hasMember_person.csv", ("forum_id", "person_id", "join_date")),
    "moderator": InputFile("tables/forum_hasModerator_person.csv", ("forum_id", "person_id")),
    "person": InputFile(
        "tables/person.csv",
        ("person_id", "first_name", "last_name", "gender", "birthday", "creation_date",
         "location_ip", "browser"),
        encoding="ISO-8859-1",
    ),
    "interest": InputFile("tables/person_hasInterest_tag.csv", ("person_id", "tag"), encoding="ISO-8859-1"),
    "language": InputFile("tables/person_speaks_language.csv", ("person_id", "language"), encoding="ISO-8859-1"),
    "knows": InputFile("tables/person_knows_person.csv", ("person1_id", "person2_id"), encoding="ISO-8859-1"),
}
STREAMS = tuple(name for name, spec in INPUTS.items() if spec.is_stream)


def _strings(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _csv(spark: SparkSession, encoding: str, header: bool):
    """Pipe-separated, no quoting and no escapes; columns are bound by position."""
    return (
        spark.read.option("sep", "|").option("quote", "").option("escape", "")
        .option("encoding", encoding).option("header", header).option("enforceSchema", "true")
    )


# Header names of the input files where they differ from the columns' own; friendships
# name both columns alike.
HEADERS = {
    "like": ("Person.id", "Post.id", "creationDate"), "member": ("Forum.id", "Person.id", "joinDate"),
    "moderator": ("Forum.id", "Person.id"), "interest": ("Person.id", "Tag.id"), "language": ("Person.id", "language"),
    "knows": ("Person.id", "Person.id"),
}


def raw_lines(df: DataFrame, table: str) -> DataFrame:
    """The lines of a table in the layout of the raw input; the column's name is the header. Fields are
    written as they are; a text with ``|`` or line ends cannot be told apart and is refused."""
    spec = INPUTS[table]
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spec.columns])
    # Numbers hold no separator; all texts of a row are searched at once.
    texts = [F.col(c) for c in spec.columns if not isinstance(df.schema[c].dataType, T.NumericType)]
    unfit = F.concat_ws("", *[t.cast("string") for t in texts]).rlike(r"[|\n\r]") if texts else F.lit(False)
    checked = F.when(unfit, F.raise_error(F.concat(F.lit("field with a separator in "), line)).cast("string")).otherwise(line)
    # One text column whose name is the header line: a CSV header may name two columns alike.
    header = "|".join(HEADERS.get(table, spec.columns))
    return df.select(checked.alias(header))


def write_raw(df: DataFrame, out_dir: str, table: str) -> None:
    """Write a table in the layout of the raw input: header, ``|`` between fields, the file's encoding.

    Rows of ``df`` lie in the files in its order, so sort it first where that matters.
    """
    spec = INPUTS[table]
    raw_lines(df, table).write.option("header", "true").option("sep", "\x01").option("quote", "").option("escape", "") \
        .option("emptyValue", "").option("encoding", spec.encoding).option("ignoreLeadingWhiteSpace", "false") \
        .option("ignoreTrailingWhiteSpace", "false").csv(f"{out_dir}/{spec.path}")


def read_raw(spark: SparkSession, in_dir: str, table: str, file_order: bool = False) -> DataFrame:
    """A raw input file; empty fields become null.

    ``file_order`` adds columns that sort rows as they lie in the file, also when Spark
    reads it in several splits.
    """
    spec = INPUTS[table]
    rows = _csv(spark, spec.encoding, True).schema(_strings(spec.columns)).csv(f"{in_dir}/{spec.path}")
    if not file_order:
        return rows
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def clean_columns(table: str) -> list[str]:
    spec = INPUTS[table]
    return (["ts_ms"] if spec.is_stream else []) + list(spec.columns)


def clean_table(df: DataFrame, table: str) -> DataFrame:
    """A static table as it is, in column order."""
    return df.select(*clean_columns(table))


def write_clean(df: DataFrame, out_dir: str, table: str, fmt: str = "parquet") -> None:
    """Write a cleaned table: Parquet, or CSV like the input (streams without header).

    Existing output is an error, so a rerun cannot wipe tables somebody else uses.
    """
    rows = df.select(*clean_columns(table))
    path = f"{out_dir}/{table}"
    if fmt == "csv":
        rows.write.option("sep", "|").option("quote", "").option("escape", "").option("emptyValue", "").csv(
            path, header=not INPUTS[table].is_stream
        )
    else:
        rows.write.format(fmt).save(path)


def read_clean(spark: SparkSession, clean_dir: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A cleaned table with typed event time and tags, and an id for each like."""
    columns = clean_columns(table)
    schema = _strings(columns)
    if INPUTS[table].is_stream:
        schema["ts_ms"].dataType = T.LongType()
    path = f"{clean_dir}/{table}"
    if fmt == "csv":
        rows = _csv(spark, "UTF-8", not INPUTS[table].is_stream).schema(schema).csv(path)
    else:
        rows = spark.read.format(fmt).schema(schema).load(path)
    if table == "post":
        return rows.withColumn("tags", parse_tags(F.col("tags")))
    if table == "like":
        return with_like_id(rows)
    return rows


def with_like_id(likes: DataFrame) -> DataFrame:
    """Likes carry no id of their own; person, post and time make one."""
    return likes.withColumn("like_id", F.concat_ws(":", "person_id", "post_id", "ts_ms"))


def lexicon_table(spark: SparkSession, path: str, key: str = "BAD_WORDS") -> DataFrame:
    """The words of such a file as a table (word), for lexicons of any size."""
    words = spark.read.option("multiLine", "true").schema(f"{key} array<string>").json(path)
    return words.select(F.explode(key).alias("word")).select(F.lower("word").alias("word")).distinct()


def read_lexicon(spark: SparkSession, path: str, key: str = "BAD_WORDS") -> list[str]:
    """Word list from a JSON file ``{"BAD_WORDS": [...]}``, lower-cased, without repeats.

    The list is a setting that goes into expressions, so it is brought to the driver.
    """
    return sorted(r.word for r in lexicon_table(spark, path, key).collect())


def read_properties(path: str) -> dict[str, str]:
    """Key-value lines of a properties file."""
    with open(path, encoding="utf-8") as lines:
        pairs = (line.split("=", 1) for line in lines if "=" in line and not line.lstrip().startswith("#"))
        return {k.strip(): v.strip() for k, v in pairs}
