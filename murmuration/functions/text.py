"""Measures of a text."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuration.runtime import dealt

# The white space characters that separate words.
SPACES = " \t\n\x0b\f\r"


def tokens(text: Column) -> Column:
    """Words split at each single white space character.

    Leading and inner empty words count, trailing ones do not; a text of white space only
    has no words, the empty text has one empty word.
    """
    body = F.rtrim(text, F.lit(SPACES))
    return F.when((body == "") & (text != ""), F.array().cast("array<string>")).otherwise(
        F.split(body, r"[ \t\n\x0B\f\r]")
    )


def uniq_ratio_of(words: Column) -> Column:
    """Distinct words over words; null if there are none."""
    return F.size(F.array_distinct(words)) / F.nullif(F.size(words), F.lit(0))


def bad_words_of(words: Column, lexicon: Collection[str]) -> Column:
    """Number of words that, in lower case, are in the lexicon (looked up in a hash set)."""
    listed = sorted({w.lower() for w in lexicon})
    return F.size(F.filter(words, lambda w: F.lower(w).isin(listed))).cast("long")


def uniq_ratio(text: Column) -> Column:
    return uniq_ratio_of(tokens(text))


def bad_words(text: Column, lexicon: Collection[str]) -> Column:
    return bad_words_of(tokens(text), lexicon)


def bad_word_counts(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame) -> DataFrame:
    """(id, n_bad) by a table of words (``word``), of any size; a text without bad words has 0.

    A text's words are counted before they meet the lexicon, so a frequent word is one row a text;
    Spark sends the smaller side to the other or shuffles both, by their size.
    """
    listed = lexicon.select(F.lower("word").alias("word")).distinct()
    lowered = df.select(id_col, F.transform(tokens(F.col(text_col)), F.lower).alias("_words"))
    counted = lowered.select(id_col, F.explode("_words").alias("word")).groupBy(id_col, "word").agg(F.count("*").alias("n_bad"))
    none = df.select(id_col, F.lit(0).cast("long").alias("n_bad"))
    return counted.join(listed, "word", "left_semi").select(id_col, "n_bad").unionByName(none).groupBy(id_col).agg(
        F.sum("n_bad").alias("n_bad"))


def word_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, word, n) for each distinct word of each text.

    Texts are shuffled whole, and their words counted in place: a row for each word of each text would
    repeat its id and be several times as long.
    """
    # A word and the space behind it have some six characters.
    n_words = df.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0))).first()[0] // 6
    return (
        dealt(df.select(id_col, text_col), n_words, id_col).select(id_col, F.explode(tokens(F.col(text_col))).alias("word"))
        .groupBy(id_col, "word")
        .agg(F.count("*").alias("n"))
    )


def parse_tags(text: Column) -> Column:
    """Numbers in a tag text such as ``[1, 2]``, as an array of strings."""
    return F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))
