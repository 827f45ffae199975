"""Licence scan by ordered signature rules, with DataFrame functions alone.

A document is looked at only if its text holds one of a few gate words; a rule is tried
only if its own keyword is among the words. A detection inside another one of equal or
better priority is suppressed (equal intervals: the rule that comes first stays).

Defined cases: a null text is an empty one, a null id stays null, repeated rows are
documents of their own, an empty table gives an empty result, other columns are ignored.
Labels are sorted and comma-joined, empty where nothing is found.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from murmuration.llm.common import ascii_lower
from murmuration.llm.license_rules import Rule, build_rules
from murmuration.runtime import materialize

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases whose places are reported exactly. Fixed values.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Confidence of a detection by its priority.
CONFIDENCE = {0: 0.99, 1: 0.9, 2: 0.4}


def _branches(keywords: set[tuple[str, ...]], between: str, longest: bool) -> str:
    """A pattern of keywords that share their first words, so that each word is compared once.

    A keyword may end within a word; of those that begin at a place it finds the longest one, or
    any if ``longest`` is not asked for.
    """
    by_word: dict[str, set[tuple[str, ...]]] = {}
    for first, *rest in keywords:
        by_word.setdefault(first, set()).add(tuple(rest))
    by_letter: dict[str, list[str]] = {}
    for word in sorted(by_word, key=lambda w: (-len(w), w)):
        rest = by_word[word] - {()}
        ends = () in by_word[word]
        tail = f"{between}{_branches(rest, between, longest)}" if rest and (longest or not ends) else ""
        by_letter.setdefault(word[0], []).append(word[1:] + (f"(?:{tail})?" if tail and ends else tail))
    return f"(?:{'|'.join(first + (rest[0] if len(rest) == 1 else f'(?:{'|'.join(rest)})') for first, rest in by_letter.items())})"


def _keywords(rules: list[Rule]) -> list[str]:
    return sorted({r.keyword for r in rules})


def gate_pattern(rules: list[Rule]) -> str:
    """Finds in raw text the start of any rule's keyword or of a phrase's first two words."""
    between = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    wanted = {tuple(k.split()) for k in _keywords(rules)} | {tuple(p.split()[:2]) for p in PHRASES}
    return rf"(?i)(?<![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]){_branches(wanted, between, False)}"


def keywords_in(words: Column, rules: list[Rule]) -> Column:
    """The keywords in a text's words, found in one pass: the longest at each place, and its beginnings."""
    known = _keywords(rules)
    pattern = rf"(?<= )(?=({_branches({tuple(k.split()) for k in known}, ' ', True)}))"
    held = {k: [x for x in known if k.startswith(x)] for k in known}
    with_beginnings = F.from_json(F.lit(json.dumps(held)), "map<string, array<string>>")
    found = F.array_distinct(F.regexp_extract_all(words, F.lit(pattern), F.lit(1)))
    return F.array_distinct(F.flatten(F.transform(found, lambda k: F.element_at(with_beginnings, k))))


def words_of(text: Column) -> Column:
    """The words in lower case, each with a space before and behind."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(text), _SEPARATORS, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _join(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def detect(texts: DataFrame, rules: list[Rule]) -> DataFrame:
    """row, label, priority, begin, end: all places of all rules in ``texts`` (row, words),
    in characters of the words."""
    # One literal, parsed once when the plan is made.
    table = F.from_json(F.lit(json.dumps([
        {"rank": i, "label": r.label, "priority": r.priority, "keyword": r.keyword, "pattern": r.pattern}
        for i, r in enumerate(rules)])), "array<struct<rank: int, label: string, priority: int, keyword: string, pattern: string>>")
    keyed = texts.withColumn("keywords", keywords_in(F.col("words"), rules)).where(F.size("keywords") > 0)
    tried = keyed.select("row", "words", F.explode(
        F.filter(table, lambda r: F.array_contains("keywords", r["keyword"]))).alias("rule")) \
        .where(F.rlike("words", F.col("rule.pattern")))
    # What lies between the matches, and the matches, give their places.
    parts = tried.select(
        "row", "rule.rank", "rule.label", "rule.priority",
        F.transform(F.split("words", F.col("rule.pattern"), -1), F.char_length).alias("gaps"),
        F.transform(F.regexp_extract_all("words", F.col("rule.pattern"), F.lit(0)), F.char_length).alias("sizes"),
    ).where(F.size("sizes") > 0)
    one = parts.select("row", "rank", "label", "priority", F.posexplode(F.arrays_zip("gaps", "sizes")).alias("number", "part"))
    so_far = Window.partitionBy("row", "rank").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.col("part.sizes").cast("long")
    end = F.sum(F.col("part.gaps") + F.coalesce(size, F.lit(0).cast("long"))).over(so_far)
    return one.select("row", "rank", "label", "priority", (end - size).alias("begin"), end.alias("end")) \
        .where(F.col("begin").isNotNull())


def unsuppressed(found: DataFrame) -> DataFrame:
    """Detections that lie in no other of equal or better priority."""
    before = Window.partitionBy("row").orderBy("begin", F.desc("end"), "priority", "rank") \
        .rowsBetween(Window.unboundedPreceding, -1)
    reach = F.lit(None).cast("long")
    for priority in sorted(CONFIDENCE, reverse=True):
        furthest = F.max(F.when(F.col("priority") <= priority, F.col("end"))).over(before)
        reach = F.when(F.col("priority") == priority, furthest).otherwise(reach)
    return found.withColumn("reach", reach).where(F.col("reach").isNull() | (F.col("reach") < F.col("end"))).drop("reach")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rules = build_rules() if rules is None else rules
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # The texts are read once: what is written has the words of those that pass the gate.
    gate = F.rlike("text", F.lit(gate_pattern(rules)))
    read = materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.regexp_count("text", F.lit(_WORD)).cast("long").alias("n_words"),
        F.when(gate, words_of(F.col("text"))).alias("words")), "gated")
    nothing = read.where("words is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"),
        F.lit(None).cast("long").alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"),
        F.lit(0.0).alias("score"))
    gated = read.where("words is not null")
    kept = unsuppressed(detect(gated.select("row", "words"), rules)).groupBy("row").agg(
        F.collect_set("label").alias("found"), F.min("priority").alias("best"))
    phrase = F.lit(f"(?<= )(?:{'|'.join(PHRASES)})(?= )")
    label = F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in pair])
    based = gated.select(
        "row", "doc_id", "n_words", F.split("words", phrase, -1).alias("gaps"),
        F.regexp_extract_all("words", phrase, F.lit(0)).alias("places")).select(
        "row", "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.when(F.size("places") > 0, _spaces(F.get("gaps", F.lit(0))) - 1).alias("first_word"),
        F.when(F.size("places") > 0, F.col("n_words") - (_spaces(F.element_at("gaps", -1)) - 1)
               - (_spaces(F.get("places", F.size("places") - 1)) + 1)).alias("last_word"),
        F.transform("places", lambda p: label[p]).alias("base"))
    sure = F.element_at(F.create_map(*[F.lit(x) for pair in CONFIDENCE.items() for x in pair]), F.col("best"))
    found = based.join(kept, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", _join(F.col("base")).alias("base_labels"),
        _join(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce(F.greatest(sure, F.when(F.size("base") > 0, 0.95)), F.lit(0.0)).alias("score"))
    return nothing.unionByName(found)
