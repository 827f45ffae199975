"""Quality of texts by weak supervision: rules vote or abstain, and none decides alone.

Each rule looks at one measure of a text and votes to keep it, to drop it, or abstains between its
two bounds. What the votes are worth is learnt without labels: expectation-maximisation of a model
with a hidden verdict, in which every rule has its own shares of votes among good and among bad
texts. The posterior probability that a text is good replaces the demand that it passes all rules.

Texts are read once and become measures and a string of votes. The learning sees how often each
string of votes occurs, at most 3 to the number of rules; a round is one aggregate over that table,
and some sixty numbers go to the driver. All of it is DataFrame functions.

Defined cases: a null text has no words; a text without words fails the base rules; rows are
independent, so repeated rows get equal rows and null ids stay; an empty table gives an empty
result; other columns are ignored. Arrays of a text's words are made within its row, so a text may
be as long as a row's arrays (some 100 million words).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuration.runtime import materialize

# White space and symbols of the base measures, and the marks that end a sentence.
SPACE, SYMBOLS, ENDINGS = " \t\n\x0b\f\r", "#*$%&|<>", ".!?"
CLOSING = "\"')]»”"
WORD = r"[^\x20\x09-\x0D]+"
# Runs of what prose is made of: letters, digits, white space and common marks.
PROSE = r"[\p{L}\p{M}\p{Nd}\x20\x09-\x0D.,;:!?'\"()\-’“”„«»¿¡]+"
# Frequent words of English, German, French and Spanish.
STOP_WORDS = ("the of and to in is that it for was on with as are be "
              "der die das und ist nicht ein eine zu den von mit "
              "le la les et des est une dans que pour du "
              "el los las y en por con una es").split()
GOOD, BAD, NONE = "+", "-", "0"


@dataclass(frozen=True)
class Rule:
    """Votes on ``measure``: bad outside ``allowed``, good inside ``fine``, nothing between them
    or where the measure is null."""

    measure: str
    allowed: tuple[float | None, float | None]
    fine: tuple[float | None, float | None]

    def vote(self) -> Column:
        def inside(bounds: tuple[float | None, float | None]) -> Column:
            low, high = bounds
            m = F.col(self.measure)
            tests = [m >= low] if low is not None else []
            return reduce(Column.__and__, tests + ([m <= high] if high is not None else []), m.isNotNull())
        return F.when(F.col(self.measure).isNull(), NONE).when(~inside(self.allowed), BAD).when(inside(self.fine), GOOD).otherwise(NONE)


#: Bounds as commonly published for web text; the inner ones leave room for abstaining.
RULES = (
    Rule("n_words", (50, 100_000), (100, 50_000)),
    Rule("word_length", (3, 12), (4, 9)),
    Rule("symbols_per_word", (None, 0.1), (None, 0.02)),
    Rule("letter_share", (0.6, None), (0.85, None)),
    Rule("odd_share", (None, 0.1), (None, 0.03)),
    Rule("upper_share", (None, 0.4), (None, 0.15)),
    Rule("dup_line_share", (None, 0.3), (None, 0.05)),
    Rule("repeat_share", (None, 0.3), (None, 0.1)),
    Rule("unique_share", (0.1, None), (0.3, None)),
    Rule("ended_line_share", (0.1, None), (0.5, None)),
    Rule("sentence_length", (2, 100), (4, 50)),
    Rule("stop_share", (0.0, None), (0.06, None)),
)


@dataclass(frozen=True)
class Model:
    """Share of good texts; for each rule the shares of its votes among good and among bad texts."""

    good: float
    votes: tuple[tuple[dict[str, float], dict[str, float]], ...]

    def accuracies(self) -> list[float]:
        """Share of right votes among each rule's votes."""
        found = []
        for good, bad in self.votes:
            right = self.good * good[GOOD] + (1 - self.good) * bad[BAD]
            wrong = self.good * good[BAD] + (1 - self.good) * bad[GOOD]
            found.append(right / (right + wrong))
        return found

    def posterior(self, pattern: Column) -> Column:
        """Probability that a text with these votes is good."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for j, (good, bad) in enumerate(self.votes):
            cast = F.substring(pattern, j + 1, 1)
            part = {v: math.log(good[v] / bad[v]) for v in (GOOD, BAD, NONE)}
            odds = odds + F.when(cast == GOOD, part[GOOD]).when(cast == BAD, part[BAD]).otherwise(part[NONE])
        return 1 / (1 + F.exp(-odds))


#: What is believed before a text is seen; it counts as much as ``PRIOR_WEIGHT`` of all texts.
PRIOR = Model(0.8, ((({GOOD: 0.75, BAD: 0.02, NONE: 0.23}), {GOOD: 0.4, BAD: 0.3, NONE: 0.3}),) * len(RULES))
PRIOR_WEIGHT = 0.02
ROUNDS, CLOSE = 40, 1e-6


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def base_measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the sums that the rules need."""
    t = F.col("t")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    split = rows.select(
        "doc_id", F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("w"), F.char_length(_without(t, SPACE)).alias("word_chars"),
        (F.char_length(t) - F.char_length(_without(t, SYMBOLS))).alias("n_symbols"),
        F.filter(F.split(t, "\n"), lambda line: F.char_length(_without(line, SPACE)) > 0).alias("lines"),
        F.char_length(F.regexp_replace(t, r"\P{L}+", "")).alias("letters"),
        F.char_length(F.regexp_replace(t, r"\P{Lu}+", "")).alias("uppers"),
        (F.char_length(t) - F.char_length(_without(t, ENDINGS))).alias("n_endings"),
        F.char_length(F.regexp_replace(t, PROSE, "")).alias("n_odd"))
    w, n = F.col("w"), F.size("w")
    windows = F.transform(F.slice(w, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    counted = split.select(
        "doc_id", n.alias("n_words"), "word_chars", "n_symbols", "letters", "uppers", "n_endings", "n_odd",
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.filter("lines", lambda line: F.substring(F.rtrim(line, F.lit(SPACE + CLOSING)), -1, 1).isin(list(ENDINGS)))).alias("n_ended"),
        F.size(F.array_distinct(w)).alias("n_unique"), F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stop"),
        windows.alias("h"))
    # Windows of three words as (hash, place), equal ones side by side; most texts have no equal ones.
    paired = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    counted = counted.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), paired).otherwise(F.array().cast("array<struct<h: bigint, i: int>>"))).drop("h")
    s = F.col("s")
    repeated = F.filter(s, lambda x, i: (F.get(s, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"])))
    placed = counted.withColumn("at", F.sort_array(F.transform(repeated, lambda x: x["i"]))).drop("s")
    at = F.col("at")
    new = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1), p + 3) - p))
    return placed.withColumn("n_repeat_words", F.aggregate(new, F.lit(0), lambda a, b: a + b)).drop("at")


def votes(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measured`` with the derived measures and ``votes``, one character for each rule."""
    def share(a: str, b: str) -> Column:
        return F.col(a) / F.nullif(F.col(b), F.lit(0))

    derived = measured.withColumns({
        "word_length": share("word_chars", "n_words"), "symbols_per_word": share("n_symbols", "n_words"),
        "letter_share": share("letters", "word_chars"),
        "odd_share": share("n_odd", "word_chars"), "upper_share": share("uppers", "letters"),
        "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"),
        # Distinct words grow ever more slowly with length.
        "unique_share": F.when(F.col("n_words") <= 2000, share("n_unique", "n_words")),
        "ended_line_share": share("n_ended", "n_lines"), "sentence_length": share("n_words", "n_endings"),
        "stop_share": share("n_stop", "n_words"),
    })
    return derived.withColumn("votes", F.concat(*[rule.vote() for rule in rules]))


def learn(patterns: DataFrame, prior: Model = PRIOR, weight: float = PRIOR_WEIGHT, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over (votes, n): how many texts have each string of votes."""
    total = patterns.agg(F.sum("n")).first()[0] or 0
    if not total:
        return prior
    model = prior
    strength = weight * total
    for _ in range(rounds):
        p = model.posterior(F.col("votes"))
        sums = [F.sum(F.col("n") * p).alias("good")]
        for j in range(len(prior.votes)):
            cast = F.substring("votes", j + 1, 1)
            for v in (GOOD, BAD, NONE):
                here = F.when(cast == v, F.col("n")).otherwise(0)
                sums += [F.sum(here * F.col("p")).alias(f"g{j}{v}"), F.sum(here * (1 - F.col("p"))).alias(f"b{j}{v}")]
        row = patterns.withColumn("p", p).agg(*sums).first()
        good = row["good"]

        def shares(side: str, j: int, size: float, before: dict[str, float]) -> dict[str, float]:
            return {v: (row[f"{side}{j}{v}"] + strength * before[v]) / (size + strength) for v in (GOOD, BAD, NONE)}

        new = Model((good + strength * prior.good) / (total + strength), tuple(
            (shares("g", j, good, g), shares("b", j, total - good, b)) for j, (g, b) in enumerate(prior.votes)))
        moved = max(abs(new.votes[j][side][v] - model.votes[j][side][v])
                    for j in range(len(prior.votes)) for side in (0, 1) for v in (GOOD, BAD, NONE))
        model = new
        if moved < CLOSE:
            break
    return model


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base measures, base_failed, kept, quality (posterior probability), votes."""
    measured = materialize(votes(base_measures(docs, doc_id, text)), "measures")
    # At most 3 to the number of rules, a bounded table: one file, read in one order.
    patterns = materialize(measured.groupBy("votes").agg(F.count("*").alias("n")).coalesce(1).sortWithinPartitions("votes"), "votes")
    model = learn(patterns)
    n_words, repeat = F.col("n_words"), F.col("n_repeat_words").cast("long")
    failed = (n_words < 50) | (100 * repeat > 50 * n_words.cast("long"))
    longs = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    judged = measured.select("doc_id", *longs, failed.alias("base_failed"), F.round(model.posterior(F.col("votes")), 9).alias("quality"), "votes")
    return judged.select("doc_id", *[c for c in judged.columns if c.startswith(("n_", "word_"))], "base_failed",
                         (~F.col("base_failed") & (F.col("quality") >= 0.5)).alias("kept"), "quality", "votes")
