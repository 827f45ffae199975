"""Quality votes against plain counting, and the learning against the same sums in numpy."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmuration.llm import quality_votes as qv
from murmuration.llm.quality_votes import BAD, GOOD, NONE

LABELLED = "/root/testdata/sf0.01"


def _plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    words = ["a", "B#", "ünd", "\U0001f600", "the", "x<y>", "$$", "é.", "\x1f", "n b", "end!", "\x85"]
    gaps = [" ", " ", " ", "  ", "\t", "\n", "\r\n", "\x0b", "\f", "\n\n"]
    texts = ["".join(draw.choice(words[:draw.randint(1, 12)]) + draw.choice(gaps[:draw.randint(1, 10)]) for _ in range(draw.randint(0, 120)))
             for _ in range(150)]
    long = " ".join(f"w{draw.randint(0, 900)}" for _ in range(40_000))
    texts += [None, "", " \n\t ", "one", "a b c a b c", "a a a a", "x y\nx y\n x y\nx y ", long, "a b c d " * 3000]
    return list(enumerate(texts)) + [(None, "null id " * 60), (3, texts[3]), (3, texts[3])]


def _made(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2.0, "v", None, True) for i, t in rows],
                                 "doc_id long, text string, n_words int, quality double, votes string, w string, kept boolean").repartition(3)


def test_base_columns_equal_plain_counts(spark, rows):
    found = qv.judge(_made(spark, rows))
    assert "Python" not in found._jdf.queryExecution().toString()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    mine = sorted((tuple(r) for r in found.select(*names).collect()), key=str)
    assert mine == sorted(((i, *_plain(t)) for i, t in rows), key=str)
    assert found.where("base_failed and kept").count() == 0 and found.where("kept is null").count() == 0


def test_empty_table(spark):
    assert qv.judge(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_on_the_way(spark):
    plan = qv.votes(qv.base_measures(_made(spark, [(1, "a b")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _em(counts, prior, weight, rounds):
    total, good, tables = sum(counts.values()), prior.good, prior.votes
    strength = weight * total
    for _ in range(rounds):
        g, t = 0.0, [({v: 0.0 for v in "+-0"}, {v: 0.0 for v in "+-0"}) for _ in tables]
        for votes, n in counts.items():
            a = good * np.prod([x[0][v] for x, v in zip(tables, votes)])
            b = (1 - good) * np.prod([x[1][v] for x, v in zip(tables, votes)])
            p = a / (a + b)
            g += n * p
            for side, v in zip(t, votes):
                side[0][v] += n * p
                side[1][v] += n * (1 - p)
        tables = [tuple({v: (side[v] + strength * before[v]) / (size + strength) for v in "+-0"}
                        for side, before, size in zip(pair, old, (g, total - g))) for pair, old in zip(t, prior.votes)]
        good = (g + strength * prior.good) / (total + strength)
    return good, tables


def test_learning_equals_the_sums_in_numpy(spark):
    draw = random.Random(4)
    counts = Counter()
    for _ in range(3000):
        bad = draw.random() < 0.2
        counts["".join(draw.choice("---0+") if bad and j in (2, 5, 7) else draw.choice("++++++0") for j in range(len(qv.RULES)))] += 1
    patterns = spark.createDataFrame(list(counts.items()), "votes string, n long").coalesce(1)
    model = qv.learn(patterns, rounds=12)
    good, tables = _em(counts, qv.PRIOR, qv.PRIOR_WEIGHT, 12)
    assert model.good == pytest.approx(good)
    for mine, plain in zip(model.votes, tables):
        for a, b in zip(mine, plain):
            assert [a[v] for v in (GOOD, BAD, NONE)] == pytest.approx([b[v] for v in (GOOD, BAD, NONE)])
    assert 0.7 < model.good < 0.9 and all(0.5 < a <= 1 for a in model.accuracies())
    # Two of the telling rules together are enough; a vote of a rule that tells nothing is not.
    row = spark.createDataFrame([("++-++-++++++",), ("-+++++++++++",), ("+" * 12,)], "v string").select(model.posterior(F.col("v")).alias("p")).collect()
    assert row[0].p < 0.5 < row[1].p < row[2].p


def test_verdicts_against_labels(spark):
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet")
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    seen = qv.judge(docs).where("not base_failed").join(labels, "doc_id").groupBy("label").agg(F.avg(F.col("kept").cast("int")).alias("share"))
    share = {r.label: r.share for r in seen.collect()}
    assert share[1] > 0.98 and share[0] < 0.1
