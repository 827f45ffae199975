"""Phrase mining against a plain count of every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from murmuration.llm import collocations
from murmuration.llm.collocations import Limits
from murmuration.llm.common import ship_package

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _plain(rows, support, top, percent=100):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts[lang].update(tuple(words[i:i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        kept = []
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        for p, a in often.items():
            inside = [q for q, b in often.items() if len(q) > len(p) and 100 * b >= percent * a
                      and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not inside:
                score, _, l, r = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    words = ["a", "B", "cc", "ünd", "x y", "d'e", "é", "Zz", "\x1f", "n\x85"]
    ends = [" ", "  ", "\t", " ", " ", " ", " ", ". ", ",", "\n", "; ", "\r\n", "!?"]

    def text(n):
        return "".join(draw.choice(words[:draw.randint(2, len(words))]) + draw.choice(ends) for _ in range(n))

    made = [(draw.choice(["en", "de", None, "und", ""]), text(draw.randint(0, 40))) for _ in range(150)]
    long = " ".join(draw.choice(["run", "on", "and"]) for _ in range(3000))
    return made + made[:20] + [("en", None), (None, None), ("fr", ""), ("xx", " . "), ("en", long), ("en", "only words once"), ("big", "y " * 500)]


@pytest.mark.parametrize("limits", [Limits(support=6), Limits(support=6, block_words=50, waiting=64, chunk_bytes=16, filter_bits=1 << 15),
                                    Limits(support=40, block_words=400, chunk_bytes=64, shards=2), Limits(support=5, block_words=7, shards=1),
                                    Limits(support=20, shards=3, waiting=500)])
def test_phrases_equal_a_plain_count(spark, rows, limits):
    ship_package(spark)
    docs = spark.createDataFrame([(i, t, lang, 1, "r", 0) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, k int, phrase string, h long").repartition(3)
    found = collocations.collocations(docs, limits, top=30)
    assert sorted(tuple(r) for r in found.collect()) == _plain(rows, limits.support, 30)


def test_parts_of_a_longer_phrase(spark, rows):
    ship_package(spark)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    found = collocations.collocations(docs, Limits(support=20), top=5, absorb_percent=80)
    assert sorted(tuple(r) for r in found.collect()) == _plain(rows, 20, 5, 80)


def test_every_frequent_phrase_is_frequent_in_a_shard(spark, rows):
    """Mining alone, at the lowered support, finds all of them; and it leaves rare ones out."""
    ship_package(spark)
    limits = Limits(support=24, shards=3)
    docs = spark.createDataFrame([("xx" if lang is None else lang, (text or "").encode()) for lang, text in rows], "lang string, text binary").repartition(3)
    made = collocations.blocks(docs, limits)
    own = {r.part: (r.lang, r.own) for r in made.groupBy("lang", "part").agg(F.sum("own").alias("own")).collect()}
    total = Counter()
    for lang, n in own.values():
        total[lang] += n
    assert 2 * len(total) < len(own) <= 3 * len(total)

    class All:
        value = collocations.Sieve(np.full(1 << 12, 255, np.uint8))

    mined = collocations._mine(made, 2, All, limits).groupBy("part", "h").agg(F.sum("n").alias("n")).collect()
    found = {(own[r.part][0], r.h) for r in mined if r.n * total[own[r.part][0]] >= 24 * own[r.part][1]}
    exact = collocations._count(made, 2, All, All, limits).groupBy("lang", "h").agg(F.sum("n").alias("n")).collect()
    often = {(r.lang, r.h) for r in exact if r.n >= 24}
    assert often and often <= found and len(found) < len(exact)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_ratio_is_exact_beyond_64_bits(spark):
    draw = random.Random(1)
    rows = [(100, 10 ** 14 + 7, 100, 100), (10 ** 13 - 1, 10 ** 14 - 3, 10 ** 13 + 9, 10 ** 13 + 1)]
    for _ in range(300):
        a = draw.randint(100, 10 ** draw.randint(3, 13))
        rows.append((a, draw.randint(a, 10 ** 15), draw.randint(a, 10 ** 14), draw.randint(a, 10 ** 14)))
    made = spark.createDataFrame(rows, "a long, n long, l long, r long")
    found = made.select("*", collocations.floor_ratio(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r.s == 1000 * r.a * r.n // (r.l * r.r) for r in found)


def test_mined_phrases_are_dealt_in_few_bytes_without_loss():
    draw = np.random.default_rng(3)
    supports, shares, mined, plain = {7: 5, 2: 90, 9: 300}, 256, defaultdict(list), defaultdict(Counter)
    seen = draw.integers(0, 1 << 63, 40_000).astype(np.uint64)
    for part in [7, 2, 9, 7]:
        found = [draw.choice(seen, 20_000), draw.choice(seen[:300], 9_000), np.repeat(seen[:2], 1000)]
        plain[part].update(np.concatenate(found).tolist())
        batch = collocations._dealt_batch(shares, part, found)
        # Hashes of 32 bits and counts of a byte, and a little for each share.
        assert batch.nbytes < 6 * len(np.unique(np.concatenate(found))) + 40 * shares
        for row in batch.to_pylist():
            mined[row["share"]].append(row | {"support": supports[part]})
    often = [collocations._often(100, (pa.scalar(share),), pa.Table.from_pylist(rows)).column("h").to_pylist() for share, rows in mined.items()]
    expected = {h for h in seen.tolist() if sum(n[h] for n in plain.values()) >= 100 and any(n[h] >= supports[p] for p, n in plain.items())}
    assert 2 < len(expected) < 400 and sorted(h for some in often for h in some) == sorted(h % (shares << 32) for h in expected)
