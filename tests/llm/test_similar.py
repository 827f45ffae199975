"""Near-duplicate groups against the Jaccard similarity of all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from murmuration.llm import similar, simhash
from murmuration.llm.common import ship_package
from murmuration.llm.components import components

SCHEMA = "doc_id long, text string"


def _shingles(text: str | None) -> set:
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _groups(rows: list[tuple]) -> dict:
    sets, name = {i: _shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def top(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and 10 * len(a & b) >= 8 * len(a | b):
                i_top, j_top = top(i), top(j)
                name[max(i_top, j_top)] = min(i_top, j_top)
    return {i: top(i) for i in name}


def _edited(draw: random.Random, words: list[str], edits: int) -> str:
    words = list(words)
    for place in draw.sample(range(len(words)), edits):
        words[place] = f"new{draw.randrange(10 ** 6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    draw = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \n", "one", "One", "two words", "a b c d e", "a b c d e f"]
    for _ in range(60):  # about the threshold
        base = [draw.choice(words) for _ in range(draw.randint(90, 400))]
        texts += [" ".join(base), _edited(draw, base, round(len(base) * draw.uniform(0.005, 0.06)))]
    for n in range(6, 80, 2):  # 4 of 5 shingles, 5 of 6 and so on; and one shingle too few
        base = [draw.choice(words) for _ in range(n)]
        texts += [" ".join(base), " ".join(base[:-(n // 9) or None]), " ".join(base[2:] + ["end"])]
    template = [draw.choice(words) for _ in range(40)]
    texts += [_edited(draw, template, 1) for _ in range(30)] + [_edited(draw, template, 3) for _ in range(30)]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("group", [2048, 6])
def test_small_sets_and_the_threshold(spark, rows, group):
    ship_package(spark)
    short = [r for r in rows if group == 2048 or len(_shingles(r[1])) <= 64]
    found = similar.groups(spark.createDataFrame(short, SCHEMA).repartition(3), group=group).collect()
    assert {r.doc_id: r.component_id for r in found} == _groups(short)


def test_stage_keeps_one_of_each_group(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(_groups(rows).values()))


def test_crowded_blocks_keep_the_recall(spark):
    """300 pairs at the distance share, in one family whose blocks are crowded at a small bound."""
    ship_package(spark)
    draw = np.random.default_rng(5)

    def flipped(print_, bits):
        out = print_.copy()
        out[draw.choice(256, bits, replace=False)] ^= True
        return out

    base = draw.random(256) < 0.5
    firsts = [flipped(base, 40) for _ in range(300)]
    prints = [p for first in firsts for p in (first, flipped(first, 38))]
    rows = [(i, np.packbits(p, bitorder="little").view("<i8").tolist()) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "node long, print array<long>").repartition(3)
    for group in (2, 8):  # blocks are refined; blocks are compared by pages
        links = simhash.near_links(nodes, simhash.wide_blocks(len(rows)), 44, 4, group)
        part = {r.node: r.component for r in components(links).collect()}
        assert sum(part.get(i, -1) == part.get(i + 1, -2) for i in range(0, 600, 2)) >= 0.97 * 300
