"""Repairs against all edit scripts, and chunks against whole conversations."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from murmuration.llm import conversation_repair as cr
from murmuration.llm.common import ship_package

SPACE = " \t\n\x0b\x0c\r"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        here = out.setdefault(conv, [])
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if harm == 4 else role
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        here += [] if harm == 0 else [(turn, role, text)] * (2 if harm == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def _scripts(rows, must, cut):
    """Cheapest (cost, audit, lines) over all edit scripts, found by trying them all."""
    best = [(4 * len(rows), "D" * len(rows), [])]

    def go(i, cost, audit, lines):
        if cost > best[0][0]:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(x[:1] or "-" for x, _ in lines)):
            best[0] = min(best[0], (cost, audit, lines), key=lambda x: x[:2])
        for role in ("user", "assistant"):
            go(i, cost + 3, audit + "I", lines + [(role, "")])
        if i < len(rows):
            _, role, text = rows[i]
            go(i + 1, cost + 4, audit + "D", lines)
            if not must[i]:
                extra = 3 if cut[i] else 0
                go(i + 1, cost + extra, audit + "K", lines + [(role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + 3 + extra, audit + "R", lines + [(new, text)])

    go(0, 0, "", [])
    return best[0]


def _plain(rows):
    out = []
    for conv, turns in _damaged(rows).items():
        seen, must, cut, faults = set(), [], [], Counter()
        for _, role, text in turns:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            must.append(fault in ("blank", "duplicate"))
            cut.append(fault == "truncated")
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, lines = _scripts(turns, must, cut)
        whole = "\n".join(f"{r}:{t}" for r, t in lines)
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                    hashlib.sha256(whole.encode()).hexdigest()))
    return sorted(out, key=str)


def _made(spark, rows):
    return spark.createDataFrame([(*r, 9, "x", "y") for r in rows],
                                 "conv_id long, turn long, role string, text string, copies_ int, audit string, plan string").repartition(3)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(12)
    out = [(10_000, None, None, None), (10_001, 3, "", "Hm."), (None, 0, "user", "Hi."), (None, None, "assistant", "Yo."),
           (10_002, 0, "user", ""), (10_003, 7, "assistant", "So."), (10_003, 7, "assistant", "So."), (10_003, 9, "assistant", "So.")]
    for conv in range(400):
        for turn in range(draw.randint(0, 5)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "ünd"])
            text = draw.choice(["Yes.", "No!", "cut", " ", "\x0b\n", None, "end? \n", "Yes.", "…", "\x85", "a.\x1f"])
            out.append((conv, draw.choice([turn, turn, turn, turn * 3, None]), role, text))
    return out


def test_repairs_equal_the_best_of_all_scripts(spark, rows):
    ship_package(spark)
    found = cr.repair(cr.damage(_made(spark, rows))).select(*NAMES).collect()
    assert sorted((tuple(r) for r in found), key=str) == _plain(rows)


def test_conversations_whose_rows_are_all_gone(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = cr.repair(cr.damage(_made(spark, [(conv, 0, "user", "Hi.")]))).select(*NAMES).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_chunks_join_to_the_whole(spark):
    draw = random.Random(6)
    turns = [(draw.choice(["user", "assistant", "user", "assistant", "system", "tool"]), draw.choice(["Yes.", "cut", " ", "Well!"]) + "." * draw.randint(0, 1))
             for _ in range(700)]
    results = []
    for limits in (cr.Limits(), cr.Limits(rows=1), cr.Limits(rows=3), cr.Limits(rows=64), cr.Limits(chars=20)):
        conversation, seen = cr.Conversation(limits), set()
        for i, (role, text) in enumerate(turns):
            conversation.add(i, role, text, 1 + (i % 50 == 0), (role, text, i % 30) not in seen)
            seen.add((role, text, i % 30))
        results.append(conversation.finish())
    assert results.count(results[0]) == len(results) and len(results[0][6]) > 700


def test_agenda_pops_values_in_order_and_long_runs_end():
    assert cr.derivations("", cr.START) == {0: (0, ""), 2: (3, "u"), 3: (6, "ua")}
    assert cr.derivations("uaua", cr.START)[cr.ASSISTANT] == (0, "KKKK")
    assert cr.derivations("uua", cr.START)[cr.ASSISTANT] == (3, "KaKK")
    assert cr.derivations("x" * 300, cr.START)[cr.START] == (1200, "D" * 300)


def test_repaired_turns_are_the_digests_text(spark, rows):
    turns = cr.damage(_made(spark, rows))
    repairs = cr.repair(turns)
    lines = {}
    for r in cr.repaired_turns(turns, repairs).collect():
        lines.setdefault(r.conv_id, []).append((r.place, f"{r.role}:{r.text}"))
    for r in repairs.collect():
        whole = "\n".join(line for _, line in sorted(lines.get(r.conv_id, [])))
        assert hashlib.sha256(whole.encode()).hexdigest() == r.repaired_sha256


def test_empty_table(spark):
    empty = _made(spark, [(1, 1, "user", "x")]).limit(0)
    assert cr.repair(cr.damage(empty)).collect() == [] and cr.repaired_turns(cr.damage(empty), cr.repair(cr.damage(empty))).collect() == []


def test_the_general_operator_counts_rows_without_copies(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Why?")]
    (row,) = cr.repair(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    assert (row.cost, row.audit, row.plan) == (3, "KKKKI", "KKKKa")
