"""The training-data operators against brute force, on rows with every awkward case."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from murmuration.llm import (attention_lm, chat, decontaminate, lempel_ziv, license_rules, licenses, packing, queries, repeats,
                             sharding, simhash, suffix_array, toxicity)
from murmuration.llm.common import free_names, ship_package
from murmuration.llm.components import components

SCHEMA = "doc_id long, text string, bucket string, position int, shard int, row long, spans int, path string"
PASSAGE = "".join(random.Random(5).choice("abcdefgh ") for _ in range(260))


def _texts() -> list[tuple]:
    draw = random.Random(1)
    words = ["".join(draw.choice("abcdeéñ") for _ in range(draw.randint(1, 7))) for _ in range(60)]
    rows = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(1, 160)))) for i in range(40)]
    base = rows[3][1]
    rows += [(50, base), (51, base), (52, base + " tail"), (53, None), (54, ""), (55, None), (56, " \n\t "), (57, "x"), (None, base),
             (None, None), (58, "AaK İ word " * 30), (59, "ab" * 400), (60, "y" * 700), (61, "long " * 4000),
             (62, f"{PASSAGE} one"), (63, f"two {PASSAGE} three"), (64, f"é{PASSAGE}ß"), (50, base), (50, base)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(*r, "b", 1, 2, 3, 4, "p") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark, docs):
    return docs.limit(0)


def _sorted(found) -> list[tuple]:
    return sorted((tuple(r) for r in found), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_free_names(docs):
    assert free_names(docs, "Position", "other", "other") == ["Position_1", "other", "other_1"]


# op1

def test_ids_equal_those_of_the_other_library(rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = ["<|endoftext|> it's 12,5 €  two   spaces\n\n\tend ", "a<|endoftext|><|endoftext|> hi", "<|endoftext|", " <|endoftext|>\n\nb"]
    assert packing.token_ids("<|endoftext|> hi", queries.ranks_path()).tolist() == [50256, 23105]
    for _, text in rows + [(0, t) for t in special]:
        assert packing.token_ids(text, queries.ranks_path()).tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_long_texts_are_cut_where_no_token_crosses():
    draw = random.Random(2)
    text = "".join(draw.choice(["a", "Word", " ", "  ", "é", "7", ".", "\n", " it's"]) for _ in range(3000))
    parts = list(packing.text_parts(text, 50))
    assert "".join(parts) == text and len(parts) > 20
    encode = packing.encoder(queries.ranks_path()).encode_ordinary
    assert [i for p in parts for i in encode(p)] == encode(text)


def test_lower_bound_holds_and_best_fit_is_a_packing():
    draw = random.Random(3)
    for _ in range(60):
        sizes = np.array([draw.randint(1, 12) for _ in range(draw.randint(1, 7))])
        best = next(k for k in range(1, 8) if any(
            max(Counter({b: sum(s for s, c in zip(sizes, at) if c == b) for b in set(at)}).values()) <= 12
            for at in itertools.product(range(k), repeat=len(sizes))))
        assert packing.lower_bound(sizes, 12) <= best
        bins, offsets, used = packing.best_fit_decreasing(sizes, 12)
        assert best <= used and np.bincount(bins, sizes).max() <= 12
        for b in range(used):
            at = np.flatnonzero(bins == b)
            at = at[np.argsort(offsets[at])]
            assert offsets[at].tolist() == [0, *np.cumsum(sizes[at])[:-1].tolist()]


@pytest.mark.parametrize("group_rows", [10, 1 << 16])
def test_packing(docs, rows, group_rows):
    pieces = packing.token_pieces(docs, queries.ranks_path(), 64, 2)
    done = packing.pack(pieces, 64, group_rows)
    found = done.placed.collect()
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
    expected = []
    for doc_id, text in rows:
        ids = np.append(packing.token_ids(text, queries.ranks_path()), 2).astype("<u4")
        first = (len(ids) - 1) % 64 + 1
        edges = [0, *range(first, len(ids) + 1, 64)]
        expected += [(doc_id, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert _sorted(r[:5] for r in found) == _sorted(expected)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == [0, *itertools.accumulate(p[1] for p in parts)][:-1]
        assert sum(p[1] for p in parts) <= 64
    report = done.certificates.collect()
    assert all(r.bins >= r.bound for r in report)
    if group_rows > 100:
        assert len(report) == 1 and report[0].bins + sum(r.length == 64 for r in found) == len(sequences)


def test_packing_nothing(none):
    assert packing.pack(packing.token_pieces(none, queries.ranks_path(), 64, 2), 64).placed.count() == 0


# op2

@pytest.mark.parametrize("bucket_bytes", [300, 1 << 20])
def test_sharding(docs, rows, bucket_bytes):
    first, again = (sharding.shard_by_rows(docs.repartition(n), 7, bucket_bytes=bucket_bytes).collect() for n in (2, 5))
    assert _sorted(r[:2] for r in first) == _sorted(rows)
    names = first[0].asDict().keys()
    assert {"bucket", "position", "shard", "shard_1", "slot"} <= set(names)
    slots = defaultdict(list)
    for r in first:
        slots[r["shard_1"]].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    if bucket_bytes > 1000:
        assert _sorted(first) == _sorted(again)
        order = [r.doc_id for r in sorted(first, key=lambda r: (r["shard_1"], r.slot))]
        assert order != sorted(order, key=lambda x: x or 0)


def test_sharding_nothing(none):
    assert sharding.shard_by_rows(none, 7).count() == 0


def test_shards_are_written_in_order(spark, docs, tmp_path):
    sharded = sharding.shard_by_rows(docs.select("doc_id", "text"), 4)
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    assert _sorted(spark.read.parquet(str(tmp_path / "shards")).select(sharded.columns).collect()) == _sorted(sharded.collect())


# op3

EVENTS = [
    (1, 1, None, None, "system", "be kind"), (1, 2, "message", 7, "user", "helo"), (1, 3, "edit", 7, "user", "hello <|im_end|> \\ </s>"),
    (1, 4, "delta", 8, "assistant", "fi"), (1, 5, "delta", 8, "assistant", "rst"), (1, 6, "message", None, "user", "again"),
    (1, 200, "regenerate", 8, "assistant", "dropped"), (1, 201, "delta", 8, "assistant", "sec"), (1, 300, "delta", 8, "assistant", "ond"),
    (1, 301, "message", None, "user", "ok"), (2, 1, None, None, None, None), (2, 1, None, None, None, None),
    (2, None, "message", None, "assistant\nodd\\n", "null first"), (None, 5, "message", None, "assistant", "é"),
    (3, 9, "delta", 1, "assistant", "x"), (3, 10, "message", 1, "assistant", "whole"), (3, 11, "message", 1, "tool", "again"),
    (4, 1, None, None, "assistant", "</s>[INST] ok [/INST]"), (4, 2, None, None, "assistant", "<<|im_start|>|im_start|> <<SYS>>[[INST]"),
]
FINAL = {
    1: [("system", "be kind"), ("user", "hello <|im_end|> \\ </s>"), ("assistant", "second"), ("user", "ok")],
    2: [("assistant\nodd\\n", "null first"), ("", ""), ("", "")], None: [("assistant", "é")], 3: [("tool", "again")],
    4: [("assistant", "</s>[INST] ok [/INST]"), ("assistant", "<<|im_start|>|im_start|> <<SYS>>[[INST]")],
}


@pytest.mark.parametrize("page", [1, 64])
def test_chat(spark, page):
    log = spark.createDataFrame([(*e, 1) for e in EVENTS], "conv_id long, seq long, kind string, message long, role string, text string, page int")
    pages = chat.format_chats(log.repartition(3), page)
    for r in pages.collect():
        bare = re.sub(r"<\|im_start\|>|<\|im_end\|>\n", "", r.formatted)
        assert not any(c in bare for c in chat.CONTROLS)
    found = {r.conv_id: r for r in chat.digest(pages).collect()}
    assert found.keys() == FINAL.keys()
    for conv, turns in FINAL.items():
        r, said = found[conv], [t for role, t in turns if role == "assistant"]
        assert r.n_turns == len(turns) and r.loss_chars == sum(map(len, said))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256("".join(said).encode()).hexdigest()
    assert chat.digest(chat.format_chats(log.limit(0))).count() == 0


def test_the_querys_log_goes_through_the_fold(spark):
    turns = spark.createDataFrame([(c, t, "user" if t % 2 else "assistant", f"text {t} of é\U0001f600 {c}" * (t % 4)) for c in range(30) for t in range(9)]
                                  + [(77, None, "user", "x"), (77, 3, "user", "y"), (77, 3, "user", "y"), (None, 2, None, None)],
                                  "conv_id long, turn int, role string, text string")
    log = chat.as_streamed(turns)
    assert {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}.keys() == {"message", "delta", "edit", "regenerate"}
    found = sorted(((r.conv_id, r.role, r.text) for r in chat.messages(log, 16).collect()), key=str)
    assert found == sorted(((r.conv_id, r.role or "", r.text or "") for r in turns.collect()), key=str)
    order = [r.text for r in chat.messages(log).where("conv_id = 5").orderBy("seq").collect()]
    assert order == [r.text for r in turns.where("conv_id = 5").orderBy("turn").collect()]


# op4

def test_folding_and_matching():
    assert toxicity.words("ІDІ0T! 5tup1d $cum, tr@sh") == ["idiot", "stupid", "scum", "trash"]
    model = toxicity.Model({" idiot ": 3.0, " idio": 2.0, " scum ": 4.0}, (" pond scum ",), (0.0, 1.0, 1.0, 0.0))
    assert sorted(toxicity.matches(toxicity.words("the idiot idiotic pond scum"), model).values()) == [2.0, 3.0]
    assert toxicity.score(None, model) == toxicity.score("", model) == 0.5
    assert toxicity.score("one idiot", model) > toxicity.score("one idiot " + "fine " * 200, model) > 0.5


def test_toxicity_learns_and_holds_out(spark):
    draw = random.Random(4)
    calm = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows = [(i, " ".join([*(draw.choice(calm) for _ in range(60)), *["zzbad" if i % 3 == 0 else "zgood"] * 2])) for i in range(600)]
    docs = spark.createDataFrame([*rows, (9000, None), (9001, ""), (None, "x"), (1, "again")], "doc_id long, text string").withColumnRenamed("x", "x")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = toxicity.score_documents(docs, labels).collect()
    assert len(found) == 604 and all(0 <= r.score <= 1 for r in found)
    for r in found:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) / len(held) > 0.95
    assert {r.score for r in toxicity.score_documents(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


def test_matches_equal_a_plain_search():
    draw = random.Random(21)
    for _ in range(300):
        vocabulary = ["ab", "abc", "abcd", "b", "bc", "not", "so"]
        lexicon = {f" {w} " if draw.random() < 0.5 else f" {w}": draw.choice([0.5, 1.0, 2.0]) for w in draw.sample(vocabulary, 3)}
        exceptions = tuple({f" {' '.join(draw.choice(vocabulary) for _ in range(draw.randint(1, 3)))} " for _ in range(draw.randint(0, 4))})
        model = toxicity.Model(lexicon, exceptions, ())
        parts = [draw.choice(vocabulary) for _ in range(draw.randint(0, 25))]
        whole = f" {' '.join(parts)} "
        covered = {i for e in exceptions for at in range(len(whole)) if whole.startswith(e, at) for i in range(at, at + len(e) - 1)}
        plain = {}
        for at in range(len(whole)):
            heavy = [w for e, w in lexicon.items() if whole.startswith(e, at)]
            if heavy and at not in covered and parts:
                plain[at] = max(heavy)
        assert toxicity.matches(parts, model) == plain


def test_exceptions_of_a_long_text_take_linear_time():
    import time
    model = toxicity.Model({" bad ": 1.0}, (" not bad ",), ())
    begin = time.process_time()
    assert len(toxicity.matches(["not", "bad", "bad"] * 200_000, model)) == 200_000
    assert time.process_time() - begin < 10


# op5

def _lz78(text: str) -> list[str]:
    seen, out, phrase = set(), [], ""
    for c in text:
        phrase += c
        if phrase not in seen:
            seen.add(phrase)
            out.append(phrase)
            phrase = ""
    return out + ([phrase] if phrase else [])


def test_phrases(rows):
    for text in [t or "" for _, t in rows] + ["a" * 300]:
        parse = lempel_ziv.Parse()
        rest = parse.extend(text, 0, len(text))
        assert parse.order + ([text[rest:]] if rest < len(text) else []) == _lz78(text)


@pytest.mark.parametrize("part_bytes", [700, 1 << 20])
def test_prints_and_edits(docs, rows, part_bytes):
    found = lempel_ziv.compare_with_edits(docs, part_bytes=part_bytes).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for (doc_id, text), (_, after) in zip(ordered, [*ordered[1:], ordered[0]]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        prints = [lempel_ziv.fingerprint(t) for t in (text, edited, after)]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), lempel_ziv.as_text(prints[0]), lempel_ziv.as_text(prints[1]),
                         lempel_ziv.likeness(prints[0], prints[1]), lempel_ziv.likeness(prints[0], prints[2])))
    assert _sorted(found) == _sorted(expected)


def test_prints_of_nothing(none, docs):
    assert lempel_ziv.compare_with_edits(none).count() == 0
    assert lempel_ziv.fingerprint_documents(docs).count() == docs.count()


# op6

def test_gradient():
    draw = np.random.default_rng(0)
    tables = attention_lm.Tables(draw.integers(0, 500, attention_lm._END + 1), draw.integers(0, 50, (attention_lm.CLASSES,) * 2).astype(float))
    params = {k: v + 0.1 * draw.standard_normal(v.shape) for k, v in attention_lm.first_params().items()}
    lengths, ids = np.array([5, 40]), draw.integers(0, attention_lm._END, (2, 45))
    gradient, _ = attention_lm.step(params, tables, *ids, lengths)
    for name, g in gradient.items():
        at, loss = np.unravel_index(np.abs(g).argmax(), g.shape), []
        old = params[name][at]
        for change in (1e-5, -1e-5):
            params[name][at] = old + change
            loss.append(attention_lm.step(params, tables, *ids, lengths)[1])
        params[name][at] = old
        assert g[at] == pytest.approx((loss[0] - loss[1]) / 2e-5, rel=1e-3)


def test_windows_score_each_id_once_and_causally():
    draw = np.random.default_rng(1)
    tables = attention_lm.Tables(draw.integers(0, 500, attention_lm._END + 1), draw.integers(0, 50, (attention_lm.CLASSES,) * 2).astype(float))
    params = attention_lm.first_params()
    params["out"] *= 20
    after = draw.integers(0, attention_lm._END, 70)
    before = np.concatenate([[attention_lm._END], after[:-1]])
    whole = attention_lm.log_probabilities(params, tables, before, after, np.array([70]))
    # Later ids change nothing, other texts neither.
    cut = attention_lm.log_probabilities(params, tables, before[:33], after[:33], np.array([33]))
    assert np.allclose(whole[:33], cut, atol=1e-5)
    both = attention_lm.log_probabilities(params, tables, np.tile(before, 2), np.tile(after, 2), np.array([70, 70]))
    assert np.allclose(both, np.tile(whole, 2), atol=1e-5)
    # Probabilities of all ids sum to one.
    n = attention_lm._END + 1
    total = np.exp(tables.log_share) * 0
    hidden = attention_lm.forward(params, tables.input_of[before[:1]], *attention_lm.windows(np.array([1])))["hidden"][0]
    logits = hidden @ params["out"] + tables.prior[tables.class_of[before[0]]]
    total = np.exp(logits - np.log(np.exp(logits).sum()))[tables.class_of] * np.exp(tables.log_share)
    assert len(total) == n and total.sum() == pytest.approx(1, abs=1e-3)


def test_training_takes_every_subword_of_every_training_text(spark, monkeypatch):
    texts = ["some words of a long text " * 80, "another", "", "x y " * 900]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    weights, average = [], attention_lm.averaged
    monkeypatch.setattr(attention_lm, "averaged", lambda group: weights.append(average(group).column("weight")[0].as_py()) or average(group))
    draw = np.random.default_rng(2)
    tables = attention_lm.Tables(draw.integers(0, 500, attention_lm._END + 1), draw.integers(0, 50, (attention_lm.CLASSES,) * 2).astype(float))
    attention_lm.train(docs, tables, queries.ranks_path())
    before, after, lengths, _ = attention_lm.joined_texts([attention_lm.words_of(t) for t in texts], queries.ranks_path())
    assert sum(weights) == len(after)
    # Taken in parts, each place is scored once, with the loss of the whole.
    parts = [(part[3][1][:, attention_lm.CONTEXT:].sum(), attention_lm.step(attention_lm.first_params(), tables, *part)[1])
             for part in attention_lm.steps(before, after, lengths)]
    assert len(parts) > 1 and sum(n for n, _ in parts) == len(after)
    whole = attention_lm.step(attention_lm.first_params(), tables, before, after, lengths)[1]
    assert sum(n * loss for n, loss in parts) / len(after) == pytest.approx(whole, rel=1e-4)


def test_words_that_are_remembered_have_the_ids_of_the_whole_text(rows, monkeypatch):
    import tiktoken
    monkeypatch.setattr(attention_lm, "REMEMBERED", 50)
    words, coded = attention_lm.Words(queries.ranks_path(), {b"x": 3}), []
    encode = tiktoken.Encoding.encode_ordinary
    monkeypatch.setattr(tiktoken.Encoding, "encode_ordinary", lambda self, text: coded.append(text) or encode(self, text))
    for _, text in [*rows, (0, "it's 12,5 x \u00a0 €")]:
        found = attention_lm.words_of(text)
        ids, sizes, seen = words.of([*found, b""])
        expected = [*encode(packing.encoder(queries.ranks_path()), (b" " + b" ".join(found)).decode()), 50256] if found else [50256]
        assert ids.tolist() == expected and sizes.sum() == len(ids) and len(sizes) == len(found) + 1
        assert seen.tolist() == [3 * (w == b"x") for w in found] + [0]
    # Words that come again are not coded again, as long as they are remembered.
    coded.clear()
    words.of([b"again", b"other", b"again"])
    words.of([b"other", b"again"])
    assert len("".join(coded).split()) == 2


@pytest.mark.parametrize("head", [20, 1 << 18])
def test_base_scores(docs, rows, head):
    found = attention_lm.score(docs, queries.ranks_path(), head_words=head).collect()
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter()
    for i, text in rows:
        if not held[i]:
            counts.update([*(text or "").encode().lower().split(), b"<end>"])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, text in rows:
        words = [*(text or "").encode().lower().split(), b"<end>"]
        expected.append((i, held[i], len(words), sum(counts[w] > 0 for w in words), n,
                         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), 6)))
    assert _sorted((*r[:5], round(r.base_score, 6)) for r in found) == _sorted(expected)
    assert all(r.score < 0 for r in found)
    other = attention_lm.score(docs, queries.ranks_path(), head_words=7).collect()
    assert np.allclose(sorted(r.score for r in found), sorted(r.score for r in other), rtol=1e-3)


def test_a_long_unknown_word_has_a_finite_score(spark):
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]
    word = "".join(random.Random(3).choice("qxzjkvw0123456789") for _ in range(900))
    docs = spark.createDataFrame([(i, word if i in held else "some words") for i in range(40)], "doc_id long, text string")
    for head in (1, 1 << 18):
        found = {r.score for r in attention_lm.score(docs, queries.ranks_path(), head_words=head).collect() if r.doc_id in held}
        # Below what a float's exponent can hold.
        assert len(held) > 1 and all(-1e5 < s < -320 for s in found)


def test_scores_of_nothing(none):
    assert attention_lm.score(none, queries.ranks_path()).count() == 0


# op7

def _simhash(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _union(n: int, pairs) -> list[int]:
    label = list(range(n))
    for a, b in pairs:
        a, b = label[a], label[b]
        label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_simhash_groups(docs, rows):
    prints = [_simhash(t) for _, t in rows]
    label = _union(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    least = {c: min((rows[i][0] for i in range(len(rows)) if label[i] == c and rows[i][0] is not None), default=None) for c in label}
    found = simhash.near_groups(docs).collect()
    assert _sorted((r.doc_id, r.print[0] % (1 << 64), r.component_id) for r in found) == _sorted(
        (rows[i][0], prints[i], least[label[i]]) for i in range(len(rows)))


@pytest.mark.parametrize("group", [24, 100])
def test_crowded_blocks_are_refined(spark, group):
    draw = random.Random(6)
    values = {draw.getrandbits(64) for _ in range(60)}
    centre = draw.getrandbits(64)
    values |= {centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))) for _ in range(150)}
    values = sorted(values)
    nodes = spark.createDataFrame([(i, [v - (1 << 64) if v >> 63 else v]) for i, v in enumerate(values)], "node long, print array<long>")
    links = simhash.near_links(nodes, simhash.ExactBlocks(3), 3, group=group)
    assert all((values[r.a] ^ values[r.b]).bit_count() >= 1 for r in links.collect())
    found = {r.node: r.component for r in components(links).collect()}
    expected = _union(len(values), [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 3])
    assert [found.get(i, i) for i in range(len(values))] == expected


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(20, 60)] + [(5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in [7, *range(20, 60)]}}


def test_simhash_of_nothing(none):
    assert simhash.near_groups(none).count() == 0


# op8

def test_leaks(spark, docs):
    items = [(1, "The quick brown fox jumps over the lazy dog near the old river bank at nine."), (2, PASSAGE * 2), (3, None), (4, "tiny"),
             (5, ""), (1, "The quick brown fox jumps over the lazy dog near the old river bank at nine.")]
    edited = "intro, THE quick brwn fox -- jumps over the lazzy dog near the old\nriver bank at nine! outro"
    more = spark.createDataFrame([(100, edited), (101, "the quick brown fox jumps over nothing"), (102, "ünï " * 50 + items[0][1])], "doc_id long, text string")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    for block in (1 << 16, 2):
        found = decontaminate.leaks(docs.select("doc_id", "text").unionByName(more), bench, decontaminate.Limits(block=block)).collect()
        pairs = {(r.doc_id, r.item_id) for r in found}
        assert {(100, 1), (102, 1), (62, 2), (63, 2), (64, 2)} == pairs
        at = {(r.doc_id, r.item_id): r for r in found}
        assert at[102, 1].start == 200 and at[102, 1].edits == 0 and at[102, 1].end >= 200 + len(items[0][1]) - 1
        assert at[100, 1].edits == 2
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0 == decontaminate.leaks(docs.limit(0), bench).count()


def _edits(pattern: np.ndarray, text: np.ndarray) -> int:
    row = np.zeros(len(text) + 1, int)
    for j, c in enumerate(pattern):
        new = np.minimum(row[:-1] + (text != c), row[1:] + 1)
        row = np.concatenate([[j + 1], new])
        row = np.minimum.accumulate(row - np.arange(len(row))) + np.arange(len(row))
    return int(row.min())


def test_no_region_within_the_budget_is_lost():
    draw = random.Random(8)
    limits, base = decontaminate.Limits(), [draw.choice("abcdef ghi") for _ in range(100)]
    pattern = np.array([ord(c) for c in "".join(base)], np.uint32)
    index = decontaminate.Index([pattern], [1], limits)
    for _ in range(150):
        text = base.copy()
        for _ in range(draw.randint(0, 12)):
            at = draw.randrange(len(text))
            draw.choice([lambda: text.pop(at), lambda: text.insert(at, "z"), lambda: text.__setitem__(at, "y")])()
        whole = "".join(draw.choice("abcdefghi ") for _ in range(draw.randint(0, 90))) + "".join(text) + "".join(draw.choice("abcdefghi ") for _ in range(40))
        chars = decontaminate.normalise(whole)[0]
        found = [x[3] for x in index.find(whole)]
        best = _edits(pattern, chars)
        assert (min(found) == best) if best <= index.edits[0] else not found


def test_many_blocks_in_one_worker():
    """Values that come and go at the same places in memory do not get each other's index."""
    for i in range(50):
        class Sent:
            value = decontaminate.named(([i], [f"passage number {i} of the benchmark, told at some length"]))
        assert decontaminate._index(Sent, decontaminate.Limits()).items == [i]
        del Sent


def test_leaks_over_several_blocks(spark):
    words = [f"{a}{b}" for a in ("red", "oak", "sun", "tin", "fog") for b in ("fish", "road", "bell", "lamp", "seed")]
    draw = random.Random(4)
    items = [(i, " ".join(draw.choice(words) for _ in range(30))) for i in range(12)]
    docs = spark.createDataFrame([(i, f"so it began {t} and ended") for i, t in items], "doc_id long, text string").repartition(2)
    found = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), decontaminate.Limits(block=8))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i) for i, _ in items}


# op9

def test_suffix_arrays():
    draw = random.Random(9)
    for _ in range(3000):
        values = [draw.randrange(draw.choice([1, 2, 4])) for _ in range(draw.randrange(30))]
        assert suffix_array.suffix_array(values) == sorted(range(len(values)), key=lambda i: values[i:])


def _repeated(texts: list[str | None], span: int) -> list[list[bool]]:
    counts = Counter(d[i:i + span] for t in texts for d in [(t or "").encode()] for i in range(len(d) - span + 1))
    out = []
    for t in texts:
        d = (t or "").encode()
        gone = [False] * len(d)
        for i in range(len(d) - span + 1):
            if counts[d[i:i + span]] > 1:
                gone[i:i + span] = [True] * span
        out.append(gone)
    return out


@pytest.mark.parametrize("chunk", [1, 256])
def test_repeats(docs, rows, chunk):
    expected = []
    for (doc_id, text), gone in zip(rows, _repeated([t for _, t in rows], 60)):
        data = (text or "").encode()
        expected.append((doc_id, len(data), sum(gone), sum(a and not b for a, b in zip(gone, [False, *gone])),
                         hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    assert _sorted(repeats.report(docs, span=60, gram=20, chunk=chunk).collect()) == _sorted(expected)


def test_common_passage_is_compared_by_windows(spark, monkeypatch):
    draw = random.Random(90)

    def letters(n: int) -> str:
        return "".join(draw.choice("abcdefgh") for _ in range(n))

    passage, tail = letters(58), letters(30)
    # One passage in all texts, too short to be a repeat alone, and with the same words behind it in some.
    texts = [letters(80) + passage + (tail if i % 10 == 0 else letters(30)) + letters(50) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables, write = {}, repeats.materialize

    def counted(df, name):
        table = write(df, name)
        tables.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(repeats, "materialize", counted)
    found = {r.doc_id: r.n_removed for r in repeats.report(docs, span=60, gram=20, chunk=16).collect()}
    assert found == {i: sum(gone) for i, gone in enumerate(_repeated(texts, 60))}
    assert sum(found.values()) > 0
    # No table has a row for each start of a string in these windows.
    assert max(max(sizes) for sizes in tables.values()) <= 2 * tables["windows"][0], tables


def test_cut_texts(docs, rows, none):
    found = repeats.remove_repeats(docs, span=60, gram=20)
    assert found.schema == docs.schema
    expected = [(i, t if t is None else bytes(b for b, g in zip(t.encode(), gone) if not g).decode("utf-8", "ignore"))
                for (i, t), gone in zip(rows, _repeated([t for _, t in rows], 60))]
    assert _sorted(r[:2] for r in found.collect()) == _sorted(expected)
    assert repeats.report(none).count() == 0


# op10

def test_rules_hold_their_keywords():
    rules = license_rules.build_rules()
    assert len(rules) > 300
    for rule in rules:
        assert re.search(rf"[ (|?:]{re.escape(rule.keyword[:4])}", rule.pattern), rule


def test_every_identifier_is_found_in_a_tag_a_grant_and_by_name(spark):
    names = [(line.split(" | ")[0].strip(), name.strip()) for line in license_rules.IDS.strip().splitlines() for name in line.split(" | ")[1:]]
    assert len(names) > 70
    forms = ["// SPDX-License-Identifier: {}", "released under {}", "It is licensed under the {} license.", "License: {}", "{} licensed",
             "SPDX-License-Identifier: (MIT OR {})"]
    rows = [(i, form.format(name)) for i, (form, (_, name)) in enumerate((f, n) for f in forms for n in names)]
    labels = [label for _ in forms for label, _ in names]
    found = {r.doc_id: r.labels.split(",") for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i, _ in rows if labels[i] not in found[i]] == []
    # Besides the base phrase "cc by nc", which stays in the longer identifiers, there is no other label.
    assert [i for i, _ in rows if set(found[i]) - {"mit", "cc-by-nc", labels[i]}] == []


def test_words_that_are_identifiers_count_in_no_other_place(spark):
    texts = ["mit der Hand", "a ruby ring", "curl the hair", "python programs", "the isc and zlib", "under the sun", "License for all", "x11 windows"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.labels for r in licenses.scan(docs).collect()} == {""}


def test_every_rule_matches_some_text():
    """Each rule has a text of its own, made from its pattern."""
    for rule in license_rules.build_rules():
        sample = re.sub(r"\(\?<?= \)|\(\?= \)", "", rule.pattern)
        for a, b in ((r"(?:\S+ ){1,8}?", "x "), (r"{0,4}?", ""), (r"(\S+ ){1,12}", "x "), (r"(\S+ ){0,4}", "x "), (r"f\w+", "fun"), ("[0-9]{2}", "20"), (r"\w+", "x")):
            sample = sample.replace(a, b)
        sample = re.sub(r"\[(.)[^]]*\]", r"\1", sample)
        while m := re.search(r"\((\?:)?([^()|]*)((?:\|[^()]*)?)\)\??", sample):
            sample = sample[:m.start()] + m[2] + sample[m.end():]
        sample = re.sub(r"(.)\?", r"\1", sample)
        assert re.search(rule.pattern, f" {sample.strip()} ".replace("  ", " ")), (rule, sample)
        assert f" {rule.keyword}" in f" {sample} ".replace("  ", " "), (rule, sample)


def test_licenses(spark):
    texts = [
        "SPDX-License-Identifier: MIT", "released under MIT", "License: Zlib", "MIT licensed", "SPDX-License-Identifier: MIT OR Apache-2.0",
        "Licensed under the Apache License, Version 2.0. See under the MIT license", None, "", "no words here", "CC-BY-NC 4.0 cc by nc",
        "SPDX-License-Identifier: GPL-3.0-or-later", "under the\nMIT\tlicense under the mit license.", "sous la licence MIT", "mit der Hand, permit license",
        "All rights reserved. Copyright (c) 2020", "This work is licensed under the GNU General Public License, version 3.", "cc byé nc", "x " * 3000 + "cc by nc"]
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in enumerate(texts)] + [(None, texts[0], "r", 1)], "doc_id long, text string, row string, words int")
    rules = license_rules.build_rules()
    for r in licenses.scan(docs.repartition(2)).collect():
        text = texts[0] if r.doc_id is None else texts[r.doc_id] or ""
        words = [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower())]
        places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min((p[0] for p in places), default=None), max((p[0] for p in places), default=None))
        joined = f" {' '.join(words)} "
        hits = [(m.start(), m.end(), rule.priority, k, rule.label) for k, rule in enumerate(rules) for m in re.finditer(rule.pattern, joined)]
        kept = {h[4] for h in hits if not any(
            o is not h and o[0] <= h[0] and o[1] >= h[1] and o[2] <= h[2] and (o[:2] != h[:2] or o[2:4] < h[2:4]) for o in hits)}
        base = {p[1] for p in places}
        assert r.base_labels == ",".join(sorted(base)) and r.labels == ",".join(sorted(base | kept)), (text, r)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert licenses.scan(docs.limit(0)).count() == 0
