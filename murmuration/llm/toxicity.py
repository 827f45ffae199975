"""Toxicity by a weighted lexicon.

Texts are folded (letters that look like Latin ones, digits and signs that stand for letters)
and cut into words. An Aho-Corasick automaton finds lexicon entries, whole words or word
beginnings; the heaviest entry of a word counts, unless the word stands in an exception
phrase. The sum of weights, normalised by the text's length, goes through a logistic curve.

Entries, exception phrases and the curve are learnt from labelled rows: a bounded sample
(``Limits``) of them is enough, as entries that matter are frequent. Scoring covers all
texts whole.

Defined cases: a null or empty text gets the score of a text without any entry, repeated rows
are scored one by one, without labelled rows of both kinds every score is 0, other columns
are ignored.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuration.llm.common import crc32_mod

#: Letters of other scripts that look like Latin ones, and digits that stand for letters. Fixed values.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r", "п": "n",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "l", "ѵ": "v", "ⅼ": "l", "ⅰ": "i", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m",
}
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
_FOLD = {ord(a): b for a, b in {**_LOOKALIKES, **_DIGITS}.items()}
_FOLD |= {0xFF00 + i: chr(0x20 + i) for i in range(1, 0x5F)}  # full-width forms
_FOLD |= dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])  # invisible
_FOLD |= {0xFF00 + i: _DIGITS[chr(0x20 + i)] for i in range(1, 0x5F) if chr(0x20 + i) in _DIGITS}
_SIGNS = re.compile(r"[$@](?=[^\W_])")
_WORD = re.compile(r"[^\W_]+")


class Limits(NamedTuple):
    #: Labelled rows that are read for the lexicon and for the curve, about.
    lexicon_rows: int = 16_000
    curve_rows: int = 4_000
    #: Entries and phrases that are kept.
    entries: int = 4_000
    phrases: int = 1_000
    #: Texts with label 1 in which an entry occurs, its log odds, and its log-likelihood ratio, at least.
    support: int = 5
    log_odds: float = 2.5
    evidence: float = 15.0
    #: Lengths of word beginnings.
    beginnings: tuple[int, ...] = (4, 5, 6)


class Model(NamedTuple):
    #: Entry (word between spaces, or beginning after a space) to weight
    lexicon: dict[str, float]
    #: " word word " phrases in which entries don't count
    exceptions: tuple[str, ...]
    curve: tuple[float, ...]


def words(text: str | None) -> list[str]:
    """The folded words of a text."""
    if not text:
        return []
    text = text.lower()
    if "$" in text or "@" in text:
        text = _SIGNS.sub(lambda m: "s" if m[0] == "$" else "a", text)
    return _WORD.findall(text.translate(_FOLD))


def units(word: str, beginnings: tuple[int, ...]) -> list[str]:
    return [f" {word} ", *(f" {word[:n]}" for n in beginnings if len(word) > n)]


@functools.lru_cache(maxsize=4)
def _automaton(lexicon: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for entry, weight in lexicon:
        automaton.add_word(entry, (len(entry), weight))
    for phrase in exceptions:
        automaton.add_word(phrase, (len(phrase), None))
    automaton.make_automaton()
    return automaton


def matches(text: list[str], model: Model) -> dict[int, float]:
    """Weight of the heaviest entry by the place at which its word starts."""
    if not text or not (model.lexicon or model.exceptions):
        return {}
    found: dict[int, float] = {}
    excepted: list[tuple[int, int]] = []
    for end, (size, weight) in _automaton(tuple(model.lexicon.items()), model.exceptions).iter(f" {' '.join(text)} "):
        start = end - size + 1
        if weight is None:
            excepted.append((start, end))
        elif weight > found.get(start, 0.0):
            found[start] = weight
    if excepted:
        # A word belongs to a phrase if it starts in it before the phrase's last space. Of the phrases that
        # start at or before a word, the one that reaches furthest decides.
        excepted.sort()
        starts = [a for a, _ in excepted]
        reach = list(itertools.accumulate((b for _, b in excepted), max))
        found = {at: w for at, w in found.items() if not (i := bisect.bisect_right(starts, at)) or at >= reach[i - 1]}
    return found


def features(text: str | None, model: Model) -> list[float]:
    parts = words(text)
    found = matches(parts, model)
    total, length = sum(found.values()), len(parts)
    return [1.0, total / math.sqrt(length + 1), 10 * total / (length + 1), max(found.values(), default=0.0)]


def score(text: str | None, model: Model) -> float:
    if not model.curve:
        return 0.0
    z = sum(a * b for a, b in zip(model.curve, features(text, model)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _evidence(pos: pd.Series, neg: pd.Series, n_pos: int, n_neg: int) -> tuple[pd.Series, pd.Series]:
    """Log odds of an entry, and its log-likelihood ratio."""
    odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
    share = (pos + neg) / (n_pos + n_neg)
    terms = [(pos, n_pos * share), (neg, n_neg * share), (n_pos - pos, n_pos * (1 - share)), (n_neg - neg, n_neg * (1 - share))]
    return odds, 2 * sum(np.where(a > 0, a * np.log(np.maximum(a, 1e-9) / np.maximum(b, 1e-9)), 0.0) for a, b in terms)


def _counts(sample: DataFrame, of) -> DataFrame:
    """unit, pos, neg: texts of either label in which each unit occurs; ``of`` gives a text's units."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos, neg = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                (pos if label else neg).update(set(of(text)))
            keys = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in (pos, neg))],
                names=["unit", "pos", "neg"])

    return sample.select("text", "label").mapInArrow(count, "unit string, pos long, neg long").groupBy("unit").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def sample_of(docs: DataFrame, labels: DataFrame, limits: Limits) -> DataFrame:
    """text, label, part: labelled documents, about as many as the limits say, distinct texts.

    ``labels`` has doc_id, label. Rows are chosen by a hash of the id, so that the choice is
    the same in every run; ``part`` 0 is for the lexicon, 1 for the curve.
    """
    labels = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    wanted = limits.lexicon_rows + limits.curve_rows
    share = min(1.0, wanted / max(1, labels.count()))
    place = F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(1 << 20))
    chosen = labels.where(place < int(share * (1 << 20)) + (share == 1.0))
    # The chosen rows are bounded by the limits.
    return docs.join(F.broadcast(chosen), "doc_id").groupBy(F.xxhash64(F.lit(1), "text"), F.xxhash64(F.lit(2), "text")).agg(
        F.first("text").alias("text"), F.max("label").alias("label"),
        (F.min(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1000))) >= 1000 * limits.lexicon_rows // wanted)
        .cast("int").alias("part")).select("text", "label", "part")


def fit_curve(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 40) -> tuple[float, ...]:
    """Logistic regression by Newton's method with a small quadratic penalty."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - penalty * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def learn(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> Model:
    """``docs`` has doc_id and text, ``labels`` doc_id and label (0 or 1)."""
    from murmuration.runtime import materialize

    sample = materialize(sample_of(docs.select("doc_id", "text"), labels, limits), "labelled")
    basis = sample.where("part = 0")
    n_pos, n_neg = basis.agg(F.coalesce(F.sum("label"), F.lit(0)), F.coalesce(F.sum(1 - F.col("label")), F.lit(0))).first()
    if not n_pos or not n_neg:
        return Model({}, (), ())
    beginnings = limits.beginnings
    # Only what is frequent enough in texts of label 1 is counted in the others.
    frequent = _counts(basis.where("label = 1"), lambda text: (
        u for w in set(words(text)) for u in units(w, beginnings))).where(F.col("pos") >= limits.support)
    wanted = frozenset(frequent.orderBy(F.desc("pos"), "unit").limit(50 * limits.entries).toPandas()["unit"])
    counted = _counts(basis, lambda text: (
        u for w in set(words(text)) for u in units(w, beginnings) if u in wanted)).toPandas()
    odds, evidence = _evidence(counted["pos"], counted["neg"], n_pos, n_neg)
    counted = counted.assign(weight=odds, evidence=evidence)
    counted = counted[(counted["weight"] >= limits.log_odds) & (counted["evidence"] >= limits.evidence)]
    best = counted.sort_values(["evidence", "unit"], ascending=[False, True]).head(limits.entries)
    lexicon = dict(zip(best["unit"], best["weight"]))
    draft = Model(lexicon, (), ())

    def phrases(text: str) -> Iterator[str]:
        parts = words(text)
        places, at = {}, 0
        for i, word in enumerate(parts):
            places[at] = i
            at += len(word) + 1
        for start in matches(parts, draft):
            i = places[start]
            if i:
                yield f" {parts[i - 1]} {parts[i]} "
            if i + 1 < len(parts):
                yield f" {parts[i]} {parts[i + 1]} "

    around = _counts(basis, phrases).where((F.col("neg") >= limits.support) & (F.col("neg") / n_neg > 2 * F.col("pos") / n_pos)) \
        .orderBy(F.desc("neg"), "unit").limit(limits.phrases).toPandas()
    model = Model(lexicon, tuple(around["unit"]), ())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t, model) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("label")], names=["x", "y"])

    fitted = sample.where("part = 1").select("text", "label").mapInArrow(rows, "x array<double>, y int").toPandas()
    if fitted.empty or fitted["y"].nunique() < 2:
        return model._replace(curve=(-4.0, 1.0, 1.0, 0.5))
    # A fixed order of the rows makes the sums the same in every run.
    x = np.array(fitted["x"].tolist())
    y = fitted["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))
    return model._replace(curve=fit_curve(x[order], y[order]))


def score_column(text: Column, model: Model) -> Column:
    """Score (0 to 1) of each text."""
    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([score(t, model) for t in texts], dtype="float64")

    return scores(text)


def score_documents(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), fold: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted. Rows with crc32(doc_id) mod ``fold`` = 0 are held out."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    labels = labels.select("doc_id", F.col("toxic").alias("label")).where(crc32_mod("doc_id", fold) != 0)
    model = learn(docs, labels, limits)
    return docs.select("doc_id", (crc32_mod("doc_id", fold) == 0).alias("held_out"),
                       score_column(F.col("text"), model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
