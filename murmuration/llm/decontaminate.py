"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into overlapping windows. A place in a document that matches a window
of m characters with at most e edits shares at least m - q + 1 - q*e of its q-grams, all
near one diagonal. So shared q-grams are counted in overlapping bands of diagonals; regions
that reach this bound are kept, and verified by banded alignment.

Both sides are compared in lower case, letters and digits alone, with single spaces between
words. Windows are dealt into blocks of bounded size; each block's index is sent to the
tasks that read the documents.

Defined cases: null and empty texts match nothing; an item of fewer than ``q`` compared
characters can't be found; repeated documents or items give one row per pair of ids; a null
document id keeps its rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from murmuration.llm.common import bucket_of, grams
from murmuration.runtime import materialize


class Limits(NamedTuple):
    #: Characters of a window; a shorter item is one window.
    window: int = 100
    step: int = 50
    #: Edits by characters of a window.
    edit_share: float = 0.08
    q: int = 10
    #: Width of a band of diagonals, without its overlap.
    band: int = 32
    #: Windows in one block of the index, about.
    block: int = 1 << 16


@functools.cache
def _folded() -> np.ndarray:
    """Code point to its lower-case letter or digit, or to a space."""
    table = np.full(0x110000, 32, np.uint32)
    for start, stop in ((0x30, 0x3400), (0x3400, 0xD800), (0xF900, 0x20000), (0x20000, 0x32000)):
        for c in range(start, stop):
            if (x := chr(c)).isalnum():
                table[c] = ord(x.lower()[0])
    return table


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Compared characters as numbers, and the place of each in the text."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    folded = _folded()[points]
    space = folded == 32
    keep = ~space
    if len(space):
        keep[1:] |= space[1:] & ~space[:-1]
    at = np.flatnonzero(keep)
    return folded[at], at


def budget(m: int, limits: Limits) -> int:
    """Edits allowed in a window: its share, as far as the lemma still demands a shared q-gram."""
    return min(int(limits.edit_share * m), (m - limits.q) // limits.q)


class Index:
    """The q-grams of a block of windows."""

    def __init__(self, windows: list[np.ndarray], items: list, limits: Limits) -> None:
        self.windows, self.items, self.limits = windows, items, limits
        self.sizes = np.array([len(w) for w in windows], np.int64)
        self.edits = np.array([budget(len(w), limits) for w in windows], np.int64)
        self.needed = self.sizes - limits.q + 1 - limits.q * self.edits
        hashes = [grams(w, limits.q) for w in windows]
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(windows)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.owner, self.place = owner[order].astype(np.int64), place[order].astype(np.int64)
        self.known, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.known & np.uint64((1 << 20) - 1)).astype(np.intp)] = True

    def candidates(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and bands of diagonals that reach the lemma's bound."""
        none = np.empty(0, np.int64)
        h = grams(chars, self.limits.q)
        maybe = np.flatnonzero(self.sieve[(h & np.uint64((1 << 20) - 1)).astype(np.intp)])
        if not len(maybe):
            return none, none
        slot = np.minimum(np.searchsorted(self.known, h[maybe]), len(self.known) - 1)
        real = self.known[slot] == h[maybe]
        at, slot = maybe[real], slot[real]
        if not len(at):
            return none, none
        count = self.count[slot]
        entry = np.repeat(self.first[slot] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        window = self.owner[entry]
        diagonal = np.repeat(at, count) - self.place[entry] + (1 << 20)
        # Bands overlap by the edit budget, so that no match lies across an edge.
        width = self.limits.band
        band = diagonal // width
        again = diagonal % width < self.edits[window]
        key = np.concatenate([window, window[again]]) << 40 | np.concatenate([band, band[again] - 1])
        key, shared = np.unique(key, return_counts=True)
        window, band = key >> 40, key & ((1 << 40) - 1)
        enough = shared >= self.needed[window]
        return window[enough], band[enough] * width - (1 << 20)

    def aligned(self, chars: np.ndarray, window: int, diagonal: int) -> tuple[int, int] | None:
        """Edits and diagonal of the best banded alignment that keeps the budget."""
        pattern, edits = self.windows[window], int(self.edits[window])
        low = diagonal - edits
        width = self.limits.band + 3 * edits + 1
        reach = np.arange(width)
        row = np.zeros(width, np.int64)
        padded = np.full(len(pattern) + width, 0xFFFFFFFF, np.uint32)
        a, b = max(0, low), min(len(chars), low + len(padded))
        if b > a:
            padded[a - low:b - low] = chars[a:b]
        for j, c in enumerate(pattern):
            new = row + (padded[j:j + width] != c)
            new[:-1] = np.minimum(new[:-1], row[1:] + 1)
            row = np.minimum.accumulate(new - reach) + reach
            if row.min() > edits:
                return None
        best = int(row.argmin())
        return (int(row[best]), low + best) if row[best] <= edits else None

    def find(self, text: str | None) -> Iterator[tuple[object, int, int, int]]:
        """item, start, end (in the text), edits of each window found."""
        if not text or not self.windows:
            return
        chars, at = normalise(text)
        windows, diagonals = self.candidates(chars)
        done: set[tuple[int, int]] = set()
        for window, diagonal in zip(windows.tolist(), diagonals.tolist()):
            found = self.aligned(chars, window, diagonal)
            if found and (window, found[1]) not in done:
                done.add((window, found[1]))
                start = min(max(0, found[1]), len(at) - 1)
                end = min(len(at), found[1] + len(self.windows[window]))
                yield self.items[window], int(at[start]), int(at[end - 1]) + 1, found[0]


def windows_of(items: DataFrame, limits: Limits, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, chars (the window's compared characters): distinct windows of the items."""
    items = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    schema = T.StructType([items.schema["item_id"], T.StructField("chars", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pieces = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                chars = "".join(map(chr, normalise(text)[0])).strip()
                last = max(0, len(chars) - limits.window)
                for start in sorted({*range(0, last + 1, limits.step), last}):
                    if len(chars) >= limits.q:
                        rows.append(row)
                        pieces.append(chars[start:start + limits.window])
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(rows, pa.int64())), pa.array(pieces, pa.string())],
                                             names=["item_id", "chars"])

    return items.mapInArrow(cut, schema).distinct()


def indexes(items: DataFrame, limits: Limits, item_id: str = "item_id", text: str = "text") -> Iterator[tuple[list, list[str]]]:
    """Items and windows of each block. A block is bounded by ``limits.block``; there are as
    many as the benchmark needs, each sent to the tasks in its turn."""
    windows = materialize(windows_of(items, limits, item_id, text), "windows")
    blocks = max(1, -(-windows.count() // limits.block))
    dealt = windows.withColumn("block", bucket_of(blocks, F.lit(8), "item_id", "chars"))
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).orderBy("item_id", "chars").select("item_id", "chars").toArrow()
        yield rows.column("item_id").to_pylist(), rows.column("chars").to_pylist()


#: Indexes that a worker keeps: those of the blocks that one stage searches in turn.
KEPT = 4
_indexes: dict[str, Index] = {}


def named(block: tuple[list, list[str]]) -> tuple[str, list, list[str]]:
    """A block as it is sent: with a name that no other block of any run has."""
    return (uuid.uuid4().hex, *block)


def _index(shared, limits: Limits) -> Index:
    """The index of a broadcast block of ``named``, made once per worker."""
    name, ids, chars = shared.value
    if name not in _indexes:
        while len(_indexes) >= KEPT:
            del _indexes[next(iter(_indexes))]
        _indexes[name] = Index([np.frombuffer(c.encode("utf-32-le"), np.uint32) for c in chars], ids, limits)
    return _indexes[name]


def leaks(docs: DataFrame, items: DataFrame, limits: Limits = Limits(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, windows, start, end, edits: one row per document and item it holds.

    ``start`` and ``end`` span the windows found, in code points of the text, to within the
    edit budget; ``edits`` is the least of a window.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("item_id", items.schema["item_id"].dataType),
        *(T.StructField(c, T.LongType()) for c in ("start", "end", "edits"))])
    found = []
    for block in indexes(items, limits):
        shared = docs.sparkSession.sparkContext.broadcast(named(block))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(row, *hit) for row, text in enumerate(batch.column("text").to_pylist())
                        for hit in _index(shared, limits).find(text)]
                columns = list(zip(*rows)) or [()] * 5
                types = to_arrow_schema(schema).types
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(columns[0], pa.int64())),
                     *(pa.array(c, kind) for c, kind in zip(columns[1:], types[1:]))], names=schema.fieldNames())

        found.append(docs.mapInArrow(search, schema))
    return functools.reduce(DataFrame.unionAll, found).groupBy("doc_id", "item_id").agg(
        F.count("*").alias("windows"), F.min("start").alias("start"), F.max("end").alias("end"), F.min("edits").alias("edits"))


def leak_column(text: Column, block: tuple[list, list[str]], context, limits: Limits = Limits()) -> Column:
    """Whether each text holds a window of a block of ``indexes``."""
    shared = context.broadcast(named(block))

    @F.pandas_udf("boolean")
    def leaked(texts: pd.Series) -> pd.Series:
        index = _index(shared, limits)
        return pd.Series([any(True for _ in index.find(t)) for t in texts], dtype=bool)

    return leaked(text)
