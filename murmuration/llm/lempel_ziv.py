"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into the phrases of an LZ78 dictionary (each the longest phrase seen so far
plus one character). The set of phrases stands for what a compressor would learn from the
text; its minimum hashes, one per bin, are the fingerprint. The share of equal minima
estimates the Jaccard likeness of two phrase sets.

Defined cases: a null text is an empty one, whose fingerprint has empty bins only and is
alike (1.0) to another such; the last phrase of a text counts though it may have been seen;
equal ids sort by text; repeated rows are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from murmuration.runtime import materialize

BINS = 128
#: Value of a bin without any phrase.
_EMPTY = 0xFFFF
#: Bytes of texts in one range of ids, about.
PART_BYTES = 4 << 20


class Parse:
    """The phrase set of a text that can grow and be cut back to an earlier place."""

    def __init__(self) -> None:
        self.phrases: set[str] = set()
        self.order: list[str] = []

    def extend(self, text: str, start: int, stop: int) -> int:
        """Phrases of text[start:stop]; returns where the first phrase that doesn't end before
        ``stop`` begins. Nothing is added for that one."""
        phrases, order = self.phrases, self.order
        guess = 3
        while start < stop:
            # Prefixes of phrases are phrases, so the longest match is found from any guess.
            end = start + guess
            if text[start:end] in phrases and end <= stop:
                end += 1
                while end <= stop and text[start:end] in phrases:
                    end += 1
            else:
                while end - 1 > start and (end > stop + 1 or text[start:end - 1] not in phrases):
                    end -= 1
            if end > stop:
                return start
            phrase = text[start:end]
            phrases.add(phrase)
            order.append(phrase)
            guess = max(1, end - start - 1)
            start = end
        return start

    def cut_back(self, count: int) -> None:
        self.phrases.difference_update(self.order[count:])
        del self.order[count:]


def minima(phrases: list[str], bins: int = BINS) -> np.ndarray:
    """Smallest hash of each bin, 16 bits; the hash's top bits choose the bin."""
    least = np.full(bins, _EMPTY, np.uint16)
    if phrases:
        hashes = np.fromiter(map(xxh64_intdigest, phrases), np.uint64, len(phrases))
        np.minimum.at(least, (hashes % np.uint64(bins)).astype(np.intp), ((hashes >> np.uint64(44)) % np.uint64(_EMPTY)).astype(np.uint16))
    return least


def fingerprint(text: str | None) -> np.ndarray:
    text = text or ""
    parse = Parse()
    rest = parse.extend(text, 0, len(text))
    return minima(parse.order + ([text[rest:]] if rest < len(text) else []))


def fingerprints_of_both(text: str, kept: int, edited: str) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of ``text`` and of ``edited``, which share their first ``kept`` characters:
    what the parses have in common is done once."""
    parse = Parse()
    common = parse.extend(text, 0, kept)
    count = len(parse.order)
    shared = minima(parse.order)

    def whole(of: str) -> np.ndarray:
        rest = parse.extend(of, common, len(of))
        least = np.minimum(shared, minima(parse.order[count:] + ([of[rest:]] if rest < len(of) else [])))
        parse.cut_back(count)
        return least

    return whole(text), whole(edited)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    used = (a != _EMPTY) | (b != _EMPTY)
    return float((a == b)[used].mean()) if used.any() else 1.0


def as_text(least: np.ndarray) -> str:
    return least.astype(">u2").tobytes().hex()


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint: one row per document."""
    @F.pandas_udf("string")
    def prints(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: as_text(fingerprint(t)), na_action=None)

    return docs.select(F.col(doc_id).alias("doc_id"), prints(F.col(text).cast("string")).alias("fingerprint"))


def _with_next(docs: DataFrame, part_bytes: int, most_parts: int = 20_000) -> DataFrame:
    """key, doc_id, text, part, ahead: documents dealt into ranges of ids, each range followed
    by a copy of the next range's first document (``ahead`` 1), the last one by the first of all.

    Only this copy is needed for a task to know each document's successor, so texts are
    shuffled once.
    """
    docs = docs.withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = min(most_parts, max(1, -(-total // part_bytes)))
    # At most ``most_parts`` numbers; tasks stream over their range, so its size is free.
    bounds = np.array(sorted(set(docs.approxQuantile("key", [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else [])

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), side="right").astype(np.int32))

    docs = docs.withColumn("part", range_of("key") if len(bounds) else F.lit(0)).withColumn("ahead", F.lit(0))
    firsts = docs.groupBy("part").agg(F.min("key").alias("key"))
    following = firsts.select("part", F.coalesce(F.lag("part").over(Window.orderBy("part")),
                                                 F.max("part").over(Window.partitionBy())).alias("before"), "key")
    # As many rows as there are ranges.
    heads = docs.drop("ahead").join(F.broadcast(following), ["part", "key"]).groupBy("before", "key").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text"))
    heads = materialize(heads, "heads").select(
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", "key",
        F.col("before").alias("part"), F.lit(1).alias("ahead"))
    return docs.unionByName(heads)


def compare_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last half (rounded down) replaced by as many first
    characters, or all, of the next document by ascending id; the last takes the first.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = _with_next(docs, part_bytes).repartition("part").sortWithinPartitions(
        "part", "ahead", "key", F.coalesce("text", F.lit("")))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_chars", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
        *(T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ``done`` waits for its successor's fingerprint, ``current`` for its successor's text.
        done = current = None
        for batch in batches:
            out = []
            for row_id, row_text, ahead in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                               batch.column("ahead").to_pylist()):
                row_text = row_text or ""
                if current is not None:
                    record, least = _record(*current, row_text)
                    if done is not None:
                        out.append((*done[0], likeness(done[1], least)))
                    done = record, least
                if ahead:
                    out.append((*done[0], likeness(done[1], fingerprint(row_text))))
                    done = current = None
                else:
                    current = row_id, row_text
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out), to_arrow_schema(schema).types)]
                if out else [pa.array([], kind) for kind in to_arrow_schema(schema).types], names=schema.fieldNames())

    return ordered.select("doc_id", "text", "ahead").mapInArrow(run, schema)


def _record(row_id, text: str, following: str) -> tuple[tuple, np.ndarray]:
    half = len(text) // 2
    kept = len(text) - half
    edited = text[:kept] + following[:half]
    least, changed = fingerprints_of_both(text, kept, edited)
    return (row_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(least), as_text(changed),
            likeness(least, changed)), least
