"""Removal of repeated passages by suffix arrays.

A byte is repeated if a string of ``span`` bytes that covers it also starts elsewhere. Each
start of such a string is assigned to the string's minimiser, the least of the hashes of its
grams; starts that follow each other with the same minimiser form a window. Equal strings
have equal minimisers, so only windows that share one need be compared:

1. windows are made and counted by minimiser; only those with a shared one go on;
2. windows of equal content are repeated whole, and count as one from here on;
3. different windows of one minimiser are sorted together by their suffixes (``suffix_array``);
   equal strings are neighbours there. Windows of a crowded minimiser are texts of their own, whose
   starts are assigned anew, by longer grams: from step 1, down to windows of a single start;
4. repeated starts become spans of documents, and the spans are cut out.

Text is read whole; matches don't cross documents. Defined cases: null texts are empty and stay
null, texts shorter than a span have no repeats, repeated rows are repeats of each other,
ids may be null or of any type, an empty table gives an empty result, other columns stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh3_64_intdigest

from murmuration.llm.common import free_names, grams
from murmuration.llm.suffix_array import prefix_ranks
from murmuration.runtime import materialize

SPAN = 200
#: Bytes of the grams whose least hash assigns a string.
GRAM = 48
#: Different windows of one minimiser that are sorted together.
CHUNK = 1024
#: Bytes that are sorted at once, where a single minimiser's windows are not more.
_SORTED = 1 << 20
#: Bytes of a text that are looked at in one step.
_STEP = 1 << 22


def windows(text: bytes, span: int, gram: int) -> Iterator[tuple[int, int, int, int]]:
    """minimiser, content, start, starts: runs of starts with one minimiser place."""
    for base in range(0, max(0, len(text) - span + 1), _STEP):
        part = text[base:base + _STEP + span - 1]
        n = len(part) - span + 1
        hashes = grams(np.frombuffer(part, np.uint8), gram)
        width = span - gram + 1
        # The least hash and, among equals, the first place: equal strings choose alike.
        keyed = (hashes & ~np.uint64((1 << 23) - 1)) | np.arange(len(hashes), dtype=np.uint64)
        padded = np.full(-(-len(keyed) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:len(keyed)] = keyed
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & np.uint64((1 << 23) - 1)).astype(np.int64)
        edges = np.flatnonzero(place[1:] != place[:-1]) + 1
        starts = [0, *edges.tolist()]
        for start, stop in zip(starts, [*starts[1:], n]):
            yield (int(hashes[place[start]].astype(np.int64)), xxh3_64_intdigest(part[start:stop + span - 1]) - (1 << 63),
                   base + start, stop - start)


def _windows_of(span: int, gram: int):
    schema = pa.schema([("minimiser", pa.int64()), ("content", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                        ("start", pa.int64()), ("starts", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                rows, found = [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    before = len(found)
                    found.extend(windows(text, span, gram))
                    rows.extend([row] * (len(found) - before))
                at = pa.array(rows, pa.int64())
                minimiser, content, start, starts = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(minimiser, pa.int64()), pa.array(content, pa.int64()), part.column("k1").take(at),
                     part.column("k2").take(at), pa.array(start, pa.int64()), pa.array(starts, pa.int32())], schema=schema)
    return run


def _slices(span: int):
    """Bytes of the wanted windows of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                out = []
                for data, wanted in zip(part.column("text").to_pylist(), part.column("wanted").to_pylist()):
                    out.extend((w["minimiser"], w["content"], data[w["start"]:w["start"] + w["starts"] + span - 1]) for w in wanted)
                columns = list(zip(*out)) or [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:2]), pa.array(columns[2], pa.binary())],
                    names=["minimiser", "content", "data"])
    return run


def repeated_runs(data: np.ndarray, ends: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text, first, last: runs of starts of strings of ``span`` bytes that also start elsewhere.

    The texts lie one after the other in ``data``, up to ``ends``; none is shorter than ``span``.
    """
    sizes = np.diff(ends, prepend=0)
    counts = sizes - span + 1
    owners = np.repeat(np.arange(len(ends)), counts)
    starts = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    # Whole strings end in their text, so what is behind it does not matter.
    ranks = prefix_ranks(data, span)[np.repeat(ends - sizes, counts) + starts]
    again = np.flatnonzero(np.bincount(ranks)[ranks] > 1)
    owners, starts = owners[again], starts[again]
    edges = np.flatnonzero((np.diff(owners) != 0) | (np.diff(starts) != 1))
    first, last = np.concatenate([[0], edges + 1]), np.concatenate([edges, [len(again) - 1]])
    return (owners[first], starts[first], starts[last]) if len(again) else (owners, starts, starts)


def _sorted_windows(span: int):
    """Runs of repeated starts in windows that come sorted by minimiser."""
    def compare(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data = rows.column("data").cast(pa.large_binary())
        offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
        values = np.frombuffer(data.buffers()[2], np.uint8)
        minimiser = rows.column("minimiser").to_numpy()
        groups = np.concatenate([[0], np.flatnonzero(np.diff(minimiser)) + 1, [len(minimiser)]])
        at = 0
        # Equal strings have one minimiser: whole groups are sorted together, as many as there is room for.
        while at < len(groups) - 1:
            low = groups[at]
            at = max(at + 1, int(np.searchsorted(offsets[groups], offsets[low] + _SORTED, "right")) - 1)
            high = groups[at]
            if high - low > 1:
                text, first, last = repeated_runs(values[offsets[low]:offsets[high]], offsets[low + 1:high + 1] - offsets[low], span)
                here = rows.select(["minimiser", "content"]).slice(low, high - low).take(pa.array(text))
                yield pa.RecordBatch.from_arrays([*here.columns, pa.array(first), pa.array(last)], names=["minimiser", "content", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_batches([held, batch]) if held else batch
            # The last minimiser may go on in the next batch.
            low = int(np.searchsorted(*(rows.column("minimiser").to_numpy()[i] for i in (slice(None), -1)), "left"))
            held = rows.slice(low)
            if low:
                yield from compare(rows.slice(0, low))
        if held:
            yield from compare(held)
    return run


def keyed(docs: DataFrame, text: str) -> tuple[DataFrame, str, str]:
    """``docs`` with two columns that identify a row's content."""
    k1, k2 = free_names(docs, "k1", "k2")
    columns = docs.columns
    return docs.withColumn(k1, F.xxhash64(F.lit(1), *columns)).withColumn(k2, F.xxhash64(F.lit(2), *columns)), k1, k2


def repeated_spans(docs: DataFrame, span: int = SPAN, gram: int = GRAM, chunk: int = CHUNK) -> DataFrame:
    """k1, k2, spans: of each text with repeats the (first, past) byte ranges of repeated strings, sorted.

    ``docs`` has k1, k2 (which identify the row) and text as bytes, and is read three times.
    """
    small = docs.where(F.octet_length("text") >= span)
    schema = "minimiser long, content long, k1 long, k2 long, start long, starts int"
    made = small.mapInArrow(_windows_of(span, gram), schema)
    shared = made.groupBy("minimiser").agg(F.count("*").alias("n"), (F.min("content") != F.max("content")).alias("mixed")) \
        .where(F.col("n") > 1)
    made = materialize(made.join(shared, "minimiser"), "windows")
    contents = materialize(made.groupBy("minimiser", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct("k1", "k2", "start", "starts")).alias("at"),
        F.first("mixed").alias("mixed"), F.first("n").alias("n")), "contents")
    mixed = contents.where("mixed")

    wanted = mixed.groupBy("at.k1", "at.k2").agg(F.collect_list(
        F.struct("minimiser", "content", F.col("at.start").alias("start"), F.col("at.starts").alias("starts"))).alias("wanted"))
    slices = small.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).mapInArrow(
        _slices(span), "minimiser long, content long, data binary")

    def compared(rows: DataFrame) -> DataFrame:
        return rows.repartition("minimiser").sortWithinPartitions("minimiser").mapInArrow(
            _sorted_windows(span), "minimiser long, content long, first long, last long")

    crowded = materialize(mixed.where(F.col("n") > chunk).groupBy("minimiser").agg(F.count("*").alias("n"))
                          .where(F.col("n") > chunk).select("minimiser"), "crowded")
    if gram >= span or crowded.isEmpty():
        inner = compared(slices)
    else:
        # Starts of crowded windows are assigned once more, by longer grams, which fewer of them share.
        slices = materialize(slices, "slices")
        texts = materialize(slices.join(crowded, "minimiser", "left_semi").select(
            F.col("minimiser").alias("k1"), F.col("content").alias("k2"), F.col("data").alias("text")), "crowded-windows")
        finer = repeated_spans(texts, span, max(gram + 1, span - (span - gram) // 4), chunk)
        inner = compared(slices.join(crowded, "minimiser", "left_anti")).unionAll(
            finer.select(F.col("k1").alias("minimiser"), F.col("k2").alias("content"), F.explode("spans").alias("run")).select(
                "minimiser", "content", "run.first", F.col("run.past") - span))
    whole = contents.where(F.col("copies") > 1).select(
        "minimiser", "content", F.lit(0).cast("long").alias("first"), (F.col("at.starts") - 1).cast("long").alias("last"))
    starts = inner.unionAll(whole).groupBy("minimiser", "content").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    spans = made.select("minimiser", "content", "k1", "k2", "start").distinct().join(starts, ["minimiser", "content"]).select(
        "k1", "k2", F.transform("runs", lambda r: F.struct(
            (F.col("start") + r["first"]).alias("first"), (F.col("start") + r["last"] + span).alias("past"))).alias("runs"))
    return spans.groupBy("k1", "k2").agg(F.flatten(F.collect_list("runs")).alias("spans"))


def cut(data: bytes, first: np.ndarray, past: np.ndarray) -> tuple[bytes, int, int]:
    """Kept bytes, removed bytes, and maximal removed runs."""
    if not len(first):
        return data, 0, 0
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(past[order])
    # A run begins where nothing before reaches.
    begins = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    starts, stops = first[begins], reach[np.concatenate([begins[1:] - 1, [len(reach) - 1]])]
    edges = [0, *stops.tolist()], [*starts.tolist(), len(data)]
    return b"".join(data[x:y] for x, y in zip(*edges)), int((stops - starts).sum()), len(begins)


def _cut_batch(batch: pa.RecordBatch, text: str, spans: str) -> Iterator[tuple[str | None, bytes, tuple[bytes, int, int]]]:
    """Each row's text, its bytes, and what ``cut`` makes of them."""
    column = batch.column(spans)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    flat = column.flatten()
    first, past = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("first", "past"))
    for value, low, high in zip(batch.column(text).to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
        data = (value or "").encode()
        yield value, data, cut(data, first[low:high], past[low:high])


def _with_spans(docs: DataFrame, text: str, span: int, gram: int, chunk: int) -> tuple[DataFrame, str]:
    docs, k1, k2 = keyed(docs, text)
    (name,) = free_names(docs, "spans")
    spans = repeated_spans(docs.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(text).cast("string").cast("binary").alias("text")), span, gram, chunk)
    spans = spans.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("spans").alias(name))
    return docs.join(spans, [k1, k2], "left").drop(k1, k2), name


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per document."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    joined, spans = _with_spans(docs, "text", span, gram, chunk)
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(data), removed, runs, hashlib.sha256(kept).hexdigest())
                    for _, data, (kept, removed, runs) in _cut_batch(batch, "text", spans)]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                names=schema.fieldNames())

    return joined.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, text: str = "text", span: int = SPAN, gram: int = GRAM, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with repeated bytes cut out of its texts. A character of which a part is cut goes whole."""
    joined, spans = _with_spans(docs, text, span, gram, chunk)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_schema(schema)
        for batch in batches:
            texts = [value if value is None or not runs else kept.decode("utf-8", "ignore")
                     for value, _, (kept, _, runs) in _cut_batch(batch, text, spans)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, kind.field(c).type) if c == text else batch.column(c) for c in kind.names], names=kind.names)

    return joined.mapInArrow(run, schema)
