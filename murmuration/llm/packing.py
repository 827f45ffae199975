"""Best-fit packing with certificates.

Documents become token pieces; pieces shorter than a sequence are dealt into partitions and
packed there by best-fit decreasing. Dual-feasible functions give a lower bound on each
partition's bin count. A partition that meets its bound is finished. The bins with gaps of
the others are exchanged: whole bins are dealt anew among fewer partitions, which pack
their documents again and keep the new packing where it needs fewer bins.

Defined cases: a null text is an empty one (its end token alone), a null doc_id stays null,
repeated rows are packed one by one, an empty table gives an empty result, and columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration.llm.common import bucket_of
from murmuration.runtime import materialize

#: Texts are encoded in parts of about so many characters, so that memory stays bounded.
ENCODE_CHARS = 1 << 17
# Fixed value: the special token of the vocabulary; its string in a text is that token.
SPECIAL = "<|endoftext|>"
#: Pieces that one partition packs.
GROUP_ROWS = 1 << 16


@functools.cache
def encoder(ranks_path: str):
    """Byte-level BPE from a file of ranks (the fast reader of the same vocabulary).

    Its one special token has the id after the ranks; only ``token_ids`` looks for it in texts."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={SPECIAL: len(ranks)})


_SAFE_CUT = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


def text_parts(text: str, size: int = ENCODE_CHARS) -> Iterator[str]:
    """The text cut before single spaces between letters or digits, where no token crosses."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def token_ids(text: str | None, ranks_path: str) -> np.ndarray:
    encode = functools.partial(encoder(ranks_path).encode, allowed_special={SPECIAL}, disallowed_special=())
    parts = [np.array(encode(part), dtype="<u4") for part in text_parts(text or "")]
    return np.concatenate(parts)


def token_pieces(docs: DataFrame, ranks_path: str, capacity: int, end_id: int,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids plus ``end_id``, cut only
    where there are more than ``capacity``; then the first piece takes the remainder."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, starts, lengths, sums = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = np.append(token_ids(text.as_py(), ranks_path), np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for number, (a, b) in enumerate(zip(edges, edges[1:])):
                    rows.append(row)
                    numbers.append(number)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                 *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(cut, schema)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of three families of dual-feasible functions."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    # Large pieces fill a bin, tiny ones count nothing.
    total, number = np.cumsum(count * size), np.cumsum(count)
    tiny = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - tiny]
    middle = total[capacity - tiny] - total[tiny - 1]
    if len(tiny):
        best = max(best, int((large - (-middle // capacity)).max()))
    # Sizes rounded to multiples of 1/k; exact multiples of 1/(k+1) keep their size.
    for k in range(1, 32):
        scaled = (k + 1) * size
        weight = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)  # in 1/(k*capacity)
        best = max(best, -(-int((count * weight).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r
    used = 0
    for i, size in zip(np.argsort(-lengths, kind="stable").tolist(), np.sort(lengths)[::-1].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen, used = capacity, used, used + 1
        bins[i], offsets[i] = chosen, capacity - room
        left = room - size
        if left:
            with_room[left].append(chosen)
            rooms |= 1 << left
    return bins, offsets, used


def repacker(fields: list[str], capacity: int, exchange: int, last: bool):
    """Packs one partition's pieces; the first eight ``fields`` are those of a piece."""
    def repack(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        lengths = group.column("length").to_numpy()
        order = np.argsort(group.column("row").to_numpy(), kind="stable")
        found, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        found[order], offsets[order], bins = best_fit_decreasing(lengths[order], capacity)
        bound = lower_bound(lengths, capacity)
        old, before = np.unique(group.column("sequence_id").to_numpy(), return_inverse=True)
        if bins < len(old):
            sequence = (np.int64(exchange + 1) << 58) | (np.int64(part) << 24) | found
        else:
            bins, found = len(old), before
            sequence, offsets = old[before], group.column("offset").to_numpy()
        filled = np.bincount(found, weights=lengths, minlength=bins)[found] >= capacity
        done = filled | last | (bins <= bound)
        out = group.select(fields[:6])
        for name, values in (("sequence_id", sequence), ("offset", offsets),
                             ("exchange", np.full(len(lengths), exchange, np.int32)),
                             ("part", np.full(len(lengths), part)), ("bins", np.full(len(lengths), bins)),
                             ("bound", np.full(len(lengths), bound)), ("done", done)):
            out = out.append_column(name, pa.array(values))
        return out

    return repack


class Packing(NamedTuple):
    #: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    placed: DataFrame
    #: exchange, part, bins, bound: one row per partition and exchange
    certificates: DataFrame


def pack(pieces: DataFrame, capacity: int, group_rows: int = GROUP_ROWS, exchanges: int = 5) -> Packing:
    """Pack pieces of at most ``capacity`` tokens.

    Memory of a task is bounded by ``group_rows`` pieces. After each exchange only bins with
    gaps in partitions above their bound go on, so the partitions become fewer each time;
    when all that remains fits one partition, its packing is the last.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") >= capacity)
    settled = [full.select("doc_id", "piece", "start", "length", "ids_crc32",
                           (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    # A document alone is a bin of its own until the first packing.
    going = pieces.where(F.col("length") < capacity).withColumn("sequence_id", F.col("row")) \
        .withColumn("offset", F.lit(0).cast("long"))
    schema = T.StructType([
        *going.schema.fields, T.StructField("exchange", T.IntegerType()), T.StructField("part", T.LongType()),
        T.StructField("bins", T.LongType()), T.StructField("bound", T.LongType()), T.StructField("done", T.BooleanType()),
    ])
    reports = []
    for exchange in range(exchanges + 1):
        rows = going.count()
        if not rows:
            break
        parts = max(1, -(-rows // group_rows))
        last = parts == 1 or exchange == exchanges

        # Whole bins move, so the packing so far stays possible and bins never become more.
        dealt = going.select(*schema.fieldNames()[:8]).withColumn(
            "part", bucket_of(parts, F.lit(exchange), F.col("sequence_id")))
        result = materialize(dealt.groupBy("part").applyInArrow(
            repacker(schema.fieldNames(), capacity, exchange, last), schema), "packed")
        settled.append(result.where("done").select(*settled[0].columns))
        reports.append(result.groupBy("exchange", "part").agg(
            F.first("bins").alias("bins"), F.first("bound").alias("bound")))
        going = result.where(~F.col("done"))
        if last:
            break
    placed = functools.reduce(DataFrame.unionAll, settled)
    report = functools.reduce(DataFrame.unionAll, reports) if reports else spark.createDataFrame(
        [], "exchange int, part long, bins long, bound long")
    return Packing(placed, report)
