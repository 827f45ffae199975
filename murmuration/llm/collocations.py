"""Phrases whose words come together more often than chance, by SON partitioning.

A phrase is a run of words inside a piece of text. The corpus is dealt into a few shards; a shard is
mined completely at a support that is lowered in proportion to its share of its language's words: a
phrase that reaches the support in the whole corpus reaches the lowered one in at least one shard.
The union of the shards' frequent phrases is then counted exactly, by the phrases' own text, over all
shards. Lengths come one after the other, and only phrases whose shorter parts are frequent in the
whole corpus are looked at.

The number of shards does not grow with the corpus, so that the lowered support stays above one; a
shard is spread over many tasks, whose counts of hashed phrases are added up, dealt by the hash. Texts are taken apart
once, into blocks of numbered words. What is sent to all tasks are bitmaps of hashes of at most
``Limits.filter_bits`` bits: they may let through phrases that are not frequent, never the other way
round, and the exact counts leave those out.

Defined cases: a null text is an empty one, a null language is ``und``, repeated rows count one by
one, an empty table gives an empty result, other columns are ignored. A text may be longer than
a block: it is cut, and phrases across the cut are counted once.
"""

from __future__ import annotations

import functools
import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuration.llm.common import arrow_batches, free_names, release_shuffles
from murmuration.runtime import materialize, write_counting

# The bytes that end a piece, those between words, and one that no UTF-8 text holds.
ENDS, BLANKS, MARK = b".,;:!?\n\x0b\x0c\r", b" \t", b"\xff"
_TABLE = bytes.maketrans(ENDS + BLANKS, MARK * len(ENDS) + b" " * len(BLANKS))
# Arrays are bytes, which Spark need not take apart; words have a space between them. Their hashes, which cannot be
# compressed, are made again when a block is read.
_BLOCKS = "lang string, part long, known int, own long, tokens binary, words binary"
_MINED = "part long, h long, n long"
_DEALT = "share int, part long, h binary, n binary"
_COUNTED = "lang string, phrase string, h long, n long"


#: A block is large for a row: so few go to Python at once.
BATCH = "8m"
#: Phrases that come back from Python at once.
_ROWS = 1 << 14


class Limits(NamedTuple):
    """``support``: least count of a phrase; ``longest``: its words; ``shards``: parts of the corpus.
    The others bound the memory of a task."""

    support: int = 100
    longest: int = 5
    shards: int = 8
    block_words: int = 1 << 17
    waiting: int = 1 << 21
    filter_bits: int = 1 << 27
    share_words: int = 1 << 20
    chunk_bytes: int = 1 << 20


class Sieve:
    """Hashes of phrases as a bitmap of a power of two of bits."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    @classmethod
    def of(cls, hashed: DataFrame, count: int, limits: Limits) -> "Sieve":
        """Of a column ``h``: 16 bits for each of ``count`` rows, up to the bound, fetched in pieces of 4 KB."""
        size = max(1 << 15, min(limits.filter_bits, 1 << (16 * count).bit_length()))
        place = F.col("h").bitwiseAND(F.lit(size - 1)) + 1
        rows = hashed.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
        bits = np.zeros(size // 8, np.uint8)
        for row in rows:
            bits[(row.part - 1) << 12:row.part << 12] = np.frombuffer(row.bits, np.uint8)
        return cls(bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.bits[(at >> np.uint64(3)).astype(np.intp)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _number_type(words: int) -> type:
    """Of the numbers of so many words."""
    return np.uint16 if words <= 1 << 16 else np.int32


def _numbers(lang: pa.Scalar, tokens: pa.Scalar, words: pa.Scalar) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words of a block as numbers, and each number's word's hash and the word."""
    names, seed = words.as_py().split(b" "), xxhash.xxh64_intdigest(lang.as_py())
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, names, itertools.repeat(seed)), np.uint64, len(names))
    return np.frombuffer(tokens.as_buffer(), _number_type(len(names))), hashes, names


class Block:
    """Words of one language as numbers from 1, in order of appearance; 0 stands between pieces."""

    def __init__(self, lang: str, carried: list[bytes] = []) -> None:
        self.lang = lang
        numbers = itertools.count()
        self.number: defaultdict[bytes, int] = defaultdict(lambda: next(numbers))
        self.number[MARK]
        self.known = len(carried)
        self.runs = [np.array([self.number[w] for w in carried], np.int32)]
        self.size = self.known

    def push(self, ids: np.ndarray) -> None:
        self.runs.append(ids)
        self.size += len(ids)

    def tail(self, length: int) -> list[bytes]:
        """The last words, as far as they belong to one piece."""
        last = np.concatenate(self.runs)[-length:]
        ends = np.flatnonzero(last == 0)
        names = list(self.number)
        return [names[i] for i in (last[ends[-1] + 1:] if len(ends) else last)]

    def row(self, shard: int) -> tuple:
        """The block as a row of ``_BLOCKS``; words carried over are not its own. ``part`` stands
        for the language and the shard."""
        tokens = np.concatenate(self.runs)
        own = np.count_nonzero(tokens[self.known:])
        words = list(self.number)
        words[0] = b""
        part = xxhash.xxh64_intdigest(self.lang, shard) >> 1
        tokens = tokens.astype(_number_type(len(words)), copy=False)
        return self.lang, part, self.known, own, tokens.tobytes(), b" ".join(words)


_END = np.zeros(1, np.int32)


def _add(block: Block, data: bytes, limits: Limits) -> Iterator[Block]:
    """Append a text; the blocks that are left, all but the last of them full."""
    block.push(_END)
    at = 0
    while at < len(data):
        end = at + limits.chunk_bytes
        cut = data.find(b" ", end) if end < len(data) else len(data)
        part = data[at:len(data) if cut < 0 else cut]
        at += len(part)
        tokens = part.lower().translate(_TABLE).replace(MARK, b" \xff ").split()
        i = 0
        while i < len(tokens):
            some = tokens[i:i + max(1, limits.block_words - block.size)]
            i += len(some)
            block.push(np.fromiter(map(block.number.__getitem__, some), np.int32, len(some)))
            if block.size >= limits.block_words:
                yield block
                block = Block(block.lang, block.tail(limits.longest - 1))
    block.push(_END)
    yield block


def _texts(values: list[bytes]) -> pa.Array:
    return pc.cast(pa.array(values, pa.binary()), options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))


def _block_batch(row: tuple) -> pa.RecordBatch:
    names = ["lang", "part", "known", "own", "tokens", "words"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds)], names=names)


def blocks(docs: DataFrame, limits: Limits) -> DataFrame:
    """The (lang, text) rows as blocks of words, each in the shard of the task that read it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % limits.shards
        waiting: dict[str, Block] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = waiting.pop(lang, None) or Block(lang)
                size -= block.size
                *full, last = _add(block, text.as_py(), limits)
                for block in full:
                    yield _block_batch(block.row(shard))
                waiting[lang] = last
                size += last.size
                if size >= limits.waiting:
                    yield from (_block_batch(b.row(shard)) for b in waiting.values())
                    waiting, size = {}, 0
        yield from (_block_batch(b.row(shard)) for b in waiting.values())

    return materialize(docs.mapInArrow(run, _BLOCKS), "blocks")


def _mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its beginning and its last word."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + word
    return h ^ (h >> np.uint64(29))


def phrases_at(tokens: np.ndarray, hashes: np.ndarray, known: int, k: int, frequent: Sieve) -> tuple[np.ndarray, np.ndarray]:
    """Places of a block where phrases of k words start whose shorter parts are frequent, and their hashes.

    Phrases within the ``known`` words that a longer text carries over were the last block's.
    """
    fine = frequent.has(hashes)
    fine[0] = False
    at = np.flatnonzero(fine[tokens])
    h = hashes[tokens[at]]
    for length in range(2, k + 1):
        # A phrase needs the one that starts a word later, too.
        both = np.flatnonzero(np.diff(at) == 1)
        at, h = at[both], _mixed(h[both], hashes[tokens[at[both] + length - 1]])
        if length < k:
            keep = frequent.has(h)
            at, h = at[keep], h[keep]
    new = at + k > known
    return at[new], h[new]


def _mined_batch(part: int, found: list[np.ndarray]) -> pa.RecordBatch:
    h, n = np.unique(np.concatenate(found), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(h), part, np.int64)), pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))],
                                      names=["part", "h", "n"])


def _dealt_batch(shares: int, part: int, found: list[np.ndarray]) -> pa.RecordBatch:
    """The same as a row for each share of the hashes: their last 32 bits, the share's number being the
    bits before these, and the counts in bytes; a phrase that needs more than a byte is there again."""
    h, n = np.unique(np.concatenate(found) & np.uint64((shares << 32) - 1), return_counts=True)
    again = -(-n // 255)
    left = n - 255 * (again - 1)
    h, n = np.repeat(h, again), np.full(again.sum(), 255, np.uint8)
    n[np.cumsum(again) - 1] = left
    ends = np.searchsorted(h, np.arange(shares + 1, dtype=np.uint64) << np.uint64(32))
    some = np.flatnonzero(np.diff(ends))
    starts = np.append(ends[some], len(h)).astype(np.int32)

    def rows(values: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(starts * values.dtype.type(1).nbytes), pa.py_buffer(values)])

    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(np.full(len(some), part, np.int64)), rows(h.astype(np.uint32)), rows(n)],
                                      names=["share", "part", "h", "n"])


def _mine(made: DataFrame, k: int, frequent, limits: Limits, batch_of: Callable = _mined_batch, schema: str = _MINED) -> DataFrame:
    """part, h, n: the hashed phrases of k words of each shard, counted in pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: defaultdict[int, list[np.ndarray]] = defaultdict(list)
        size = 0
        for batch in batches:
            for part, known, *block in zip(*batch.columns):
                tokens, hashes, _ = _numbers(*block)
                _, h = phrases_at(tokens, hashes, known.as_py(), k, frequent.value)
                waiting[part.as_py()].append(h)
                size += len(h)
                if size >= limits.waiting:
                    yield from itertools.starmap(batch_of, waiting.items())
                    waiting.clear()
                    size = 0
        yield from itertools.starmap(batch_of, waiting.items())

    return made.select("part", "known", "lang", "tokens", "words").mapInArrow(run, schema)


def _often(support: int, key: tuple, rows: pa.Table) -> pa.Table:
    """h: the hashes of a share that reach a shard's lowered support, and ``support`` in all shards together. Counts can
    only be too high, where hashes meet."""
    parts, first, part = np.unique(rows.column("part").to_numpy(), return_index=True, return_inverse=True)
    lowered = rows.column("support").to_numpy()[first]
    h, n = ([np.frombuffer(v.as_buffer(), kind) for v in rows.column(c)] for c, kind in (("h", np.uint32), ("n", np.uint8)))
    place = np.repeat(part.astype(np.uint64), np.fromiter(map(len, n), np.int64, len(n)))
    both = np.concatenate(h).astype(np.uint64) << np.uint64(32) | place
    order = np.argsort(both)
    both = both[order]
    new = np.flatnonzero(np.diff(both, prepend=~both[:1]))
    in_shard = np.add.reduceat(np.concatenate(n)[order], new, dtype=np.int64)
    h, part = both[new] >> np.uint64(32), (both[new] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(h, prepend=~h[:1]))
    keep = (np.add.reduceat(in_shard, new) >= support) & np.logical_or.reduceat(in_shard >= lowered[part], new)
    return pa.table({"h": (h[new][keep] | np.uint64(key[0].as_py() << 32)).view(np.int64)})


def _added(ids: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each distinct phrase once, a row of its words' numbers, with its hash and the sum of its counts."""
    key = ids[:, 0]
    for i in range(1, ids.shape[1]):
        # Numbers of words are below 2**31; from the second word on phrases get such numbers, too.
        key = (key if i == 1 else np.unique(key, return_inverse=True)[1]) << 31 | ids[:, i]
    _, first, place = np.unique(key, return_index=True, return_inverse=True)
    return ids[first], h[first], np.bincount(place, n, len(first)).astype(np.int64)


class Sums:
    """Counts of phrases of one task, by numbers that it gives to words."""

    def __init__(self, limits: Limits) -> None:
        self.limits, self.number, self.size = limits, {}, 0
        self.waiting: defaultdict[str, list[tuple]] = defaultdict(list)

    def add(self, lang: str, names: list[bytes], ids: np.ndarray, h: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Takes distinct phrases of a block, as rows of its words' numbers; gives what there is no room for."""
        used, number = np.unique(ids), self.number
        own = np.zeros(len(names), np.int64)
        own[used] = [number.setdefault(names[i], len(number)) for i in used.tolist()]
        self.waiting[lang].append((own[ids], h, n))
        self.size += len(n)
        if self.size >= self.limits.waiting >> 2:
            self.add_up()
            if self.size >= self.limits.waiting >> 4:
                yield from self.rest()

    def add_up(self) -> None:
        for lang, some in self.waiting.items():
            self.waiting[lang] = [_added(*map(np.concatenate, zip(*some)))]
        self.size = sum(len(n) for ((_, _, n),) in self.waiting.values())

    def rest(self) -> Iterator[pa.RecordBatch]:
        """lang, phrase, h, n, as text."""
        self.add_up()
        names = list(self.number)
        for lang, ((ids, h, n),) in self.waiting.items():
            for low in range(0, len(n), _ROWS):
                some = slice(low, low + _ROWS)
                phrases = [b" ".join([names[i] for i in row]) for row in ids[some].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(phrases), pa.string()), _texts(phrases), pa.array(h[some].view(np.int64)), pa.array(n[some])],
                    names=["lang", "phrase", "h", "n"])
        self.number, self.size = {}, 0
        self.waiting.clear()


def _count(made: DataFrame, k: int, frequent, candidates, limits: Limits) -> DataFrame:
    """lang, phrase, h, n: the candidates of k words, counted by their text in parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(limits)
        for batch in batches:
            for known, *block in zip(*batch.columns):
                tokens, hashes, names = _numbers(*block)
                at, h = phrases_at(tokens, hashes, known.as_py(), k, frequent.value)
                keep = candidates.value.has(h)
                at, h = at[keep], h[keep]
                if len(at):
                    ids = tokens[at[:, None] + np.arange(k)].astype(np.int64)
                    yield from sums.add(block[0].as_py(), names, *_added(ids, h, np.ones(len(h), np.int64)))
        yield from sums.rest()

    return made.select("known", "lang", "tokens", "words").mapInArrow(run, _COUNTED)


def _frequent(counted: DataFrame, k: int, limits: Limits) -> tuple[DataFrame, int]:
    """lang, phrase, f, h, k of the phrases that the whole corpus has often enough, and their number."""
    sums = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("f"), F.first("h").alias("h")).where(F.col("f") >= limits.support)
    path, count = write_counting(sums.withColumn("k", F.lit(k)), f"frequent-{k}", F.lit(True))
    return counted.sparkSession.read.schema("lang string, phrase string, f long, h long, k int").parquet(path), count


def frequent_phrases(docs: DataFrame, limits: Limits = Limits(), lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f, h, k): all phrases of 1 to ``limits.longest`` words that occur ``limits.support``
    times in their language; (lang, total): its number of words."""
    spark = docs.sparkSession
    made = blocks(docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                              F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text")), limits)
    sizes = materialize(made.groupBy("lang", "part").agg(F.sum("own").alias("own")), "shards")
    totals = sizes.groupBy("lang").agg(F.sum("own").alias("total")).where("total > 0")
    # As many rows as there are shards and languages: Spark sends them along if they are few.
    lowered = materialize(sizes.join(totals, "lang").select("part", F.ceil(limits.support * F.col("own") / F.col("total")).alias("support")), "supports")
    n_words = sizes.agg(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    shares = max(256, 1 << (n_words // limits.share_words).bit_length())

    def often(key: tuple, rows: pa.Table) -> pa.Table:
        return _often(limits.support, key, rows)

    # Any word may be frequent.
    found, count, sieve = None, 0, Sieve(np.full(1 << 12, 255, np.uint8))
    for k in range(1, limits.longest + 1):
        frequent = spark.sparkContext.broadcast(sieve)
        # Dealt by hash once: its counts in each shard, then those of all shards together.
        dealt = _mine(made, k, frequent, limits, functools.partial(_dealt_batch, shares), _DEALT).join(lowered, "part")
        union = dealt.groupBy("share").applyInArrow(often, "h long")
        path, size = write_counting(union, f"candidates-{k}", F.lit(True))
        candidates = spark.sparkContext.broadcast(Sieve.of(spark.read.schema("h long").parquet(path), size, limits))
        # What only the bitmap lets through is counted whole, too, and stays below the support.
        longer, more = _frequent(_count(made, k, frequent, candidates, limits), k, limits)
        found, count = longer if found is None else found.unionByName(longer), count + more
        del dealt, union
        release_shuffles(spark)
        if k < limits.longest:
            sieve = Sieve.of(found, count, limits)
    return found, totals


def _inner(phrase: Column, k: Column) -> Column:
    """A phrase without its last, and without its first word."""
    words = F.split(phrase, " ")
    return F.array(F.array_join(F.slice(words, F.lit(1), k - 1), " "), F.array_join(F.slice(words, F.lit(2), k - 1), " "))


def floor_ratio(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), in whole numbers of up to 38 digits."""
    def wide(c: Column, digits: int) -> Column:
        return c.cast(f"decimal({digits},0)")
    return F.call_function("div", wide(a * 1000, 20) * wide(n, 18), wide(left, 19) * wide(right, 19))


def collocations(docs: DataFrame, limits: Limits = Limits(), top: int = 2000, absorb_percent: int = 100,
                 lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A phrase's score is that of its worst cut in two: 1000 times how much more often the parts come
    together than if they were independent. A phrase that a longer one holds in at least
    ``absorb_percent`` of its places is left out; as counts fall with length, one word more is
    enough to look at.
    """
    with arrow_batches(docs.sparkSession, BATCH):
        found, totals = frequent_phrases(docs, limits, lang, text)
    phrases = found.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"))
    longer = phrases.where("k > 2").select("lang", F.explode(F.array_distinct(_inner(F.col("phrase"), F.col("k")))).alias("phrase"), "a") \
        .groupBy("lang", "phrase").agg(F.max("a").alias("of_longer"))
    whole = phrases.join(longer, ["lang", "phrase"], "left") \
        .where(F.coalesce(100 * F.col("of_longer") < absorb_percent * F.col("a"), F.lit(True))).drop("of_longer")
    cuts = whole.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    words = F.split("phrase", " ")
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("left"),
                       F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"))
    part = found.select("lang", "phrase", "f")
    cuts = cuts.join(part.toDF("lang", "left", "l"), ["lang", "left"]).join(part.toDF("lang", "right", "r"), ["lang", "right"]) \
        .join(totals.withColumnRenamed("total", "n"), "lang")
    score = floor_ratio(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("w")).select("lang", "phrase", "a", "w.l", "w.r", "n", "w.score")
    # A language may hold nearly all phrases: first the best of each part of it, then of those.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    (salt,) = free_names(worst, "part")
    some = worst.withColumn(salt, F.pmod(F.xxhash64("phrase"), F.lit(64))) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
