"""Near-duplicates by SimHash.

A fingerprint has a bit for each bit that is set in over half of the hashes of a text's word
shingles. Fingerprints are split into blocks such that close pairs share a block; they are
joined on blocks, and the pairs of a block are verified by their Hamming distance.

* ``ExactBlocks``: 64 bits in radius + 1 parts, so every pair within the radius shares one
  (pigeonhole).
* ``SampledBlocks``: for wide fingerprints and large radii, many sampled blocks, so that a
  pair at the stated share of different bits shares one with a stated probability.

A block that too many different fingerprints share is cut further by blocks of its remaining
bits, so no group of any size is compared whole: by the same pigeonhole argument, or by as many
sampled blocks as keep the probability; where that sends more rows, the block is dealt into
pages, and each two pages are compared. Sampled blocks may lose a pair in half as many cases on each
level as on the one above, so all levels together lose less than twice what the first may. Exact copies share a
fingerprint and count once. Of each group only links that span it are kept.

Defined cases: null and empty texts have fingerprint zero and are linked like any other,
texts of fewer words than a shingle hash their whole word sequence, repeated rows and null
ids are allowed (a null id is never a component's name unless all are null), an empty table
gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from murmuration.llm.components import components
from murmuration.runtime import materialize

#: Fingerprints that are compared with each other in one group, at most; beyond it blocks are refined.
GROUP = 1 << 11
_LANE = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str | None, width: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle of ``width`` words, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64_intdigest(joined, seed)], np.uint64)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:len(words) - width])]
    return np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1:])), np.uint64, len(starts))


def simhash(hashes: np.ndarray, lanes: int = 1) -> list[int]:
    """Signed 64-bit lanes of a fingerprint: lane 0 of the hashes, others of hashes mixed from them."""
    out = []
    for lane in range(lanes):
        counts = np.zeros(64, np.int64)
        for part in (hashes[i:i + (1 << 16)] for i in range(0, len(hashes), 1 << 16)):
            if lane:
                part = _mix(part + np.uint64(int(_LANE) * lane % (1 << 64)))
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.uint32)
        set_bits = np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]
        out.append(int(set_bits.astype(np.int64)))
    return out


def fingerprint_column(text: Column, width: int, lanes: int = 1, seed: int = 42, distinct: bool = False) -> Column:
    """array<long> of the fingerprint's lanes. ``distinct``: a repeated shingle counts once."""
    @F.pandas_udf("array<long>")
    def prints(texts: pd.Series) -> pd.Series:
        found = (shingle_hashes(t, width, seed) for t in texts)
        return pd.Series([simhash(np.unique(h) if distinct else h, lanes) for h in found])

    return prints(text)


class ExactBlocks(NamedTuple):
    """One lane; the bits that are left are cut into radius + 1 parts."""

    radius: int = 3

    def most_pages(self, level: int) -> int:
        return 0

    @functools.lru_cache(maxsize=1 << 14)
    def children(self, path: int) -> list[tuple[int, np.ndarray]]:
        """The blocks below a path (0 is the root): child path and bit mask, with the parent's bits."""
        fan = self.radius + 1
        parent = self.children((path - 1) // fan)[(path - 1) % fan][1] if path else np.zeros(1, np.uint64)
        left = [b for b in range(64) if not int(parent[0]) >> b & 1]
        return [(path * fan + i + 1, parent | np.uint64(sum(1 << b for b in left[i::fan]))) for i in range(fan)]


class SampledBlocks(NamedTuple):
    """Blocks of ``bits`` sampled bits, as many as give ``recall`` at ``distance_share``; a full
    block is refined by blocks of its own."""

    lanes: int
    bits: int
    distance_share: float = 0.15
    recall: float = 0.97
    refined_bits: int = 8
    seed: int = 7

    def tables(self, level: int) -> int:
        """Blocks on a level; below the first each level loses half of what the one above may."""
        bits = self.refined_bits if level else self.bits
        return tables_needed(self.distance_share, min(bits, 64 * self.lanes), 1 - (1 - self.recall) / 2 ** level)

    def most_pages(self, level: int) -> int:
        """Pages up to which comparing each two of them sends no more rows than refining."""
        return self.tables(level + 1)

    @functools.lru_cache(maxsize=1 << 14)
    def children(self, path: int) -> list[tuple[int, np.ndarray]]:
        """The blocks below a path, numbered level by level."""
        level, before, wide = 0, 0, 1  # paths above the level, and on it
        while path >= before + wide:
            level, before, wide = level + 1, before + wide, wide * self.tables(level)
        fan, place = self.tables(level), path - before
        parent = np.zeros(self.lanes, np.uint64)
        if level:
            above = self.tables(level - 1)
            parent = self.children(before - wide // above + place // above)[place % above][1]
        draw = np.random.default_rng([self.seed, path])
        left = np.array([b for b in range(64 * self.lanes) if not int(parent[b // 64]) >> (b % 64) & 1])
        out = []
        for i in range(fan):
            mask = parent.copy()
            for b in draw.choice(left, min(len(left), self.refined_bits if level else self.bits), replace=False):
                mask[b // 64] |= np.uint64(1 << int(b % 64))
            out.append((before + wide + place * fan + i, mask))
        return out


Blocks = ExactBlocks | SampledBlocks


def tables_needed(distance_share: float, bits: int, recall: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - (1 - distance_share) ** bits))


def _matrix(batch: pa.RecordBatch | pa.Table, lanes: int) -> np.ndarray:
    values = batch.column("print")
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return np.asarray(values.flatten()).astype(np.int64, copy=False).view(np.uint64).reshape(-1, lanes)


def _expand(blocks: Blocks, lanes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, paths = _matrix(batch, lanes), batch.column("path").to_numpy(zero_copy_only=False)
            for path in np.unique(paths):
                rows = np.flatnonzero(paths == path)
                chosen = batch.take(pa.array(rows))
                for child, mask in blocks.children(int(path)):
                    key = np.full(len(rows), child, np.uint64)
                    for lane in range(lanes):
                        key = _mix(key * _LANE + (prints[rows, lane] & mask[lane]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), child)), pa.array(key.view(np.int64)), chosen.column("node"), chosen.column("print")],
                        names=["path", "key", "node", "print"])
    return run


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row of each row's part in the graph of the links (a, b)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, b, label[a])
        np.minimum.at(label, a, label[b])
        label = label[label]
        if (label == before).all():
            return label


def _parts(prints: np.ndarray, groups: np.ndarray, radius: int) -> np.ndarray:
    """The least row of each row's part, by the pairs of equal group within the radius."""
    n = len(prints)
    firsts, seconds = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    rows = np.arange(n)
    shift = 1
    while True:
        # Rows that have a row of their group ``shift`` places behind them.
        rows = rows[rows + shift < n]
        rows = rows[groups[rows] == groups[rows + shift]]
        if not len(rows):
            break
        for part in np.array_split(rows, max(1, len(rows) >> 18)):
            apart = np.bitwise_count(prints[part] ^ prints[part + shift]).sum(axis=1, dtype=np.int64)
            near = part[apart <= radius]
            firsts.append(near)
            seconds.append(near + shift)
        shift += 1
    return _labels(n, np.concatenate(firsts), np.concatenate(seconds))


def _spanning(nodes: np.ndarray, prints: np.ndarray, groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its part) of the pairs of equal group within the radius."""
    label = _parts(prints, groups, radius)
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def by_groups(keys: list[str], run_groups: Callable[[pa.Table, np.ndarray], pa.RecordBatch]):
    """For ``mapInArrow`` on rows sorted by ``keys``: ``run_groups`` takes whole groups and their
    numbers. A group may go over batches; groups are bounded, and so is what is held."""
    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for key in keys:
            column = table.column(key).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            new = starts(table)
            last = int(np.flatnonzero(new)[-1])
            held = table.slice(last).to_batches()
            if last:
                yield run_groups(table.slice(0, last), np.cumsum(new[:last]))
        if held:
            table = pa.Table.from_batches(held)
            yield run_groups(table, np.cumsum(starts(table)))
    return run


def _verify(radius: int, lanes: int):
    """Links of sorted rows (path, key, node, print)."""
    def links(table: pa.Table, groups: np.ndarray) -> pa.RecordBatch:
        a, b = _spanning(table.column("node").to_numpy(), _matrix(table, lanes), groups, radius)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return by_groups(["path", "key"], links)


def clusters(nodes: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """cluster, node: the parts of several rows, named by a hash of their nodes, so that the same
    part of another block has the same name."""
    order = np.argsort(label, kind="stable")
    _, first, size = np.unique(label[order], return_index=True, return_counts=True)
    inside = order[np.repeat(size > 1, size)]
    first, size = np.cumsum(size[size > 1]) - size[size > 1], size[size > 1]
    hashes = _mix((nodes[inside].astype(np.uint64) + np.uint64(1)) * _LANE)
    name = np.add.reduceat(hashes, first) if len(first) else np.empty(0, np.uint64)
    name = np.repeat(_mix(name + size.astype(np.uint64)), size)
    return pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(nodes[inside])], names=["cluster", "node"])


def _gather(radius: int, lanes: int):
    """Parts of sorted rows (path, key, node, print)."""
    def parts(table: pa.Table, groups: np.ndarray) -> pa.RecordBatch:
        return clusters(table.column("node").to_numpy(), _parts(_matrix(table, lanes), groups, radius))

    return by_groups(["path", "key"], parts)


def near_links(nodes: DataFrame, blocks: Blocks, radius: int, lanes: int = 1, group: int = GROUP) -> DataFrame:
    """a, b: links that span the groups of near fingerprints. ``nodes`` has node (long) and
    print (array of ``lanes`` longs), distinct prints, and is read several times."""
    return _by_blocks(nodes, blocks, lanes, group, _verify(radius, lanes), "a long, b long")


def near_clusters(nodes: DataFrame, blocks: Blocks, radius: int, lanes: int = 1, group: int = GROUP) -> DataFrame:
    """cluster, node: at most ``group`` nodes of a block that links within the radius connect."""
    return _by_blocks(nodes, blocks, lanes, group, _gather(radius, lanes), "cluster long, node long")


def _by_blocks(nodes: DataFrame, blocks: Blocks, lanes: int, group: int, compare, schema: str) -> DataFrame:
    keyed_schema = "path long, key long, node long, print array<long>"
    half = max(1, group // 2)
    found = []
    going = nodes.select(F.lit(0).cast("long").alias("path"), "node", "print")
    for level in itertools.count():
        keyed = going.mapInArrow(_expand(blocks, lanes), keyed_schema)
        crowded = materialize(keyed.groupBy("path", "key").count().where(F.col("count") > group)
                              .select("path", "key", F.ceil(F.col("count") / half).cast("long").alias("pages")), "crowded")
        none = crowded.isEmpty()
        small = keyed if none else keyed.join(crowded, ["path", "key"], "left_anti")
        few = F.col("pages") <= blocks.most_pages(level)
        if not none and blocks.most_pages(level):
            small = small.unionAll(_paged(keyed.join(crowded.where(few), ["path", "key"])))
        found.append(materialize(
            small.repartition("path", "key").sortWithinPartitions("path", "key", "node")
            .mapInArrow(compare, schema).distinct(), "links"))
        if none or crowded.where(~few).isEmpty():
            return functools.reduce(DataFrame.unionAll, found)
        going = materialize(keyed.join(crowded.where(~few), ["path", "key"], "left_semi").select("path", "node", "print"), "crowd")


def _paged(keyed: DataFrame) -> DataFrame:
    """A block for each two of its pages, and for each page alone with itself."""
    page = F.pmod(F.xxhash64("node"), F.col("pages"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages") - 1))
    key = F.xxhash64("key", F.least("page", "other"), F.greatest("page", "other"))
    return keyed.withColumn("page", page).withColumn("other", other).select("path", key.alias("key"), "node", "print")


def wide_blocks(prints: int, lanes: int = 4, distance_share: float = 0.15, recall: float = 0.97) -> SampledBlocks:
    """Blocks for so many different fingerprints: some four of them share a block by chance, and a
    pair that differs in ``distance_share`` of its bits shares one with probability ``recall``."""
    bits = max(14, math.ceil(math.log2(max(1, prints) / 4)))
    # All levels together lose less than twice what the first does.
    return SampledBlocks(lanes, bits, distance_share, (1 + recall) / 2)


def near_groups(docs: DataFrame, width: int = 3, radius: int = 3, lanes: int = 1, distinct: bool = False,
                group: int = GROUP) -> DataFrame:
    """doc_id, print, component_id: ``docs`` has doc_id and text. ``component_id`` is the smallest
    doc_id among the documents that links reach. One lane: all links within the radius; more
    lanes: by ``wide_blocks``."""
    prints = materialize(docs.select("doc_id", fingerprint_column(F.col("text"), width, lanes, distinct=distinct).alias("print")), "prints")
    nodes = materialize(prints.groupBy("print").agg(F.min("doc_id").alias("least"))
                        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    blocks = ExactBlocks(radius) if lanes == 1 else wide_blocks(nodes.count(), lanes)
    parts = components(near_links(nodes.select("node", "print"), blocks, radius, lanes, group))
    named = nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(names, "component").select("print", "component_id"), "named")
    return prints.join(named, "print").select("doc_id", "print", "component_id")
