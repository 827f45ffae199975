"""Near-duplicates by the exact Jaccard similarity of texts' shingle sets.

Candidates are gathered in clusters of bounded size, and only links that reach the similarity
by their shingle sets count:

* Sets of over ``SHORT`` shingles: SimHash fingerprints within ``RADIUS`` bits that share a
  sampled block (``simhash.wide_blocks``).
* Small sets, whose fingerprints scatter too much: an inverted join on prefixes. In any common
  order of the shingles, two sets of similarity s share one among the first n - ceil(s n) + 1
  of each. Rare shingles come first. A prefix shingle that too many sets share is dealt into
  pages, and each two pages are compared.

Equal sets count once; texts without words have the empty set and are copies of each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from murmuration.llm import simhash
from murmuration.llm.components import components
from murmuration.runtime import materialize

#: Lanes of 64 fingerprint bits; bits in which candidates differ at most. Sets of over SHORT
#: shingles at a similarity of 0.8 differ in 39 of 256 with a deviation of 5.7.
LANES, RADIUS = 4, 60
SHORT = 64
#: Probability with which candidates at the similarity share a block.
RECALL = 0.99
SEED = 42
#: Counters by which shingles of small sets are ordered.
_COUNTERS = 1 << 20


def _set(text: str | None, width: int) -> np.ndarray:
    return np.unique(simhash.shingle_hashes(text, width, SEED))


def _prints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, size, print, digest of each text's shingle set."""
    @F.pandas_udf("size long, digest long, print array<long>")
    def prints(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            s = _set(text, width)
            whole = np.array([xxh64_intdigest(s.tobytes(), SEED)], np.uint64).view(np.int64)[0]
            rows.append((len(s), int(whole), simhash.simhash(s, LANES)))
        return pd.DataFrame(rows, columns=["size", "digest", "print"])

    return docs.select("doc_id", prints(F.col("text")).alias("of")).select("doc_id", "of.*")


def _prefix_clusters(sets: DataFrame, share: float, group: int) -> DataFrame:
    """cluster, node: nodes whose prefixes share a shingle. ``sets`` has node and shingles."""
    slot = F.col("shingle").bitwiseAND(F.lit(_COUNTERS - 1))
    seen = sets.select(F.explode("shingles").alias("shingle")).groupBy(slot.alias("slot")).count().toArrow()
    often = np.zeros(_COUNTERS, np.int64)
    often[seen.column("slot").to_numpy()] = seen.column("count").to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(np.minimum(often, (1 << 31) - 1).astype(np.int32))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners = [np.empty(0, np.int64)], []
            for row in batch.column("shingles"):
                s = np.asarray(row.values).astype(np.int64)
                order = np.lexsort((s, shared.value[s & (_COUNTERS - 1)]))
                keys.append(s[order[:len(s) - math.ceil(share * len(s) - 1e-9) + 1]])
                owners.append(len(keys[-1]))
            nodes = np.repeat(batch.column("node").to_numpy(), owners)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(nodes)], names=["key", "node"])

    def whole(table: pa.Table, groups: np.ndarray) -> pa.RecordBatch:
        return simhash.clusters(table.column("node").to_numpy(), groups)

    keyed = materialize(sets.mapInArrow(prefixes, "key long, node long"), "prefixes")
    half = max(1, group // 2)
    crowded = materialize(keyed.groupBy("key").count().where(F.col("count") > group)
                          .select("key", F.ceil(F.col("count") / half).cast("long").alias("pages")), "crowded")
    small = keyed.join(crowded, "key", "left_anti").select("key", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "node")
    if not crowded.isEmpty():
        # Each page meets each other one and itself.
        page = F.pmod(F.xxhash64("node"), F.col("pages"))
        dealt = keyed.join(crowded, "key").withColumn("page", page) \
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages") - 1)))
        small = small.unionAll(dealt.select("key", F.least("page", "other").alias("a"), F.greatest("page", "other").alias("b"), "node"))
    return small.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "node") \
        .mapInArrow(simhash.by_groups(["key", "a", "b"], whole), "cluster long, node long").distinct()


def _similar_pairs(sets: list[np.ndarray], share: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of sets whose Jaccard similarity reaches ``share``."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    both = np.zeros((n, n), np.int64)
    # Shingles of few sets by their pairs, the others by matrices.
    few = np.flatnonzero((count[column] > 1) & (count[column] < 16))
    few = few[np.argsort(column[few], kind="stable")]
    for shift in range(1, 16):
        a, b = few[:-shift], few[shift:]
        same = column[a] == column[b]
        if not same.any():
            break
        both += np.bincount(owner[a[same]] * n + owner[b[same]], minlength=n * n).reshape(n, n)
    many = np.flatnonzero(count >= 16)
    place = np.full(len(values), -1, np.int64)
    place[many] = np.arange(len(many))
    at = place[column]
    for start in range(0, len(many), 4096):
        chosen = np.flatnonzero((at >= start) & (at < start + 4096))
        held = np.zeros((n, min(4096, len(many) - start)), np.float32)
        held[owner[chosen], at[chosen] - start] = 1
        both += np.triu(held @ held.T, 1).astype(np.int64)
    a, b = np.nonzero(np.triu(both, 1))
    near = both[a, b] >= share * (sizes[a] + sizes[b] - both[a, b])
    return a[near], b[near]


def _exact(share: float):
    """Links that span the parts of sorted rows (cluster, node, shingles)."""
    def links(table: pa.Table, groups: np.ndarray) -> pa.RecordBatch:
        nodes, column = table.column("node").to_numpy(), table.column("shingles").combine_chunks()
        flat, ends = np.asarray(column.values), np.asarray(column.offsets)
        firsts, seconds = [nodes[:0]], [nodes[:0]]
        cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1), len(nodes)]
        for start, stop in zip(cuts, cuts[1:]):
            a, b = _similar_pairs([flat[ends[i]:ends[i + 1]] for i in range(start, stop)], share)
            label = simhash._labels(stop - start, a, b)
            moved = np.flatnonzero(label != np.arange(stop - start))
            firsts.append(nodes[start + moved])
            seconds.append(nodes[start + label[moved]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(firsts)), pa.array(np.concatenate(seconds))], names=["a", "b"])

    return simhash.by_groups(["cluster"], links)


def groups(docs: DataFrame, width: int = 5, share: float = 0.8, group: int = simhash.GROUP) -> DataFrame:
    """doc_id, component_id: ``docs`` has doc_id (not null, unique) and text, and is read several
    times. ``component_id`` is the smallest doc_id among the documents that links reach."""
    @F.pandas_udf("array<long>")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([_set(t, width).view(np.int64) for t in texts])

    prints = materialize(_prints(docs, width), "prints")
    nodes = materialize(prints.groupBy("print", "digest").agg(F.min("doc_id").alias("least"), F.first("size").alias("size"))
                        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    wide = nodes.where(F.col("size") > SHORT).select("node", "print")
    small = nodes.where(F.col("size").between(1, math.ceil(SHORT / share))).select("node", F.col("least").alias("doc_id"))
    small = materialize(docs.join(small, "doc_id").select("node", shingles("text").alias("shingles")), "small")
    blocks = simhash.wide_blocks(wide.count(), LANES, recall=RECALL)
    found = simhash.near_clusters(wide, blocks, RADIUS, LANES, group).unionAll(_prefix_clusters(small, share, group))
    found = materialize(found.distinct(), "clusters")
    wanted = nodes.join(found.select("node").distinct(), "node", "left_semi").select("node", F.col("least").alias("doc_id"))
    sets = docs.join(wanted, "doc_id").select("node", shingles("text").alias("shingles"))
    links = found.join(sets, "node").select("cluster", "node", "shingles").repartition("cluster") \
        .sortWithinPartitions("cluster", "node").mapInArrow(_exact(share), "a long, b long").distinct()
    named = nodes.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(names, "component").select("print", "digest", "component_id"), "named")
    return prints.join(named, ["print", "digest"]).select("doc_id", "component_id")
