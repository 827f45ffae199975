"""Suggestions for many people: all pairs of selected people and candidates, in blocks.

The score of a pair is a sum over what both have: ``affinity`` writes that out as rows, which for a
share of all people are some hundred rows for each of quadratically many pairs. Here what people have
is numbered, people are put into blocks of bounded size, and a task multiplies one block of selected
people with one block of candidates after the other, keeping the best ``top_k`` so far. The static
scores of all pairs are made, so that work grows with candidates times selected people; rows shuffled
do with each of them. In a window a pair is looked at if the candidate's own activity and the best
static score of the block could reach a rank, or if both were active on the same target. The most
active candidates come first, so that ranks are high early.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration.operators import affinity
from murmuration.operators.scan import prefix_scan
from murmuration.params import Params
from murmuration.runtime import arrow_batches, dealt, materialize

#: People in a block of selected people and of candidates.
SELECTED_BLOCK, CANDIDATE_BLOCK = 2048, 2048
#: A key goes through matrices if this many times its pairs in two blocks are more than all pairs; a window's shared
#: targets do if they make more pairs than this share of all.
DENSE, CROWDED = 512, 8
#: Stands for a window without a time.
NO_TIME = -(1 << 62)

# What a trait of a selected person counts as, for candidates with the same key among these traits. A forum of a
# selected person counts for its members and for its moderators.
_COUNTS = {
    "member": {"member": "sameForumMember", "moderator": "sameForumMemberModerator"},
    "moderator": {"moderator": "sameForumModerator", "member": "sameForumMemberModerator"},
    "year": {"year": "sameAge"}, "browser": {"browser": "sameBrowser"},
    "tag": {"tag": "sameInterestTag"}, "language": {"language": "sameLanguage"},
}


def _static(person: DataFrame, member: DataFrame, moderator: DataFrame, interest: DataFrame, language: DataFrame,
            people: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """What selected people have (person_id, kind, key, value), value in score units, and all people (person_id, kind, key)."""
    def has(df: DataFrame, kind: str, key) -> DataFrame:
        return df.select("person_id", F.lit(kind).alias("kind"), key.cast("string").alias("key")).filter(
            "person_id is not null and key is not null")

    tables = [("member", member, "forum_id"), ("moderator", moderator, "forum_id"), ("year", person, "birth_year"),
              ("browser", person, "browser"), ("tag", interest, "tag"), ("language", language, "language")]
    # Written out once: memberships and interests are made by joins over all purchases.
    theirs = materialize(reduce(DataFrame.unionByName, [has(df, kind, F.col(key)) for kind, df, key in tables]), "traits")
    band = F.explode(F.sequence(F.col("birth_year") - p.age_range, F.col("birth_year") + p.age_range))
    ours = affinity._of(people, theirs.filter("kind <> 'year'")).unionByName(
        has(affinity._of(people, person).withColumn("year", band), "year", F.col("year")))
    own = materialize(dealt(ours, theirs.count(), "person_id").distinct(), "traits-of-selected")
    spread = F.coalesce(*[F.when(F.col("kind") == kind, F.array(*[
        F.struct(F.lit(at).alias("kind"), affinity.weight_of(p.weights, F.lit(feature)).alias("value"))
        for at, feature in counts.items()])) for kind, counts in _COUNTS.items()])
    return own.select("person_id", "key", F.explode(spread).alias("e")).select("person_id", "e.kind", "key", "e.value"), theirs


def _shared(slices: DataFrame, people: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """The same for activity on targets; the key holds the window, and the window it counts in again."""
    rows = affinity._windows(affinity._slices(slices.filter("target is not null and person_id is not null and ts_ms is not null"),
                                              ["kind", "target", "person_id"], p), ["kind", "target", "person_id"], p)
    again = F.explode(F.array(*[F.col("window_end_ms") + i * p.slide_ms for i in range(p.window_ms // p.slide_ms)]))
    rows = materialize(rows.withColumn("at", again).select(
        "person_id", F.col("kind"), F.concat_ws(" ", "at", "window_end_ms", "target").alias("key"), "n", F.col("at").alias("window_end_ms")),
        "shared")
    feature = F.coalesce(*[F.when(F.col("kind") == k, name) for k, name in affinity.SHARED_FEATURES.items()])
    mine = affinity._of(people, rows).select("person_id", "kind", "key", affinity.weight_of(p.weights, feature).alias("value"))
    return mine, rows


def _keys(rows: DataFrame, name: str) -> DataFrame:
    """(kind, key, key_no): the distinct keys numbered from 0."""
    one = rows.select("kind", "key").distinct().withColumn("_one", F.lit(1).cast("long"))
    numbered = prefix_scan(one, order=["kind", "key"], sums={"key_no": "_one"})
    return materialize(numbered.select("kind", "key", (F.col("key_no") - 1).cast("int").alias("key_no")), name)


def _listed(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """One row per person with ``rows`` as an array."""
    return rows.groupBy("person_id").agg(F.collect_list(F.struct(*columns)).alias(name))


def _of_lists(batch, name: str, *fields: str) -> list[np.ndarray]:
    """Row numbers of the structs in the arrays of a column, and their fields."""
    column = batch.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    return [np.repeat(np.arange(len(column)), n)] + [flat.field(f).to_numpy(zero_copy_only=False) for f in fields]


def candidate_blocks(windows: list[int]):
    """Function from people with what they have to one packed row per batch of them."""
    of_lists = _by_value(_of_lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ends, made = np.array(windows, np.int64), TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            traits = batch.column("traits")
            many = traits.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int32)
            key = traits.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            who, end, base = of_lists(batch, "acting", "window_end_ms", "base")
            w = np.searchsorted(ends, end)
            # The most active first, in each window.
            order = np.lexsort((-base, w))
            acting = [w[order].astype(np.int32), who[order].astype(np.int32), base[order]]
            who, end, key_no, n = of_lists(batch, "shared", "window_end_ms", "key_no", "n")
            w = np.searchsorted(ends, end)
            order = np.argsort(w, kind="stable")
            shared = [w[order].astype(np.int32), who[order].astype(np.int32), key_no[order].astype(np.int32), n[order]]
            data = pickle.dumps((batch.column("id").to_numpy(), batch.column("person_id"), many, key, acting, shared), 5)
            yield pa.RecordBatch.from_arrays([pa.array([made], pa.int64()), pa.array([data], pa.binary())], names=["c_block", "c_data"])
            made += 1

    return run


def selected_blocks():
    """Function from the selected people of a block with what they have to one packed row."""
    of_lists = _by_value(_of_lists)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        who, key, value = of_lists(table, "traits", "key_no", "value")
        at, target, weight = of_lists(table, "shared", "key_no", "value")
        # A block goes to its task once for each block of candidates. There are few weights.
        values, value = np.unique(value, return_inverse=True)
        data = pickle.dumps((
            table.column("id").to_numpy(), table.column("person_id").combine_chunks(),
            (np.bincount(who, minlength=table.num_rows).astype(np.int32), key.astype(np.int32), values, value.astype(np.min_scalar_type(len(values)))),
            (at.astype(np.int32), target.astype(np.int32), weight), of_lists(table, "friends", "friend")), 5)
        return pa.table({"s_block": table.column("s_block").slice(0, 1), "s_data": pa.array([data], pa.binary())})

    return run


def _by_value(function):
    """A copy of a function of this module that goes to workers as a whole, not by its name."""
    import types

    copy = types.FunctionType(function.__code__, {"np": np, "pa": pa}, function.__name__, function.__defaults__)
    copy.__module__ = "__main__"
    return copy


def best_pairs(top_k: int, windows: list[int], kinds: list[int], n_keys: int, n_shared: int, person_type: pa.DataType):
    """Function over rows of a packed block of selected people and one of candidates: the ``top_k`` best candidates of
    each selected person and window among all candidates of the task. ``kinds``: the first key number of each kind of trait."""
    dense, crowded, no_time, n_windows, last = DENSE, CROWDED, NO_TIME, len(windows), np.iinfo(np.int64).max

    class Index:
        """Entries (person, key, value) by key."""

        def __init__(self, who: np.ndarray, key: np.ndarray, value: np.ndarray, size: int):
            order = np.argsort(key, kind="stable")
            self.who, self.key, self.value = who[order], key[order], value[order]
            self.count = np.bincount(key, minlength=size)
            self.start = np.cumsum(self.count) - self.count

        def pairs(self, who: np.ndarray, key: np.ndarray, limit: int = 1 << 21) -> Iterator[tuple]:
            """Entries (who, key) beside those of the index with the same key: numbers of both, some at a time."""
            n = self.count[key]
            some = np.flatnonzero(n)
            n, key = n[some], key[some]
            total = np.cumsum(n)
            cuts = np.unique(np.searchsorted(total, np.arange(limit, total[-1], limit))) if len(n) else []
            for part in np.split(np.arange(len(n)), cuts):
                m = n[part]
                first = np.repeat(self.start[key[part]] - (np.cumsum(m) - m), m)
                yield np.repeat(some[part], m), first + np.arange(len(first))

    class Selected:
        """A block of selected people and the best of what they were beside so far."""

        def __init__(self, data: bytes):
            self.ids, self.names, (many, key, values, value), (at, target, weight), (self.knows, self.friend) = pickle.loads(data)
            n = self.n = len(self.ids)
            who, value = np.repeat(np.arange(n), many), values[value] if len(values) else np.empty(0)
            # A forum may count for several reasons.
            code, back = np.unique(who * n_keys + key, return_inverse=True)
            value = np.bincount(back, value, len(code))
            who, key = code // max(1, n_keys), code % max(1, n_keys)
            self.traits, free = Index(who, key, value, n_keys), value == 0
            self.free = Index(who[free], key[free], value[free], n_keys) if free.any() else None
            self.most = value.max(initial=0)
            self.shared = Index(at, target, weight.astype(float), n_shared)
            self.often, self.buffers = None, {}
            # Of each window, and last of the static scores alone: score, number and place, best first.
            shape = (n_windows + 1, n, top_k)
            self.score, self.id, self.at = np.full(shape, -1.0), np.full(shape, last), np.full(shape, -1)
            # Candidates' names and what they did, by place.
            self.places, self.others, self.acted = 0, [], []

        def keep(self, w: int, who: np.ndarray, ids: np.ndarray, at: np.ndarray, score: np.ndarray) -> None:
            floor = self.score[w, who, -1]
            good = np.flatnonzero((score > floor) | ((score == floor) & (ids < self.id[w, who, -1])))
            if not len(good):
                return
            rows, group = np.unique(who[good], return_inverse=True)
            both = [np.concatenate([x[w, rows].ravel(), y[good]]) for x, y in ((self.score, score), (self.id, ids), (self.at, at))]
            group = np.concatenate([np.repeat(np.arange(len(rows)), top_k), group])
            order = np.lexsort((both[1], -both[0], group))
            best = order[np.searchsorted(group[order], np.arange(len(rows)))[:, None] + np.arange(top_k)]
            for x, y in zip((self.score, self.id, self.at), both):
                x[w, rows] = y[best]

        def buffer(self, name: str, n: int, kind) -> np.ndarray:
            """Zeroed when made: selected people x candidates."""
            if self.buffers.get((name, kind), np.empty(0)).size < self.n * n:
                self.buffers[name, kind] = np.zeros(self.n * n, kind)
            return self.buffers[name, kind][:self.n * n]

        def beside(self, data: bytes) -> None:
            """Score a block of candidates."""
            ids, names, many, key, (w, acting, base), shared = pickle.loads(data)
            n, place = len(ids), self.places
            who, acting = np.repeat(np.arange(n), many), acting.astype(np.int64)
            self.places += n
            self.others.append(names)
            self.acted.append((acting + place) * n_windows + w)
            order = np.argsort(ids)
            barred = []
            for left, right in ((np.arange(self.n), self.ids), (self.knows, self.friend)):
                at = np.minimum(np.searchsorted(ids, right, sorter=order), n - 1)
                same = ids[order[at]] == right
                barred.append(left[same] * n + order[at[same]])
            barred = np.concatenate(barred)
            # Whole numbers below 2^24 are exact in 32 bits.
            kind = np.float32 if 2 * base.max(initial=0) + self.most * many.max(initial=0) < 1 << 24 else np.float64
            # Keys that many have go through matrices.
            often = np.flatnonzero(np.bincount(key, minlength=n_keys) * self.traits.count * dense > self.n * n)
            if self.often is None or not np.array_equal(often, self.often):
                self.often, self.slot, self.matrix = often, np.full(n_keys, -1), {}
                self.slot[often] = np.arange(len(often))
            if kind not in self.matrix:
                at = self.slot[self.traits.key]
                self.matrix[kind] = np.zeros((self.n, len(often)), kind)
                self.matrix[kind][self.traits.who[at >= 0], at[at >= 0]] = self.traits.value[at >= 0]
            mine, at = self.matrix[kind], self.slot[key]
            here = at >= 0
            theirs = np.bincount(who[here] * len(often) + at[here], minlength=n * len(often)).reshape(n, len(often)).astype(kind)
            value, who_else, key_else = self.traits.value.astype(kind), who[~here], key[~here]
            if not len(w) and not self.free:
                # No score of a selected person is above ``most``, but for those with other keys in common.
                floor, last_id = self.score[n_windows, :, -1], self.id[n_windows, :, -1]
                most, cuts = np.zeros(self.n), np.searchsorted(often, kinds + [n_keys])
                for i, j in zip(cuts, cuts[1:]):
                    # Of a kind that candidates have few of, such as a year, few can count.
                    if i < j:
                        some = mine[:, i:j]
                        most += np.minimum(some @ theirs[:, i:j].max(axis=0), some.max(axis=1) * theirs[:, i:j].sum(axis=1).max())
                rows = np.flatnonzero((most > np.maximum(floor, 0)) | ((most == floor) & (ids.min() < last_id)))
                if 2 * len(rows) <= self.n:
                    return self.few(rows, most, mine, theirs, who_else, key_else, value, barred, ids, place, kind)
            out = np.matmul(mine, theirs.T, out=self.buffer("scores", n, kind).reshape(self.n, n))
            flat = out.reshape(-1)
            for i, j in self.traits.pairs(who_else, key_else):
                np.add.at(flat, self.traits.who[j] * n + who_else[i], value[j])
            flat[barred] = -np.inf
            top = out.max(axis=1).astype(float)
            # Static scores alone. Whoever has nothing in common does not count.
            floor = np.maximum(self.reach(n_windows, out[:, :256], 0.5), 0.5)
            self.take(n_windows, np.flatnonzero(top >= floor), np.arange(n), out, None, floor, ids, place, None)
            if self.free:
                low, code = self.score[n_windows, :, -1] < 0.5, np.empty(0, np.int64)
                for i, j in self.free.pairs(who, key) if low.any() else ():
                    s, c = self.free.who[j], who[i]
                    code = np.union1d(code, (s * n + c)[low[s] & (out[s, c] == 0)])
                s, c = np.divmod(code, n)
                self.keep(n_windows, s, ids[c], place + c, np.zeros(len(s)))
            base_of = np.zeros(n)
            for end in np.unique(w):
                first, after = np.searchsorted(w, (end, end + 1))
                self.window(end, out, top, acting[first:after], base[first:after].astype(float), base_of,
                            [x[slice(*np.searchsorted(shared[0], (end, end + 1)))] for x in shared[1:]], ids, place)

        def few(self, rows, most, mine, theirs, who, key, value, barred, ids, place: int, kind) -> None:
            """Keep static scores of all candidates for some selected people, and for the others where more than ``most`` is needed
            of those that they have keys of ``who`` in common with."""
            n, w = len(ids), n_windows
            flat = self.buffer("others", n, kind)
            for i, j in self.traits.pairs(who, key):
                np.add.at(flat, self.traits.who[j] * n + who[i], value[j])
            flat[barred] = -np.inf
            others, floor = flat.reshape(self.n, n), np.maximum(self.score[w, :, -1], 0.5)
            for some in (rows[i:i + 256] for i in range(0, len(rows), 256)):
                scores = mine[some] @ theirs.T + others[some]
                s, c = np.nonzero(scores >= floor[some][:, None])
                self.keep(w, some[s], ids[c], place + c, scores[s, c].astype(float))
            # What must come from other keys, and from one at least.
            need = np.maximum(floor - most, 0.5).astype(kind)
            need[rows] = np.inf
            for i in range(0, self.n, 256):
                s, c = np.nonzero(others[i:i + 256] >= need[i:i + 256, None])
                for x, y in ((s[j:j + 65536] + i, c[j:j + 65536]) for j in range(0, len(s), 65536)):
                    self.keep(w, x, ids[y], place + y, (np.einsum("ij,ij->i", mine[x], theirs[y]) + others[x, y]).astype(float))
            flat.fill(0)

        def reach(self, w: int, scores: np.ndarray, least: float, base: np.ndarray | None = None) -> np.ndarray:
            """Scores that the next candidates must have: of the last rank, where there is one, or of some candidates."""
            floor = self.score[w, :, -1].copy()
            new = np.flatnonzero(floor < 0)
            if len(new) and scores.shape[1] >= top_k:
                some = scores[new] if base is None else scores[new] + base
                kth = np.partition(some, some.shape[1] - top_k, axis=1)[:, some.shape[1] - top_k]
                floor[new] = np.where(kth >= least, kth, -1)
            return floor

        def take(self, w: int, rows: np.ndarray, cols: np.ndarray, out: np.ndarray, base, floor: np.ndarray, ids, place: int, but) -> None:
            """Keep what is good enough of some selected people (``rows``) and candidates, save for pairs of ``but``."""
            step, n, floor = 256, out.shape[1], floor.astype(out.dtype)
            base = None if base is None else base.astype(out.dtype)
            for some in (rows[i:i + step] for i in range(0, len(rows), step)):
                scores = out[some] if base is None else out[some][:, cols] + base
                s, c = np.nonzero(scores >= floor[some][:, None])
                score, s, c = scores[s, c].astype(float), some[s], cols[c]
                if but is not None and len(but):
                    code = s * n + c
                    new = but[np.minimum(np.searchsorted(but, code), len(but) - 1)] != code
                    score, s, c = score[new], s[new], c[new]
                self.keep(w, s, ids[c], place + c, score)

        def window(self, w: int, out, top, acting, base, base_of, shared, ids, place: int) -> None:
            who, key, n = shared
            size, index = out.shape[1], self.shared
            floor = np.maximum(self.reach(w, out[:, acting[:256]], 0, base[:256]), 0)
            if index.count[key].sum() * crowded > self.n * len(acting):
                scores = np.zeros((self.n, len(acting)))
                column = np.empty(size, np.int64)
                column[acting] = np.arange(len(acting))
                for i, j in index.pairs(who, key):
                    np.add.at(scores.reshape(-1), index.who[j] * len(acting) + column[who[i]], index.value[j] * n[i])
                scores += out[:, acting]
                scores += base
                floor = np.maximum(self.reach(w, scores[:, :256], 0), 0)
                s, c = np.nonzero(scores >= floor[:, None])
                return self.keep(w, s, ids[acting[c]], place + acting[c], scores[s, c])
            code = None
            found = [(index.who[j] * size + who[i], index.value[j] * n[i]) for i, j in index.pairs(who, key)]
            if found:
                code, back = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
                base_of[acting] = base
                s, c = np.divmod(code, size)
                score = np.bincount(back, np.concatenate([x for _, x in found]), len(code)) + out[s, c] + base_of[c]
                good = score >= floor[s]
                self.keep(w, s[good], ids[c[good]], place + c[good], score[good])
                floor = np.maximum(floor, self.score[w, :, -1])
            rows = np.flatnonzero(top + base[0] >= floor)
            if len(rows):
                enough = np.searchsorted(-base, (top - floor)[rows].max(), "right")
                self.take(w, rows, acting[:enough], out, base[:enough], floor, ids, place, code)

        def found(self) -> Iterator[pa.RecordBatch]:
            acted = np.sort(np.concatenate(self.acted))
            names = pa.chunked_array(self.others, person_type).combine_chunks()
            score, ids, at = self.score[-1], self.id[-1], self.at[-1]
            for w, end in enumerate(windows):
                # Without activity in a window, only the best by static scores can reach a rank.
                code = at * n_windows + w
                i = np.minimum(np.searchsorted(acted, code), max(0, len(acted) - 1))
                s, k = np.nonzero((score >= 0) & ((acted[i] != code) if len(acted) else True))
                self.keep(w, s, ids[s, k], at[s, k], score[s, k])
                s, k = np.nonzero(self.score[w] >= 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array([None if end == no_time else end] * len(s), pa.int64()), self.names.take(pa.array(s)), pa.array(k + 1, pa.int64()),
                    names.take(pa.array(self.at[w, s, k])), pa.array(self.score[w, s, k].astype(np.int64)), pa.array(self.id[w, s, k])],
                    names=["window_end_ms", "selected_id", "rank", "candidate_id", "score", "number"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {}
        for batch in batches:
            numbers, ours, theirs = (batch.column(x) for x in ("s_block", "s_data", "c_data"))
            for row, number in enumerate(numbers.to_pylist()):
                if number not in blocks:
                    blocks[number] = Selected(ours[row].as_buffer())
                blocks[number].beside(theirs[row].as_buffer())
        for block in blocks.values():
            yield from block.found()

    return run


def suggest(rows: DataFrame, tables: list[DataFrame], knows: DataFrame, p: Params, selected: DataFrame) -> DataFrame:
    """``affinity.suggest`` of activity ``rows`` and of people's ``tables`` (those of ``affinity.static_units``)."""
    spark = rows.sparkSession
    slices = materialize(affinity._slices(rows, ["kind", "target", "person_id"], p).withColumnRenamed("slice_ms", "ts_ms"), "activity-slices")
    people = selected.select(F.col("selected_id")).filter("selected_id is not null").distinct()
    mine, theirs = _static(*tables, people, p)
    ours, others = _shared(slices, people, p)
    base = materialize(affinity._windowed_again(affinity.own_features(slices, p), ["candidate_id"], p).select(
        F.coalesce("window_end_ms", F.lit(NO_TIME)).alias("window_end_ms"), F.col("candidate_id").alias("person_id"), F.col("score").alias("base")), "base")
    windows = sorted(r.window_end_ms for r in base.select("window_end_ms").distinct().collect())
    keys, targets = _keys(mine, "keys"), _keys(ours, "targets")
    on = ["kind", "key"]

    # What all people have, one row each.
    traits = materialize(dealt(theirs.join(keys, on).select("person_id", "key_no"), theirs.count(), "person_id").groupBy("person_id").agg(
        F.collect_list("key_no").alias("traits")), "static")
    acting = _listed(base.filter("person_id is not null"), "acting", "window_end_ms", "base").withColumn(
        "most", F.array_max(F.transform("acting", lambda x: x["base"])))
    shared = _listed(others.join(targets, on), "shared", "window_end_ms", "key_no", "n")
    everyone = reduce(DataFrame.unionAll, [df.select("person_id") for df in (traits, base.filter("person_id is not null"))] + [people]).distinct()
    # People by their place in the order of ids.
    # ``affinity.id_order``, but texts with other letters than a number's are not cast: a cast that fails is slow.
    number = F.when(~F.col("person_id").cast("string").rlike(r"[^0-9+.\x00-\x20\x7f-]"), F.col("person_id").try_cast("long"))
    order = materialize(everyone.orderBy(number.asc_nulls_last(), "person_id").withColumn("id", F.monotonically_increasing_id()), "people")
    candidates = order
    for df in (traits, acting, shared):
        candidates = candidates.join(df, "person_id", "left")
    with arrow_batches(spark, "256m", CANDIDATE_BLOCK):
        c_blocks = materialize(candidates.orderBy(F.desc_nulls_last("most"), "id").select("id", "person_id", "traits", "acting", "shared").mapInArrow(
            candidate_blocks(windows), "c_block long, c_data binary"), "candidate-blocks")

    s_blocks_n = max(1, -(-people.count() // SELECTED_BLOCK))
    chosen = materialize(order.join(people.withColumnRenamed("selected_id", "person_id"), "person_id", "left_semi").withColumn(
        "s_block", F.pmod(F.xxhash64("id"), F.lit(s_blocks_n))), "selected-people")
    friend = F.explode(F.array(F.struct(F.col("person1_id").alias("person_id"), F.col("person2_id").alias("f")),
                               F.struct(F.col("person2_id").alias("person_id"), F.col("person1_id").alias("f"))))
    friends = affinity._of(people, knows.select(friend.alias("e")).select("e.person_id", "e.f").distinct()).join(
        order.select(F.col("person_id").alias("f"), F.col("id").alias("friend")), "f")
    mine_listed = _listed(dealt(mine.join(keys, on).select("person_id", "key_no", "value"), theirs.count(), "person_id"), "traits", "key_no", "value")
    ours_listed = _listed(ours.join(targets, on), "shared", "key_no", "value")
    for df in (mine_listed, ours_listed, _listed(friends, "friends", "friend")):
        chosen = chosen.join(df, "person_id", "left")
    s_blocks = materialize(chosen.groupBy("s_block").applyInArrow(selected_blocks(), "s_block long, s_data binary"), "selected-blocks")

    # Each task has one block of selected people; where these are few, each takes a part of the candidates.
    tasks = 2 * spark.sparkContext.defaultParallelism
    parts = max(1, min(-(-tasks // s_blocks_n), -(-order.count() // CANDIDATE_BLOCK) // 8))
    dealt_out = c_blocks.repartition(parts, "c_block").sortWithinPartitions("c_block").hint("shuffle_replicate_nl")
    pairs = dealt_out.crossJoin(s_blocks.repartitionByRange(s_blocks_n, "s_block")).select("s_block", "s_data", "c_data")
    person = order.schema["person_id"].dataType
    schema = T.StructType([T.StructField(name, person if name.endswith("_id") else T.LongType()) for name in (
        "window_end_ms", "selected_id", "rank", "candidate_id", "score", "number")])
    person_type = pa.int64() if isinstance(person, T.LongType) else pa.int32() if isinstance(person, T.IntegerType) else pa.string()
    with arrow_batches(spark, "16m"):
        kinds = sorted(r.first for r in keys.groupBy("kind").agg(F.min("key_no").alias("first")).collect())
        found = materialize(pairs.mapInArrow(best_pairs(p.top_k, windows, kinds, keys.count(), targets.count(), person_type), schema), "best-pairs")
    if parts > 1:
        ranked = Window.partitionBy("window_end_ms", "selected_id").orderBy(F.desc("score"), "number")
        found = found.withColumn("rank", F.row_number().over(ranked).cast("long")).filter(F.col("rank") <= p.top_k)
    return found.select("window_end_ms", "selected_id", "rank", "candidate_id", "score")
