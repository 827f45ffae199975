"""Tables that a ``foreachBatch`` job keeps between micro-batches, and how far its input is."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration.runtime import Files


class BatchTable:
    """A Parquet table with one partition per micro-batch, for results.

    A batch writes its own partition only and reads only earlier ones, so a batch that is
    run again after a failure finds the same input and replaces its own output.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path = spark, path
        self.schema = T.StructType.fromDDL(schema)
        self.write(self.empty(), -1, mode="ignore")

    def empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame, batch_id: int, mode: str = "overwrite") -> None:
        df.select(*self.schema.names).write.mode(mode).parquet(f"{self.path}/batch={batch_id}")

    def _all(self) -> DataFrame:
        with_batch = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        return self.spark.read.schema(with_batch).parquet(self.path)

    def before(self, batch_id: int) -> DataFrame:
        """All rows of earlier batches."""
        return self._all().filter(F.col("batch") < batch_id).drop("batch")

    def of(self, batch_id: int) -> DataFrame:
        """Rows of one batch; the folders of the others are not even listed."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch_id}")

    def everything(self) -> DataFrame:
        return self._all().drop("batch")


@dataclass(frozen=True)
class Kept:
    """A table of ``State``: rows are spread over ``buckets`` by their ``keys``. With ``latest`` a
    key's last row counts alone; ``prune`` drops rows that are of no more use when segments are merged."""

    schema: str
    keys: tuple[str, ...] = ()
    latest: bool = False
    buckets: int = 8
    prune: Callable[["State", DataFrame], DataFrame] | None = None


class State:
    """Tables as logs of segments, and notes; all change together when a batch commits.

    A batch adds segments or replaces a table by one. What belongs to the state after a batch
    stands in that batch's manifest, a small file that is switched as a whole. A batch that runs again
    starts from its predecessor's manifest and so finds what it found before.

    As soon as there are ``fanout`` segments of a size class they are merged into one of the next,
    so a table has a few segments for each power of ``fanout`` batches, and every row is rewritten as
    often as there are classes. Segments and manifests that the last batches do not need are deleted.
    """

    #: Manifests that stay: a batch can run again as long as that of its predecessor is there.
    HISTORY = 3

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Kept], fanout: int = 4):
        self.spark, self.path, self.tables, self.fanout = spark, path.rstrip("/"), tables, fanout
        self.schemas = {name: T.StructType.fromDDL(kept.schema) for name, kept in tables.items()}
        self.files = Files(spark)
        self.notes: dict = {}
        self._segments: dict[str, list] = {name: [] for name in tables}
        self.batch_id = -1

    # -- manifests

    def _manifests(self) -> list[int]:
        names = self.files.names(f"{self.path}/manifests")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _load(self, batch_id: int) -> dict:
        return json.loads(self.files.read(f"{self.path}/manifests/{batch_id}.json"))

    def begin(self, batch_id: int) -> None:
        """Go back to the state in front of a batch."""
        self.batch_id = batch_id
        earlier = [i for i in self._manifests() if i < batch_id]
        found = self._load(earlier[-1]) if earlier else {"segments": {}, "notes": {}}
        self._segments = {name: found["segments"].get(name, []) for name in self.tables}
        self.notes = found["notes"]

    def commit(self) -> None:
        """Merge segments where there are many, switch to this batch's manifest, delete what is not needed."""
        for name in self.tables:
            self._merge(name)
        self.files.write(f"{self.path}/manifests/{self.batch_id}.json",
                         json.dumps({"segments": self._segments, "notes": self.notes}))
        known = self._manifests()
        for old in [i for i in known if i <= self.batch_id][:-self.HISTORY]:
            self.files.delete(f"{self.path}/manifests/{old}.json")
            known.remove(old)
        used = {name: set() for name in self.tables}
        for i in known:
            for name, segments in self._load(i)["segments"].items():
                used.setdefault(name, set()).update(s["name"] for s in segments)
        for name in self.tables:
            for segment in set(self.files.names(f"{self.path}/{name}")) - used[name]:
                self.files.delete(f"{self.path}/{name}/{segment}")

    # -- tables

    def _bucket(self, name: str) -> Column:
        kept = self.tables[name]
        return F.pmod(F.xxhash64(*kept.keys), F.lit(kept.buckets)).cast("int") if kept.keys else F.lit(0)

    def _write(self, name: str, df: DataFrame, tier: int) -> dict:
        segment = f"segment={self.batch_id}-{tier}-{uuid.uuid4().hex}"
        # Rebalancing gives a bucket one file, and several where it is large.
        rows = df.withColumn("bucket", self._bucket(name)).hint("rebalance", F.col("bucket"))
        rows.write.partitionBy("bucket").parquet(f"{self.path}/{name}/{segment}")
        return {"name": segment, "tier": tier}

    def _raw(self, name: str, segments: Sequence[dict]) -> DataFrame:
        extra = [T.StructField("_at", T.LongType()), T.StructField("segment", T.StringType()), T.StructField("bucket", T.IntegerType())]
        schema = T.StructType([*self.schemas[name].fields, *extra])
        if not segments:
            return self.spark.createDataFrame([], schema)
        folder = f"{self.path}/{name}"
        return self.spark.read.schema(schema).option("basePath", folder).parquet(*[f"{folder}/{s['name']}" for s in segments])

    def _latest(self, name: str, df: DataFrame) -> DataFrame:
        kept = self.tables[name]
        if not kept.latest:
            return df
        rest = [c for c in self.schemas[name].names if c not in kept.keys]
        return df.groupBy(*kept.keys).agg(F.max_by(F.struct(*rest), "_at").alias("v"), F.max("_at").alias("_at")).select(
            *kept.keys, *[F.col(f"v.{c}").alias(c) for c in rest], "_at")

    def add(self, name: str, df: DataFrame) -> None:
        rows = df.select(*self.schemas[name].names, F.lit(self.batch_id).cast("long").alias("_at"))
        self._segments[name] = [*self._segments[name], self._write(name, rows, 0)]

    def replace(self, name: str, df: DataFrame) -> None:
        """The table consists of these rows, which may be read from it."""
        rows = df.select(*self.schemas[name].names, F.lit(self.batch_id).cast("long").alias("_at"))
        self._segments[name] = [self._write(name, rows, 0)]

    def read(self, name: str) -> DataFrame:
        """The table with what this batch has added so far."""
        return self._latest(name, self._raw(name, self._segments[name])).select(*self.schemas[name].names)

    def lookup(self, name: str, asked: DataFrame) -> DataFrame:
        """The rows of the keys in ``asked``, from the buckets that hold any of them."""
        kept = self.tables[name]
        keys = asked.select(*kept.keys).distinct()
        # At most as many numbers as there are buckets.
        hit = [r[0] for r in keys.select(self._bucket(name)).distinct().collect()]
        rows = self._raw(name, self._segments[name]).filter(F.col("bucket").isin(hit)).join(keys, [*kept.keys], "left_semi")
        return self._latest(name, rows).select(*self.schemas[name].names)

    def after(self, batch_id: int, name: str) -> DataFrame:
        """The table as a batch left it."""
        return self._latest(name, self._raw(name, self._load(batch_id)["segments"].get(name, []))).select(*self.schemas[name].names)

    def newest(self, name: str) -> DataFrame:
        """The table as the last batch left it."""
        known = self._manifests()
        return self.after(known[-1], name) if known else self._raw(name, []).select(*self.schemas[name].names)

    def _merge(self, name: str) -> None:
        kept = self.tables[name]
        while True:
            segments = self._segments[name]
            # Classes fall from the oldest segment to the newest, so equal ones lie side by side.
            full = [t for t in {s["tier"] for s in segments} if sum(s["tier"] == t for s in segments) >= self.fanout]
            if not full:
                return
            tier = min(full)
            merged = [s for s in segments if s["tier"] == tier]
            rows = self._latest(name, self._raw(name, merged)).select(*self.schemas[name].names, "_at")
            if kept.prune:
                rows = kept.prune(self, rows)
            made = self._write(name, rows, tier + 1)
            at = segments.index(merged[0])
            rest = [s for s in segments if s["tier"] != tier]
            self._segments[name] = [*rest[:at], made, *rest[at:]]


class Clock:
    """How far all inputs of a job are: the slowest decides, an input that has not begun holds all.

    ``delay_ms`` is how far rows of one input may be out of order. With ``idle_s`` an input without
    rows for so many seconds of real time does not hold the others any longer (off by default: rows
    that it brings afterwards may be late).
    """

    def __init__(self, inputs: Sequence[str], delay_ms: int, idle_s: float | None = None, now: Callable[[], float] = time.time):
        self.inputs, self.delay_ms, self.idle_s, self.now = list(inputs), delay_ms, idle_s, now

    def advance(self, notes: dict, newest: dict[str, int | None]) -> int | None:
        """Note the newest event of each input in a batch; the time up to which all have been seen."""
        seen, heard = notes.setdefault("newest", {}), notes.setdefault("heard", {})
        for name in self.inputs:
            heard.setdefault(name, self.now())
            if newest.get(name) is not None:
                seen[name] = max(newest[name], seen.get(name, newest[name]))
                heard[name] = self.now()
        idle = {n for n in self.inputs if self.idle_s is not None and self.now() - heard[n] > self.idle_s}
        waited = [n for n in self.inputs if n not in idle]
        if not seen or any(n not in seen for n in waited):
            return None
        return (min(seen[n] for n in waited) if waited else max(seen.values())) - self.delay_ms
