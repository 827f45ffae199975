"""Session defaults and materialised intermediate tables."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", app: str = "murmuration", **conf) -> SparkSession:
    """Session for tests and the bench; on a cluster the session comes from spark-submit."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in spark.checkpoint.dir.

    Where it is unset a local session gets a temporary folder. On a cluster a
    machine-local folder would not be visible to the other executors, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="murmuration-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def _run_folder(spark: SparkSession) -> str:
    app = re.sub(r"\W+", "-", spark.sparkContext.applicationId)
    return f"{checkpoint_root(spark).rstrip('/')}/murmuration/{app}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Results that still read from
    them must have been written out before."""
    Files(spark).delete(_run_folder(spark))


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder of this application that nobody else uses."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


_scratch = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that this thread writes in the block are deleted at its end.

    For work that goes on for ever, such as a micro-batch; what the block returns must not
    read from them.
    """
    outer, _scratch.paths = getattr(_scratch, "paths", None), []
    try:
        yield
    finally:
        files = Files(spark)
        for path in _scratch.paths:
            files.delete(path)
        _scratch.paths = outer


def write_table(df: DataFrame, name: str) -> str:
    """Write ``df`` as a Parquet table in the checkpoint folder; returns its path."""
    path = new_folder(df.sparkSession, name)
    if getattr(_scratch, "paths", None) is not None:
        _scratch.paths.append(path)
    df.write.parquet(path)
    return path


class Files:
    """Small files and folders in any store that Spark reads."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _open(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        place, fs = self._open(folder)
        return sorted(status.getPath().getName() for status in fs.listStatus(place)) if fs.exists(place) else []

    def read(self, path: str) -> str:
        place, fs = self._open(path)
        stream = fs.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Replace a file as a whole: readers see the old text or the new one."""
        place, fs = self._open(path)
        fresh = self._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(fresh)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self._conf).rename(
            fs.makeQualified(fresh), fs.makeQualified(place), options)

    def delete(self, path: str) -> None:
        place, fs = self._open(path)
        fs.delete(place, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` out and read it back.

    Cuts the lineage durably (a lost executor costs a re-read, not a re-run), fixes
    values that depend on the physical layout, and gives Catalyst a known size, so that
    it broadcasts the table later only if it really is small.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, name))


@contextmanager
def arrow_batches(spark: SparkSession, size: str, rows: int | None = None) -> Iterator[None]:
    """Bound of the batches that jobs of this block exchange with Python, for rows that are large."""
    bounds = {"spark.sql.execution.arrow.maxBytesPerBatch": size}
    if rows:
        bounds["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(rows)
    before = {key: spark.conf.get(key, None) for key in bounds}
    for key, value in bounds.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Rows that a task of a dealt table gets, about.
ROWS_A_TASK = 1 << 20


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by hash of ``keys``, by as many tasks as keep each near ``ROWS_A_TASK`` of its ``rows``.

    The session's number of shuffle partitions is fixed, so tasks would grow with the table.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(*keys) if rows <= ROWS_A_TASK else df.repartition(max(least, -(-rows // ROWS_A_TASK)), *keys)


def write_counting(df: DataFrame, name: str, condition: Column) -> tuple[str, int]:
    """``write_table`` that also counts the rows for which ``condition`` holds, in the same job."""
    seen = Observation()
    path = write_table(df.observe(seen, F.count_if(condition).alias("n")), name)
    return path, seen.get["n"]
