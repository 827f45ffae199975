"""Helpers shared by the training-data operators."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, each with a suffix where ``df`` already has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    names = []
    for want in wanted:
        tries = itertools.chain([want], (f"{want}_{i}" for i in itertools.count(1)))
        name = next(n for n in tries if n.lower() not in taken)
        taken.add(name.lower())
        names.append(name)
    return names


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z alone; other letters stay as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bucket_of(count: int, *columns: Column | str) -> Column:
    """Bucket 0 .. count-1 by a seeded hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(max(1, count))).cast("long")


def grams(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` values, by doubling."""
    if len(values) < size:
        return np.empty(0, np.uint64)
    factor = 0x9E3779B97F4A7C15
    h, done = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), 1
    while done < size:
        step = min(done, size - done)
        h = h[:len(h) - step] * np.uint64(factor) + (h[step:] ^ (h[step:] >> np.uint64(29)))
        done += step
        factor = (factor * factor + 2 * step + 2) % (1 << 64)
    return h ^ (h >> np.uint64(32))


def crc32_mod(column: Column | str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``; null counts as empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


@contextmanager
def arrow_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Bound of the batches that jobs of this block exchange with Python, for rows that are large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose DataFrames are gone: it does so when the
    driver's JVM collects its garbage, which a driver with little to do puts off."""
    spark._jvm.System.gc()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application.

    Workers that were started with it (``--py-files``, PYTHONPATH) get the same code again;
    without this, a driver that found it on its own path alone would fail in the workers.
    """
    import tempfile
    import zipfile
    from pathlib import Path

    import murmuration

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(murmuration.__file__).parent
    if root.is_dir():  # else it already runs from a shipped archive
        archive = Path(tempfile.mkdtemp(prefix="murmuration-")) / "murmuration-src.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
