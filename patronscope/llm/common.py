"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronscope.operators.durable import fresh_path


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did.

    A cluster whose hosts don't share that folder gets the package by ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting that removes a query's shuffle files once the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries built and run within go as soon as each has ended."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


#: What a task holds of whole texts at once: bytes of an Arrow batch (64 MB unless set) and rows that the Parquet
#: reader decodes together (4,096 unless set).
BATCH_BYTES, READ_ROWS = 2 << 20, 256
_BOUNDS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    "spark.sql.parquet.columnarReaderBatchSize": str(READ_ROWS),
}


def bound_batches(spark: SparkSession) -> list[str]:
    """Bounds the session's batches from here on, unless it sets a size itself; returns the names of what was set."""
    known = spark.conf.getAll
    names = [name for name in _BOUNDS if name not in known]
    for name in names:
        spark.conf.set(name, _BOUNDS[name])
    return names


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of the queries run within have about ``BATCH_BYTES`` and are read by ``READ_ROWS`` rows, unless the
    session sets a size itself.

    A task holds a batch several times, in the JVM and in Python; its rows may be long.
    """
    names = bound_batches(spark)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage ends there.

    The table is complete when the write has ended, so its shuffle files go at once.
    """
    path = fresh_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def free(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc32_mod(key: str, n: int) -> Column:
    """``crc32(key as text) mod n``; a NULL key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def drawn(rows: DataFrame, key: Column, n: int, known: int) -> DataFrame:
    """About ``n`` of ``known`` rows, ``2 n`` at most: those whose key has a small hash.

    Every task passes on only its share, so a draw from a large table stays small.
    """
    bound = min(1.0, n / max(known, 1))
    # a hash of the hash, as tables may be dealt by the hash itself
    place = F.xxhash64(F.xxhash64(key), F.lit(17)).bitwiseAND((1 << 32) - 1)
    return rows.where(place < int(bound * (1 << 32))).limit(2 * n)


def texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each value, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type, from_pandas=False) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def gathered(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most ``size`` rows."""
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) >= size:
            yield batch(schema, list(zip(*kept)))
            kept = []
    if kept:
        yield batch(schema, list(zip(*kept)))


def fmix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of MurmurHash3 (its two constants are fixed values)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
