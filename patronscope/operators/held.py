"""Tables kept in memory and on disk while several parts of a plan or job read them."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

_held: list[DataFrame] = []


def held(df: DataFrame) -> DataFrame:
    """``df``, computed once when first read; what a lost executor held is computed again."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _held.append(df)
    return df


def release() -> int:
    """Frees all held tables of running sessions, and returns their number.

    Plans that still read one compute it again.
    """
    count = len(_held)
    while _held:
        df = _held.pop()
        if df.sparkSession.sparkContext._jsc is not None:
            df.unpersist()
    return count
