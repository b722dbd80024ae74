"""Top rows of a few large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame, group: str, order: Sequence[Column], n: int, merge_tasks: int = 256
) -> DataFrame:
    """The first ``n`` rows of each group, exactly, ranked in ``rank``.

    Groups may hold a large part of the table. The first ranking runs on the group
    split by input partition: each partition keeps ``n`` rows per group before
    anything is shuffled, and the survivors meet in up to ``merge_tasks`` tasks per
    group. The second ranking then sees at most ``n * merge_tasks`` rows of a group.
    Any split gives the same result, since the first ``n`` rows of a group are among
    the first ``n`` of each of its pieces. ``order`` must decide every tie.
    """
    pieces = df.withColumn("__piece", F.spark_partition_id() % merge_tasks)
    per_piece = Window.partitionBy(group, "__piece").orderBy(*order)
    per_group = Window.partitionBy(group).orderBy(*order)
    survivors = (
        pieces.withColumn("__place", F.row_number().over(per_piece))
        .where(F.col("__place") <= n)
        .drop("__place", "__piece")
    )
    return survivors.withColumn("rank", F.row_number().over(per_group)).where(F.col("rank") <= n)
