"""Counts over a fixed set of bins, empty bins included."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def bin_grid(spark: SparkSession, bins: Mapping[str, Sequence[str]]) -> DataFrame:
    """Every combination of the labels of each dimension."""
    grid = spark.range(0, 1, 1, 1).select()
    for name, labels in bins.items():
        grid = grid.select(
            "*", F.explode(F.array(*[F.lit(label) for label in labels])).alias(name)
        )
    return grid


def count_bins(
    df: DataFrame,
    bins: Mapping[str, Sequence[str]],
    count_name: str = "cnt",
    weight: str | None = None,
    others: str | None = None,
    ignore_others: bool = False,
) -> DataFrame:
    """Rows (or summed ``weight``) per combination of labels, 0 where there are none.

    The grid enters as rows of weight 0 ahead of the one aggregation, so filling the
    empty bins takes neither a join nor a second shuffle. A label that is not one of
    ``bins``, NULL included, counts under the label ``others`` where that is given, is left
    out with ``ignore_others``, and is an error otherwise.
    """
    names = list(bins)
    inside = df
    for name, labels in bins.items():
        known = F.coalesce(F.col(name).isin(*labels), F.lit(False))
        if others is not None:
            label = F.lit(others)
        elif ignore_others:
            inside, label = inside.where(known), F.col(name)
        else:
            said = F.concat(F.lit(f"no bin of {name}: "), F.coalesce(F.col(name).cast("string"), F.lit("NULL")))
            label = F.raise_error(said).cast("string")
        inside = inside.withColumn(name, F.when(known, F.col(name)).otherwise(label))
    amount = F.lit(1) if weight is None else F.col(weight)
    counted = inside.select(*names, amount.cast("bigint").alias(count_name))
    shown = {n: [*labels, others] if others and others not in labels else labels for n, labels in bins.items()}
    empty = bin_grid(df.sparkSession, shown).withColumn(count_name, F.lit(0).cast("bigint"))
    return (
        counted.unionByName(empty).groupBy(*names).agg(F.sum(count_name).alias(count_name))
    )
