"""Distances between a row's numeric columns and a point."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(values: Sequence[Column], point: Sequence[Column]) -> Column:
    return reduce(add, ((v - p) * (v - p) for v, p in zip(values, point, strict=True)))


def euclidean(values: Sequence[Column], point: Sequence[Column]) -> Column:
    return F.sqrt(squared_distance(values, point))


def nearest_center(values: Sequence[Column], centers: Sequence[Sequence[float]]) -> Column:
    """Struct ``(distance, cluster)`` of the closest centre; ties take the lower index.

    The centres are model parameters, a few rows of numbers, so they enter the
    expression as literals and assignment needs no join.
    """
    options = [
        F.struct(
            euclidean(values, [F.lit(float(c)) for c in center]).alias("distance"),
            F.lit(index).alias("cluster"),
        )
        for index, center in enumerate(centers)
    ]
    return F.array_min(F.array(*options))
