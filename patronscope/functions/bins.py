"""Labelled half-open bins over a number: ages and hours of the day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bin labels and their exclusive upper bounds.
AGE_LABELS = ("<18", "18-25", "25-35", "35-50", ">50")
AGE_BOUNDS = (18, 25, 35, 50)
PERIOD_LABELS = ("0-6clock", "6-12clock", "12-18clock", "18-24clock")
PERIOD_BOUNDS = (6, 12, 18, 24)


def bin_label(
    value: Column,
    bounds: Sequence[int],
    labels: Sequence[str],
    overflow: str | None = None,
) -> Column:
    """Label of the first bin whose exclusive upper bound lies above ``value``.

    A value above every bound, and NULL, take ``overflow`` (NULL by default).
    """
    chain = reduce(
        lambda done, step: done.when(value < step[0], step[1]),
        zip(bounds, labels),
        F,
    )
    return chain.otherwise(F.lit(overflow).cast("string"))


def age_group(age: Column, null_label: str = ">50") -> Column:
    """Age bin; 50 and above is ``>50``, and so is NULL unless it gets its own label."""
    binned = bin_label(age, AGE_BOUNDS, AGE_LABELS, overflow=AGE_LABELS[-1])
    if null_label == AGE_LABELS[-1]:
        return binned
    return F.when(age.isNull(), null_label).otherwise(binned)


def login_period(login_time: Column) -> Column:
    """Six-hour period of the day of a timestamp, NULL for NULL."""
    return bin_label(F.hour(login_time), PERIOD_BOUNDS, PERIOD_LABELS)
