"""Sums of money that don't depend on the order of their terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total_money(amount: Column) -> Column:
    """Aggregate: the sum as a double, added up as a decimal; 0 without any amount.

    Amounts of 10 ** 20 and more, and what is not finite, are no money and count as NULL.
    """
    return F.coalesce(F.sum(amount.try_cast("decimal(28,8)")).cast("double"), F.lit(0.0))
