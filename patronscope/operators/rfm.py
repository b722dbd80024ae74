"""Recency, frequency and monetary value per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronscope.functions import months_between_days, total_money
from patronscope.operators.purchases import dated_records

RFM_COLUMNS = ("recency", "frequency", "monetary")


def rfm_merge_users(records: DataFrame) -> DataFrame:
    """Last purchase day, summed frequency and summed spending of each user.

    NULLs are skipped; a user without any price has spent 0, a user without any
    readable date has a NULL ``last_purchase``. Money is summed as a decimal. The sums are combined per partition
    before the shuffle, so a user with very many records is no hot spot.
    """
    return dated_records(records).groupBy("user_id").agg(*_merged_columns())


def _merged_columns() -> list[Column]:
    return [
        F.max("purchase_day").alias("last_purchase"),
        F.coalesce(F.sum("frequency"), F.lit(0)).alias("frequency"),
        total_money(F.col("monetary")).alias("monetary"),
    ]


def user_totals(records: DataFrame, as_of: Column) -> DataFrame:
    """:func:`rfm_merge_users` with the counts that segments need, from the same pass.

    A purchase is a record that has a price; ``yearly_purchases`` counts those in the
    12 months before ``as_of``.
    """
    year_start = F.add_months(as_of.cast("date"), -12)
    in_year = F.col("monetary").isNotNull() & (F.col("purchase_day") >= year_start)
    return dated_records(records).groupBy("user_id").agg(
        *_merged_columns(),
        F.count("monetary").alias("purchases"),
        F.count_if(in_year).alias("yearly_purchases"),
    )


def with_recency(merged: DataFrame, as_of: Column) -> DataFrame:
    """Adds ``recency``, the months from ``last_purchase`` to ``as_of``."""
    return merged.withColumn("recency", months_between_days(F.col("last_purchase"), as_of))


def rfm_features(merged: DataFrame, as_of: Column) -> DataFrame:
    """``user_id, recency, frequency, monetary`` of the users with a purchase date."""
    dated = merged.where(F.col("last_purchase").isNotNull())
    return with_recency(dated, as_of).select("user_id", *RFM_COLUMNS)


def rfm_user_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count_distinct("user_id").alias("rfm_users"))


def rfm_extent(features: DataFrame) -> DataFrame:
    """Smallest and largest value of each feature."""
    return features.agg(
        *[f(name).alias(f"{label}_{name}")
          for name in RFM_COLUMNS
          for label, f in (("min", F.min), ("max", F.max))]
    )


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``<column>_mean`` and ``<column>_scale`` of each column.

    The scale is the population standard deviation, or 1 for a constant column.
    """
    return df.agg(
        *[F.avg(name).alias(f"{name}_mean") for name in columns],
        *[_scale(name).alias(f"{name}_scale") for name in columns],
    )


def _scale(name: str) -> Column:
    deviation = F.stddev_pop(name)
    return F.when(deviation > 0, deviation).otherwise(1.0)


def standardize(df: DataFrame, columns: Sequence[str] = RFM_COLUMNS) -> DataFrame:
    """The columns shifted to mean 0 and scaled to population deviation 1.

    The statistics are one row of doubles, used as a scalar subquery: ``df`` is read twice, so
    hold it if it is costly.
    """
    stats = column_stats(df, columns)
    # one column, so that the plan has the subquery once and not once for each number
    one_row = stats.select(F.struct(*stats.columns)).scalar()
    shifted = {
        name: (F.col(name) - F.col(f"__stats.{name}_mean")) / F.col(f"__stats.{name}_scale")
        for name in columns
    }
    return df.withColumn("__stats", one_row).withColumns(shifted).drop("__stats")


def rfm_summary(report: DataFrame, merged: DataFrame) -> DataFrame:
    """Missing-value report and per-user RFM rows as one table with a ``section``."""
    missing = report.select(
        F.lit("missing").alias("section"),
        F.col("column_name").alias("name"),
        "missing_count",
        "missing_percent",
    )
    users = merged.select(
        F.lit("rfm").alias("section"),
        F.col("user_id").cast("string").alias("name"),
        F.date_format("last_purchase", "yyyy-MM-dd").alias("last_purchase"),
        "frequency",
        "monetary",
    )
    return missing.unionByName(users, allowMissingColumns=True)
