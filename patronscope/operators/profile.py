"""Who the users are: totals and distributions.

Distribution operators take an optional ``weight`` column, so that they also run on
:func:`demographics`, the table counted once per combination of attributes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronscope.functions import (
    AGE_LABELS,
    age_group,
    has_document,
    purchase_document,
    total_money,
)
from patronscope.operators.binned import count_bins
from patronscope.operators.quality import percent


def _tally(weight: str | None) -> Column:
    if weight is None:
        return F.count("*")
    return F.coalesce(F.sum(weight), F.lit(0)).cast("bigint")


def demographics(users: DataFrame) -> DataFrame:
    """Users per gender, age bin and country: one scan behind several distributions."""
    return with_age_group(users).groupBy("gender", "age_group", "country").agg(
        F.count("*").alias("cnt")
    )


def total_users(users: DataFrame, weight: str | None = None) -> DataFrame:
    return users.agg(_tally(weight).alias("total_users"))


def gender_dist(users: DataFrame, weight: str | None = None) -> DataFrame:
    """Users per gender; a missing gender is a group of its own."""
    return users.groupBy("gender").agg(_tally(weight).alias("cnt"))


def with_age_group(users: DataFrame, null_label: str = ">50") -> DataFrame:
    return users.withColumn("age_group", age_group(F.col("age"), null_label))


def age_dist(users: DataFrame, null_label: str = ">50", weight: str | None = None) -> DataFrame:
    """Users per age bin, empty bins included."""
    labels = list(dict.fromkeys([*AGE_LABELS, null_label]))
    if "age_group" not in users.columns:
        users = with_age_group(users, null_label)
    return count_bins(users, {"age_group": labels}, weight=weight)


def age_share(users: DataFrame, null_label: str = ">50", weight: str | None = None) -> DataFrame:
    """Users per age bin with their share to one decimal; no rows without users."""
    return _with_share(age_dist(users, null_label, weight)).where(F.col("percent").isNotNull())


def _with_share(counts: DataFrame) -> DataFrame:
    # One row per bin or per listed country reaches this window, never user rows.
    whole = F.sum("cnt").over(Window.partitionBy())
    return counts.withColumn("percent", F.round(percent(F.col("cnt"), whole), 1))


def country_counts(users: DataFrame, weight: str | None = None) -> DataFrame:
    return users.groupBy("country").agg(_tally(weight).alias("cnt"))


def country_top(users: DataFrame, n: int = 10, weight: str | None = None) -> DataFrame:
    """The ``n`` countries with the most users; ties go by name."""
    return country_counts(users, weight).orderBy(F.desc("cnt"), F.asc("country")).limit(n)


def country_share(users: DataFrame, n: int = 10, weight: str | None = None) -> DataFrame:
    """Share of each top country among the top countries, to one decimal."""
    return _with_share(country_top(users, n, weight))


def country_top_per_file(users: DataFrame, file_column: str, n: int = 10) -> DataFrame:
    """The top countries of each input file, ranked."""
    counts = users.groupBy(file_column, "country").agg(F.count("*").alias("cnt"))
    ranking = Window.partitionBy(file_column).orderBy(F.desc("cnt"), F.asc("country"))
    return counts.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= n)


def active_users(users: DataFrame) -> DataFrame:
    """Distinct ids flagged active that have a purchase document."""
    return (
        users.where(F.col("is_active") & has_document(F.col("purchase_history")))
        .select("id")
        .distinct()
    )


def total_spent(users: DataFrame) -> DataFrame:
    """Sum of the average prices of all purchase documents, 0 when there are none."""
    return users.agg(_spent().alias("total_spent"))


def _spent() -> Column:
    return total_money(purchase_document(F.col("purchase_history"), "avg_price")["avg_price"])


def profile_summary(users: DataFrame, purchases: DataFrame | None = None) -> DataFrame:
    """One row of key figures.

    ``spent_per_user`` divides by all users, ``spent_per_active_user`` by the active ones. Where
    purchases are kept apart from the users, ``purchases`` has them, with the ``id`` and
    ``is_active`` of their users; then ``users`` is only counted.
    """
    active = F.col("is_active") & has_document(F.col("purchase_history"))
    counted = F.count("*").alias("total_users")
    bought = [
        F.count_distinct(F.when(active, F.col("id"))).alias("total_active_users"),
        _spent().alias("total_spent"),
    ]
    if purchases is None:
        figures = users.agg(counted, *bought)
    else:
        total = users.agg(counted).scalar()
        figures = purchases.agg(*bought).select(total.alias("total_users"), "*")
    return figures.select(
        "*",
        F.try_divide("total_active_users", "total_users").alias("active_fraction"),
        F.try_divide("total_spent", "total_users").alias("spent_per_user"),
        F.try_divide("total_spent", "total_active_users").alias("spent_per_active_user"),
    )
