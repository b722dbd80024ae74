"""When users log in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.functions import (
    AGE_LABELS,
    PERIOD_LABELS,
    age_group,
    login_document,
    login_period,
)
from patronscope.operators.binned import count_bins


def parse_login(users: DataFrame, *wanted: str) -> DataFrame:
    """Adds ``login_data``, the parsed login document, or only its fields in ``wanted``."""
    return users.withColumn("login_data", login_document(F.col("login_history"), *wanted))


def login_times(users: DataFrame, *keep: str) -> DataFrame:
    """One row per login: ``user_id``, the columns named in ``keep``, ``login_time``.

    The outer generator, cut back to real positions, gives the rows of a plain
    ``explode``; a plain one makes the optimizer add size and null tests that parse
    the document two more times.
    """
    return (
        parse_login(users, "timestamps")
        .select(
            F.col("id").alias("user_id"),
            *keep,
            F.posexplode_outer("login_data.timestamps").alias("login_no", "login_time"),
        )
        .where(F.col("login_no").isNotNull())
        .drop("login_no")
    )


def with_login_period(logins: DataFrame) -> DataFrame:
    return logins.withColumn("period", login_period(F.col("login_time")))


def login_period_dist(users: DataFrame) -> DataFrame:
    """Logins per six-hour period."""
    # a login without a time has no period
    times = with_login_period(login_times(users))
    return count_bins(times, {"period": PERIOD_LABELS}, ignore_others=True)


def login_by_age_period(users: DataFrame) -> DataFrame:
    """Logins per age bin and period; users of unknown age are in no bin."""
    aged = users.where(F.col("age").isNotNull()).withColumn("age_group", age_group(F.col("age")))
    return count_bins(
        with_login_period(login_times(aged, "age_group")),
        {"age_group": AGE_LABELS, "period": PERIOD_LABELS},
        ignore_others=True,
    )


def login_heatmap(users: DataFrame) -> DataFrame:
    """Age bins as rows, periods as columns, number of logins in the cells."""
    return heatmap(login_by_age_period(users))


def heatmap(cells: DataFrame) -> DataFrame:
    """The cells of :func:`login_by_age_period` as a table, 0 where there are no logins."""
    table = cells.groupBy("age_group").pivot("period", list(PERIOD_LABELS)).agg(F.sum("cnt"))
    return table.na.fill(0)
