"""Missing values, sparse columns, key checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from patronscope.operators.durable import fresh_path


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; NULL for an empty whole."""
    return F.try_divide(part, whole) * 100


def missing_counts(df: DataFrame) -> DataFrame:
    """NULLs and rows of every column, from one pass over the table."""
    totals = df.agg(
        F.count("*").alias("__rows"),
        *[(F.count("*") - F.count(F.col(f"`{name}`"))).alias(name) for name in df.columns],
    )
    return totals.unpivot(
        ["__rows"], [F.col(f"`{name}`") for name in df.columns], "column_name", "missing_count"
    ).select("column_name", "missing_count", F.col("__rows").alias("row_count"))


def missing_percent(df: DataFrame) -> DataFrame:
    """Share of NULLs of every column, in percent."""
    return missing_counts(df).withColumn(
        "missing_percent", percent(F.col("missing_count"), F.col("row_count"))
    )


def quality_report(df: DataFrame) -> DataFrame:
    """Column, missing count and missing percentage to two decimals."""
    return missing_percent(df).select(
        "column_name",
        "missing_count",
        F.round("missing_percent", 2).alias("missing_percent"),
    )


def drop_sparse_columns(
    df: DataFrame, threshold: float = 50.0, report: DataFrame | None = None
) -> DataFrame:
    """``df`` without the columns missing in more than ``threshold`` percent of rows.

    The remaining columns depend on the data. Without a ``report`` (from :func:`missing_percent`)
    the table is written once to the shared folder, its NULLs are counted on the way, and
    the result reads it back: however costly the table, it is built once.
    """
    if report is None:
        return _written_without_sparse(df, threshold)
    sparse = report.where(F.col("missing_percent") > threshold).select("column_name").collect()
    return df.drop(*[row.column_name for row in sparse])


def _written_without_sparse(df: DataFrame, threshold: float) -> DataFrame:
    spark = df.sparkSession
    seen = Observation(f"missing-{uuid.uuid4().hex}")
    present = [F.count(F.col(f"`{name}`")).alias(f"c{i}") for i, name in enumerate(df.columns)]
    path = fresh_path(spark, "table")
    df.observe(seen, F.count("*").alias("rows"), *present).write.parquet(path)
    rows = seen.get["rows"]
    kept = [
        name
        for i, name in enumerate(df.columns)
        if 100 * (rows - seen.get[f"c{i}"]) <= threshold * rows
    ]
    stored = spark.read.schema(df.schema).parquet(path)
    return stored.select(*[f"`{name}`" for name in kept])


def stored_missing_counts(spark: SparkSession, path: str) -> DataFrame:
    """:func:`missing_counts` of a parquet table from its footers, without reading a column.

    Columns of plain types are counted so; where one has no statistics Spark reads the table.
    """
    settings = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        df = spark.read.parquet(path)
        counts = df.agg(
            F.count("*").alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
        ).first()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    rows = [(c, counts["rows"] - counts[f"c{i}"], counts["rows"]) for i, c in enumerate(df.columns)]
    return spark.createDataFrame(rows, "column_name string, missing_count long, row_count long")


def unique_id_check(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows, distinct ids, and whether every row has its own id."""
    return df.agg(
        F.count("*").alias("total_count"),
        F.count_distinct(id_column).alias("unique_count"),
    ).withColumn("is_unique", F.col("total_count") == F.col("unique_count"))


def duplicate_ids(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Ids held by more than one row, with their number of rows."""
    counts = df.groupBy(id_column).agg(F.count("*").alias("row_count"))
    return counts.where(F.col("row_count") > 1)
