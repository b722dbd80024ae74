"""Purchase documents and the records taken from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.functions import has_document, purchase_day, purchase_document


def parse_purchase(users: DataFrame, *wanted: str) -> DataFrame:
    """Adds ``purchase_data``, the parsed document, and keeps the rows that have one.

    With names in ``wanted`` only those fields are parsed.
    """
    text = F.col("purchase_history")
    return users.where(has_document(text)).withColumn(
        "purchase_data", purchase_document(text, *wanted)
    )


def expand_purchase(users: DataFrame) -> DataFrame:
    """The fields of the purchase document as columns, NULLs where there is no document."""
    parsed = users.withColumn("purchase_data", purchase_document(F.col("purchase_history")))
    return parsed.select("id", "purchase_data.*")


def purchase_records(users: DataFrame) -> DataFrame:
    """``user_id, purchase_time, frequency, monetary``, one row per document.

    ``frequency`` is the number of items, 0 when the document names none.
    """
    return parse_purchase(users, "avg_price", "items", "purchase_date").select(
        F.col("id").alias("user_id"),
        F.col("purchase_data.purchase_date").alias("purchase_time"),
        F.coalesce(F.size("purchase_data.items"), F.lit(0)).cast("bigint").alias("frequency"),
        F.col("purchase_data.avg_price").alias("monetary"),
    )


def dated_records(records: DataFrame) -> DataFrame:
    """Purchase records with ``purchase_day`` as a date."""
    return records.withColumn("purchase_day", purchase_day(F.col("purchase_time")))
