"""Profile totals that grow as files arrive.

Entries are rows ``dimension, label, amount, once``; equal entries marked ``once`` count once, however
often they come. Those of a whole user table come from :func:`profile_entries`; where logins
and purchases arrive apart from the users, :func:`user_entries`, :func:`login_entries` and
:func:`purchase_entries` make them one by one.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patronscope.functions import age_group, has_document, login_period, purchase_document
from patronscope.operators.durable import fresh_path
from patronscope.operators.logins import login_times

_TOTALS = "dimension string, label string, cnt bigint, amount decimal(38,8)"
_ACTIVE = "active_user"


def stream_files(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    glob: str | None = "part-*",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files as a stream; all files that are there make one step, unless limited.

    ``path`` is a directory or a pattern of files or directories.
    """
    reader = spark.readStream.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _entry(dimension: str, label: Column, amount: Column | None = None) -> Column:
    money = F.lit(None) if amount is None else amount.try_cast("decimal(28,8)")
    return F.struct(
        F.lit(dimension).alias("dimension"),
        label.cast("string").alias("label"),
        money.cast("decimal(28,8)").alias("amount"),
    )


def _marked(entries: DataFrame, once: bool = False) -> DataFrame:
    # a literal, so that the optimizer leaves out the branches that a filter on it excludes
    return entries.withColumn("once", F.lit(once))


def user_entries(users: DataFrame) -> DataFrame:
    """Everyone, gender, age bin and, where there is one, country."""
    entries = [
        _entry("all", F.lit("all")),
        _entry("gender", F.col("gender")),
        _entry("age_group", age_group(F.col("age"))),
    ]
    if "country" in users.columns:
        entries.append(_entry("country", F.col("country")))
    return _marked(users.select(F.inline(F.array(*entries))))


def login_entries(users: DataFrame) -> DataFrame:
    """Each login of a user of known age under ``age bin|period``."""
    aged = users.where(F.col("age").isNotNull()).withColumn("age_group", age_group(F.col("age")))
    times = login_times(aged, "age_group").where(F.col("login_time").isNotNull())
    label = F.concat_ws("|", "age_group", login_period(F.col("login_time")))
    return _marked(times.select(_entry("login", label).alias("entry")).select("entry.*"))


def purchase_entries(users: DataFrame) -> DataFrame:
    """What each purchase document spent, and, ``once`` each, the ids of active users that have one."""
    bought = users.where(has_document(F.col("purchase_history")))
    price = purchase_document(F.col("purchase_history"), "avg_price")["avg_price"]
    spent = bought.select(_entry("spent", F.lit("all"), price).alias("entry"))
    active = bought.where("is_active").select(_entry(_ACTIVE, F.col("id")).alias("entry"))
    return _marked(spent.select("entry.*")).unionByName(_marked(active.select("entry.*"), once=True))


def profile_entries(users: DataFrame) -> DataFrame:
    """All entries of a user table."""
    return (
        user_entries(users)
        .unionByName(login_entries(users))
        .unionByName(purchase_entries(users))
    )


def batch_totals(entries: DataFrame) -> DataFrame:
    """The totals of entries, or of a stream of them; one row per label.

    Of entries marked ``once`` those seen before go, and the label of the rest is ``all``.
    """
    first = entries.where("once").dropDuplicates(["dimension", "label"])
    counted = entries.where("not once").unionByName(first.withColumn("label", F.lit("all")))
    return counted.groupBy("dimension", "label").agg(
        F.count("*").alias("cnt"), F.sum("amount").cast("decimal(38,8)").alias("amount")
    )


def latest_totals(spark: SparkSession, output: str) -> DataFrame:
    """The last total of every label under ``output``; empty before the first step."""
    steps = spark.read.schema(_TOTALS + ", step bigint").option("basePath", output)
    try:
        every = steps.parquet(output)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _TOTALS)
    last = F.max_by(F.struct("cnt", "amount"), "step").alias("last")
    return every.groupBy("dimension", "label").agg(last).select("dimension", "label", "last.*")


def incremental_profile(
    entries: DataFrame, output: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Run a stream of entries to the end of the available files and return the totals.

    The totals are few rows: one per label. Every step writes those that it changed to a
    folder of its own under ``output``, named after the moment; a step that is repeated after a
    failure writes the same totals again. Which ids have been seen stays in the stream's state, spread
    over its partitions, and is never handed out. With the same ``output`` and ``checkpoint`` a
    later call continues with the files that have arrived since.
    """
    spark = entries.sparkSession
    output = output or fresh_path(spark, "profile-totals")
    checkpoint = checkpoint or fresh_path(spark, "profile-stream")

    def write_step(batch: DataFrame, _: int) -> None:
        batch.write.parquet(f"{output}/step={time.time_ns()}")

    query = (
        batch_totals(entries)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write_step)
        .start()
    )
    query.awaitTermination()
    return latest_totals(spark, output)
