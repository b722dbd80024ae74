"""The whole reports: profile, RFM, key check, preview, prompts.

A job reads a user table of any size, writes its tables as JSON under one folder and
returns them as DataFrames. Tables that feed several outputs are persisted, in memory
and on disk, until ``held.release()``; what a lost executor held is computed again. The user table itself is
scanned a fixed number of times, whatever the number of files.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronscope.functions import AGE_LABELS, PERIOD_LABELS, age_group
from patronscope.operators import clusters, logins, profile, prompts, purchases, quality, rfm
from patronscope.operators.binned import count_bins
from patronscope.operators.held import held
from patronscope.operators.segments import (
    SegmentRule,
    rfm_segments,
    segment_actions,
    segment_features,
)
from patronscope.sources import require_rows, write_json, write_one_json_object

Tables = dict[str, DataFrame]
_UNKNOWN = "unknown"


def profile_tables(
    users: DataFrame,
    login_records: DataFrame | None = None,
    purchase_records: DataFrame | None = None,
    drop_sparse: bool = False,
) -> Tables:
    """Every profile table from four scans: quality, attributes, logins, key figures.

    Where logins and purchases are kept apart from the users, ``login_records`` has them
    with the ``id`` and ``age`` of their users, ``purchase_records`` with ``id`` and ``is_active``.
    With ``drop_sparse``, columns that are missing in most rows show in ``quality_report`` but
    feed no other table, and the tables that need them are left out.
    """
    report = quality.quality_report(users)
    if drop_sparse:
        report = held(report)
        users = quality.drop_sparse_columns(users, report=report)
    people = held(profile.demographics(users)) if _has(users, "gender", "age", "country") else None
    tables = {"quality_report": report}
    if people is not None:
        tables |= {
            "total_users": profile.total_users(people, weight="cnt"),
            "gender_dist": profile.gender_dist(people, weight="cnt"),
            "age_share": profile.age_share(people, weight="cnt"),
            "country_share": profile.country_share(people, weight="cnt"),
        }
    from_logins = users if login_records is None else login_records
    if _has(from_logins, "id", "age", "login_history"):
        cells = held(_login_cells(from_logins))
        known = cells.where(F.col("age_group") != _UNKNOWN)
        tables |= {
            "login_by_age_period": known,
            "login_heatmap": logins.heatmap(known),
            "login_period_dist": cells.groupBy("period").agg(F.sum("cnt").alias("cnt")),
        }
    from_purchases = users if purchase_records is None else purchase_records
    if _has(from_purchases, "id", "is_active", "purchase_history"):
        tables["profile_summary"] = profile.profile_summary(users, purchase_records)
    return tables


def _has(df: DataFrame, *columns: str) -> bool:
    return set(columns) <= set(df.columns)


def _login_cells(users: DataFrame) -> DataFrame:
    """Logins per age bin and period, with one more bin for users of unknown age."""
    binned = users.withColumn("age_group", age_group(F.col("age"), null_label=_UNKNOWN))
    times = logins.with_login_period(logins.login_times(binned, "age_group"))
    # a login without a time has no period
    bins = {"age_group": [*AGE_LABELS, _UNKNOWN], "period": PERIOD_LABELS}
    return count_bins(times, bins, ignore_others=True)


def run_profile(users: DataFrame, output: str, **options) -> Tables:
    """Writes the profile tables; the summary is one JSON object with the time taken."""
    started = time.time()
    tables = profile_tables(require_rows(users, "user table"), **options)
    for name, table in tables.items():
        if name != "profile_summary":
            write_json(table, f"{output}/{name}")
    if "profile_summary" in tables:
        summary = held(tables["profile_summary"])
        summary.count()
        seconds = F.lit(round(time.time() - started, 2)).alias("processing_seconds")
        write_one_json_object(summary.select("*", seconds), f"{output}/profile_summary")
    return tables


def rfm_tables(
    users: DataFrame,
    as_of: Column,
    k: int = 3,
    seed: int = 42,
    nearest: int = 1000,
    rule: SegmentRule = SegmentRule(),
) -> Tables:
    """Every RFM table. The documents are parsed once, into one row per user."""
    records = purchases.purchase_records(users)
    totals = held(rfm.user_totals(records, as_of))
    merged = totals.select("user_id", "last_purchase", "frequency", "monetary")
    features = rfm.rfm_features(merged, as_of)
    report = held(quality.quality_report(users))
    tables = {
        "quality_report": report,
        "rfm_user_count": merged.agg(F.count("*").alias("rfm_users")),
        "rfm_extent": rfm.rfm_extent(features),
        "segments": segment_actions(rfm_segments(segment_features(totals, as_of), rule)),
        "rfm_summary": rfm.rfm_summary(report, merged),
    }
    model = clusters.fit_clusters(features, k, seed)
    labelled = clusters.rfm_clusters(features, k, seed, model)
    tables["cluster_centers"] = clusters.cluster_centers(features, model)
    tables["user_clusters"] = clusters.user_clusters(labelled)
    if model is not None:
        tables["cluster_sizes"] = clusters.cluster_sizes(labelled)
        tables["cluster_means"] = clusters.cluster_means(labelled)
        tables["nearest_to_center"] = clusters.nearest_to_center(labelled, k, nearest)
    return tables


def run_rfm(users: DataFrame, output: str, as_of: Column, **options) -> Tables:
    """Writes the RFM tables, per-user ones in as many files as Spark has partitions."""
    started = time.time()
    tables = rfm_tables(require_rows(users, "user table"), as_of, **options)
    for name, table in tables.items():
        write_json(table, f"{output}/{name}")
    taken = users.sparkSession.createDataFrame(
        [(round(time.time() - started, 2),)], "processing_seconds double"
    )
    write_one_json_object(taken, f"{output}/run")
    return tables


def check_ids(users: DataFrame) -> Tables:
    return {
        "unique_id_check": quality.unique_id_check(users),
        "duplicate_ids": quality.duplicate_ids(users),
    }


def run_prompts(spark: SparkSession, examples: DataFrame, output: str, end_token: str) -> DataFrame:
    """Writes instruction examples with their prompt text as JSON lines."""
    write_json(prompts.prompt_format(examples, end_token), output)
    return spark.read.schema(
        "instruction string, input string, output string, text string"
    ).json(output)
