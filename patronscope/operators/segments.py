"""Named customer segments and what to do about them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronscope.operators.rfm import with_recency

# Segment names, thresholds and actions.
HIGH_VALUE = "high-value"
POTENTIAL = "potential"
AT_RISK = "at-risk"
SEGMENT_ACTIONS = {
    HIGH_VALUE: "exclusive discount",
    POTENTIAL: "promotion",
    AT_RISK: "time-limited offer",
}


@dataclass(frozen=True)
class SegmentRule:
    active_months: float = 6
    yearly_purchases: int = 12
    mean_spend: float = 8500
    inactive_months: float = 24


def segment_features(totals: DataFrame, as_of: Column) -> DataFrame:
    """``user_id, recency, yearly_purchases, mean_spend`` of users with a purchase date.

    ``totals`` comes from :func:`patronscope.operators.rfm.user_totals`.
    """
    dated = totals.where(F.col("last_purchase").isNotNull())
    mean_spend = F.coalesce(F.try_divide("monetary", "purchases"), F.lit(0.0))
    return with_recency(dated, as_of).select(
        "user_id", "recency", "yearly_purchases", mean_spend.alias("mean_spend")
    )


def rfm_segments(features: DataFrame, rule: SegmentRule = SegmentRule()) -> DataFrame:
    """Adds ``segment``: at-risk first, then high-value, everyone else potential."""
    valuable = (
        (F.col("recency") <= rule.active_months)
        & (F.col("yearly_purchases") >= rule.yearly_purchases)
        & (F.col("mean_spend") >= rule.mean_spend)
    )
    segment = (
        F.when(F.col("recency") >= rule.inactive_months, AT_RISK)
        .when(valuable, HIGH_VALUE)
        .otherwise(POTENTIAL)
    )
    return features.withColumn("segment", segment)


def segment_actions(segmented: DataFrame, actions: dict[str, str] | None = None) -> DataFrame:
    """Adds the ``action`` of each row's segment."""
    pairs = (actions or SEGMENT_ACTIONS).items()
    lookup = F.create_map(*[F.lit(text) for pair in pairs for text in pair])
    return segmented.withColumn("action", F.try_element_at(lookup, F.col("segment")))
