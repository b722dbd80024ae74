"""Column expressions: everything here returns a ``Column`` and stays in the JVM."""

from patronscope.functions.bins import (
    AGE_LABELS,
    PERIOD_LABELS,
    age_group,
    bin_label,
    login_period,
)
from patronscope.functions.distance import euclidean, nearest_center, squared_distance
from patronscope.functions.documents import (
    LOGIN_FIELDS,
    PURCHASE_FIELDS,
    has_document,
    login_document,
    purchase_document,
)
from patronscope.functions.money import total_money
from patronscope.functions.recency import SECONDS_PER_MONTH, months_between_days, purchase_day

__all__ = [
    "AGE_LABELS",
    "LOGIN_FIELDS",
    "PERIOD_LABELS",
    "PURCHASE_FIELDS",
    "SECONDS_PER_MONTH",
    "age_group",
    "bin_label",
    "euclidean",
    "has_document",
    "login_document",
    "login_period",
    "months_between_days",
    "nearest_center",
    "purchase_day",
    "purchase_document",
    "squared_distance",
    "total_money",
]
