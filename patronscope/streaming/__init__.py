"""Running totals over arriving files."""

from patronscope.streaming.incremental import (
    batch_totals,
    incremental_profile,
    latest_totals,
    login_entries,
    profile_entries,
    purchase_entries,
    stream_files,
    user_entries,
)

__all__ = [
    "batch_totals",
    "incremental_profile",
    "latest_totals",
    "login_entries",
    "profile_entries",
    "purchase_entries",
    "stream_files",
    "user_entries",
]
