"""Report sinks: Spark writes the files, no rows pass through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one file per partition, NULL fields kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_one_json_object(summary: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row summary as a single JSON file."""
    write_json(summary.coalesce(1), path, mode)
