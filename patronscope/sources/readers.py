"""Scans of whole directories, and small looks at what was scanned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The columns of the user table and the file name prefix of its parts.
USER_SCHEMA = (
    "id bigint, gender string, age int, country string, income double, "
    "is_active boolean, last_login string, login_history string, purchase_history string"
)
PART_GLOB = "part-*"


def scan_users(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | StructType | None = None,
    glob: str | None = None,
) -> DataFrame:
    """A parquet file, several, or a whole directory as one DataFrame.

    Without ``schema`` the columns come from the parquet footers. ``glob`` keeps only
    the files whose names match.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def scan_part_files(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    glob: str | None = PART_GLOB,
) -> DataFrame:
    """Every part file of a directory; other files in it are ignored.

    ``path`` may be a pattern; without ``glob`` all files that it finds are read.
    """
    return scan_users(spark, path, schema, glob)


def input_name() -> Column:
    """Of each scanned row the parquet table it is from: one file, or a folder of part files."""
    path = F.col("_metadata.file_path")
    return F.regexp_extract(path, r"([^/]+\.parquet)(/[^/]*)?$", 1)


def rows_per_file(scanned: DataFrame, name: Column | None = None) -> DataFrame:
    """Rows read from each file of a scan, or from each ``name`` given. Call it on the scan itself."""
    name = F.col("_metadata.file_name") if name is None else name
    return scanned.groupBy(name.alias("file_name")).agg(F.count("*").alias("row_count"))


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and whether it may be NULL."""
    rows = [
        (position, field.name, field.dataType.simpleString(), field.nullable)
        for position, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, column_type string, nullable boolean"
    )


def preview_columns(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str] = ("id",), rows: int = 5
) -> DataFrame:
    """The first rows of some columns, in a stated order.

    The first of ``order_by`` alone tells which keys can be shown; the other columns, costly
    documents perhaps, are built for the rows of those keys only.
    """
    shown = list(dict.fromkeys([*order_by, *columns]))
    key = F.col(shown[0])
    last = df.select(shown[0]).orderBy(shown[0]).limit(rows).agg(F.max(shown[0])).scalar()
    # NULL keys come first
    return df.select(*shown).where(key.isNull() | (key <= last)).orderBy(*shown).limit(rows)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """The same DataFrame, or ``ValueError`` when it has no rows."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def scan_instructions(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Instruction examples from JSON lines or parquet, as three text columns."""
    reader = spark.read.schema("instruction string, input string, output string")
    return reader.format(file_format).load(path)
