"""Reading user tables and instruction sets, describing them, writing reports."""

from patronscope.sources.readers import (
    USER_SCHEMA,
    describe_schema,
    input_name,
    preview_columns,
    require_rows,
    rows_per_file,
    scan_instructions,
    scan_part_files,
    scan_users,
)
from patronscope.sources.writers import write_json, write_one_json_object

__all__ = [
    "USER_SCHEMA",
    "describe_schema",
    "input_name",
    "preview_columns",
    "require_rows",
    "rows_per_file",
    "scan_instructions",
    "scan_part_files",
    "scan_users",
    "write_json",
    "write_one_json_object",
]
