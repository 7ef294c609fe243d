from tidewatch.sources.schemas import assert_schema, enforce_schema, existing_columns, numeric_columns
from tidewatch.sources.tables import (
    export_csv,
    commit_run,
    committed_runs,
    latest_run,
    path_exists,
    revoke_run,
    read_bucketed,
    read_table,
    row_audit,
    stage,
    unstage,
    write_bucketed,
    write_table,
)

__all__ = [
    "assert_schema",
    "enforce_schema",
    "existing_columns",
    "export_csv",
    "commit_run",
    "committed_runs",
    "latest_run",
    "path_exists",
    "revoke_run",
    "numeric_columns",
    "read_bucketed",
    "read_table",
    "row_audit",
    "stage",
    "unstage",
    "write_bucketed",
    "write_table",
]
