"""Sources and sinks."""

from starfold.sources.delimited import read_csv, read_dictionary, write_csv
from starfold.sources.tables import (
    fits,
    inspect,
    is_complete,
    read_optional,
    read_table,
    register_views,
    schema_rows,
    scratch_dir,
    stage,
    stored_rows,
    to_pandas,
    union_all,
    write_table,
)
from starfold.sources.versions import current_version, expire_versions, files_digest, input_digest, publish_version, version_paths

__all__ = [
    "current_version",
    "expire_versions",
    "files_digest",
    "fits",
    "input_digest",
    "inspect",
    "is_complete",
    "publish_version",
    "read_csv",
    "read_dictionary",
    "read_optional",
    "read_table",
    "register_views",
    "schema_rows",
    "scratch_dir",
    "stage",
    "stored_rows",
    "to_pandas",
    "union_all",
    "version_paths",
    "write_csv",
    "write_table",
]
