"""starfold: layered star-schema analytics on Spark DataFrames."""

from starfold.operators import *  # noqa: F403
from starfold.operators import __all__ as _operators
from starfold.plans import CATALOG, REPORTS, Gold, Lake, open_gold, open_table, run_catalog
from starfold.session import session
from starfold.sources import (
    expire_versions,
    read_csv,
    read_dictionary,
    read_optional,
    read_table,
    register_views,
    schema_rows,
    to_pandas,
    write_csv,
    write_table,
)

__all__ = [
    *_operators,
    "CATALOG",
    "REPORTS",
    "Gold",
    "Lake",
    "expire_versions",
    "open_gold",
    "open_table",
    "read_csv",
    "read_dictionary",
    "read_optional",
    "read_table",
    "register_views",
    "run_catalog",
    "schema_rows",
    "session",
    "to_pandas",
    "write_csv",
    "write_table",
]
