"""Table-level operators (DataFrame -> DataFrame)."""

from aerostar.operators.tables import (
    distinct_of, drop_cols, preview, project, project_as, rename, row_count,
    schema_report, union_distinct, with_cols,
)
from aerostar.operators.clean import blank_to_null, dedupe, drop_null, drop_sentinel, fill
from aerostar.operators.keys import dense_key, hashed_key, position_key, unique_key
from aerostar.operators.joins import fits_broadcast, lookup_key
from aerostar.operators.bucketed import Bucketed, bucketed_lookup, store_bucketed
from aerostar.operators.registry import extend_keys, new_members

__all__ = [
    "project", "project_as", "with_cols", "rename", "drop_cols", "distinct_of",
    "row_count", "preview", "union_distinct", "schema_report",
    "blank_to_null", "dedupe", "drop_null", "fill", "drop_sentinel",
    "dense_key", "hashed_key", "unique_key", "position_key", "lookup_key", "fits_broadcast",
    "extend_keys", "new_members", "Bucketed", "bucketed_lookup", "store_bucketed",
]
