from rowsieve.operators.dedup import dedup, dedup_stream, dropped_as_late
from rowsieve.operators.flatten import flatten
from rowsieve.operators.route import (
    BatchMetrics,
    count_routes,
    read_once,
    route_batch,
    route_once,
    write_once,
    write_routes,
)
from rowsieve.operators.standardize import (
    add_event_date,
    add_platform,
    enrich_ingestion,
    map_columns,
    parse_timestamp,
    rename_present,
    standardize,
)

__all__ = [
    "BatchMetrics",
    "add_event_date",
    "add_platform",
    "count_routes",
    "dedup",
    "dedup_stream",
    "dropped_as_late",
    "enrich_ingestion",
    "flatten",
    "map_columns",
    "parse_timestamp",
    "read_once",
    "rename_present",
    "route_batch",
    "route_once",
    "standardize",
    "write_once",
    "write_routes",
]
