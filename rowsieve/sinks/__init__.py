from rowsieve.sinks.files import start_append
from rowsieve.sinks.generations import generations, read_widened, register_widened
from rowsieve.sinks.tables import (
    RouteSink,
    append_table,
    compact_batches,
    ensure_database,
    overwrite_table,
    register_route,
)

__all__ = [
    "RouteSink",
    "append_table",
    "compact_batches",
    "ensure_database",
    "generations",
    "overwrite_table",
    "read_widened",
    "register_route",
    "register_widened",
    "start_append",
]
