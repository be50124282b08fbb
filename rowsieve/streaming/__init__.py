from rowsieve.streaming.bronze import bronze_sink, bronze_stream, start_bronze, start_bronze_split
from rowsieve.streaming.late import SeenKeys, start_dedup_late, write_unseen
from rowsieve.streaming.silver import (
    await_end,
    register_silver,
    silver_schema,
    start_routing,
    start_routing_once,
    start_silver,
)
from rowsieve.streaming.triggers import trigger_options

__all__ = [
    "SeenKeys",
    "await_end",
    "bronze_sink",
    "bronze_stream",
    "register_silver",
    "silver_schema",
    "start_bronze",
    "start_bronze_split",
    "start_dedup_late",
    "start_routing",
    "start_routing_once",
    "start_silver",
    "trigger_options",
    "write_unseen",
]
