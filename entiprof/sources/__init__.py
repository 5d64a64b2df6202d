from entiprof.sources.sinks import materialize, write_table, write_tables
from entiprof.sources.tables import (
    DRIVER_TABLES,
    TableSet,
    has_rows,
    id_set,
    load_tables,
    read_table,
    restrict_to,
)

__all__ = [
    "DRIVER_TABLES", "TableSet", "has_rows", "id_set", "load_tables", "materialize", "read_table", "restrict_to",
    "write_table", "write_tables",
]
