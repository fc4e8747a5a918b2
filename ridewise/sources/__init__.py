"""Sources and sinks: parquet tables, CSV/JSON I/O, domain bindings."""
