"""File, object-store, table and database sinks."""
