"""Table access: catalog names, file paths and the test-table stand-ins."""

from stratal.sources.tables import TEST_TABLES, LazyTables, load_tables, read_table, register_views

__all__ = ["TEST_TABLES", "LazyTables", "load_tables", "read_table", "register_views"]
