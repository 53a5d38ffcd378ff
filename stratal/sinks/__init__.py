"""Writers: partitioned files with partition-level overwrite, JDBC refresh."""

from stratal.sinks.writers import jdbc_options, refresh_jdbc, write_jdbc, write_partitioned

__all__ = ["jdbc_options", "refresh_jdbc", "write_jdbc", "write_partitioned"]
