"""Sinks: table overwrite, JDBC append, replay-safe keyed logs."""

from clickpath.sinks.keyed_log import (BATCH_COL, IncrementLog, KeyedLog, LineLog, ReplaceLog,
                                       SetLog, mkdirs, numbered_dirs)
from clickpath.sinks.tables import overwrite_table, publish, read_published, write_bucketed, write_jdbc

__all__ = ["BATCH_COL", "IncrementLog", "KeyedLog", "LineLog", "ReplaceLog", "SetLog", "mkdirs",
           "numbered_dirs", "overwrite_table",
           "publish", "read_published", "write_bucketed", "write_jdbc"]
