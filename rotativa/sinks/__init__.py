"""Writers: partitioned files, relational tables, prediction sets."""
