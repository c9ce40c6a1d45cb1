"""DuckDB oracle SQL for the driver correctness check (not part of the library)."""
